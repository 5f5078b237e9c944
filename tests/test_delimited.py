import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from samples import FACTS, LOOKUP, LOOKUP_REPEATS, write_text

from registra.config import LOOKUP_SCHEMA, text_schema
from registra.operators.columns import rename_positional, sample_rows
from registra.operators.lookup import clean_lookup
from registra.sources.delimited import read_delimited, read_facts, read_lookup


def test_lookup(spark, tmp_path):
    folder = write_text(tmp_path / "m", "M.csv", LOOKUP)
    assert read_lookup(spark, folder).schema == LOOKUP_SCHEMA
    rows = clean_lookup(read_lookup(spark, folder)).collect()
    assert set(map(tuple, rows)) == {(7107, "SÃO PAULO"), (1, "X;Y"), (None, "BAD")}


def test_lookup_with_surplus_and_missing_fields(spark, tmp_path):
    folder = write_text(tmp_path / "m", "M.csv", LOOKUP + LOOKUP_REPEATS)
    rows = clean_lookup(read_lookup(spark, folder)).filter("municipio_cod = 7107").collect()
    assert {r["municipio_nome"] for r in rows} == {"SÃO PAULO", "DUP", None}


def test_schemaless_facts(spark, tmp_path):
    folder = write_text(tmp_path / "e", "E", "".join(FACTS))
    facts = read_facts(spark, folder + "/*")
    assert facts.columns == [f"_c{i}" for i in range(21)]
    assert {t for _, t in facts.dtypes} == {"string"}
    assert facts.count() == 11
    padded = facts.filter("_c0 = '4'").first()
    assert padded["_c20"] == " 7107" and padded["_c1"] is None
    assert facts.filter("_c0 = '10'").select("_c2", "_c20").first() == ("y", None)


def test_given_width_overrides_what_a_file_says(spark, tmp_path):
    write_text(tmp_path / "e", "a", "1;2\n" * 50)
    folder = write_text(tmp_path / "e", "b.txt", "1;2;3\n")
    assert sorted(r["_c2"] or "" for r in read_facts(spark, folder, 3).collect())[-1] == "3"
    named = read_facts(spark, folder, ["id", "value"])
    assert named.columns == ["id", "value"] and named.count() == 51


def test_all_files_of_a_folder_but_hidden_ones(spark, tmp_path):
    write_text(tmp_path / "e", "one.csv", "1;a\n")
    write_text(tmp_path / "e", "two", "2;b\n")
    write_text(tmp_path / "e", "_three", "3;c\n")
    folder = write_text(tmp_path / "e", ".four", "4;d\n")
    write_text(tmp_path / "e" / "sub", "five", "5;e\n")
    ids = sorted(r["_c0"] for r in read_facts(spark, folder + "/*", 2).collect())
    assert ids == ["1", "2", "5"]


def test_missing_input(spark, tmp_path):
    absent = str(tmp_path / "absent")
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_lookup(spark, absent)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_facts(spark, absent + "/*", 21)
    empty = read_lookup(spark, absent + "/*", on_missing="empty")
    assert empty.schema == LOOKUP_SCHEMA and empty.isEmpty()
    with pytest.raises(ValueError):
        read_delimited(spark, absent, on_missing="ignore")


def test_renames_and_samples(spark):
    df = spark.createDataFrame([("1", "a"), ("2", "b")], text_schema(2))
    assert rename_positional(df, ["id", "name"]).columns == ["id", "name"]
    assert rename_positional(df, {"_c1": "name"}).columns == ["_c0", "name"]
    assert sample_rows(df, 1).count() == 1
    assert sample_rows(df.orderBy(F.desc("_c0")), 1, ["_c0"]).first()["_c0"] == "1"
