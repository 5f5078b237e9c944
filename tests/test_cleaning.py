import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from registra.functions import paths as P
from registra.functions.cleaning import digits_to_int, kind_label, text_equals

EDGES = {
    "": None,
    "abc": None,
    "0": 0,
    "000": 0,
    "07107": 7107,
    "71-07": 7107,
    " 7107": 7107,
    "7107 ": 7107,
    "-7": 7,
    "+7": 7,
    "1.5": 15,
    "99999999999": None,
    "2147483647": 2147483647,
    "2147483648": None,
    "000002147483647": 2147483647,
    "9" * 400: None,
    "123\n": 123,
    "123\x85": 123,
    "١٢٣": None,
}


def by_hand(text):
    digits = re.sub("[^0-9]", "", text)
    return int(digits) if digits and int(digits) < 2**31 else None


def cleaned(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = rows.select("i", digits_to_int(F.col("t")).alias("n")).collect()
    return [r["n"] for r in sorted(out)]


def test_edges(spark):
    assert cleaned(spark, list(EDGES)) == list(EDGES.values())
    assert cleaned(spark, [None]) == [None]


def test_whole_long_texts(spark):
    texts = ["a" * 200_000 + "7", "0" * 200_000 + "7", "1 " * 100_000, "x0" * 100_000, "é\n" * 100_000]
    assert cleaned(spark, texts) == [7, 7, None, 0, None]


def test_edges_without_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert cleaned(spark, list(EDGES)) == list(EDGES.values())
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.sampled_from("0123456789 -.aS\n\x85é"), max_size=16), max_size=40))
def test_digits_by_hand(spark, texts):
    texts = texts + ["7"]
    assert cleaned(spark, texts) == [by_hand(t) for t in texts]


def test_text_equals_is_the_cast_comparison(spark):
    df = spark.createDataFrame(
        [(7, 7, "7", 7.0, True), (-7, 70, "07", 0.7, False), (None, None, None, None, None)],
        "a int, b long, c string, d double, e boolean",
    )
    for value in ("7", "-7", "07", "+7", "7.0", "true", "", "99999999999", "-0"):
        for f in df.schema.fields:
            ours = text_equals(F.col(f.name), f.dataType, value)
            plain = F.col(f.name).cast("string") == value
            assert df.filter(~ours.eqNullSafe(plain)).count() == 0, (value, f.name)


def test_kind_label(spark):
    flags = spark.createDataFrame([("1",), ("2",), ("9",), (None,)], "k string")
    labels = kind_label(F.col("k"), {"1": "matriz", "2": "filial"})
    got = [r[0] for r in flags.select(labels).collect()]
    assert got == ["matriz", "filial", "unknown", "unknown"]


def test_paths(spark):
    df = spark.createDataFrame(
        [("s3a://b/estabelecimentos_2025-12/E0.zip", 3 * 2**20 - 1), ("x/loose.zip.tmp", 0)],
        "path string, length long",
    )
    path = F.col("path")
    got = df.select(
        P.dataset(path), P.ref_month(path), P.file_name(path), P.folder(path),
        P.whole_mib(F.col("length")), P.in_progress(path),
    ).collect()
    assert tuple(got[0]) == (
        "estabelecimentos", "2025-12", "E0.zip", "s3a://b/estabelecimentos_2025-12", 2, False
    )
    assert tuple(got[1]) == (None, None, "loose.zip.tmp", "x", 0, True)
