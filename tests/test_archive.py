import io
import json
import os
import random
import subprocess
import sys
import zipfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle
from pyspark.sql import functions as F
from samples import FACTS, LOOKUP, write_month, write_text, write_zip

from registra.catalogue.storage import scan_archive_all_names
from registra.config import LOOKUP_SCHEMA, text_schema
from registra.sources import archive as A
from registra.sources.delimited import parse_lines, read_facts, width_of
from registra.sources.listing import list_objects


def lines_of(data: bytes) -> list[str]:
    return [line.decode("iso-8859-1") for line in data.splitlines()]


def sliced(data: bytes, cuts: list[int]) -> list[str]:
    edges = sorted({0, len(data), *[c for c in cuts if c < len(data)]})
    out = []
    for start, end in zip(edges, edges[1:]):
        stream = io.BytesIO(data)
        stream.seek(max(start - 1, 0))
        for block in A._line_blocks(stream, start, end):
            out += A._split(block, "iso-8859-1")
    return out


@settings(max_examples=400, deadline=None)
@given(
    st.binary(max_size=60).map(lambda b: bytes(b"ab\r\n\x85"[x % 5] for x in b)),
    st.lists(st.integers(1, 60), max_size=6),
    st.integers(1, 9),
)
def test_slices_give_every_line_once(data, cuts, block):
    A.BLOCK, kept = block, A.BLOCK
    try:
        assert sliced(data, cuts) == lines_of(data)
    finally:
        A.BLOCK = kept


@pytest.mark.parametrize("method", [zipfile.ZIP_DEFLATED, zipfile.ZIP_STORED])
def test_large_member_is_read_by_several_tasks(spark, tmp_path, method):
    body = "".join(f'"{i}";"São {i}"\r\n' for i in range(50_000))
    path = write_zip(tmp_path / "big.zip", {"m": body}, method)
    lines = A.read_archives(spark, path, sliceBytes=str(100_000), partitionBytes="0")
    expected = -(-len(body.encode("iso-8859-1")) // 100_000)
    assert lines.rdd.getNumPartitions() == expected
    rows = parse_lines(lines, text_schema(2))
    stats = rows.agg(F.count("*"), F.countDistinct("_c0"), F.sum(F.col("_c0").cast("long"))).first()
    assert tuple(stats) == (50_000, 50_000, sum(range(50_000)))
    assert rows.filter("_c1 != concat('São ', _c0)").isEmpty()


def test_compressed_slices_are_bounded_and_whole(tmp_path):
    path = write_zip(tmp_path / "a.zip", {"m": b"x\n" * 10_000})
    [member] = A.members_of(path)
    slices = A.slices_of(member, 100, A.INFLATE_SLICES)
    assert 1 < len(slices) <= A.INFLATE_SLICES
    assert slices[0].start == 0 and slices[-1].end == 20_000
    assert all(a.end == b.start for a, b in zip(slices, slices[1:]))


def test_archives_of_a_month(spark, tmp_path):
    root = write_month(tmp_path / "bronze")
    lines = A.read_archives(spark, f"{root}/estabelecimentos_2025-12")
    assert lines.columns == ["archive", "member", "line"]
    assert lines.rdd.getNumPartitions() == 3
    assert lines.count() == 11
    got = parse_lines(lines.select("line"), text_schema(21))
    plain = read_facts(spark, write_text(tmp_path / "plain", "f.csv", "".join(FACTS)), 21)
    assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()


def test_listing_route_gives_the_same_lines(spark, tmp_path):
    root = write_month(tmp_path / "bro nze%20#1")
    folder = f"{root}/estabelecimentos_2025-12"
    direct = A.read_archives(spark, folder).select("member", "line")
    listed = A.expand_archives(list_objects(spark, folder), 4).select("member", "line")
    assert sorted(direct.collect()) == sorted(listed.collect())


def test_member_conflict(spark, tmp_path):
    write_zip(tmp_path / "E0.zip", {"part0": "a\n", "only0": "b\n"})
    write_zip(tmp_path / "E1.zip", {"part0": "c\nd\n"})
    both = A.read_archives(spark, str(tmp_path))
    assert sorted(r.line for r in both.collect()) == ["a", "b", "c", "d"]
    last = A.read_archives(spark, str(tmp_path), memberConflict="last")
    assert sorted(r.line for r in last.collect()) == ["b", "c", "d"]


def test_line_ends_and_blank_lines_as_in_a_file_scan(spark, tmp_path):
    body = 'a;b\rc;d\r\ne;\x85f\n\n   \ng;"h\n"";k;\n'
    folder = write_text(tmp_path / "plain", "f", body)
    write_zip(tmp_path / "z" / "f.zip", {"f": body})
    plain = read_facts(spark, folder, 2)
    lines = A.read_archives(spark, str(tmp_path / "z"))
    got = parse_lines(lines.select("line"), text_schema(2))
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    assert got.count() == 5


@pytest.mark.parametrize("seed", range(4))
def test_random_text_reads_as_from_a_file(spark, tmp_path, seed):
    pick = random.Random(seed)
    body = "".join(pick.choices('12ab;;""\\ é\x85\t\r\n\n', k=20_000)) + "\n"
    folder = write_text(tmp_path / "plain", "f", body)
    write_zip(tmp_path / "z" / "f.zip", {"f": body})
    plain = read_facts(spark, folder, 4)
    lines = A.read_archives(spark, str(tmp_path / "z"), sliceBytes="1500", partitionBytes="0")
    got = parse_lines(lines.select("line"), text_schema(4))
    assert got.count() == plain.count() > 1000
    assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()


def test_hidden_members_and_folders_are_passed_over(spark, tmp_path):
    write_zip(
        tmp_path / "a.zip",
        {"__MACOSX/x": "no\n", ".hidden": "no\n", "_x": "no\n", "sub/": "", "sub/m": "yes\n"},
    )
    assert [r.line for r in A.read_archives(spark, str(tmp_path)).collect()] == ["yes"]


def test_missing_archives(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    for folder in ("empty", "absent"):
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            A.read_archives(spark, str(tmp_path / folder)).count()
        lines = A.read_archives(spark, str(tmp_path / folder), onMissing="empty")
        assert parse_lines(lines, LOOKUP_SCHEMA).count() == 0


def test_empty_and_damaged_archives(spark, tmp_path):
    write_zip(tmp_path / "ok" / "a.zip", {"nothing": "", "m": "x"})
    assert A.read_archives(spark, str(tmp_path / "ok")).count() == 1
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "a.zip").write_bytes(b"not a zip")
    with pytest.raises(Exception, match="zip"):
        A.read_archives(spark, str(tmp_path / "bad")).count()


def test_repeated_names_in_one_archive(spark, tmp_path):
    path = tmp_path / "a.zip"
    with zipfile.ZipFile(path, "w") as z, pytest.warns(UserWarning, match="Duplicate"):
        z.writestr("m", "old\n")
        z.writestr("m", "new\n")
    assert [r.line for r in A.read_archives(spark, str(path)).collect()] == ["new"]


def test_small_members_share_tasks(spark, tmp_path):
    for i in range(40):
        write_zip(tmp_path / f"{i:02}.zip", {f"m{i}": f"{i}\n" * 10})
    packed = A.read_archives(spark, str(tmp_path))
    assert packed.rdd.getNumPartitions() <= 16
    apart = A.read_archives(spark, str(tmp_path), partitionBytes="0")
    assert apart.rdd.getNumPartitions() == 40
    assert packed.count() == apart.count() == 400


def test_format_options(spark, tmp_path):
    write_zip(tmp_path / "u.zip", {"m": "São\n".encode()})
    A.read_archives(spark, str(tmp_path), onMissing="empty")
    by_name = spark.read.format("ziplines").option("encoding", "utf-8").load(str(tmp_path))
    assert [r.line for r in by_name.collect()] == ["São"]
    many = spark.read.format("ziplines").option("paths", json.dumps([str(tmp_path)] * 2)).load()
    assert many.count() == 2


def test_width_comes_from_the_largest_member(spark, tmp_path):
    write_zip(tmp_path / "a.zip", {"narrow": "1;2\n"})
    write_zip(tmp_path / "b.zip", {"wide": "\n" + '"1";"2;x";3\n' * 100})
    line = A.first_line(spark, str(tmp_path))
    assert width_of(spark, line) == 3
    assert width_of(spark, FACTS[0].strip()) == 21


def test_reader_travels_without_an_installed_package(tmp_path):
    """What Spark sends to a worker must run where this package cannot be imported."""
    write_zip(tmp_path / "a.zip", {"m": "x\ny\n"})
    A.ship_package()
    reader = A.ZipLinesSource({"path": str(tmp_path)}).reader(A.LINES_SCHEMA)
    (tmp_path / "reader").write_bytes(cloudpickle.dumps(reader))
    code = (
        "import pickle; r = pickle.load(open('reader', 'rb'));"
        "print(sum(b.num_rows for p in r.partitions() for b in r.read(p)));"
        "import importlib.util; print(importlib.util.find_spec('registra'))"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True
    )
    assert out.stdout.split() == ["2", "None"], out.stderr


def test_lookup_member(spark, tmp_path):
    write_zip(tmp_path / "M.zip", {"M": LOOKUP})
    lines = A.read_archives(spark, str(tmp_path)).select("line")
    rows = sorted(map(tuple, parse_lines(lines, LOOKUP_SCHEMA).collect()))
    assert rows == [("0001", "X;Y"), ("7107", "SÃO PAULO"), ("abc", "BAD")]


def test_names_of_archives_are_not_worked_out_by_line(spark, tmp_path):
    rows = spark.range(90).selectExpr("id as l_orderkey", "cast(id % 7 as int) as l_linenumber")
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    found = scan_archive_all_names(spark, str(tmp_path))
    # From the result down to the lines.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    _, counted, below = plan.rpartition("Aggregate [archive#")
    assert counted and "regexp_extract" in plan
    assert "regexp_extract" not in below.partition("\n")[2]
    assert {r["name"]: r["n"] for r in found.collect()} == {"_hidden": 39, ".dotted": 26, "plain": 25}
