import itertools
import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash

from registra.llm import simhash
from registra.llm.components import _star, components
from registra.llm.simhash import (
    covering_masks,
    drop_near_copies,
    fingerprint,
    forest,
    links,
    simhash_components,
)
from tests.llm.cases import edge_docs


def plain_fingerprint(text, size):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in words.replace("\t", " ").replace("\n", " ").replace("\r", " ")
             .replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if ones[b] * 2 > len(shingles))


def plain_components(prints):
    ids = list(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(ids, 2):
        if (prints[a] ^ prints[b]).bit_count() <= 3:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: find(i) for i in ids}


def test_fingerprint_matches_the_definition(monkeypatch):
    monkeypatch.setattr(simhash, "SLICE", 3)
    texts = ["", None, "one", "one two", "One TWO three", "a b c d", "a  b\tc\nd e f g h i j k",
             "é É ü漢 x y z w", " \x1c a b"]
    for text in texts:
        for size in (1, 3, 5):
            assert fingerprint(text, size) % 2**64 == plain_fingerprint(text, size)


def test_whole_table_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    table = pq.read_table(f"{sf}/documents.parquet").to_pylist()
    prints = {r["doc_id"]: plain_fingerprint(r["text"], 3) for r in table}
    expected = plain_components(prints)
    got = simhash_components(spark.read.parquet(f"{sf}/documents.parquet"), shingle=3).collect()
    assert {r.doc_id: r.fingerprint for r in got} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r.doc_id: r.component_id for r in got} == expected


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover_every_set_of_bits(radius):
    positions = random.Random(1).sample(range(64), 16)
    masks = covering_masks(positions, radius)
    for bits in itertools.combinations(positions, radius):
        assert any(not any(m >> b & 1 for b in bits) for m in masks)


@pytest.mark.parametrize("bucket", [4096, 2])
def test_links_lose_none(spark, bucket):
    rnd = random.Random(5)
    centres = [rnd.getrandbits(64) for _ in range(6)]
    prints = set(centres)
    for c in centres:
        for _ in range(60):
            x = c
            for b in rnd.sample(range(64), rnd.randint(1, 6)):
                x ^= 1 << b
            prints.add(x)
    signed = [p - 2**64 if p >> 63 else p for p in prints]
    frame = spark.createDataFrame(pa.table({"fp": pa.array(signed, pa.int64())}))
    found = links(frame, 3, bucket).collect()
    assert all((r.a % 2**64 ^ r.b % 2**64).bit_count() <= 3 for r in found)
    joined = {r.node: r.root for r in components(links(frame, 3, bucket)).collect()}
    expected = plain_components({s: s % 2**64 for s in sorted(signed)})
    assert {s: joined.get(s, s) for s in signed} == expected


def test_forest_is_no_longer_than_its_bucket():
    values = np.arange(8, dtype=np.int64)
    assert len(forest(values, 3)) == 7


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 130)] + [(200, 200)]
    table = pa.table({"a": [a for a, _ in edges], "b": [b for _, b in edges]})
    got = {r.node: r.root for r in components(spark.createDataFrame(table)).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {i: 100 for i in range(101, 130)}


def test_edges(spark):
    got = simhash_components(edge_docs(spark), shingle=3).collect()
    assert len(got) == 12
    blank = {str(r.doc_id): r for r in got if r.fingerprint == "0" * 16}
    assert set(blank) == {"3", "4", "5", "None"}
    assert {r.component_id for r in blank.values()} == {3}
    assert {r.component_id for r in got if r.doc_id in (1, 2)} == {1}
    kept = drop_near_copies(edge_docs(spark), shingle=3)
    assert kept.columns == edge_docs(spark).columns
    ids = [str(r.doc_id) for r in kept.collect()]
    assert ids.count("1") == 1 and "2" not in ids and ids.count("None") == 2
    assert simhash_components(edge_docs(spark, [])).collect() == []
    with pytest.raises(ValueError):
        simhash_components(edge_docs(spark), radius=4)


def test_a_hub_and_a_path_leave_one_table(spark):
    """A node with most edges, and a path of 300 nodes: one folder is left of all rounds."""
    root = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = {*root.glob("stars-*"), *root.glob("smallest-*")}
    edges = spark.range(20_000).selectExpr("id + 1000 as a", "500000 as b").unionAll(
        spark.range(300).selectExpr("id as a", "id + 1 as b")
    )
    got = {r.node: r.root for r in components(edges).collect()}
    assert len(got) == 20_000 + 300 and got[500_000] == 1000 and got[300] == 0
    assert set(got.values()) == {0, 1000}
    assert len({*root.glob("stars-*"), *root.glob("smallest-*")} - before) == 1


def test_a_star_is_written_with_its_smallest_neighbours(spark):
    edges = spark.range(2000).selectExpr("id + 1 as a", "0 as b")
    star, folders = _star(edges, large=True)
    assert len(folders) == 2 and star.count() == 2000
    assert {(r.a, r.b) for r in star.collect()} == {(0, i + 1) for i in range(2000)}
