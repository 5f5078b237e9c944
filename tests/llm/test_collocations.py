"""Phrases against counting by text."""

import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from registra.llm import collocations as module
from registra.llm.collocations import (
    _ENTRY,
    MORE,
    Adder,
    KeyAdder,
    Ranges,
    _from_planes,
    _key_slices,
    _packed,
    _parts,
    _unpacked,
    added_up,
    bit_map,
    chunked,
    collocations,
    frequent_phrases,
    has_bit,
    maybe_frequent,
    normalised,
)
from tests.llm.cases import ROWS, edge_docs

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    text = (text or "").translate(LOWER).translate(dict.fromkeys(map(ord, ".,;:!?\n\x0b\x0c\r"), "\n"))
    found = [[w for w in p.replace("\t", " ").split(" ") if w] for p in text.split("\n")]
    return [p for p in found if p]


def plain_counts(rows, longest=4):
    counts = defaultdict(Counter)
    for text, lang in rows:
        for p in pieces(text):
            for k in range(1, longest + 1):
                counts[lang or "und"].update(" ".join(p[i : i + k]) for i in range(len(p) - k + 1))
    return counts


def plain(rows, longest=4, least=30, covered=80, scale=2_000_000, top=2000):
    out = []
    for lang, f in plain_counts(rows, longest).items():
        n = sum(c for w, c in f.items() if " " not in w)
        candidates = {p: a for p, a in f.items() if a >= least and " " in p}
        ranked = []
        for p, a in candidates.items():
            w = p.split(" ")
            cuts = []
            for k in range(1, len(w)):
                left, right = f[" ".join(w[:k])], f[" ".join(w[k:])]
                cuts.append((scale * a // (left + right), k, left, right))
            score, _, left, right = min(cuts)
            inside = f" {p} "
            if not any(len(q) > len(p) and inside in f" {q} " and 100 * b >= covered * a
                       for q, b in candidates.items()):
                ranked.append((-score, -a, p.encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return sorted(out)


def found(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


def docs(spark, rows):
    return edge_docs(spark, [(i, t, g) for i, (t, g) in enumerate(rows)])


def prose(seed, count, words=12):
    rng = random.Random(seed)
    vocabulary = ["a", "der", "é", "New", "York", "漢字", "x-1", "the", "\x00", "no break", "of", "to"][:words]
    ends = [" ", "  ", "\t", ". ", ",", "\n", " \r\n ", "! ", " "] + [" "] * 20
    rows = []
    for _ in range(count):
        text = "".join(rng.choice(vocabulary) + rng.choice(ends) for _ in range(rng.randint(0, 60)))
        rows.append((rng.choice(["", " ", "\n"]) + text, rng.choice(["en", "fr", None, "und"])))
    return rows + [("kick the bucket. " * 40, "en"), ("in spite of it all", "fr")] * 7 + [("in spite of", "fr")] * 40


@pytest.mark.parametrize("options", [{}, {"top": 5, "least": 10}, {"longest": 2}, {"covered": 50, "least": 3}])
def test_against_counting_by_text(spark, options):
    rows = prose(1, 300)
    expected = plain(rows, **options)
    assert len(expected) >= 10
    assert found(collocations(docs(spark, rows), **options)) == expected


def test_shared_fingerprints_are_counted_by_text(spark, monkeypatch):
    # With one bit and no check words share fingerprints; each two stand apart at some end.
    rows = [("Aa bb. " * 40, "en"), ("cc dd. " * 31 + "cc ee", "en"), ("aa bb", "fr")] + [("x.", "en")] * 10
    calls = []
    again = module.recounted
    monkeypatch.setattr(module, "recounted", lambda *a, **k: calls.append(1) or again(*a, **k))
    table = docs(spark, rows).coalesce(1)
    assert found(collocations(table, bits=1)) == plain(rows) != []
    assert calls
    # A few bits more are told apart by the check.
    rows = prose(2, 250)
    assert found(collocations(docs(spark, rows), least=5, bits=40)) == plain(rows, least=5)


def test_edge_rows(spark):
    rows = [(t, g) for _, t, g in ROWS] * 3
    assert found(collocations(edge_docs(spark, ROWS * 3), least=2)) == plain(rows, least=2)
    assert found(collocations(edge_docs(spark, []))) == []
    assert found(collocations(docs(spark, [(None, None), ("", "en"), (" .,", "en")]))) == []


def test_a_full_map_of_pairs_changes_nothing(spark, monkeypatch):
    rows = prose(3, 200)
    monkeypatch.setattr(module, "bit_map", lambda df: bit_map(df, most_bits=64))
    assert found(collocations(docs(spark, rows))) == plain(rows)


def test_long_pieces_in_several_chunks(spark):
    rng = random.Random(4)
    words = [rng.choice(["alpha", "beta", "gamma", "the", "of"]) for _ in range(4000)]
    rows = [(" ".join(words), "en"), (". ".join(words), "en"), ("z" * 9000 + " the of", "en")]
    chunks = chunked(docs(spark, rows), "text", "lang", "und", 4, size=500).persist()
    assert chunks.count() > 40 and chunks.filter("tail > 0").count() > 20
    got = {(r["lang"], r["phrase"]): r["count"] for r in frequent_phrases(chunks).collect()}
    counts = plain_counts(rows)
    assert got == {(g, p): a for g, f in counts.items() for p, a in f.items() if a >= 30}
    assert chunks.agg({"words": "sum"}).first()[0] == sum(len(p) for t, _ in rows for p in pieces(t))


@pytest.mark.parametrize("seed", range(5))
def test_normal_form_and_parts(seed):
    for text, _ in prose(seed, 40):
        expected = "".join(" ".join(p) + "\n" for p in pieces(text)).encode()
        assert normalised(text) == expected
        assert b"".join(p for p, tail in _parts(expected, 10**9, 4)) == expected


def test_fingerprints_do_not_depend_on_the_place_and_survive_packing():
    body = b"a b c a b\nb a b c\n"
    ranges = Ranges(body, "en", 0, 64)
    by_text = defaultdict(set)
    for words in (1, 2, 3):
        first = ranges.firsts(words)
        for f, fp in zip(first, ranges.fingerprints(first, words)):
            by_text[body[ranges.starts[f] : ranges.ends[f + words - 1]]].add(int(fp))
    assert set(by_text) == {b"a", b"b", b"c", b"a b", b"b c", b"c a", b"b a", b"a b c", b"b c a", b"c a b", b"b a b"}
    assert all(len(v) == 1 for v in by_text.values())
    assert len(set.union(*by_text.values())) == len(by_text)
    # "de" in a language "es" is not "es" in a language "de".
    one, other = (Ranges(w + b"\n", g, 0, 64).fingerprints(np.array([0]), 1) for w, g in ((b"de", "es"), (b"es", "de")))
    assert one != other
    entries = added_up([ranges.entries(7, ranges.firsts(2), 2)])
    assert sorted(entries["count"]) == [1, 1, 2, 3]
    back = np.concatenate([_unpacked(b["entries"][0].as_py()) for b in _packed(entries, 62)])
    assert np.array_equal(np.sort(back, order="fp"), np.sort(entries, order="fp"))


def test_keys_survive_their_slices():
    rng = np.random.default_rng(5)
    drawn = rng.integers(0, 1 << 20, 50_000).astype(np.uint64)
    adder = KeyAdder()
    for part in np.array_split(drawn, 7):
        adder.add(part)
    keys, counts = adder.total()
    again = KeyAdder()
    for batch in _key_slices(keys, counts, 17):
        number, steps, own = (c[0].as_py() for c in batch.columns)
        first = np.cumsum(_from_planes(steps, np.uint64), dtype=np.uint64) + np.uint64(number << 17)
        assert (first >> np.uint64(17) == number).all()
        again.add(first, _from_planes(own, np.uint32))
    assert dict(zip(*map(np.ndarray.tolist, again.total()))) == Counter(drawn.tolist())


def test_bit_map_lets_every_fingerprint_through(spark):
    keys = spark.range(5000).selectExpr("xxhash64(id) as key")
    bits = bit_map(keys)
    own = keys.toArrow()["key"].to_numpy().view(np.uint64)
    assert has_bit(bits, own).all()
    assert has_bit(bits, own + np.uint64(1)).mean() < 0.15


def test_entries_are_not_held_twice_while_they_are_added_up():
    rng = np.random.default_rng(6)
    fps = rng.integers(0, MORE // 4, MORE + 5000).astype(np.uint64)
    held, expected = fps.nbytes // 8 * np.dtype(_ENTRY).itemsize, Counter(fps.tolist())
    tracemalloc.start()
    try:
        adder, places = Adder(), 0
        for own in np.array_split(fps, 60):
            entries = np.zeros(len(own), _ENTRY)
            entries["fp"], entries["count"] = own, 1
            entries["first"] = entries["last"] = places + np.arange(len(own))
            places += len(own)
            adder.add(entries)
        del entries
        summed = adder.total()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 1.8 * held
    assert dict(zip(summed["fp"].tolist(), summed["count"].tolist())) == expected
    # Both places are ones of the fingerprint, the first and the last of them.
    assert (fps[summed["first"]] == summed["fp"]).all() and (fps[summed["last"]] == summed["fp"]).all()
    often = summed["count"] > 1
    assert often.any() and (summed["first"][often] < summed["last"][often]).all()


def test_tasks_get_like_shares_of_the_keys(spark):
    rng = random.Random(7)
    rows = [(" ".join(f"w{rng.randrange(3000)}" for _ in range(100)), "en") for _ in range(200)]
    chunks = chunked(docs(spark, rows), "text", "lang", "und", 4, size=4000)
    keys = maybe_frequent(chunks, (1, 2), 1, 64, 40, 40)
    shares = [n for _, n in keys.groupBy(F.spark_partition_id()).count().collect()]
    assert len(shares) == 40 and sum(shares) > 20_000
    assert max(shares) < 1.4 * sum(shares) / 40
