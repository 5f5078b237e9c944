import math
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest

from registra.llm.lm_score import (
    MU,
    Shard,
    build_slice,
    levels_of,
    score_documents,
    slice_of,
    typical,
)
from tests.llm.cases import by_id, edge_docs, texts

SF = "/root/testdata/sf0.001"


def tokens(text):
    return [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
            .translate({i: " " for i in range(9, 14)}).split(" ") if w]


def plain(rows):
    held = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2 for r in rows}
    counts = Counter(t for r in rows if not held[r["doc_id"]] for t in [*tokens(r["text"]), None])
    n, v = sum(counts.values()), len(counts)
    out = {}
    for r in rows:
        own = [*tokens(r["text"]), None]
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own)
        out[r["doc_id"]] = held[r["doc_id"]], len(own), sum(counts[t] > 0 for t in own), n, base
    return out


@pytest.mark.parametrize("dictionary", [1 << 18, 50])
def test_base_against_brute_force_and_model_on_held_out_texts(spark, dictionary):
    rows = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    got = by_id(score_documents(spark.read.parquet(f"{SF}/documents.parquet"), dictionary=dictionary))
    for doc_id, (held, n_tokens, known, train, base) in plain(rows).items():
        r = got[doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n_tokens, known, train)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert math.isfinite(r.score) and r.score < 0
    if dictionary > 50:
        held = [r for r in got.values() if r.held_out]
        assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_several_shards_give_the_same_scores(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one = by_id(score_documents(docs, per_slice=5000))
    many = by_id(score_documents(docs, per_slice=5000, filter_bytes=20_000))
    assert one.keys() == many.keys()
    assert all(many[k].score == pytest.approx(one[k].score, rel=1e-12) for k in one)


def test_filter_never_understates_and_seldom_overstates():
    rnd = np.random.default_rng(1)
    keys = np.unique(rnd.integers(0, 1 << 62, 40_000, dtype=np.uint64))
    counts = rnd.geometric(0.3, len(keys)).astype(np.int64)
    number = slice_of(keys, 4)
    shard = Shard(4, {s: build_slice(keys[number == s], counts[number == s]).tobytes() for s in range(4)})
    found, true = shard.levels(keys), levels_of(counts)
    assert (found >= true).all() and (found > true).mean() < 0.05
    others = rnd.integers(1 << 62, 1 << 63, 40_000, dtype=np.uint64)
    assert (shard.levels(others) > 0).mean() < 0.05


def test_levels():
    assert levels_of(np.array([1, 2, 3, 4, 7, 8])).tolist() == [1, 2, 2, 3, 3, 4]
    assert typical(np.array([0, 1, 2, 3])).tolist() == [0, 1, 2.5, 5.5]


def test_edges(spark):
    got = score_documents(edge_docs(spark)).collect()
    assert len(got) == 12
    assert {r.n_tokens for r in got if r.doc_id in (3, 4, 5)} == {1}
    assert {r.held_out for r in got if r.doc_id is None} == {False}
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in got)
    assert score_documents(edge_docs(spark, [])).collect() == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    only = score_documents(edge_docs(spark, [(held, "a b", "en")])).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in only] == [(3, 0, 0)]
    assert only[0].base_score == 0.0


def test_many_shards_leave_one_pass_on_disk(spark):
    docs = texts(spark, {i: " ".join(f"w{(i * 7 + k * k) % 900}" for k in range(200)) for i in range(150)})

    def size(**options):
        before = folder_bytes(spark)
        got = {r["doc_id"]: round(r["score"], 9) for r in score_documents(docs, **options).collect()}
        return got, folder_bytes(spark) - before

    one, alone = size(per_slice=2000)
    many, parts = size(per_slice=2000, filter_bytes=2000)
    assert many == one
    levels = 2 * sum(len(r["text"].split()) + 1 for r in docs.collect()) + sum(
        len(r["text"]) for r in docs.collect()
    )
    assert parts - alone <= 2 * max(alone, levels)


def folder_bytes(spark):
    root = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    return sum(f.stat().st_size for f in root.rglob("*") if f.is_file())


def test_score_against_exact_counts(spark):
    """The same smoothing over exact counts. The filter overstates less than one key in twenty (see
    above): an unseen pair then counts as seen once, any other count at most doubles. So much a
    token may the scores be apart, taken over all texts."""
    rows = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    words = {r["doc_id"]: [*tokens(r["text"]), None] for r in rows}
    got = by_id(score_documents(spark.read.parquet(f"{SF}/documents.parquet")))
    single, double = Counter(), Counter()
    for doc_id, own in words.items():
        if zlib.crc32(str(doc_id).encode()) % 7 != 2:
            single.update(own)
            double.update(zip([None, *own], own))
    n, v = sum(single.values()), len(single)

    def known(count):
        return float(typical(levels_of(np.array([count])))[0]) if count else 0.0

    apart = allowed = 0.0
    for doc_id, own in words.items():
        score = 0.0
        for before, token in zip([None, *own], own):
            alone = MU * (known(single[token]) + 1) / (n + v + 1)
            both = known(double[before, token])
            score += math.log10((both + alone) / (max(known(single[before]), both) + MU))
            unseen = 0 if both else math.log10((1 + alone) / alone)
            allowed += 0.05 * (unseen + 3 * math.log10(2))
        apart += abs(got[doc_id].score - score)
    assert 0 < apart <= allowed
    assert apart < 0.05 * sum(-r.score for r in got.values())
