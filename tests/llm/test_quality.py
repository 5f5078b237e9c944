"""Compression classifier: held-out accuracy, bounded fit, edge rows."""

import zlib

import numpy as np
import pytest

from registra.llm.quality import (
    BLOCK_BYTES,
    BLOCKS,
    Sizes,
    fit,
    fit_curve,
    quality_report,
    score_quality,
    spread_blocks,
)
from tests.llm.cases import by_id, edge_docs, texts

SF = "/root/testdata/sf0.1"


def auc(scores, labels):
    ranks = np.empty(len(scores))
    ranks[np.argsort(scores, kind="stable")] = np.arange(len(scores))
    y = np.array(labels)
    return (ranks[y == 1].sum() - y.sum() * (y.sum() - 1) / 2) / (y.sum() * (len(y) - y.sum()))


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_report(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    assert 0.15 < len(held) / len(rows) < 0.25
    assert auc([r["score"] for r in held], [r["quality"] for r in held]) > 0.98
    good = [r["predicted"] for r in held if r["quality"] == 1]
    bad = [r["predicted"] for r in held if r["quality"] == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.2
    # Calibrated: mean scores of bins are near the share of good labels in them.
    score, y = (np.array([r[c] for r in held], float) for c in ("score", "quality"))
    assert abs(score.mean() - y.mean()) < 0.05
    assert np.mean((score - y) ** 2) < 0.05


def test_labels_of_the_held_out_fold_and_other_columns_are_not_read(spark):
    docs = texts(spark, {i: ("word salad " if i % 2 else "qzx! $$$ ") * 40 + str(i) for i in range(80)})
    rows = [(i, i % 2, 0) for i in range(80)]
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y, 1) for i, y, _ in rows]
    schema = "doc_id long, quality int, toxic int"
    first, second = (
        by_id(quality_report(docs, spark.createDataFrame(r, schema))) for r in (rows, turned)
    )
    assert {i: r["score"] for i, r in first.items()} == {i: r["score"] for i, r in second.items()}
    other = docs.selectExpr("doc_id", "text", "'zz' as lang", "'elsewhere' as source")
    third = by_id(quality_report(other, spark.createDataFrame(rows, schema)))
    assert all(third[i]["score"] == r["score"] for i, r in first.items())


def test_fit_parts_two_kinds_and_reads_whole_texts(spark):
    docs = texts(spark, {i: ("the river bank " if i % 2 else "QQ## ZZ@@ ") * 60 + str(i) for i in range(200)})
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, quality int")
    got = by_id(score_quality(docs, labels))
    assert all(got[i]["score"] > 0.8 for i in range(101, 200, 2))
    assert all(got[i]["score"] < 0.2 for i in range(100, 200, 2))
    good, bad, slope, intercept = fit(
        [(i % 2, i // 2 % 2, [b"the river bank " * 20 if i % 2 else b"QQ## ZZ@@ " * 20]) for i in range(80)]
    )
    sizes = Sizes(good, bad)
    head = b"the river bank " * 500
    assert slope > 0
    assert sizes.difference(head + b"QQ## ZZ@@ " * 500) < sizes.difference(head)


@pytest.mark.parametrize("length", [0, 1, BLOCK_BYTES, BLOCK_BYTES * BLOCKS + 1, 10_000_000])
def test_blocks_of_the_fit_are_bounded_and_spread(length):
    text = bytes(i % 251 for i in range(min(length, 251))) * (length // 251 + 1)
    found = spread_blocks(text[:length])
    assert len(found) <= BLOCKS and (length == 0) == (not found)
    if length == 10_000_000:
        assert sum(map(len, found)) == BLOCKS * BLOCK_BYTES


def test_curve_is_finite_for_parted_classes_and_follows_shares():
    slope, intercept = fit_curve(np.array([-1.0] * 50 + [1.0] * 50), np.array([0.0] * 50 + [1.0] * 50))
    assert slope > 0 and np.isfinite([slope, intercept]).all()
    slope, intercept = fit_curve(np.zeros(100), np.array([1.0] * 80 + [0.0] * 20))
    assert abs(1 / (1 + np.exp(-intercept)) - 0.8) < 0.02


def test_edge_rows(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (2, 1), (3, 1), (6, 0), (7, 0), (8, 1), (None, 1), (9, None), (4, 7)],
        "doc_id long, quality int",
    )
    got = quality_report(docs, labels).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r["doc_id"]) for r in docs.collect())
    empty = {r["score"] for r in got if r["doc_id"] in (3, 4)}
    assert len(empty) == 1
    assert all(r["held_out"] for r in got if r["doc_id"] is None)
    assert len({r["score"] for r in got if r["doc_id"] == 2}) == 1


@pytest.mark.parametrize("rows,score", [([], 0.5), ([(1, 1), (8, 1), (9, 1)], None), ([(5, 2)], 0.5)])
def test_without_labels_of_both_classes(spark, rows, score):
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    got = score_quality(edge_docs(spark), labels).collect()
    assert len({r["score"] for r in got}) == 1
    assert got[0]["score"] == score or (score is None and got[0]["score"] > 0.5)


def test_empty_table(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    assert quality_report(edge_docs(spark, []), labels).count() == 0
