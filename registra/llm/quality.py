"""Quality of texts by compression.

Two zstandard dictionaries are built, one from texts labelled good and one from texts labelled bad.
A text is cut into blocks, every block is compressed with both, and the difference of the summed
sizes, per byte of the text, says which of the two it is more like. A logistic curve fitted on
labelled texts that the dictionaries have not seen turns the difference into a probability.

Only the fit reads a sample, and its bound is a parameter: `sample` labelled documents of each
class, chosen by a hash of their id, and `blocks` blocks of each, spread over the whole text. All
rows are scored, every text as a whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registra.llm.common import worker_state

SAMPLE = 2000
BLOCKS = 16
BLOCK_BYTES = 512
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
# Bytes that the length counts more, so that a few words decide less than a page.
SMOOTHING = 16

# Good dictionary, bad dictionary, slope and intercept. A model without dictionaries gives every
# text the share of good labels.
Model = tuple[bytes, bytes, float, float]


def spread_blocks(text: bytes, blocks: int = BLOCKS, size: int = BLOCK_BYTES) -> list[bytes]:
    """At most `blocks` blocks at even steps over the whole text."""
    starts = range(0, len(text), size)
    chosen = starts[:: max(1, math.ceil(len(starts) / blocks))]
    return [text[s : s + size] for s in chosen]


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary of the samples; of too few for the trainer, the samples themselves."""
    usable = [s for s in samples if len(s) >= 8]
    try:
        return zstandard.train_dictionary(size, usable).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


class Sizes:
    """Compressed sizes of whole texts under two dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        self.coders = []
        for content in (good, bad):
            made = zstandard.ZstdCompressionDict(content)
            made.precompute_compress(level=LEVEL)
            self.coders.append(
                zstandard.ZstdCompressor(
                    dict_data=made, write_checksum=False, write_content_size=False, write_dict_id=False
                )
            )

    def difference(self, text: bytes) -> float:
        """How many bytes the bad dictionary needs more than the good one, per byte."""
        view, more = memoryview(text), 0
        good, bad = (coder.compress for coder in self.coders)
        for start in range(0, len(text), BLOCK_BYTES):
            block = view[start : start + BLOCK_BYTES]
            more += len(bad(block)) - len(good(block))
        return more / (len(text) + SMOOTHING)


def fit_curve(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and intercept of a logistic curve. The targets are drawn in a little from 0 and 1, so
    that the fit is finite for classes that the difference parts completely."""
    scale = float(np.std(x)) or 1.0
    rows = np.column_stack([x / scale, np.ones(len(x))])
    n1, n0 = y.sum(), len(y) - y.sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    w = np.array([0.0, math.log((n1 + 1) / (n0 + 1))])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        slope = rows.T @ (target - p) - 1e-3 * w * [1, 0]
        curve = (rows * (p * (1 - p))[:, None]).T @ rows + np.diag([1e-3, 1e-9])
        step = np.clip(np.linalg.solve(curve, slope), -2, 2)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def fit(rows: list[tuple[int, int, list[bytes]]]) -> Model:
    """The model of (label, half, blocks) rows: dictionaries of half 0, the curve of half 1."""

    def of(label: int, half: int) -> list[list[bytes]]:
        return [b for y, h, b in rows if y == label and h == half]

    good, bad = (train_dictionary([s for b in of(y, 0) for s in b]) for y in (1, 0))
    judged = [(y, b"".join(b)) for y in (0, 1) for b in of(y, 1)]
    labels = np.array([y for y, _ in judged], float)
    n1 = sum(y for y, _, _ in rows)
    if not good or not bad or not 0 < labels.sum() < len(labels):
        return b"", b"", 0.0, math.log((n1 + 1) / (len(rows) - n1 + 1))
    sizes = Sizes(good, bad)
    slope, intercept = fit_curve(np.array([sizes.difference(t) for _, t in judged]), labels)
    return good, bad, slope, intercept


def labelled_sample(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
    learn_from: Column, sample: int,
) -> list[tuple[int, int, list[bytes]]]:
    """Blocks of at most `sample` labelled documents of each class.

    The ids are chosen among the labels alone, so the texts are read once, with a join whose small
    side has 2 * `sample` rows at most. Of several labels of an id the least counts, and of rows
    that repeat an id the one with the least blocks.
    """
    marked = (
        labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
        .filter(F.col("_y").isin(0, 1) & F.col("_id").isNotNull())
        .groupBy("_id")
        .agg(F.min("_y").alias("_y"))
        .withColumn("_order", F.xxhash64(F.col("_id").cast("string")))
        .filter(learn_from)
    )
    parts = [
        marked.filter(F.col("_y") == y).orderBy("_order", "_id").limit(sample) for y in (0, 1)
    ]
    chosen = parts[0].unionByName(parts[1])
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    found = texts.filter(F.length("_text") > 0).join(F.broadcast(chosen), "_id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = [spread_blocks(t.as_py().encode()) for t in batch.column(2)]
            out = [batch.column(0), batch.column(1), pa.array(blocks, pa.list_(pa.binary()))]
            yield pa.record_batch(out, names=["y", "mark", "blocks"])

    cuts = found.select("_y", "_order", "_text").mapInArrow(
        cut, "y int, mark long, blocks array<binary>"
    )
    one = cuts.groupBy("mark", "y").agg(F.min("blocks").alias("blocks"))
    rows = one.orderBy("y", "mark").collect()
    # The hash that orders ids also parts them, by a bit that the order does not show.
    return [(r["y"], r["mark"] & 1, [bytes(b) for b in r["blocks"]]) for r in rows]


def score_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", learn_from: Column | None = None, sample: int = SAMPLE,
) -> DataFrame:
    """Per row of `docs`: id, `difference` of compressed sizes per byte, and `score`, the
    probability of label 1.

    `learn_from` is a condition on `_id`, the id of a labelled row; all rows are scored. Null and
    empty texts have difference 0 and the score of that. Repeated rows come out as often as they go
    in. A class without labelled texts leaves nothing to compare: every score is then the smoothed
    share of good labels, 0.5 without labels. An empty table gives no rows. Labels that are null or
    neither 0 nor 1 are not learned from. Other columns of `docs` are not read.
    """
    spark = docs.sparkSession
    condition = F.lit(True) if learn_from is None else learn_from
    model = fit(labelled_sample(docs, labels, id_col, text_col, label_col, condition, sample))
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good, bad, slope, intercept = shared.value
        kept = worker_state()
        if good and kept.get("quality", (None,))[0] != (good, bad):
            kept["quality"] = (good, bad), Sizes(good, bad)
        difference = kept["quality"][1].difference if good else lambda text: 0.0
        for batch in batches:
            found = [difference((t.as_py() or "").encode()) for t in batch.column(1)]
            x = np.array(found, float)
            score = 1 / (1 + np.exp(-np.clip(slope * x + intercept, -700, 700)))
            out = [batch.column(0), pa.array(x), pa.array(score)]
            yield pa.record_batch(out, names=["id", "difference", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    scored = docs.select(id_col, text_col).mapInArrow(
        run, f"id {kind}, difference double, score double"
    )
    return scored.withColumnRenamed("id", id_col)


def fold(id_col: Column, folds: int) -> Column:
    """A fold of an id: CRC-32 of its text, modulo `folds`. A null id counts as an empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % folds


def quality_report(
    docs: DataFrame, labels: DataFrame, folds: int = 5, threshold: float = 0.3, **options
) -> DataFrame:
    """Scores learned from all folds but the first, and whether they reach the threshold."""
    id_col = options.get("id_col", "doc_id")
    scored = score_quality(docs, labels, learn_from=fold(F.col("_id"), folds) != 0, **options)
    return scored.select(
        id_col,
        (fold(F.col(id_col), folds) == 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "difference",
    )
