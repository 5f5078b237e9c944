"""Hard negatives: for an anchor and each of its best rows of the same label, the best rows of other
labels whose score lies in a band below the positive's.

Scores are inner products of vectors of integers, so every comparison is exact. The search prunes
like LEMP: rows are sorted by length and cut into buckets; a bucket holds the directions of its
rows as one sorted list per coordinate. A query with a least score t asks of a bucket whose longest
row is l for cosines of at least t / (|q| l). A bucket where that is above 1 is passed over. For
others, the angles between the query and each of its focus coordinates (those where it is largest)
bound the values that a row can have there; the runs of the sorted lists within these bounds are
intersected, and only the rows in all of them are scored.

The least score rises as better rows are found. It first comes from one bucket in sixteen, so
that the search of the others begins with a bound near the end result and what tasks hand on stays
small. Nothing is approximate: a bound is always the score of a row that was found.

Queries are handed to the tasks in blocks of at most `block` anchors, one pass over the buckets
each, so what is broadcast has a fixed bound. Pairs exist only inside a bucket and a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from registra.llm.common import settled, shuffle_tasks
from registra.session import work_folder

BUCKET_ROWS = 4096
# A bucket also ends where rows get this much shorter than its first.
BUCKET_SPAN = 0.9
FOCUS = 4
BLOCK = 50_000
FIRST_LOOK = 16
# Queries of a block that are scored at once against a bucket.
AT_ONCE = 512
# Components beyond this could make a score that 64 bits do not hold.
LARGEST = float(1 << 24)
LOWEST = -(1 << 62)
HIGHEST = 1 << 62
# Far above the rounding of cosines in single precision, far below what would weaken pruning.
SLACK = 1e-5

_RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
    "negative_score long"
)
_BUCKET = pa.schema(
    [
        ("number", pa.int64()),
        ("rows", pa.int32()),
        ("width", pa.int32()),
        ("ids", pa.binary()),
        ("labels", pa.binary()),
        ("cells", pa.binary()),
        ("lists", pa.binary()),
    ]
)


def integer_cells(column: pa.Array, scale: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Matrix of floor(scale * x), and which rows are whole: present, every component finite and
    within +-2^24 after scaling. Vectors shorter than `width` are padded with zeros."""
    rows = len(column)
    out, whole = np.zeros((rows, width), np.int32), np.zeros(rows, bool)
    sizes = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    values = column.flatten()  # without the rows that are null
    holes = values.is_null().to_numpy(zero_copy_only=False)
    flat = np.floor(scale * values.cast(pa.float64()).fill_null(0).to_numpy(zero_copy_only=False))
    fine = ~holes & np.isfinite(flat) & (np.abs(flat) < LARGEST)
    ends = np.cumsum(np.maximum(sizes, 0))
    for size in np.unique(sizes[sizes >= 0]):
        at = np.flatnonzero(sizes == size)
        cells = (ends[at] - size)[:, None] + np.arange(size)
        whole[at] = fine[cells].all(axis=1)
        kept = at[whole[at]]
        out[kept, :size] = flat[cells[whole[at]]]
    return out, whole


def prepared(
    rows: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int, width: int
) -> DataFrame:
    """id, label, cells (int32, packed), length (squared) and a hash of the rows that take part."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, whole = integer_cells(batch.column(2), scale, width)
            cells = np.ascontiguousarray(cells[whole])
            wide = cells.astype(np.float64)
            kept = batch.filter(pa.array(whole))
            packed = [c.tobytes() for c in cells]
            columns = [kept.column(0), kept.column(1), pa.array(packed, pa.binary())]
            length = pa.array(np.einsum("ij,ij->i", wide, wide))
            yield pa.record_batch([*columns, length], names=["id", "label", "cells", "length"])

    source = rows.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("long").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    ).dropna()
    packed = source.mapInArrow(pack, "id long, label long, cells binary, length double")
    return packed.withColumn("mark", F.xxhash64("cells"))


def _fewest(copies: int, width: int):
    """Of rows in order of length, vector, label and id: each once, and of each run of one vector
    and label the first `copies`. More can never be among the best, as they tie in every score."""
    last: list = [None, None, 0]  # vector and label, id, how many so far

    def keep(table: pa.RecordBatch) -> np.ndarray:
        taken = np.zeros(table.num_rows, bool)
        ids, labels = table.column(0).to_numpy(), table.column(1).to_numpy()
        for i, (row, label, cells) in enumerate(zip(ids, labels, table.column(2))):
            key = (cells.as_py(), label)
            if key != last[0]:
                last[:] = [key, None, 0]
            if row != last[1]:
                last[1], last[2] = row, last[2] + 1
                taken[i] = last[2] <= copies
        return taken

    return keep


def _bucket(number: int, ids: np.ndarray, labels: np.ndarray, cells: np.ndarray) -> dict:
    lists = np.argsort(directions(cells), axis=0, kind="stable").T.astype(np.uint16)
    return {
        "number": number,
        "rows": len(ids),
        "width": cells.shape[1],
        "ids": ids.tobytes(),
        "labels": labels.tobytes(),
        "cells": cells.tobytes(),
        "lists": np.ascontiguousarray(lists).tobytes(),
    }


def directions(cells: np.ndarray) -> np.ndarray:
    lengths = np.sqrt(np.einsum("ij,ij->i", cells, cells, dtype=np.float64))
    return (cells / np.maximum(lengths, 1e-300)[:, None]).astype(np.float32)


def length_buckets(
    rows: DataFrame, width: int, copies: int, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Rows in order of length, longest first, in buckets of sorted coordinate lists."""
    tasks = shuffle_tasks(rows.sparkSession, rows.count() * 8 * width)
    order = [F.col("length").desc(), "mark", "cells", "label", "id"]
    dealt = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        keep = _fewest(copies, width)
        number = TaskContext.get().partitionId() << 32
        held: list[np.ndarray] = [np.empty(0, np.int64), np.empty(0, np.int64)]
        held += [np.empty((0, width), np.int32), np.empty(0, np.float64)]

        def cut(to_end: bool) -> Iterator[pa.RecordBatch]:
            nonlocal number, held
            while len(held[0]):
                shorter = held[3] < BUCKET_SPAN**2 * held[3][0]
                end = int(shorter.argmax()) if shorter.any() else len(shorter)
                if end == len(shorter) and end < bucket_rows and not to_end:
                    return
                end = min(end, bucket_rows)
                made = _bucket(number, *(part[:end] for part in held[:3]))
                held = [part[end:] for part in held]
                number += 1
                yield pa.RecordBatch.from_pylist([made], _BUCKET)

        for batch in batches:
            batch = batch.filter(pa.array(keep(batch)))
            cells = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.int32)
            own = [batch.column(0).to_numpy(), batch.column(1).to_numpy()]
            own += [cells.reshape(-1, width), batch.column(3).to_numpy()]
            held = [np.concatenate(pair) for pair in zip(held, own)]
            yield from cut(to_end=False)
        yield from cut(to_end=True)

    kinds = "number long, rows int, width int, ids binary, labels binary, cells binary, lists binary"
    plain = dealt.select("id", "label", "cells", "length")
    return plain.mapInArrow(fill, kinds)


class Bucket:
    """Rows of about one length, and their directions as sorted lists by coordinate."""

    def __init__(self, row: dict):
        shape = (row["rows"], row["width"])
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.labels = np.frombuffer(row["labels"], np.int64)
        self.cells = np.frombuffer(row["cells"], np.int32).reshape(shape)
        self.lists = np.frombuffer(row["lists"], np.uint16).reshape(shape[::-1])
        wide = self.cells.astype(np.float64)
        self.longest = float(np.sqrt(np.einsum("ij,ij->i", wide, wide).max()))
        # Products up to 2^53 are exact in double precision, which is the faster way.
        exact = self.longest**2 < 2.0**53 and np.abs(wide).max(initial=0) < 2.0**24
        self.factor = wide.T if exact else self.cells.astype(np.int64).T
        self.unit = directions(self.cells)
        self._sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def coordinate(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """Values of a coordinate in order, and the place of each row in that order."""
        if f not in self._sorted:
            places = np.empty(len(self.ids), np.uint16)
            places[self.lists[f]] = np.arange(len(self.ids), dtype=np.uint16)
            self._sorted[f] = self.unit[self.lists[f], f], places
        return self._sorted[f]

    def candidates(self, focus: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray | None:
        """Per query and row whether the row is in the query's runs of all its lists; None if all
        are. `focus`, `low` and `high` hold a coordinate and its bounds, per query and list."""
        first, last = np.empty(focus.shape, np.int64), np.empty(focus.shape, np.int64)
        for f in np.unique(focus):
            values, _ = self.coordinate(int(f))
            at = focus == f
            first[at] = np.searchsorted(values, low[at], "left")
            last[at] = np.searchsorted(values, high[at], "right")
        if (first == 0).all() and (last == len(self.ids)).all():
            return None
        inside = np.ones((len(focus), len(self.ids)), bool)
        part = (first > 0) | (last < len(self.ids))
        for q in np.flatnonzero(part.any(axis=1)):
            # The shortest run first; its rows are looked up in the other lists.
            runs = sorted((last[q, k] - first[q, k], k) for k in np.flatnonzero(part[q]))
            k = runs[0][1]
            rows = self.lists[focus[q, k]][first[q, k] : last[q, k]]
            for _, k in runs[1:]:
                places = self.coordinate(int(focus[q, k]))[1][rows]
                rows = rows[(places >= first[q, k]) & (places < last[q, k])]
            inside[q] = False
            inside[q, rows] = True
        return inside


def feasible(cosine: np.ndarray, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of a row's value in a coordinate where the query's direction has the value `query`, if
    the cosine between row and query is at least `cosine`: angles differ by no more than its."""
    reach = np.arccos(np.clip(cosine, -1, 1))[:, None]
    angle = np.arccos(np.clip(query, -1, 1))
    low = np.cos(np.minimum(angle + reach, np.pi)) - SLACK
    high = np.cos(np.maximum(angle - reach, 0)) + SLACK
    return low.astype(np.float32), high.astype(np.float32)


class Search:
    """The best rows so far for a block of queries, each with bands of scores.

    `low` and `high` bound the scores of a band, both included; a band keeps its `best` first rows
    in order of score and id.
    """

    def __init__(self, ids, labels, cells, low, high, best: int, same: bool):
        self.ids, self.labels, self.best, self.same = ids, labels, best, same
        self.cells = cells
        wide = cells.astype(np.float64)
        self.lengths = np.sqrt(np.einsum("ij,ij->i", wide, wide))
        unit = wide / np.maximum(self.lengths, 1e-300)[:, None]
        count = min(FOCUS, cells.shape[1])
        self.focus = np.argpartition(-np.abs(unit), count - 1, axis=1)[:, :count]
        self.values = np.take_along_axis(unit, self.focus, axis=1)
        self.least, self.high = low.copy(), high
        shape = (*low.shape, best)
        self.scores = np.full(shape, LOWEST, np.int64)
        self.found = np.full(shape, HIGHEST, np.int64)

    def visit(self, bucket: Bucket) -> None:
        # What a bucket can hold at most decides whether a query looks at it.
        open_bands = (self.least <= self.high).any(axis=1)
        need = np.where(self.least <= self.high, self.least, HIGHEST).min(axis=1)
        room = self.lengths * bucket.longest * (1 + 1e-9) + 1e-6
        asked = np.flatnonzero(open_bands & (need <= room))
        for at in range(0, len(asked), AT_ONCE):
            self._block(bucket, asked[at : at + AT_ONCE], need, room)

    def _block(self, bucket: Bucket, q: np.ndarray, need: np.ndarray, room: np.ndarray) -> None:
        # A score below zero may come from a short row at any angle.
        cosine = np.where(need[q] >= 0, need[q] / room[q], -1.0)
        low, high = feasible(cosine, self.values[q])
        inside = bucket.candidates(self.focus[q], low, high)
        own = bucket.labels[None, :] == self.labels[q, None]
        fit = own if self.same else ~own
        if self.same:
            fit &= bucket.ids[None, :] != self.ids[q, None]
        if inside is not None:
            fit &= inside
        if not fit.any():
            return
        kind = bucket.factor.dtype
        scores = (self.cells[q].astype(kind) @ bucket.factor).astype(np.int64)
        for band in range(self.least.shape[1]):
            low, high = self.least[q, band], self.high[q, band]
            hit = fit & (scores >= low[:, None])
            if (high < HIGHEST).any():
                hit &= scores <= high[:, None]
            self._merge(q, band, *np.nonzero(hit), scores, bucket.ids)

    def _merge(self, q, band, at, row, scores, ids) -> None:
        if not len(at):
            return
        touched, at_touched = np.unique(at, return_inverse=True)
        old = q[touched]
        who = np.concatenate([at_touched, np.repeat(np.arange(len(touched)), self.best)])
        score = np.concatenate([scores[at, row], self.scores[old, band].ravel()])
        found = np.concatenate([ids[row], self.found[old, band].ravel()])
        order = np.lexsort((found, -score, who))
        starts = np.searchsorted(who[order], np.arange(len(touched)))
        first = order[starts[:, None] + np.arange(self.best)]
        self.scores[old, band], self.found[old, band] = score[first], found[first]
        self.least[old, band] = np.maximum(self.least[old, band], score[first[:, -1]])

    def results(self) -> pa.RecordBatch:
        query, band, _ = got = np.nonzero(self.found < HIGHEST)
        columns = [query, band, self.found[got], self.scores[got]]
        return pa.record_batch(
            [pa.array(c.astype(np.int64)) for c in columns], names=["query", "band", "id", "score"]
        )


def searched(buckets: DataFrame, queries: dict, low, high, best: int, same: bool) -> DataFrame:
    """query, band, id, score, place: the best rows of each band, over all buckets.

    `query` is the number of a query in the block.
    """
    spark = buckets.sparkSession
    labels, cells, own = queries["labels"], queries["cells"], queries["ids"]

    def look(part: DataFrame, least) -> DataFrame:
        shared = spark.sparkContext.broadcast((own, labels, cells, least, high))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, marks, vectors, low, high = shared.value
            state = Search(ids, marks, vectors, low, high, best, same)
            for batch in batches:
                for row in batch.to_pylist():
                    state.visit(Bucket(row))
            yield state.results()

        found = part.mapInArrow(run, "query long, band long, id long, score long")
        place = F.row_number().over(
            Window.partitionBy("query", "band").orderBy(F.col("score").desc(), "id")
        )
        return found.withColumn("place", place).filter(F.col("place") <= best)

    first = buckets.filter(F.pmod(F.xxhash64("number"), F.lit(FIRST_LOOK)) == 0)
    reached = look(first, low).filter(F.col("place") == best).toArrow()
    least = low.copy()
    at = reached["query"].to_numpy(), reached["band"].to_numpy()
    least[at] = np.maximum(least[at], reached["score"].to_numpy())
    return look(buckets, least)


def hard_negatives(
    rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
    label_col: str = "label", scale: int = 256, positives: int = 5, negatives: int = 3,
    least: int = 50, most: int = 95, block: int = BLOCK, bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A score is the inner product of vectors of floor(`scale` * x); higher ones come first, ties by
    smaller id. For each row that meets `is_anchor` (a condition on `id_col`) and each of its first
    `positives` other rows of the same label, the first `negatives` rows of other labels whose score
    is from `least` to `most` percent of the positive's, both included. All rows are searched.

    Rows with a null id, label or vector, or with a component that is null, not finite or beyond
    2^24 after scaling, take no part. A row that is repeated as a whole counts once; rows that share
    an id but not label and vector are rows of their own, though never each other's positives. Shorter
    vectors are padded with zeros. Fewer rows than asked for give fewer results; an empty table,
    or one without anchors, gives none. Other columns are not read.
    """
    spark = rows.sparkSession
    width = max(rows.agg(F.max(F.size(vector_col))).first()[0] or 0, 1)
    whole = settled(prepared(rows, id_col, vector_col, label_col, scale, width), "vectors")
    copies = max(positives + 1, negatives)
    buckets = settled(length_buckets(whole, width, copies, bucket_rows), "buckets")
    anchors = prepared(rows.filter(is_anchor), id_col, vector_col, label_col, scale, width)
    anchors = anchors.dropDuplicates(["id", "label", "cells"])
    blocks = -(-anchors.count() // block)
    folder = work_folder(spark, "hard-negatives")
    for number in range(max(blocks, 1)):
        mark = F.pmod(F.xxhash64("id", "label", "mark"), F.lit(max(blocks, 1)))
        own = anchors.filter(mark == number).select("id", "label", "cells").toArrow()
        if own.num_rows or not number:
            _mine(buckets, own, width, positives, negatives, least, most).write.mode(
                "append"
            ).parquet(folder)
    return spark.read.schema(_RESULT).parquet(folder)


def _mine(buckets, anchors: pa.Table, width, positives, negatives, least, most) -> DataFrame:
    """Results of one block of anchors; what is gathered here has its bound."""
    spark: SparkSession = buckets.sparkSession
    count = anchors.num_rows
    cells = b"".join(anchors["cells"].to_pylist())
    queries = {
        "ids": anchors["id"].to_numpy(),
        "labels": anchors["label"].to_numpy(),
        "cells": np.frombuffer(cells, np.int32).reshape(count, width),
    }
    low, high = np.full((count, 1), LOWEST), np.full((count, 1), HIGHEST)
    near = searched(buckets, queries, low, high, positives, same=True).toArrow()
    who, band = near["query"].to_numpy(), near["place"].to_numpy() - 1
    score = near["score"].to_numpy()
    low, high = np.full((count, positives), HIGHEST), np.full((count, positives), LOWEST)
    low[who, band] = -(-score * least // 100)
    high[who, band] = score * most // 100
    far = searched(buckets, queries, low, high, negatives, same=False)
    pairs = spark.createDataFrame(
        pa.table(
            {
                "query": who,
                "band": band.astype(np.int64),
                "anchor_id": queries["ids"][who],
                "positive_id": near["id"],
                "positive_score": near["score"],
            }
        )
    )
    found = far.select(
        "query",
        "band",
        F.col("place").alias("rank"),
        F.col("id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    names = [field.split()[0] for field in _RESULT.split(", ")]
    return found.join(pairs, ["query", "band"]).select(names)
