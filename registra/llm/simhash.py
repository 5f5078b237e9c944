"""SimHash fingerprints, linked within a bit distance by covering locality-sensitive hashing.

Each bit position gets a vector of `radius + 1` bits; a mask keeps the positions whose vector has
odd parity with the mask's number. Of any `radius` positions the vectors span less than the whole
space, so some number is orthogonal to all of them: its mask drops every differing bit, and
the pair falls into one bucket of that table. No link can be missed, and a mask still keeps half
of the bits.

Fingerprints are made distinct first, so exact copies and texts without words cost one row. A
bucket of two is compared where it is counted. A larger one is compared as a list up to
`BUCKET` members and gives a spanning forest of its links, never all pairs; beyond that it is cut
again by covering masks over the bits that it has not agreed on yet. Three levels leave 8 free
bits, so a bucket there has 256 members at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registra.llm.common import settled
from registra.llm.components import components

BITS = 64
SEED = 42
BUCKET = 4096
SALTS = 64  # at least, and one more for each
ROWS_PER_SALT = 1_000_000
SLICE = 1 << 16  # shingles whose bits are counted at once


def fingerprint(text: str | None, size: int) -> int:
    """Bits set in over half of the hashes of all shingles, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    last = max(0, len(words) - size)
    hashed, seed = xxhash.xxh64_intdigest, SEED
    ones = np.zeros(BITS, np.int64)
    for at in range(0, last + 1, SLICE):
        to = min(at + SLICE, last + 1)
        first = starts[at:to].tolist()
        until = ends[at + size - 1 : to + size - 1].tolist() if len(words) > size else [len(joined)]
        values = np.array(
            [hashed(joined[s:e], seed) for s, e in zip(first, until, strict=True)], "<u8"
        )
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > last + 1, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(x.as_py(), size) for x in batch.column(1)]
            yield pa.record_batch(
                [batch.column(0), pa.array(values, pa.int64())], names=["id", "fp"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, fp long")


def covering_masks(positions: list[int], radius: int) -> list[int]:
    """Masks over some bit positions: any `radius` of the positions are all dropped by one."""
    width = 1 << (radius + 1)
    return [
        sum(1 << p for j, p in enumerate(positions) if (j % width & v).bit_count() & 1)
        for v in range(1, width)
    ]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def forest(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that join, within one bucket, all that its links within the radius join."""
    unseen = values.view(np.uint64)
    links: list[tuple[int, int]] = []
    while len(unseen):
        front, unseen = unseen[:1], unseen[1:]
        while len(front) and len(unseen):
            x, front = front[0], front[1:]
            near = np.bitwise_count(unseen ^ x) <= radius
            links += [(int(x.view(np.int64)), int(y)) for y in unseen[near].view(np.int64)]
            front = np.concatenate([front, unseen[near]])
            unseen = unseen[~near]
    return links


def _forests(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for bucket in batch.column(0):
                found += forest(np.sort(np.array(bucket.values, np.int64)), radius)
            a, b = zip(*found, strict=True) if found else ((), ())
            yield pa.record_batch(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]
            )

    return run


def links(classes: DataFrame, radius: int, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints `fp` that join all within the radius."""
    whole = (1 << BITS) - 1
    paths = [(0, list(range(BITS)))]
    rows = classes.select(F.lit(0).alias("path"), "fp")
    found = None
    while True:
        # Of each mask so far: its masks one level down, as kept bits of the whole fingerprint.
        deeper: list[tuple[int, list[int]]] = []
        for kept, free in paths:
            deeper += [
                (kept | m, [p for p in free if not m >> p & 1])
                for m in covering_masks(free, radius)
            ]
        fan = (1 << (radius + 1)) - 1
        table = ",".join(str(_signed(kept & whole)) for kept, _ in deeper)
        masks = F.split(F.lit(table), ",").cast("array<bigint>")
        rows = rows.select(
            "fp", F.explode(F.transform(F.sequence(F.lit(0), F.lit(fan - 1)),
                                        lambda i: F.col("path") * fan + i)).alias("path")
        ).select(
            "path", "fp", F.get(masks, F.col("path")).bitwiseAND(F.col("fp")).alias("key")
        )
        last = max(len(free) for _, free in deeper) <= BITS // 8
        sizes = settled(
            rows.groupBy("path", "key")
            .agg(F.count("*").alias("n"), F.min("fp").alias("lo"), F.max("fp").alias("hi"))
            .filter("n > 1"),
            "buckets",
        )
        two = sizes.filter(
            (F.col("n") == 2) & (F.bit_count(F.col("lo").bitwiseXOR(F.col("hi"))) <= radius)
        ).select(F.col("lo").alias("a"), F.col("hi").alias("b"))
        listed = sizes.filter("n > 2" if last else f"n > 2 and n <= {bucket}")
        several = (
            rows.join(listed.select("path", "key"), ["path", "key"], "left_semi")
            .groupBy("path", "key")
            .agg(F.collect_list("fp").alias("members"))
            .select("members")
            .mapInArrow(_forests(radius), "a long, b long")
        )
        found = two.unionAll(several) if found is None else found.unionAll(two).unionAll(several)
        large = sizes.filter(f"n > {bucket}").select("path", "key")
        if last or large.isEmpty():
            return found
        rows = rows.join(large, ["path", "key"], "left_semi").select("path", "fp")
        paths = deeper


def simhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    radius: int = 3,
    bucket: int = BUCKET,
) -> DataFrame:
    """One row per row of `docs`: id, fingerprint (16 hex digits), component_id.

    A-Z is lower-cased, words are runs without ASCII white space; a text shorter than a shingle is
    one shingle, and null or no words give fingerprint zero, linked like any other. component_id
    is the smallest id reachable; it is null only where no row of the component has an id.
    Repeated rows come out as often as they go in. `radius` is 1 to 3. Other columns are not read.
    """
    if not 1 <= radius <= 3 or shingle < 1:
        raise ValueError("radius is 1 to 3, a shingle has a word at least")
    marked = settled(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    classes = settled(marked.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    joined = components(links(classes, radius, bucket))
    placed = classes.join(joined, classes["fp"] == joined["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    smallest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    answer = placed.join(smallest, "root").select("fp", "component_id")
    # The rows of a hot fingerprint meet its answer once per salt that they have.
    salts = max(SALTS, -(-marked.count() // ROWS_PER_SALT))
    dealt = marked.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)))
    salted = dealt.select("fp", "salt").distinct().join(answer, "fp")
    return (
        dealt.join(salted, ["fp", "salt"])
        .select(
            F.col("id").alias(id_col),
            F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
            "component_id",
        )
    )


def drop_near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    radius: int = 3,
) -> DataFrame:
    """The document with the smallest id of each group, with all its columns.

    Documents without an id stay. Rows that repeat an id are one document and share its fate.
    """
    report = simhash_components(docs, id_col, text_col, shingle, radius)
    gone = report.groupBy(F.col(id_col).alias("gone")).agg(
        F.min("component_id").alias("least")
    ).filter("gone != least")
    gone = settled(gone.select("gone"), "near_copies")
    return docs.join(gone, docs[id_col] == gone["gone"], "left_anti")
