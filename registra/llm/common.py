"""Helpers that several operators share."""

from __future__ import annotations

import math
import sys
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from types import ModuleType

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import registra
from registra.session import work_folder

# Task functions travel whole, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(registra)

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


BATCH_ROWS = 1000


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Let tasks hand texts to Python in batches of fewer rows, as texts may be long."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(setting)) > rows:
        spark.conf.set(setting, rows)


@contextmanager
def _at_most(spark: SparkSession, setting: str, rows: int) -> Iterator[None]:
    before = spark.conf.get(setting)
    spark.conf.set(setting, min(rows, int(before)))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def batch_rows(spark: SparkSession, rows: int):
    """Hand tasks at most so many rows at once in the jobs that run inside, and no later ones."""
    return _at_most(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def read_rows(spark: SparkSession, rows: int):
    """Read at most so many rows of a Parquet file at once in the jobs that run inside, as the reader
    puts the values of all of them side by side in one array."""
    return _at_most(spark, "spark.sql.parquet.columnarReaderBatchSize", rows)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else. `lower` does just that for pure ASCII, and is faster."""
    pure = F.length(text) == F.octet_length(text)
    return F.when(pure, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def settled(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Later steps then see one fixed result however often they run, and a lost executor costs a
    read instead of the work before it.
    """
    return settled_at(df, name)[0]


def settled_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As :func:`settled`, with the folder, for tables that can go before the session ends."""
    folder = work_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder), folder


def shuffle_tasks(spark: SparkSession, total_bytes: int = 0, bytes_per_task: int = 64 << 20) -> int:
    """Tasks for data of a known size, and the session's own number at least."""
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(own, math.ceil(total_bytes / bytes_per_task))


def joined_digest(items: Column) -> Column:
    """SHA-256, in hex, of an array of strings joined by commas."""
    return F.sha2(F.array_join(items, ","), 256)


def worker_state() -> dict:
    """What a Python worker keeps between tasks. Task functions travel by value, so their own
    module's variables would start empty in each task."""
    return vars(sys.modules.setdefault("registra_worker", ModuleType("registra_worker")))


class Shared:
    """A value that every task reads, from the driver.

    Spark unpickles what it broadcasts by the names of its classes, which an executor without this
    package does not have. So the value travels as bytes that bring their classes, and is unpacked once
    by a worker, which holds the last few. For values of some megabytes; arrays and bytes that
    are larger are broadcast as they are.
    """

    HELD = 3

    def __init__(self, spark: SparkSession, value: object):
        self.key = uuid.uuid4().hex
        self.packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        held = worker_state().setdefault("shared", {})
        if self.key not in held:
            while len(held) >= self.HELD:
                held.pop(next(iter(held)))
            held[self.key] = cloudpickle.loads(self.packed.value)
        return held[self.key]

    def release(self) -> None:
        """Free what executors hold of it. Jobs that read it must be over."""
        self.packed.unpersist()


def running_sum(values: Column, block: int = 256) -> Column:
    """Sums before each element of an array of numbers, in blocks: a fold copies what it has so
    far at each step, so one fold over a long array would take quadratic time."""

    def sums(array: Column, start: Column) -> Column:
        state = F.struct(start.alias("at"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(
            array,
            state,
            lambda s, x: F.struct(
                (s["at"] + x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")
            ),
            lambda s: s["out"],
        )

    def total(array: Column) -> Column:
        return F.aggregate(array, F.lit(0).cast("bigint"), lambda s, x: s + x)

    starts = F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), F.lit(block))
    blocks = F.transform(starts, lambda i: F.slice(values, i, F.lit(block)))
    zero = F.lit(0).cast("bigint")
    before = sums(F.transform(blocks, total), zero)
    return F.flatten(F.zip_with(blocks, before, sums))


def matches(text: Column, pattern: str) -> Column:
    """Matches of a pattern that never matches an empty string, leftmost and not overlapping."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def match_starts(text: Column, pattern: str, found: Column) -> Column:
    """Where the matches start, in code points: gaps and matches alternate, so their lengths
    add up."""
    gaps = F.split(text, pattern, -1)
    lengths = F.zip_with(
        gaps, found, lambda g, m: (F.length(g) + F.coalesce(F.length(m), F.lit(0))).cast("bigint")
    )
    return F.zip_with(running_sum(lengths), gaps, lambda at, g: at + F.length(g))


def most_frequent(counts: DataFrame, count_col: str, limit: int) -> DataFrame:
    """Rows whose count is above a threshold that at most `limit` rows reach.

    The threshold comes from a histogram of the counts' logarithms, a few hundred rows at most.
    """
    mark = F.floor(F.log2(F.col(count_col).cast("double")) * 8)
    histogram = dict(counts.groupBy(mark.alias("mark")).count().collect())
    taken, least = 0, None
    for value in sorted(histogram, reverse=True):
        if taken + histogram[value] > limit:
            break
        taken, least = taken + histogram[value], value
    return counts.filter(mark >= least if least is not None else F.lit(False))
