"""Month-wise Parquet sinks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

WRITTEN = "written"
SKIPPED_EMPTY = "skipped_empty"
SKIPPED_GUARD = "skipped_guard"


@dataclass(frozen=True)
class WriteResult:
    status: str
    rows: int


@contextmanager
def concurrent_writers(spark: SparkSession, files: int = 16) -> Iterator[None]:
    """Let a task keep several partitions' files open instead of sorting its rows first.

    For rows that arrive grouped anyway; a task with more partitions than that still sorts.
    """
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, str(files))
    try:
        yield
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Count the rows that reach the writer.

    The count sits in the last stage, whose repeated tasks are counted once, and above any
    exchange, which adaptive execution may drop together with what is below it.
    """
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _result(seen: Observation) -> WriteResult:
    rows = seen.get.get("rows", 0)
    return WriteResult(WRITTEN if rows else SKIPPED_EMPTY, rows)


def overwrite_partitions(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    rebalance: bool = False,
    sort_by: Sequence[str] = (),
    one_partition: bool = False,
) -> WriteResult:
    """Replace only the partitions that `df` has rows for, and count the rows on the way.

    An empty result therefore leaves the earlier data in place, with no count of its own
    beforehand: the facts are read once. `rebalance` evens out file sizes when many tasks
    hold rows of many partitions; adaptive execution splits a partition that holds most.
    `one_partition` does so for rows of a single one, which would give a file per task.
    `sort_by` orders the rows inside each file, without a shuffle, so that readers who
    filter on those columns skip row groups.
    """
    df = df.hint("rebalance", *partition_by) if rebalance else df
    df = df.hint("rebalance") if one_partition else df
    df = df.sortWithinPartitions(*partition_by, *sort_by) if sort_by else df
    counted, seen = _counted(df)
    (
        counted.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )
    return _result(seen)


def overwrite_seen(df: DataFrame, path: str, partition_by: Sequence[str]) -> tuple[WriteResult, set]:
    """As :func:`overwrite_partitions`, and tell which partitions had rows.

    The partitions of one write are collected, so there must be a bounded number of them.
    """
    seen = Observation()
    found = F.collect_set(F.struct(*partition_by)).alias("partitions")
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), found)
    (
        counted.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )
    return _result(seen), {tuple(p) for p in seen.get.get("partitions") or ()}


# Characters that Spark writes as %XX in the name of a partition's folder.
_ESCAPED = {chr(c) for c in [*range(1, 32), 127]} | set("\"#%'*/:=?\\{[]^")


def partition_folder(keys: Sequence[str], values: Sequence[str]) -> str:
    """The folder of one partition below its table."""
    def name(value: str) -> str:
        return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in value)

    return "/".join(f"{k}={name(v)}" for k, v in zip(keys, values, strict=True))
