"""Summaries over counts: subtotals, change from month to month, distinct counts that merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def subtotals(
    counts: DataFrame, keys: Sequence[str], sets: Sequence[Sequence[str]] | None = None
) -> DataFrame:
    """`keys, level, n`: sums of the counts `n` for each of the grouping `sets`.

    Without sets: for every leading part of the keys, as by rollup. `level` has a bit for
    each key that is summed over, the first key's being the highest, so that a key that is NULL in
    the data is told apart from a subtotal. Counted rows go in, so an input row is repeated per
    set after it was reduced.
    """
    columns = [F.col(k) for k in keys]
    if sets is None:
        grouped = counts.rollup(*columns)
    else:
        grouped = counts.groupingSets([[F.col(c) for c in s] for s in sets], *columns)
    return grouped.agg(F.grouping_id().cast("int").alias("level"), F.sum("n").alias("n")).select(
        *keys, "level", "n"
    )


def month_change(counts: DataFrame, key: str, month: str) -> DataFrame:
    """`key, month, n, change, total`: counts of each month, how they differ from the month before
    and what they add up to, for every month from a key's first to its last. Months without a count
    have 0; the first month has no change.

    `month` is the first day of a month, as a date. Windows are over one row a month and key.
    """
    span = F.sequence(F.min(month), F.max(month), F.expr("interval 1 month"))
    months = counts.groupBy(key).agg(span.alias("_months"))
    every = months.select(F.col(key).alias("_key"), F.explode("_months").alias("_month"))
    same = every["_key"].eqNullSafe(counts[key]) & (every["_month"] == counts[month])
    filled = every.join(counts, same, "left").select(
        F.col("_key").alias(key),
        F.col("_month").alias(month),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
    )
    order = Window.partitionBy(key).orderBy(month)
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return filled.withColumns(
        {"change": F.col("n") - F.lag("n").over(order), "total": F.sum("n").over(running)}
    )


def distinct_sketches(df: DataFrame, keys: Sequence[str], column: str, precision: int = 14) -> DataFrame:
    """`keys, sketch`: a binary sketch of the distinct values of a column for each group.

    It keeps the 2^`precision` smallest hashes, at most 8 bytes each: up to so many values the count is
    exact, beyond that its standard error is 1 / sqrt(2^precision), 0.8 % at 14.
    """
    return df.groupBy(*keys).agg(F.theta_sketch_agg(column, F.lit(precision)).alias("sketch"))


def merged_sketches(sketches: DataFrame, keys: Sequence[str], precision: int = 14) -> DataFrame:
    """`keys, sketch, n`: sketches of finer groups merged, and the distinct count that they give, which
    is that of one sketch over all their rows."""
    merged = sketches.groupBy(*keys).agg(F.theta_union_agg("sketch", F.lit(precision)).alias("sketch"))
    return merged.withColumn("n", F.theta_sketch_estimate("sketch"))
