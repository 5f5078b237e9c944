"""Joins in time: the last row before a moment, intervals that overlap, and what is open when."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    time: str,
    values: Sequence[str],
    bucket: Callable[[Column], Column],
    inclusive: bool = False,
) -> DataFrame:
    """Rows of `left` with the `values` of the last row of `right` of their keys before their `time`,
    at or before it if `inclusive`. Values are NULL where there is none.

    Both sides go into one set of rows, in order of time inside a key and `bucket` (such as
    `date_trunc` of the time, which must not fall as time goes on), so no pair is made that is not
    in the result. What a bucket begins with comes from the last rows of the buckets before it, of
    which there is one a key and bucket. A key with a large part of all rows is therefore sorted in
    as many tasks as it has buckets.

    Of several right rows of one key and time the one with the largest values counts. Rows with a NULL
    key or time find nothing and stay.
    """
    names = {name: f"_right_{name}" for name in values}
    item = F.struct(*(F.col(name) for name in values))
    side = F.lit(0 if inclusive else 1)
    usable = F.lit(True)
    for name in (*keys, time):
        usable = usable & F.col(name).isNotNull()
    seen = (
        right.filter(usable)
        .groupBy(*keys, time)
        .agg(F.max(item).alias("_item"))
        .withColumns({"_side": side, "_row": F.lit(None).cast(left_type(left))})
    )
    asking = left.filter(usable).select(
        *keys,
        time,
        F.lit(None).cast(seen.schema["_item"].dataType).alias("_item"),
        (1 - side).alias("_side"),
        F.struct(*(F.col(c) for c in left.columns)).alias("_row"),
    )
    rows = seen.select(*keys, time, "_item", "_side", "_row").unionByName(asking)
    rows = rows.withColumn("_bucket", bucket(F.col(time)))
    cell = [*keys, "_bucket"]
    within = Window.partitionBy(*cell).orderBy(time, "_side").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = rows.groupBy(*cell).agg(
        F.max_by("_item", F.when(F.col("_item").isNotNull(), F.col(time))).alias("_end")
    )
    carried = ends.select(*cell, F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    found = rows.withColumn("_found", F.last("_item", ignorenulls=True).over(within))
    found = found.filter(F.col("_row").isNotNull()).join(carried, cell)
    got = F.coalesce("_found", "_carried")
    joined = found.select("_row.*", *(got[name].alias(names[name]) for name in values))
    alone = left.filter(~usable).select(
        *left.columns,
        *(F.lit(None).cast(right.schema[n].dataType).alias(names[n]) for n in values),
    )
    return joined.unionByName(alone).withColumnsRenamed({v: k for k, v in names.items()})


def left_type(left: DataFrame) -> str:
    return left.select(F.struct(*(F.col(c) for c in left.columns)).alias("s")).schema["s"].dataType


def interval_join(
    left: DataFrame,
    right: DataFrame,
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    width: int,
    keys: Sequence[str] = (),
) -> DataFrame:
    """All pairs of rows of equal keys whose intervals share a moment.

    Spans name two columns of whole numbers, start and end, the end not included; columns of the two
    sides must differ but for the keys. A row is copied into every bin of `width` that its interval
    touches, and the bins are joined by equality, so only rows that are near each other meet; a bin
    that holds many is split by adaptive execution. A pair that meets in several bins counts
    in the first of them. The work is least where `width` is about the length of an interval: a longer
    one has a copy for each `width` of its length.

    Intervals that are empty or have a NULL bound, and NULL keys, share nothing. Where only counts or sums
    over the pairs are wanted and many intervals lie above each other, join with their `interval_steps`.
    """

    def binned(df: DataFrame, span: tuple[str, str], first: str) -> DataFrame:
        start, end = (F.col(c) for c in span)
        low, high = F.floor(start / width), F.floor((end - 1) / width)
        return df.filter(start < end).withColumns(
            {first: low, "_bin": F.explode(F.sequence(low, high))}
        )

    sides = binned(left, left_span, "_left_bin"), binned(right, right_span, "_right_bin")
    met = sides[0].join(sides[1], [*keys, "_bin"])
    starts_before = F.col(left_span[0]) < F.col(right_span[1])
    ends_after = F.col(right_span[0]) < F.col(left_span[1])
    own = F.col("_bin") == F.greatest("_left_bin", "_right_bin")
    return met.filter(starts_before & ends_after & own).drop("_bin", "_left_bin", "_right_bin")


def interval_steps(
    df: DataFrame,
    span: tuple[str, str],
    width: int,
    sums: Mapping[str, str],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Intervals that lie above each other as steps that do not: keys, the span's columns, `n`, and `sums`.

    While a step lasts, the same `n` intervals are open, and each of `sums` (name: column of whole
    numbers) is the exact total of its column over them, as a decimal; a NULL adds nothing. A moment
    so meets one step of its keys instead of every interval open then.

    An interval is copied into every bin of `width` that it touches, and its start and end are added up
    by moment first, so a bin is put in order as `width` rows at most, however many intervals it
    holds. Intervals that are empty or have a NULL bound are left out.
    """
    low, high = span
    # Bins are named by their first moment.
    first, last = (c - F.pmod(c, F.lit(width)) for c in (F.col(low), F.col(high) - 1))

    def turn(at: Column, sign: int) -> Column:
        totals = (F.col(c).cast("decimal(20,0)") * sign for c in sums.values())
        return F.struct(
            at.cast("long").alias("at"),
            F.lit(sign).cast("long").alias("n"),
            *(t.cast("decimal(20,0)").alias(name) for name, t in zip(sums, totals)),
        )

    copies = df.filter(F.col(low) < F.col(high)).withColumn(
        "_bin", F.explode(F.sequence(first.cast("long"), last.cast("long"), F.lit(width).cast("long")))
    )
    turns = F.array(turn(F.greatest(low, "_bin"), 1), turn(F.col(high), -1))
    turned = copies.select(*keys, "_bin", F.explode(turns).alias("_turn")).select(
        *keys, "_bin", "_turn.*"
    )
    end = F.col("_bin") + width
    changes = turned.filter(F.col("at") < end).groupBy(*keys, "_bin", "at").agg(
        *(F.sum(name).alias(name) for name in ("n", *sums))
    )
    order = Window.partitionBy(*keys, "_bin").orderBy("at")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    zero = F.lit(0).cast("decimal(38,0)")
    steps = changes.select(
        *keys,
        F.col("at").alias(low),
        F.coalesce(F.lead("at").over(order), end).alias(high),
        F.sum("n").over(running).alias("n"),
        *(F.coalesce(F.sum(name).over(running), zero).alias(name) for name in sums),
    )
    return steps.filter(F.col("n") > 0)
