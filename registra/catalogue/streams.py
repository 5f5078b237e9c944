"""Queries: event streams that arrive in parts, some rows late."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from registra.catalogue.registry import query
from registra.catalogue.tables import table
from registra.session import work_folder
from registra.streaming.events import (
    closed_sessions,
    latest_updates,
    rocks_db,
    run_available,
    windowed_counts,
)

# Rows of the first ten days come in the first part, but for some that come with the second.
FIRST_DAYS, LATE_EVERY, DELAY = "2024-01-11", 40, "2 hours"
GAP_MINUTES = 30
LATE_SQL = f"ts < timestamp '{FIRST_DAYS}' and event_id % {LATE_EVERY} = 0"


def _arrivals(spark, sf):
    """Events in the parts in which they arrive, as rows `ts, user_id, event_type`."""
    events = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    early = F.col("ts") < F.lit(FIRST_DAYS).cast("timestamp")
    late = F.col("event_id") % LATE_EVERY == 0
    middle = F.col("ts") < F.lit("2024-01-21").cast("timestamp")
    for part in (early & ~late, (early & late) | (~early & middle), ~middle):
        yield events.filter(part).select("ts", "user_id", "event_type")


def _followed(spark, sf, query, mode):
    """The output of a stream over an inbox, brought up to date after each arrival."""
    inbox, folder = work_folder(spark, "inbox"), work_folder(spark, "updates")
    checkpoint = work_folder(spark, "progress")
    stream = None
    for part in _arrivals(spark, sf):
        part.write.mode("append").parquet(inbox)
        stream = query(spark.readStream.schema(part.schema).parquet(inbox))
        run_available(stream, checkpoint, folder, mode)
    return folder, stream.schema


@query(
    "stream_hourly_counts",
    f"""with parts as (select *, {LATE_SQL} as late from events),
        mark as (select max(ts) - interval {DELAY} as seen from parts
                 where not late and ts < timestamp '{FIRST_DAYS}')
        select event_type, date_trunc('hour', ts) as hour, count(*) as n from parts, mark
        where not late or date_trunc('hour', ts) + interval 1 hour > seen
        group by all""",
)
def stream_hourly_counts(spark, sf):
    """Events by type and hour, without those that came after their hour was closed."""
    folder, schema = _followed(
        spark, sf, lambda s: windowed_counts(s, "ts", ["event_type"], "1 hour", DELAY), "update"
    )
    counts = latest_updates(spark, folder, schema, ["event_type", "start"])
    return counts.select("event_type", F.col("start").cast("timestamp_ntz").alias("hour"), "n")


@query(
    "stream_user_sessions",
    f"""with parts as (select *, {LATE_SQL} as late from events),
        mark as (select max(ts) - interval {DELAY} as seen from parts
                 where not late and ts < timestamp '{FIRST_DAYS}'),
        kept as (select user_id, epoch_us(ts) as at_us from parts, mark
                 where not late or ts > seen),
        begun as (select *, coalesce(at_us - lag(at_us) over w > {GAP_MINUTES} * 60000000, true) as new
                  from kept window w as (partition by user_id order by at_us)),
        numbered as (select *, sum(new::int) over (partition by user_id order by at_us, new desc
                            rows unbounded preceding) as number from begun),
        sessions as (select user_id, min(at_us) as first, max(at_us) as last, count(*) as n
                     from numbered group by user_id, number)
        select sessions.* from sessions
        where last + {GAP_MINUTES} * 60000000 <= (select epoch_us(max(ts) - interval {DELAY}) from events)""",
)
def stream_user_sessions(spark, sf):
    """Sessions of each user that the last watermark has closed."""
    gap = GAP_MINUTES * 60_000_000
    with rocks_db(spark):
        folder, schema = _followed(
            spark, sf, lambda s: closed_sessions(s, "user_id", "ts", gap, DELAY), "append"
        )
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())]))
    return rows.parquet(folder).drop("batch")
