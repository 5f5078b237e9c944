"""Event streams: counts by window of event time, and sessions by key, with late rows told apart.

Both know how far event time has come by a watermark, `delay` behind the latest time seen. A window or
session that lies before it is closed, and a row that would change one is late and counts no more.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from registra.session import qualify, ship_package
from registra.sources.filesystem import list_files

ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def windowed_counts(
    stream: DataFrame, time: str, keys: Sequence[str], length: str, delay: str
) -> DataFrame:
    """`keys, start, n`: rows by key and window of event time. State holds one count for each key and
    window that is still open; a row whose window is closed is dropped."""
    seen = stream.withWatermark(time, delay)
    counted = seen.groupBy(F.window(time, length), *keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(*keys, F.col("window.start").alias("start"), "n")


class UpdatesSink:
    """Writes what a batch changed under the number of the batch. A batch that is handed over again
    replaces what it wrote."""

    def __init__(self, folder: str):
        self.folder = folder

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.folder}/batch={batch_id}")


def latest_updates(
    spark: SparkSession, folder: str, schema: T.StructType, keys: Sequence[str]
) -> DataFrame:
    """The last state of each key that an :class:`UpdatesSink` was given."""
    if not list_files(qualify(spark, folder), ".parquet"):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())]))
    others = [f.name for f in schema.fields if f.name not in keys]
    last = F.max_by(F.struct(*others), "batch").alias("last")
    return rows.parquet(folder).groupBy(*keys).agg(last).select(*keys, "last.*").select(*schema.names)


class Sessions(StatefulProcessor):
    """Sessions of a key: rows each no more than `gap` microseconds after the one before.

    Rows may come in any order while they are not late, so what is open is a list of sessions that a
    row may begin, extend or join. As a closed session cannot be met by a row that is not late, the list
    stays as short as the watermark's delay allows.

    A key has one timer, at the end of its first open session; when it fires, all that have ended by the
    watermark are closed at once. So the calls to the state grow with the keys of a batch, not with
    their sessions.
    """

    def __init__(self, key: str, gap: int):
        self.key, self.gap = key, gap

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "sessions array<struct<first:long,last:long,n:long>>")

    def _expiry(self, last: int) -> int:
        return -(-(last + self.gap) // 1000)

    def _held(self) -> list[list[int]]:
        """The open sessions, in order."""
        held = self.open.get()
        return [list(s) for s in held[0]] if held else []

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = self._held()
        moments = [[m, m, 1] for m in (r["moment"] for r in rows)]
        joined: list[list[int]] = []
        for first, last, n in sorted(before + moments):
            if joined and first <= joined[-1][1] + self.gap:
                joined[-1][1] = max(joined[-1][1], last)
                joined[-1][2] += n
            else:
                joined.append([first, last, n])
        old, new = (self._expiry(s[0][1]) if s else None for s in (before, joined))
        if old != new:
            if old is not None:
                self.handle.deleteTimer(old)
            self.handle.registerTimer(new)
        self.open.update(([tuple(s) for s in joined],))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        held = self._held()
        closed = [s for s in held if self._expiry(s[1]) <= now]
        left = [tuple(s) for s in held[len(closed) :]]
        if left:
            self.open.update((left,))
            self.handle.registerTimer(self._expiry(left[0][1]))
        else:
            self.open.clear()
        for first, last, n in closed:
            yield Row(**{self.key: key[0], "first": first, "last": last, "n": n})

    def close(self) -> None:
        """Nothing is held outside the state."""


def closed_sessions(stream: DataFrame, key: str, time: str, gap: int, delay: str) -> DataFrame:
    """`key, first, last, n`: sessions of event time, in microseconds, once no row can change them.

    Rows before the watermark are dropped. A key's rows of a batch are handled by one task, which holds
    its open sessions only; Python gets a column of times. Null times belong to no session.
    """
    ship_package()
    kind = stream.schema[key].dataType.simpleString()
    moments = stream.filter(F.col(time).isNotNull()).withWatermark(time, delay)
    moments = moments.select(key, time, F.unix_micros(time).alias("moment"))
    return moments.groupBy(key).transformWithState(
        statefulProcessor=Sessions(key, gap),
        outputStructType=f"{key} {kind}, first long, last long, n long",
        outputMode="append",
        timeMode="EventTime",
    )


@contextmanager
def rocks_db(spark: SparkSession) -> Iterator[None]:
    """Start queries inside with a state store that `transformWithState` can use."""
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, ROCKS_DB)
    try:
        yield
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


def run_available(stream: DataFrame, checkpoint: str, folder: str, mode: str) -> StreamingQuery:
    """Bring a query up to date with what is there, into an :class:`UpdatesSink`."""
    query = (
        stream.writeStream.foreachBatch(UpdatesSink(folder))
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
