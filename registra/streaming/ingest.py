"""Incremental ingest: every archive under a folder is landed once, and again when replaced.

A stream of archives (see :mod:`registra.streaming.source`) is landed by `foreachBatch`. Landing
replaces the partition of an archive, and what a batch has landed is recorded under its number after
its rows are committed. So a batch that Spark hands over again, after a failure anywhere between
landing and its own commit, adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from registra.session import qualify, work_folder
from registra.sinks.bronze import land_archives
from registra.sources.filesystem import list_files, subfolders
from registra.streaming.source import archive_stream

LANDED_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("below", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("batch", T.LongType()),
        T.StructField("part", T.IntegerType()),
    ]
)
FILES_PER_BATCH = 1000


def arriving_archives(
    spark: SparkSession, folder: str, contains: str = "", log: str | None = None
) -> DataFrame:
    """Stream of `path, length` of the archives below a folder, again whenever one is replaced.

    A query that is to go on after a restart names its `log`, as it does its checkpoint.
    """
    log = log or work_folder(spark, "archive-log")
    return archive_stream(spark, folder, log, contains).select("path", "length")


@dataclass(frozen=True)
class IngestResult:
    archives: int
    rows: int


def landed_archives(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What was landed last under each path: `path, length, modificationTime`."""
    folder = f"{checkpoint}/landed"
    if not subfolders(qualify(spark, folder)):
        return spark.createDataFrame([], LANDED_SCHEMA).select(
            "path", "length", "modificationTime"
        )
    records = spark.read.schema(LANDED_SCHEMA).parquet(folder)
    newest = F.max_by(F.struct("length", "modificationTime"), "batch").alias("last")
    return records.groupBy("path").agg(newest).select(
        "path", "last.length", "last.modificationTime"
    )


class BronzeSink:
    """Lands batches of archives, each once, however often it is handed over.

    A batch is landed in parts of about `files_per_batch` archives, by a hash of their path. A part
    is recorded as a whole in `<checkpoint>/landed/batch=<id>/part=<n>`; recorded parts are passed
    over. A part that was landed but not recorded is landed again, onto the same partitions.
    """

    def __init__(
        self,
        bronze: str,
        checkpoint: str,
        schema: T.StructType,
        files_per_batch: int = FILES_PER_BATCH,
        storage: Mapping[str, str] | None = None,
        land: Callable = land_archives,
    ):
        self.bronze, self.checkpoint, self.schema = bronze, checkpoint, schema
        self.files_per_batch, self.storage, self.land = files_per_batch, dict(storage or {}), land
        self.archives = self.rows = 0

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        total = batch.count()
        parts = -(-total // self.files_per_batch)
        for part in range(parts):
            record = f"{self.checkpoint}/landed/batch={batch_id}/part={part}"
            if list_files(qualify(spark, record), "_SUCCESS", self.storage):
                continue
            own = batch.filter(F.pmod(F.xxhash64("path"), F.lit(parts)) == part)
            written = self.land(own, self.bronze, self.schema, storage=self.storage)
            own.write.mode("overwrite").parquet(record)
            self.rows += written.rows
            self.archives += own.count()


def start_ingest(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    sink: BronzeSink,
    contains: str = "",
    every: str | None = None,
) -> StreamingQuery:
    """Start the stream: for what is there now, or, with `every` ("30 seconds"), until stopped."""
    arriving = archive_stream(spark, folder, f"{checkpoint}/log", contains, **sink.storage)
    writer = (
        arriving.writeStream.foreachBatch(sink)
        .option("checkpointLocation", f"{checkpoint}/stream")
        .queryName(f"ingest {folder}")
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def _interrupted(spark: SparkSession, checkpoint: str, storage: Mapping[str, str] | None) -> bool:
    """Whether the last batch that was begun is not committed."""
    begun, done = (
        {f.rpartition("/")[2] for f in list_files(qualify(spark, f"{checkpoint}/stream/{log}"), "", storage)}
        for log in ("offsets", "commits")
    )
    return bool({f for f in begun if f.isdigit()} - done)


def ingest_archives(
    spark: SparkSession,
    folder: str,
    bronze: str,
    checkpoint: str,
    schema: T.StructType,
    contains: str = "",
    files_per_batch: int = FILES_PER_BATCH,
    storage: Mapping[str, str] | None = None,
) -> IngestResult:
    """Land all archives that are new or replaced since the last run.

    A failed run raises what stopped it; the next one goes on with the batch that it was at.
    """
    sink = BronzeSink(bronze, checkpoint, schema, files_per_batch, storage)
    # A run that begins with the batch of a failed one ends with it; what came since takes another.
    for _ in range(2 if _interrupted(spark, checkpoint, storage) else 1):
        start_ingest(spark, folder, checkpoint, sink, contains).awaitTermination()
    return IngestResult(sink.archives, sink.rows)
