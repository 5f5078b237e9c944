"""Object listings as DataFrames: path, size, age, dataset and month of every file."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registra.config import ARCHIVE_SUFFIX
from registra.functions import paths as P
from registra.session import qualify, ship_package
from registra.sources.filesystem import resolve


def list_objects(spark: SparkSession, root: str, suffix: str = ARCHIVE_SUFFIX) -> DataFrame:
    """`path, length, modificationTime` of the files below a folder; contents are not read.

    An empty suffix lists everything, which the folder-wide in-progress rule needs.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    reader = reader.option("pathGlobFilter", f"*{suffix}") if suffix else reader
    return reader.load(root).select("path", "length", "modificationTime")


_FOUND = pa.schema(
    [
        ("path", pa.string()),
        ("below", pa.string()),
        ("length", pa.int64()),
        # A timestamp would have to carry the time zone of the session.
        ("modified", pa.int64()),
        ("folder", pa.bool_()),
    ]
)


def list_archives(
    spark: SparkSession,
    root: str,
    suffix: str = ARCHIVE_SUFFIX,
    storage: Mapping[str, str] | None = None,
) -> DataFrame:
    """The same columns for every archive below a folder, whatever its name, and `below`, its path
    below that folder.

    Spark's own listing passes over names that begin with `_` or `.`, which the archive reader
    takes. Tasks do the listing, one for each folder right below the root, so no path reaches the
    driver. A folder that is not there holds nothing.
    """
    ship_package()
    top, options = qualify(spark, root), dict(storage or {})

    def found(uri: str, recursive: bool) -> pa.RecordBatch:
        _, base, _ = resolve(top, options)
        store, path, prefix = resolve(uri, options)
        chosen = fs.FileSelector(path, recursive=recursive, allow_not_found=True)
        rows = [
            {"path": prefix + f.path, "below": f.path[len(base.rstrip("/")) :].lstrip("/"),
             "length": f.size or 0, "modified": (f.mtime_ns or 0) // 1000,
             "folder": f.type == fs.FileType.Directory}
            for f in store.get_file_info(chosen)
            if f.path.endswith(suffix) or not recursive
        ]
        return pa.RecordBatch.from_pylist(rows, schema=_FOUND)

    def children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _ in range(batch.num_rows):
                yield found(top, recursive=False)

    def below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            folder = batch.column("folder")
            yield batch.filter(pc.invert(folder))
            for row in batch.filter(folder).to_pylist():
                yield found(row["path"], recursive=True)

    kind = "path string, below string, length long, modified long, folder boolean"
    first = spark.range(1).mapInArrow(children, kind)
    listed = first.repartition(spark.sparkContext.defaultParallelism, "path").mapInArrow(below, kind)
    return listed.filter(~F.col("folder") & F.col("path").endswith(suffix)).select(
        "path", "below", "length", F.timestamp_micros("modified").alias("modificationTime")
    )


def routed(listing: DataFrame) -> DataFrame:
    """Add `dataset`, `ref_month` and `name`, read off the path."""
    path = F.col("path")
    return listing.withColumns(
        {"dataset": P.dataset(path), "ref_month": P.ref_month(path), "name": P.file_name(path)}
    )


def complete_files(listing: DataFrame, rule: str = "file") -> DataFrame:
    """Drop files still being written.

    `file`: only the unfinished files themselves. `folder`: every file of a folder in which
    anything is unfinished.
    """
    path = F.col("path")
    finished = listing.filter(~P.in_progress(path))
    if rule == "file":
        return finished
    if rule != "folder":
        raise ValueError(f"rule must be file or folder, not {rule}")
    busy = listing.filter(P.in_progress(path)).select(P.folder(path).alias("folder")).distinct()
    return (
        finished.withColumn("folder", P.folder(path))
        .join(busy, "folder", "left_anti")
        .select(*listing.columns)
    )


def manifest(listing: DataFrame) -> DataFrame:
    """`name, size_mib` per file; the size is in whole MiB, rounded down."""
    return listing.select(
        P.file_name(F.col("path")).alias("name"), P.whole_mib(F.col("length")).alias("size_mib")
    )


def select_dataset(listing: DataFrame, contains: str) -> DataFrame:
    """Files whose name contains the dataset's word, case-sensitive; empty names are dropped."""
    name = P.file_name(F.col("path"))
    return listing.filter((name != "") & name.contains(contains))
