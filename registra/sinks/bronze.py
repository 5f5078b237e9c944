"""Bronze landing: one partition per dataset, month and archive."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registra.functions import paths as P
from registra.session import qualify
from registra.sinks.parquet import (
    WriteResult,
    concurrent_writers,
    overwrite_partitions,
    overwrite_seen,
    partition_folder,
)
from registra.sources.archive import expand_archives
from registra.sources.delimited import parse_lines
from registra.sources.filesystem import drop_folder, subfolders

BRONZE_KEYS = ["dataset", "ref_month", "archive"]


def bronze_keys(listing: DataFrame) -> list[Column]:
    """`dataset, ref_month, archive` of a listing's archives.

    A path that does not say dataset and month fails the job: landed without a month, its
    rows could not be found again. The archive's key is its name, after the folders above that of
    dataset and month if the listing has paths `below` its root, so that equal names in two
    folders stay apart.
    """
    path = F.col("path")
    misplaced = F.raise_error(F.concat(F.lit("no <dataset>_<yyyy-mm> folder in "), path))
    return [
        F.coalesce(P.dataset(path), misplaced.cast("string")).alias("dataset"),
        F.coalesce(P.ref_month(path), misplaced.cast("string")).alias("ref_month"),
        (P.apart_from_month(F.col("below")) if "below" in listing.columns else P.file_name(path)).alias(
            "archive"
        ),
    ]


def keyed_lines(
    listing: DataFrame,
    tasks: int | None = None,
    storage: Mapping[str, str] | None = None,
    member_conflict: str = "all",
) -> DataFrame:
    """Lines of listed archives with their keys: `dataset, ref_month, archive, member, line`.

    The keys are worked out once per archive and repeated on its lines; taking them off the
    path of every line would cost as much as parsing it. `member_conflict="last"` keeps of
    members with one name in a dataset and month those of the last archive.
    """
    dataset, ref_month, archive = bronze_keys(listing)
    named = listing.select("path", dataset, ref_month, archive.alias("file"))
    lines = expand_archives(
        named,
        tasks or task_count(listing),
        storage=storage,
        member_conflict=member_conflict,
        within=["dataset", "ref_month"],
    )
    return lines.select("dataset", "ref_month", F.col("file").alias("archive"), "member", "line")


def task_count(listing: DataFrame, packed_bytes: int = 32 << 20) -> int:
    """Tasks to deal archive slices to: enough to even out their sizes over all cores, and for the
    bytes of the archives, if the listing has them."""
    spark = listing.sparkSession
    total = 0
    if "length" in listing.columns:
        total = listing.agg(F.sum("length")).first()[0] or 0
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(2 * spark.sparkContext.defaultParallelism, shuffles, -(-total // packed_bytes))


def land_bronze(rows: DataFrame, bronze: str) -> WriteResult:
    """Land rows with the three keys. Landing an archive again replaces only that archive.

    A task reads few archives, so it writes into few partitions and nothing is shuffled.
    """
    with concurrent_writers(rows.sparkSession):
        return overwrite_partitions(rows, bronze, BRONZE_KEYS)


def land_archives(
    listing: DataFrame,
    bronze: str,
    schema: T.StructType,
    tasks: int | None = None,
    storage: Mapping[str, str] | None = None,
) -> WriteResult:
    """Land every archive of a listing, as columns; one without rows replaces by nothing.

    New rows are committed before an emptied archive's old ones go, so a failure never leaves
    less than there was. The listing's keys are collected: it is one batch of an ingest.
    """
    spark = listing.sparkSession
    rows = parse_lines(keyed_lines(listing, tasks, storage), schema)
    with concurrent_writers(spark):
        written, seen = overwrite_seen(rows, bronze, BRONZE_KEYS)
    for keys in listing.select(*bronze_keys(listing)).distinct().collect():
        if tuple(keys) not in seen:
            folder = f"{bronze}/{partition_folder(BRONZE_KEYS, keys)}"
            drop_folder(qualify(spark, folder), storage)
    return written


def land_month(
    rows: DataFrame,
    bronze: str,
    dataset: str,
    ref_month: str,
    storage: Mapping[str, str] | None = None,
) -> WriteResult:
    """Land one dataset's whole month, keyed by archive, in place of what it held before.

    Archives that have rows are replaced first, then those that have none any more go.
    """
    month = f"{bronze}/{partition_folder(BRONZE_KEYS[:2], (dataset, ref_month))}"
    with concurrent_writers(rows.sparkSession):
        written, seen = overwrite_seen(rows.drop("dataset", "ref_month"), month, ["archive"])
    kept = {partition_folder(["archive"], name) for name in seen}
    root = qualify(rows.sparkSession, month)
    for name in subfolders(root, storage):
        if name.startswith("archive=") and name not in kept:
            drop_folder(f"{root}/{name}", storage)
    return written


def read_bronze(
    spark: SparkSession, bronze: str, schema: T.StructType, dataset: str, ref_month: str
) -> DataFrame:
    """Landed rows of one dataset and month. Only that month's folder is listed."""
    keys = [T.StructField(k, T.StringType(), True) for k in BRONZE_KEYS]
    return (
        spark.read.schema(T.StructType([*schema.fields, *keys]))
        .option("basePath", bronze)
        .parquet(f"{bronze}/dataset={dataset}/ref_month={ref_month}")
    )
