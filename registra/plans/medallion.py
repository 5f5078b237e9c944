"""One monthly run: archives to bronze, bronze to silver, silver to gold."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registra.config import (
    FACTS_DATASET,
    LOOKUP_DATASET,
    LOOKUP_SCHEMA,
    RunConfig,
    text_schema,
)
from registra.functions.paths import file_name
from registra.operators.columns import rename_positional
from registra.operators.gold import by_city, by_kind, with_labels
from registra.operators.lookup import clean_lookup, keep_codes, repeated_codes
from registra.operators.metrics import run_metrics
from registra.operators.search import holds_value
from registra.operators.silver import build_silver
from registra.sinks.bronze import land_month, read_bronze
from registra.sinks.parquet import (
    SKIPPED_EMPTY,
    SKIPPED_GUARD,
    WriteResult,
    overwrite_partitions,
)
from registra.sources.archive import expand_archives, first_line, has_archives
from registra.sources.delimited import parse_lines, width_of
from registra.sources.listing import list_archives

SILVER_KEYS = T.StructType(
    [
        T.StructField("mun_clean", T.IntegerType(), True),
        T.StructField("sit_clean", T.IntegerType(), True),
        T.StructField("municipio_cod", T.IntegerType(), True),
        T.StructField("municipio_nome", T.StringType(), True),
        T.StructField("ref_month", T.StringType(), True),
    ]
)


@dataclass(frozen=True)
class RunResult:
    """What a run did. `gold` counts the month's silver, or is None if nothing was written;
    `metrics` is None if the run searched for nothing."""

    facts: WriteResult
    lookup: WriteResult
    silver: WriteResult
    gold: DataFrame | None
    metrics: dict[str, int] | None = None


def fact_schema(spark: SparkSession, cfg: RunConfig) -> T.StructType | None:
    """The configured width, or the width of the first line of the largest member.

    None if there is no line to take it from and missing input counts as empty.
    """
    if cfg.width is not None:
        return text_schema(cfg.width)
    folder = f"{cfg.archives}/{FACTS_DATASET}_{cfg.ref_month}"
    line = first_line(spark, folder, storage=cfg.storage_options)
    if line is None and cfg.on_missing == "empty":
        return None
    if line is None:
        raise FileNotFoundError(f"PATH_NOT_FOUND: no line under {folder} to take a width from")
    return text_schema(width_of(spark, line))


def land_dataset(
    spark: SparkSession, cfg: RunConfig, dataset: str, schema: T.StructType
) -> WriteResult:
    """Unpack one dataset's month into bronze, as columns, so that later scans read few of them.

    Where missing input counts as empty, a month without archives is left as it was landed.
    """
    folder = f"{cfg.archives}/{dataset}_{cfg.ref_month}"
    if not has_archives(spark, folder, cfg.storage_options):
        if cfg.on_missing == "empty":
            return WriteResult(SKIPPED_EMPTY, 0)
        raise FileNotFoundError(f"PATH_NOT_FOUND: no archive under {folder}")
    lines = expand_archives(
        list_archives(spark, folder, storage=cfg.storage_options).select("path"),
        storage=cfg.storage_options,
        member_conflict=cfg.member_conflict,
    )
    rows = parse_lines(lines.withColumn("archive", file_name(F.col("archive"))), schema)
    return land_month(rows, cfg.bronze, dataset, cfg.ref_month, cfg.storage_options)


def month_of_bronze(
    spark: SparkSession, cfg: RunConfig, dataset: str, schema: T.StructType
) -> DataFrame:
    rows = read_bronze(spark, cfg.bronze, schema, dataset, cfg.ref_month)
    return rows.select(*schema.names)


def guard_passes(facts: DataFrame, cfg: RunConfig) -> bool:
    """Whether the run may write: always, or if a raw column reads as a wanted code.

    The search stops at the first hit instead of counting them all.
    """
    if cfg.guard == "none":
        return True
    if cfg.guard != "any_column" or not cfg.codes:
        raise ValueError("guard must be none, or any_column together with codes")
    hit = reduce(Column.__or__, [holds_value(facts, str(code)) for code in cfg.codes])
    return not facts.filter(hit).isEmpty()


def read_silver(
    spark: SparkSession, cfg: RunConfig, schema: T.StructType, ref_month: str | None = None
) -> DataFrame:
    """Silver of one month (or all), where `schema` is that of the raw fact columns."""
    raw = [T.StructField(cfg.names.get(f.name, f.name), f.dataType) for f in schema.fields]
    reader = spark.read.schema(T.StructType([*raw, *SILVER_KEYS.fields]))
    folder = f"{cfg.silver}/ref_month={ref_month}" if ref_month else cfg.silver
    return reader.option("basePath", cfg.silver).parquet(folder)


def build_gold(spark: SparkSession, cfg: RunConfig, schema: T.StructType) -> DataFrame:
    """Labelled counts of the month's silver, stored by month if the run has a gold path."""
    stored = read_silver(spark, cfg, schema, cfg.ref_month)
    kind = cfg.names.get(cfg.columns.kind, cfg.columns.kind)
    counts = by_city(stored, kind) if cfg.gold_by_city else by_kind(stored, kind)
    gold = with_labels(counts, cfg.kind_labels)
    if cfg.gold is None:
        return gold
    overwrite_partitions(
        gold.withColumn("ref_month", F.lit(cfg.ref_month)), cfg.gold, ["ref_month"]
    )
    return spark.read.schema(gold.schema).parquet(f"{cfg.gold}/ref_month={cfg.ref_month}")


def refine(
    spark: SparkSession, cfg: RunConfig, schema: T.StructType
) -> tuple[WriteResult, DataFrame | None]:
    """One month that lies in bronze to silver, and the gold counts over it."""
    facts = month_of_bronze(spark, cfg, FACTS_DATASET, schema)
    lookup = month_of_bronze(spark, cfg, LOOKUP_DATASET, LOOKUP_SCHEMA)
    if cfg.unique_lookup:
        repeated = repeated_codes(keep_codes(clean_lookup(lookup), cfg.codes)).first()
        if repeated:
            raise ValueError(f"lookup code {repeated['municipio_cod']} occurs more than once")
    if not guard_passes(facts, cfg):
        return WriteResult(SKIPPED_GUARD, 0), None
    silver = build_silver(facts, lookup, cfg.columns, cfg.codes, cfg.active)
    month = rename_positional(silver, cfg.names).withColumn("ref_month", F.lit(cfg.ref_month))
    written = overwrite_partitions(
        month, cfg.silver, ["ref_month"], sort_by=["municipio_cod"], one_partition=True
    )
    return written, build_gold(spark, cfg, schema) if written.rows else None


def month_metrics(
    spark: SparkSession, cfg: RunConfig, schema: T.StructType
) -> dict[str, int] | None:
    """`n_lookup, n_search, n_final` of one month that lies in bronze, in one pass over its facts."""
    if cfg.search is None:
        return None
    facts = month_of_bronze(spark, cfg, FACTS_DATASET, schema)
    lookup = month_of_bronze(spark, cfg, LOOKUP_DATASET, LOOKUP_SCHEMA)
    counts = run_metrics(facts, lookup, cfg.search, cfg.columns, cfg.codes, cfg.active)
    return counts.first().asDict()


def run(spark: SparkSession, cfg: RunConfig) -> RunResult:
    """Archives of one month to bronze, silver and gold."""
    schema = fact_schema(spark, cfg)
    nothing = WriteResult(SKIPPED_EMPTY, 0)
    facts = land_dataset(spark, cfg, FACTS_DATASET, schema) if schema else nothing
    lookup = land_dataset(spark, cfg, LOOKUP_DATASET, LOOKUP_SCHEMA)
    if SKIPPED_EMPTY in (facts.status, lookup.status):
        return RunResult(facts, lookup, WriteResult(SKIPPED_EMPTY, 0), None)
    silver, gold = refine(spark, cfg, schema)
    return RunResult(facts, lookup, silver, gold, month_metrics(spark, cfg, schema))
