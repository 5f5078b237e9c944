"""Gold: active head offices and branches."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registra.config import ACTIVE, SAO_PAULO, ColumnMap
from registra.functions.cleaning import kind_label
from registra.operators.columns import add_clean_keys
from registra.operators.lookup import clean_lookup, keep_codes

CITY = ["municipio_cod", "municipio_nome"]


def by_kind(silver: DataFrame, kind: str) -> DataFrame:
    """Rows per flag. NULL and unknown flags stay, so the counts sum to the silver rows."""
    return silver.groupBy(F.col(kind).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def by_city(silver: DataFrame, kind: str) -> DataFrame:
    return silver.groupBy(*CITY, F.col(kind).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def active_by_city(
    facts: DataFrame,
    lookup: DataFrame,
    columns: ColumnMap = ColumnMap(),
    codes: Collection[int] | None = (SAO_PAULO,),
    active: int = ACTIVE,
) -> DataFrame:
    """The same as :func:`by_city` over silver, straight from the facts.

    Both sides are counted before they meet: facts per code and flag, lookup rows per code
    and name. Only group rows are shuffled then, however many facts one city holds, and a
    pair of groups stands for all the rows the plain join would give.
    """
    cities = keep_codes(clean_lookup(lookup), codes)
    copies = cities.groupBy(*CITY).agg(F.count(F.lit(1)).alias("copies"))
    counted = (
        add_clean_keys(facts, columns)
        .filter(F.col("sit_clean") == active)
        .groupBy("mun_clean", F.col(columns.kind).alias("kind"))
        .agg(F.count(F.lit(1)).alias("facts"))
    )
    # A plain comparison would test the cleaned codes for NULL below both aggregates, and so clean
    # them twice.
    known = copies.filter(copies.municipio_cod.isNotNull())
    return counted.join(known, counted.mun_clean.eqNullSafe(known.municipio_cod)).select(
        *CITY, "kind", (F.col("facts") * F.col("copies")).alias("n")
    )


def total_by_kind(city_counts: DataFrame) -> DataFrame:
    return city_counts.groupBy("kind").agg(F.sum("n").alias("n"))


def with_labels(counts: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    return counts.withColumn("label", kind_label(F.col("kind"), labels))


def pivot_kinds(city_counts: DataFrame, kinds: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """One column per given flag, 0 where a city has none. Other flags are not shown."""
    return (
        city_counts.groupBy(*keys)
        .agg(*[F.sum(F.when(F.col("kind") == k, F.col("n"))).alias(k) for k in kinds])
        .fillna(0, subset=list(kinds))
    )
