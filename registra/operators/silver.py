"""Silver: cleaned, active establishments of the chosen cities."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registra.config import ACTIVE, SAO_PAULO, ColumnMap
from registra.operators.columns import add_clean_keys
from registra.operators.lookup import clean_lookup, join_lookup, keep_codes
from registra.operators.search import any_column_equals


def build_silver(
    facts: DataFrame,
    lookup: DataFrame,
    columns: ColumnMap = ColumnMap(),
    codes: Collection[int] | None = (SAO_PAULO,),
    active: int = ACTIVE,
) -> DataFrame:
    """All raw columns, both cleaned keys and the lookup columns, in one pass over the facts.

    Status is tested before the join, so only active facts are matched with a city.
    """
    cities = keep_codes(clean_lookup(lookup), codes)
    alive = add_clean_keys(facts, columns).filter(F.col("sit_clean") == active)
    return join_lookup(alive, cities)


def guarded(silver: DataFrame, facts: DataFrame, value: str) -> DataFrame:
    """Silver, or no rows at all unless some raw column reads exactly as `value`.

    The test is an uncorrelated EXISTS: Spark runs it once and stops at the first hit.
    """
    hits = any_column_equals(facts, value).select(F.lit(1).alias("hit"))
    return silver.where(hits.exists())
