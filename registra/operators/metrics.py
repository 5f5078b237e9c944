"""Run metrics: lookup hits, search hits and final rows."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registra.config import ACTIVE, SAO_PAULO, ColumnMap
from registra.operators.columns import add_clean_keys
from registra.operators.lookup import clean_lookup, keep_codes
from registra.operators.search import holds_value


def run_metrics(
    facts: DataFrame,
    lookup: DataFrame,
    value: str,
    columns: ColumnMap = ColumnMap(),
    codes: Collection[int] | None = (SAO_PAULO,),
    active: int = ACTIVE,
    search_columns: Sequence[str] | None = None,
) -> DataFrame:
    """One row `n_lookup, n_search, n_final` from a single pass over the facts."""
    cities = keep_codes(clean_lookup(lookup), codes)
    copies = cities.groupBy("municipio_cod").agg(F.count(F.lit(1)).alias("copies"))
    per_code = (
        add_clean_keys(facts, columns)
        .groupBy("mun_clean")
        .agg(
            F.count_if(holds_value(facts, value, search_columns)).alias("hits"),
            F.count_if(F.col("sit_clean") == active).alias("alive"),
        )
    )
    matched = per_code.join(copies, per_code.mun_clean == copies.municipio_cod, "left")
    n_lookup = cities.agg(F.count(F.lit(1)).alias("n"))
    return matched.agg(
        F.coalesce(F.sum("hits"), F.lit(0)).alias("n_search"),
        F.coalesce(F.sum(F.col("alive") * F.col("copies")), F.lit(0)).alias("n_final"),
    ).select(n_lookup.scalar().alias("n_lookup"), "n_search", "n_final")
