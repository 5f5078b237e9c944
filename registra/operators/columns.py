"""Projections: positional rename and cleaned key columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registra.config import ColumnMap
from registra.functions.cleaning import digits_to_int


def rename_positional(df: DataFrame, names: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Give `_c0, _c1, ...` business names: all of them in order, or only the mapped ones."""
    if isinstance(names, Mapping):
        return df.withColumnsRenamed(dict(names))
    return df.toDF(*names)


def add_clean_keys(facts: DataFrame, columns: ColumnMap) -> DataFrame:
    """Add `mun_clean` and `sit_clean`; the raw columns stay."""
    return facts.withColumns(
        {
            "mun_clean": digits_to_int(F.col(columns.municipality)),
            "sit_clean": digits_to_int(F.col(columns.status)),
        }
    )


def sample_rows(df: DataFrame, n: int = 5, order_by: Sequence[str] | None = None) -> DataFrame:
    """Any n rows, or the first n of a given order (a top-k, not a full sort)."""
    return df.orderBy(*order_by).limit(n) if order_by else df.limit(n)
