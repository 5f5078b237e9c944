"""Search for a value in any column, and report which columns hold it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registra.functions.cleaning import text_equals


def _column_tests(df: DataFrame, value: str, columns: Sequence[str] | None) -> dict[str, Column]:
    return {
        name: text_equals(F.col(f"`{name}`"), df.schema[name].dataType, value)
        for name in (columns or df.columns)
    }


def holds_value(df: DataFrame, value: str, columns: Sequence[str] | None = None) -> Column:
    """True where any column reads exactly as `value`; NULL when only NULLs could have.

    A chain of comparisons keeps the truth table of a search through an array of the
    columns, but stops at the first hit, builds no array per row and reaches the scan.
    """
    return reduce(Column.__or__, _column_tests(df, value, columns).values())


def any_column_equals(
    df: DataFrame, value: str, columns: Sequence[str] | None = None
) -> DataFrame:
    return df.filter(holds_value(df, value, columns))


def locate_value(df: DataFrame, value: str, columns: Sequence[str] | None = None) -> DataFrame:
    """`col_name, matches` for every column, counted in one pass."""
    tests = _column_tests(df, value, columns)
    counts = df.agg(*[F.count_if(test).alias(name) for name, test in tests.items()])
    return counts.unpivot([], [F.col(f"`{n}`") for n in tests], "col_name", "matches")
