"""Rows that every operator has to survive."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

LONG = "lorem ipsum dolor sit amet. " * 8000
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today.", "en"),
    (2, "THE QUICK brown fox jumps over the lazy dog near the river bank today.", "en"),
    (2, "THE QUICK brown fox jumps over the lazy dog near the river bank today.", "en"),
    (3, None, "en"),
    (4, "", None),
    (5, "   \t\n ", "en"),
    (None, "The quick brown fox jumps over the lazy dog near the river bank today.", None),
    (None, None, None),
    (6, LONG, "la"),
    (7, "x" * 120_000, "und"),
    (8, "Éléphant ÉLÉPHANT naïve ▁ 漢字 \U0001f600 é", "fr"),
    (9, "éléphant", "fr"),
]
# Names that the operators use for columns of their own.
CLASHES = ["id", "row", "run", "digest", "gone", "kept", "fp", "part", "unit", "n", "spans", "_mark"]


def edge_docs(spark: SparkSession, rows=ROWS) -> DataFrame:
    ids, texts, langs = zip(*rows, strict=True) if rows else ((), (), ())
    columns = {
        "doc_id": pa.array(ids, pa.int64()),
        "text": pa.array(texts, pa.string()),
        "lang": pa.array(langs, pa.string()),
        "source": pa.array([None if i == 9 else "s0" for i in ids], pa.string()),
    }
    columns |= {name: pa.array([f"own {name}"] * len(ids), pa.string()) for name in CLASHES}
    return spark.createDataFrame(pa.table(columns))


def texts(spark: SparkSession, values: dict) -> DataFrame:
    return edge_docs(spark, [(k, v, "en") for k, v in values.items()])


def by_id(df: DataFrame, key: str = "doc_id") -> dict:
    return {r[key]: r for r in df.collect()}
