"""Delimited text: the lookup with its fixed schema, the facts as strings."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registra.config import ENCODING, FIELD_SEPARATOR, LOOKUP_SCHEMA, text_schema


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    on_missing: str = "error",
) -> DataFrame:
    """Headerless `;` text in ISO-8859-1: files, folders or globs, all taken together.

    With a schema, surplus fields are dropped and missing ones are NULL. Without, every
    column is a string `_c0, _c1, ...` and Spark takes the width from the first line of one
    file, so production runs give a schema. `on_missing="empty"` reads a path that matches
    nothing as no rows (that needs the schema); the default fails.
    """
    if on_missing not in ("error", "empty"):
        raise ValueError(f"on_missing must be error or empty, not {on_missing}")
    reader = spark.read.options(sep=FIELD_SEPARATOR, encoding=ENCODING, inferSchema=False)
    if schema is None:
        return reader.csv(path)
    reader = reader.schema(schema)
    if on_missing == "error":
        return reader.csv(path)
    found = []
    for one in [path] if isinstance(path, str) else path:
        try:
            reader.csv(one)  # lists the files, reads none
            found.append(one)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return reader.csv(found) if found else spark.createDataFrame([], schema)


def read_lookup(spark: SparkSession, path: str | list[str], on_missing: str = "error") -> DataFrame:
    return read_delimited(spark, path, LOOKUP_SCHEMA, on_missing)


def read_facts(
    spark: SparkSession,
    path: str | list[str],
    columns: int | list[str] | None = None,
    on_missing: str = "error",
) -> DataFrame:
    """Facts with a width, with names, or (None) with the width Spark finds."""
    schema = None if columns is None else text_schema(columns)
    return read_delimited(spark, path, schema, on_missing)


def parse_lines(lines: DataFrame, schema: T.StructType, line: str = "line") -> DataFrame:
    """Replace a line column by its fields; other columns are carried along.

    Blank lines are no rows, as in a file scan.
    """
    carried = [F.col(c) for c in lines.columns if c != line]
    filled = lines.filter(not_blank(F.col(line)))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    fields = F.from_csv(line, ddl, {"sep": FIELD_SEPARATOR})
    return filled.select(*carried, fields.alias("fields")).select(*carried, "fields.*")


def not_blank(line: Column) -> Column:
    """True when a line holds anything above a space."""
    return line.rlike(r"[^\x00-\x20]")


def width_of(spark: SparkSession, line: str) -> int:
    """Number of fields Spark's parser finds in a line."""
    ddl = spark.range(1).select(
        F.schema_of_csv(F.lit(line), {"sep": FIELD_SEPARATOR}).alias("ddl")
    ).first()["ddl"]
    return len(T._parse_datatype_string(ddl).fields)
