"""Column expressions that clean noisy registry codes. All run inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NON_DIGITS = "[^0-9]"
PLAIN_CODE = r"^[0-9]{1,9}\z"
# At least one digit, and no more than ten from the first that is not 0.
FEW_DIGITS = r"(?s)^(?=[^0-9]*+[0-9])(?:.{0,10}+\z|(?!.*[1-9](?:[^0-9]*+[0-9]){10}))"


def keep_digits(text: Column) -> Column:
    return F.regexp_replace(text, NON_DIGITS, "")


def digits_to_int(text: Column) -> Column:
    """Int made of the digits of a string; NULL when there are none or it overflows.

    Defined as a lenient cast of :func:`keep_digits`. A lenient cast of an empty or too long
    string raises and catches an exception per row, ten times the cost of the rest, so both
    are told apart beforehand. Plain codes, the usual case, also skip the replacement. The
    expression stays small because filters repeat it, and methods that get too long for
    the JIT compiler run interpreted.
    """
    return F.when(text.rlike(PLAIN_CODE), text.try_cast("int")).when(
        text.rlike(FEW_DIGITS), keep_digits(text).try_cast("int")
    )


def text_equals(column: Column, dtype: T.DataType, value: str) -> Column:
    """`cast(column as string) = value`, kept as an int comparison on integer columns.

    The bare comparison is one that a columnar scan can push down; a cast around the column
    is not. NULL stays NULL in every branch.
    """
    if isinstance(dtype, T.StringType):
        return column == F.lit(value)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        bits = 8 * {"tinyint": 1, "smallint": 2, "int": 4, "bigint": 8}[dtype.simpleString()]
        canonical = re.fullmatch(r"0|-?[1-9][0-9]*", value)
        if canonical and -(2 ** (bits - 1)) <= int(value) < 2 ** (bits - 1):
            return column == F.lit(int(value)).cast(dtype)
    return column.cast("string") == F.lit(value)


def kind_label(flag: Column, labels: Mapping[str, str], other: str = "unknown") -> Column:
    """Readable name of a head-office/branch flag; unknown and NULL flags keep one label."""
    pairs = list(labels.items())
    if not pairs:
        return F.lit(other)
    named = F.when(flag == pairs[0][0], pairs[0][1])
    for code, label in pairs[1:]:
        named = named.when(flag == code, label)
    return named.otherwise(other)
