"""Municipality lookup: cleaning, choice of cities and the join with the facts."""

from __future__ import annotations

import re
from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registra.functions.cleaning import digits_to_int

BROADCAST_LIMIT = 64 * 1024 * 1024


def clean_lookup(lookup: DataFrame) -> DataFrame:
    """Turn `municipio_cod` into an int in place."""
    return lookup.withColumn("municipio_cod", digits_to_int(F.col("municipio_cod")))


def keep_codes(lookup: DataFrame, codes: Collection[int] | None) -> DataFrame:
    """Only the given cities; None keeps all. NULL codes never match a given code."""
    if codes is None:
        return lookup
    key = F.col("municipio_cod")
    wanted = sorted(codes)
    return lookup.filter(key == wanted[0] if len(wanted) == 1 else key.isin(wanted))


def repeated_codes(lookup: DataFrame) -> DataFrame:
    """Codes that occur more than once: each would multiply the joined facts."""
    return (
        lookup.filter(F.col("municipio_cod").isNotNull())
        .groupBy("municipio_cod")
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
    )


def in_bytes(size: str) -> int:
    """Bytes of a Spark size setting, such as `10485760b`, `256k` or `-1`."""
    number, unit = re.fullmatch(r"\s*(-?\d+)\s*([kmgtp]?)b?\s*", size.lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def fits_broadcast(lookup: DataFrame, limit: int = BROADCAST_LIMIT) -> bool:
    """Whether a (filtered) lookup is small enough to send to every executor.

    One distributed aggregate over it gives its exact bytes, so this runs a job. The session's
    own broadcast limit counts where it is smaller, and one of -1 allows none.
    """
    limit = min(limit, in_bytes(lookup.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")))
    if limit < 0:
        return False
    row = F.lit(16)
    for f in lookup.schema.fields:
        text = isinstance(f.dataType, T.StringType)
        row = row + (F.coalesce(F.octet_length(f.name), F.lit(0)) + 16 if text else F.lit(8))
    measured = lookup.agg(F.sum(row.cast("long")).alias("bytes")).first()["bytes"] or 0
    return measured <= limit


def join_lookup(
    facts: DataFrame, lookup: DataFrame, key: str = "mun_clean", limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """Inner join on the cleaned code. Both keys stay; repeated lookup codes repeat facts.

    NULL matches nothing, on either side. A lookup over the limit is joined by a shuffle, where
    facts without a code or of other cities are dropped first and adaptive execution splits
    the partitions of hot cities. Below the limit it is broadcast, without its NULL codes and
    with a comparison that is safe for NULL: a plain one would test the key below the join, which
    cleans every code twice.
    """
    if fits_broadcast(lookup, limit):
        known = lookup.filter(lookup["municipio_cod"].isNotNull())
        return facts.join(F.broadcast(known), facts[key].eqNullSafe(known["municipio_cod"]))
    return facts.join(lookup, facts[key] == lookup["municipio_cod"])
