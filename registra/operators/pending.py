"""File names that still wait for processing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pending_files(listing: DataFrame, done: DataFrame, contains: str = "") -> DataFrame:
    """Listed names of one dataset that are not done. Empty and NULL names never qualify.

    Done names are reduced to distinct ones first, so a name that was recorded very often
    costs one row in the join.
    """
    name = F.col("name")
    wanted = listing.filter((name != "") & name.contains(contains)).select("name")
    return wanted.join(done.select("name").distinct(), "name", "left_anti")


def first_pending(listing: DataFrame, done: DataFrame, contains: str = "") -> DataFrame:
    """The next name in code-point order, or no row when all is done."""
    return pending_files(listing, done, contains).orderBy("name").limit(1)
