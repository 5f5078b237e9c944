"""Connected components of a graph that no machine holds whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registra.llm.common import settled_at
from registra.sources.filesystem import drop_folder


def _star(edges: DataFrame, large: bool) -> tuple[DataFrame, list[str]]:
    """One half of a round: hang the larger (or the smaller) neighbours of a node on the smallest.

    The smallest neighbours are written before they are joined, so both sides of the join are plain
    exchanges, and adaptive execution can split that of a node with very many neighbours. Comes
    with the folders that it wrote.
    """
    if large:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    else:
        near = edges.select(
            F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
        )
    least = near.groupBy("u").agg(F.min("v").alias("m"))
    low, at = settled_at(least.select("u", F.least("u", "m").alias("m")), "smallest")
    moved = near.join(low, "u")
    if large:
        moved = moved.filter("v > u").select("v", "m")
    else:
        moved = moved.filter("v != m").select("v", "m").unionAll(low.select("u", "m"))
    hung = moved.filter("v != m").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
    star, folder = settled_at(hung, "stars")
    return star, [at, folder]


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Edges (a, b) of integers to (node, root): the smallest node that each node reaches.

    Only nodes with an edge to another node come out. Large and small stars alternate until no
    edge moves, which takes a number of rounds logarithmic in the longest path; every half round is
    written to the shared folder, where one round lies at a time, and only two sums per round reach
    the driver.
    """
    now, folder = settled_at(edges.filter("a != b").select("a", "b").distinct(), "stars")
    old, last = [folder], None
    for _ in range(max_rounds):
        star, first = _star(now, large=True)
        now, second = _star(star, large=False)
        state = now.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        for folder in [*old, *first, second[0]]:
            drop_folder(folder)
        if state == last:
            return now.select(F.col("b").alias("node"), F.col("a").alias("root"))
        old, last = second[1:], state
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
