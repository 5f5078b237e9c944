"""Exact deduplication by a tree-merge of sorted digest runs; DataFrame functions only.

Every partition of the documents becomes a run: the SHA-256 of each normalised text with its row, in
order of digest, written as one sorted file. A run is first reduced to one entry per digest: the
row that stays, and how many rows there are. Then `fan_in` runs at a time are merged into one, round
by round, until one run is left; an entry always holds the best identifier of the rows below it.

Runs are exchanged in lanes, which are ranges of digests. As runs get fewer and longer, each is cut
into more lanes, so a round has as many merges as there were runs at first, and the last run is as
parallel as the first. The task of a run and lane gets the sorted stretches of `fan_in` runs, merges
them in order and folds equal neighbours. The answer goes back to each run's own digests, so the
rows of a hot text meet their answer in as many tasks as there are runs that hold it.

Digests are verified by the length of the text in bytes beside their 256 bits: entries merge only
if both agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registra.llm.common import ascii_lower, settled, shuffle_tasks

FAN_IN = 8
KEY = ["digest", "n_bytes"]


def _digested(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = ascii_lower(F.coalesce(docs[text_col], F.lit("")))
    return docs.select(docs[id_col].alias("id"), text.alias("text")).select(
        "id",
        F.unhex(F.sha2(F.col("text"), 256)).alias("digest"),
        F.octet_length("text").alias("n_bytes"),
    )


def _best(keep: str) -> Column:
    """The row that stays: by id, rows without an id last, repeated rows by their number."""
    return (F.max if keep == "largest" else F.min)("best")


def sorted_runs(
    docs: DataFrame, id_col: str, text_col: str, runs: int | None = None
) -> DataFrame:
    """`id, digest, n_bytes, row, run`, written so that each run lies in order of digest.

    Partitions as they come are the runs, or, where their number is given, rows dealt by a hash.
    """
    rows = _digested(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    rows = rows if runs is None else rows.repartition(runs, "row")
    return settled(
        rows.withColumn("run", F.spark_partition_id()).sortWithinPartitions(*KEY), "runs"
    )


def _merged(entries: DataFrame, keep: str, *lane: str) -> DataFrame:
    """One entry per run and digest. A run, or a lane of it, is exchanged whole and merged in order
    of digest; grouping by it and the digest needs no other exchange."""
    at = ["run", *lane, *KEY]
    stretches = entries.repartition("run", *lane).sortWithinPartitions(*at)
    merged = stretches.groupBy(*at).agg(_best(keep).alias("best"), F.sum("size").alias("size"))
    return merged.drop(*lane)


def merge_runs(
    rows: DataFrame, keep: str, runs: int, fan_in: int, width: int
) -> tuple[DataFrame, DataFrame]:
    """The first runs, and the one run they merge into: a line per digest with its best row.

    A round has about `width` merges, or as many as there are runs.
    """
    first_of = F.col("id").isNotNull() if keep == "largest" else F.col("id").isNull()
    entry = F.struct(first_of.alias("rank"), "id", "row")
    entries = rows.select("run", *KEY, entry.alias("best"), F.lit(1).alias("size"))
    # The first four bytes of a digest are its place among 2^32.
    place = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("bigint")
    first = last = _merged(entries, keep)
    left = runs
    while left > 1:
        left = -(-left // fan_in)
        lanes = -(-max(runs, width) // left)
        run, lane = F.floor(F.col("run") / fan_in), F.shiftright(place * lanes, 32)
        last = _merged(last.withColumns({"run": run, "lane": lane}), keep, "lane")
    return first, last


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    runs: int | None = None,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """One row per row of `docs`: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; a null text is empty. Of repeated rows
    with the id that stays, one is kept. A row without an id stays only if no equal one has an
    id. No rows give no rows; other columns are not read, whatever their names.
    """
    if fan_in < 2 or (runs is not None and runs < 1) or keep not in ("smallest", "largest"):
        raise ValueError("needs a run, a fan-in of two, and keep smallest or largest")
    rows = sorted_runs(docs, id_col, text_col, runs)
    found = rows.agg(F.max("run")).first()[0]
    first, last = merge_runs(
        rows, keep, 1 if found is None else found + 1, fan_in, shuffle_tasks(docs.sparkSession)
    )
    answers = first.select("run", *KEY).join(last.drop("run"), KEY)
    return rows.join(answers, ["run", *KEY]).select(
        F.col("id").alias(id_col),
        F.col("best.id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest"
) -> DataFrame:
    """The rows of `docs` that stay, with all their columns. Rows need no unique id: of rows that
    agree in id and text one stays, and an id that has two texts is judged by text."""
    names = docs.columns
    report = exact_dedup(docs, id_col, text_col, keep)
    verdict = settled(
        report.groupBy(F.col(id_col).alias("id"), F.unhex("text_sha256").alias("digest")).agg(
            F.max("kept").alias("kept"), F.count("*").alias("n")
        ),
        "verdicts",
    )
    mark = "_mark"
    while any(c.startswith(mark) for c in names):
        mark += "_"
    text = ascii_lower(F.coalesce(docs[text_col], F.lit("")))
    tagged = docs.withColumn(mark, F.unhex(F.sha2(text, 256)))
    # The rows that go, and those that are repeated, are few: only they are looked up.
    out = verdict.filter("not kept or n > 1").select("id", "digest")
    again = verdict.filter("kept and n > 1").select("id", "digest")

    def on(some: DataFrame) -> Column:
        return tagged[id_col].eqNullSafe(some["id"]) & (tagged[mark] == some["digest"])

    single = tagged.join(out, on(out), "left_anti").drop(mark)
    if again.isEmpty():
        return single
    repeated = tagged.join(again, on(again), "left_semi").dropDuplicates([id_col, mark])
    return single.unionByName(repeated.drop(mark)).select(*names)
