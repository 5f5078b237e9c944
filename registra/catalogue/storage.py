"""Queries that go through files: delimited text, archives, sinks, the stream and a whole run.

Each writes the given tables in the shape of registry extracts into a fresh shared folder
and reads them back. Folders stay, because the results are lazy.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from registra.catalogue.archives import csv_line, write_archives
from registra.catalogue.registry import query
from registra.catalogue.tables import (
    CITY,
    COLUMNS,
    FACTS_SQL,
    KEYS,
    LOOKUP_SQL,
    SILVER_SQL,
    facts,
    lookup,
    table,
)
from registra.config import (
    ENCODING,
    FACTS_DATASET,
    FIELD_SEPARATOR,
    LOOKUP_DATASET,
    ColumnMap,
    RunConfig,
    text_schema,
)
from registra.operators.silver import build_silver
from registra.plans.medallion import run
from registra.session import work_folder
from registra.sinks.bronze import BRONZE_KEYS, keyed_lines, land_bronze, read_bronze
from registra.sinks.parquet import overwrite_partitions
from registra.sources.archive import expand_archives, read_archives
from registra.sources.delimited import parse_lines, read_facts, read_lookup
from registra.sources.listing import complete_files, list_archives, list_objects, routed
from registra.streaming.ingest import ingest_archives

MONTH = "2025-12"
FACT_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "mun_raw"]
ACCENTED = "'SÃO; '"


def _write_text(df, folder):
    df.write.options(sep=FIELD_SEPARATOR, encoding=ENCODING).csv(folder)
    return folder


def _lookup_text(spark, sf):
    named = table(spark, sf, "supplier").select(
        F.col("s_suppkey"), F.concat(F.lit("SÃO; "), "s_name").alias("s_name")
    )
    return _write_text(named, work_folder(spark, "lookup-text"))


LOOKUP_TEXT_SQL = f"""
    select cast(s_suppkey as varchar) as municipio_cod, {ACCENTED} || s_name as municipio_nome
    from supplier"""


@query("scan_csv_fixed_schema", LOOKUP_TEXT_SQL)
def scan_fixed(spark, sf):
    return read_lookup(spark, _lookup_text(spark, sf))


@query("missing_input_empty", LOOKUP_TEXT_SQL)
def scan_with_missing_folder(spark, sf):
    there = _lookup_text(spark, sf)
    return read_lookup(spark, [there, work_folder(spark, "never-written")], on_missing="empty")


def _order_text(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", F.concat(F.lit("SÃO; "), "o_orderpriority").alias("p")
    )
    return _write_text(orders, work_folder(spark, "orders-text"))


@query(
    "scan_csv_schemaless",
    f"""select cast(o_orderkey as varchar) as _c0, o_orderstatus as _c1,
               {ACCENTED} || o_orderpriority as _c2 from orders""",
)
def scan_schemaless(spark, sf):
    return read_facts(spark, _order_text(spark, sf) + "/*")


@query(
    "scan_csv_given_width",
    """select cast(o_orderkey as varchar) as _c0, o_orderstatus as _c1, cast(null as varchar) as _c4
       from orders""",
)
def scan_given_width(spark, sf):
    return read_facts(spark, _order_text(spark, sf), 5).select("_c0", "_c1", "_c4")


def _fact_lines(spark, sf):
    columns = [F.col(c).cast("string") for c in FACT_COLUMNS]
    return facts(spark, sf).select(
        F.concat(F.lit(f"{FACTS_DATASET}_"), F.date_format("l_shipdate", "yyyy-MM")).alias("month"),
        csv_line(*columns).alias("line"),
    )


def _fact_archives(spark, sf, folder=None):
    lines = _fact_lines(spark, sf)
    wanted = F.col("month") if folder is None else F.lit(folder)
    return write_archives(
        lines.select(wanted.alias("folder"), "line"),
        work_folder(spark, "archives"),
        "E",
        rebalance=folder is None,
    )


FACT_TEXT_SQL = f"""
    select cast(l_orderkey as varchar) as _c0, cast(l_linenumber as varchar) as _c1,
           cast(l_partkey as varchar) as _c2, nullif(mun_raw, '') as _c3 from ({FACTS_SQL})"""


@query("scan_archive", FACT_TEXT_SQL)
def scan_archive(spark, sf):
    lines = read_archives(spark, _fact_archives(spark, sf, f"{FACTS_DATASET}_{MONTH}"))
    return parse_lines(lines.select("line"), text_schema(len(FACT_COLUMNS)))


@query("scan_archive_listed", FACT_TEXT_SQL)
def scan_archive_listed(spark, sf):
    root = _fact_archives(spark, sf, f"{FACTS_DATASET}_{MONTH}")
    lines = expand_archives(list_objects(spark, root).select("path"), spark.sparkContext.defaultParallelism)
    return parse_lines(lines.select("line"), text_schema(len(FACT_COLUMNS)))


@query(
    "scan_archive_last_member",
    """select l_linenumber, count(*) as n, sum(l_orderkey)::bigint as keys from lineitem
       where l_linenumber % 2 = 1 or l_linenumber > 4 group by 1""",
)
def scan_archive_last_member(spark, sf):
    """Members of one name in two archives, and of a name of its own in a third: that of the first
    archive goes, with the even line numbers up to 4."""
    line = F.col("l_linenumber")
    rows = table(spark, sf, "lineitem").select(
        F.lit(f"{FACTS_DATASET}_{MONTH}").alias("folder"),
        F.when(line > 4, "own").when(line % 2 == 0, "a").otherwise("b").alias("archive"),
        csv_line(F.col("l_orderkey").cast("string"), line.cast("string")).alias("line"),
    )
    dealt = rows.repartition(spark.sparkContext.defaultParallelism, F.xxhash64("line"))
    root = work_folder(spark, "archives")
    for name, member in (("a", "same"), ("b", "same"), ("own", "own")):
        write_archives(dealt.filter(F.col("archive") == name), f"{root}/{name}", member)
    lines = keyed_lines(list_archives(spark, root), member_conflict="last")
    parsed = parse_lines(lines, text_schema(["key", "number"]))
    return parsed.groupBy(F.col("number").cast("int").alias("l_linenumber")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("key").cast("long")).alias("keys")
    )


@query(
    "scan_archive_by_month",
    f"""select '{FACTS_DATASET}' as dataset, strftime(l_shipdate, '%Y-%m') as ref_month,
               count(*) as n from lineitem group by 2""",
)
def scan_archive_by_month(spark, sf):
    lines = keyed_lines(list_objects(spark, _fact_archives(spark, sf)))
    return lines.groupBy("dataset", "ref_month").agg(F.count(F.lit(1)).alias("n"))


@query(
    "list_files_manifest",
    f"""select distinct '{FACTS_DATASET}' as dataset, strftime(l_shipdate, '%Y-%m') as ref_month
        from lineitem""",
)
def list_files_manifest(spark, sf):
    files = complete_files(list_objects(spark, _fact_archives(spark, sf), suffix=""))
    return routed(files).select("dataset", "ref_month").distinct()


def _monthly_silver(spark, sf):
    silver = build_silver(facts(spark, sf), lookup(spark, sf), COLUMNS, None)
    return silver.withColumn("ref_month", F.date_format("l_shipdate", "yyyy-MM")).select(
        *KEYS, "mun_clean", "municipio_nome", "ref_month"
    )


@query(
    "write_silver_roundtrip",
    f"""select strftime(l_shipdate, '%Y-%m') as ref_month, count(*) as n
        from ({SILVER_SQL}) group by 1""",
)
def write_silver_roundtrip(spark, sf):
    silver = _monthly_silver(spark, sf)
    folder = work_folder(spark, "silver")
    overwrite_partitions(silver, folder, ["ref_month"], rebalance=True)
    overwrite_partitions(silver.filter("ref_month = '1997-03'"), folder, ["ref_month"])
    stored = spark.read.schema(silver.schema).parquet(folder)
    return stored.groupBy("ref_month").agg(F.count(F.lit(1)).alias("n"))


@query(
    "write_skips_empty",
    f"""select l_orderkey, l_linenumber, mun_clean, municipio_nome, '{MONTH}' as ref_month
        from ({SILVER_SQL}) where municipio_cod = {CITY}""",
)
def write_skips_empty(spark, sf):
    folder = work_folder(spark, "silver")
    columns = [*KEYS, "mun_clean", "municipio_nome"]
    for status in (2, -1):
        silver = build_silver(facts(spark, sf), lookup(spark, sf), COLUMNS, [CITY], status)
        month = silver.select(*columns, F.lit(MONTH).alias("ref_month"))
        overwrite_partitions(month, folder, ["ref_month"])
    return spark.read.schema(month.schema).parquet(folder)


@query(
    "land_bronze_idempotent",
    """select 'Estabelecimentos' || l_linenumber || '.zip' as archive, count(*) as n
       from lineitem group by 1""",
)
def land_bronze_idempotent(spark, sf):
    archive = F.concat(F.lit("Estabelecimentos"), F.col("l_linenumber"), F.lit(".zip"))
    rows = facts(spark, sf).select(
        F.lit(FACTS_DATASET).alias("dataset"),
        F.lit(MONTH).alias("ref_month"),
        archive.alias("archive"),
        *FACT_COLUMNS,
    )
    bronze = work_folder(spark, "bronze")
    land_bronze(rows, bronze)
    land_bronze(rows.filter("archive = 'Estabelecimentos3.zip'"), bronze)
    schema = rows.drop(*BRONZE_KEYS).schema
    stored = read_bronze(spark, bronze, schema, FACTS_DATASET, MONTH)
    return stored.groupBy("archive").agg(F.count(F.lit(1)).alias("n"))


@query("stream_files_once", "select event_type, count(*) as n from events group by 1")
def stream_files_once(spark, sf):
    events = table(spark, sf, "events").select(
        F.lit(f"eventos_{MONTH}").alias("folder"),
        (F.hour("ts") < 12).alias("early"),
        csv_line(F.col("event_id").cast("string"), F.col("event_type")).alias("line"),
    )
    inbox = work_folder(spark, "inbox")
    bronze = work_folder(spark, "bronze")
    checkpoint = work_folder(spark, "progress")
    schema = text_schema(["event_id", "event_type"])
    for arrival, stem in ((F.col("early"), "Early"), (~F.col("early"), "Late")):
        write_archives(events.filter(arrival), inbox, stem)
        ingest_archives(spark, inbox, bronze, checkpoint, schema)
    ingest_archives(spark, inbox, bronze, checkpoint, schema)
    stored = read_bronze(spark, bronze, schema, "eventos", MONTH)
    return stored.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


INGEST_MONTH_SQL = """
    select 'Lines' || (l_linenumber % 3) as archive, count(*) as n from lineitem"""


def _ingested(spark, sf, again):
    """Three sets of archives of line items landed, then one of them put again with other lines."""
    rows = table(spark, sf, "lineitem").select(
        F.lit(f"{FACTS_DATASET}_{MONTH}").alias("folder"),
        (F.col("l_linenumber") % 3).alias("part"),
        F.col("l_quantity"),
        F.col("l_orderkey"),
        csv_line(F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias(
            "line"
        ),
    )
    inbox, bronze = work_folder(spark, "inbox"), work_folder(spark, "bronze")
    checkpoint = work_folder(spark, "progress")
    schema = text_schema(["l_orderkey", "l_linenumber"])
    # By a key, so that the same rows come to the same archive both times.
    dealt = rows.repartition(spark.sparkContext.defaultParallelism, "l_orderkey")
    for part in range(3):
        write_archives(dealt.filter(F.col("part") == part), inbox, f"Lines{part}-")
    ingest_archives(spark, inbox, bronze, checkpoint, schema)
    write_archives(again(dealt.filter("part = 1")), inbox, "Lines1-")
    ingest_archives(spark, inbox, bronze, checkpoint, schema)
    ingest_archives(spark, inbox, bronze, checkpoint, schema)
    stored = read_bronze(spark, bronze, schema, FACTS_DATASET, MONTH)
    name = F.regexp_extract("archive", "^([^-]+)", 1).alias("archive")
    return stored.groupBy(name).agg(F.count(F.lit(1)).alias("n"))


@query(
    "ingest_replaced_archive",
    f"{INGEST_MONTH_SQL} where l_linenumber % 3 <> 1 or l_quantity < 25 group by 1",
)
def ingest_replaced_archive(spark, sf):
    # Blank lines are no rows, so every archive of the set is put again.
    kept = F.when(F.col("l_quantity") < 25, F.col("line")).otherwise("")
    return _ingested(spark, sf, lambda rows: rows.withColumn("line", kept))


@query(
    "ingest_emptied_archive",
    f"{INGEST_MONTH_SQL} where l_linenumber % 3 <> 1 group by 1",
)
def ingest_emptied_archive(spark, sf):
    return _ingested(spark, sf, lambda rows: rows.withColumn("line", F.lit("")))


@query(
    "ingest_same_names",
    """select runs, lot, count(*) as n from (select 'lot' || (l_linenumber % 2) as lot from lineitem),
       (values (1), (2)) as t(runs) group by all""",
)
def ingest_same_names(spark, sf):
    """Archives of equal names in two folders, landed in one run and in one run each."""
    lot = F.concat(F.lit("lot"), F.col("l_linenumber") % 2)
    rows = table(spark, sf, "lineitem").select(
        F.concat_ws("/", lot, F.lit(f"{FACTS_DATASET}_{MONTH}")).alias("folder"),
        lot.alias("lot"),
        csv_line(F.col("l_orderkey").cast("string"), lot).alias("line"),
    )
    schema = text_schema(["l_orderkey", "lot"])
    counts = []
    for runs, lots in ((1, [["lot0", "lot1"]]), (2, [["lot0"], ["lot1"]])):
        inbox, bronze = work_folder(spark, "inbox"), work_folder(spark, "bronze")
        checkpoint = work_folder(spark, "progress")
        for some in lots:
            write_archives(rows.filter(F.col("lot").isin(some)), inbox, "Lines")
            ingest_archives(spark, inbox, bronze, checkpoint, schema)
        stored = read_bronze(spark, bronze, schema, FACTS_DATASET, MONTH)
        found = stored.groupBy("lot").agg(F.count(F.lit(1)).alias("n"))
        counts.append(found.select(F.lit(runs).alias("runs"), "lot", "n"))
    return counts[0].unionByName(counts[1])


@query(
    "scan_archive_all_names",
    "select case when l_linenumber < 3 then '_hidden' when l_linenumber < 5 then '.dotted' "
    "else 'plain' end as name, count(*) as n from lineitem group by 1",
)
def scan_archive_all_names(spark, sf):
    line = F.col("l_linenumber")
    rows = table(spark, sf, "lineitem").select(
        F.lit(f"{FACTS_DATASET}_{MONTH}").alias("folder"),
        F.when(line < 3, "_hidden").when(line < 5, ".dotted").otherwise("plain").alias("name"),
        csv_line(F.col("l_orderkey").cast("string")).alias("line"),
    )
    root = work_folder(spark, "archives")
    for name in ("_hidden", ".dotted", "plain"):
        write_archives(rows.filter(F.col("name") == name), root, f"{name}-")
    listing = list_archives(spark, root)
    lines = expand_archives(listing.select("path"), 4 * spark.sparkContext.defaultParallelism)
    # The name is worked out once an archive, not once a line.
    counted = lines.groupBy("archive").agg(F.count(F.lit(1)).alias("n"))
    name = F.regexp_extract("archive", "([^/]+)-[^/]*$", 1).alias("name")
    return counted.groupBy(name).agg(F.sum("n").alias("n"))


def _registry_lines(spark, sf):
    """Line items as 21 raw columns: kind at 3, status at 5, municipality code at 20."""
    placed = {
        0: F.col("l_orderkey").cast("string"),
        1: F.col("l_linenumber").cast("string"),
        3: F.col("kind_raw"),
        5: F.col("sit_raw"),
        20: F.col("mun_raw"),
    }
    blank = F.lit(None).cast("string")
    columns = [placed.get(i, blank).alias(f"_c{i}") for i in range(21)]
    return facts(spark, sf).select(
        F.lit(f"{FACTS_DATASET}_{MONTH}").alias("folder"), csv_line(*columns).alias("line")
    )


def _lookup_lines(spark, sf):
    return lookup(spark, sf).select(
        F.lit(f"{LOOKUP_DATASET}_{MONTH}").alias("folder"),
        csv_line("municipio_cod", "municipio_nome").alias("line"),
    )


@query(
    "medallion_end_to_end",
    f"""select kind_raw as kind, count(*) as n from ({SILVER_SQL})
        where municipio_cod = {CITY} group by 1""",
)
def medallion_end_to_end(spark, sf):
    return _whole_run(spark, sf, codes=(CITY,)).gold.select("kind", "n")


@query(
    "medallion_by_city",
    f"""select municipio_cod, municipio_nome, kind_raw as kind, count(*) as n
        from ({SILVER_SQL}) group by all""",
)
def medallion_by_city(spark, sf):
    found = _whole_run(spark, sf, codes=None, gold_by_city=True)
    return found.gold.select("municipio_cod", "municipio_nome", "kind", "n")


@query(
    "medallion_metrics",
    f"""select (select count(*) from ({LOOKUP_SQL}) where municipio_cod = {CITY}) as n_lookup,
               (select count(*) from ({FACTS_SQL})
                where list_contains([mun_raw, sit_raw, kind_raw], '07')) as n_search,
               (select count(*) from ({SILVER_SQL}) where municipio_cod = {CITY}) as n_final""",
)
def medallion_metrics(spark, sf):
    """The three counts of a run, as its report has them, searched in every column of the archives."""
    found = _whole_run(spark, sf, codes=(CITY,), search="07").metrics
    return spark.createDataFrame([found], "n_lookup long, n_search long, n_final long")


def _whole_run(spark, sf, **options):
    root = work_folder(spark, "run")
    archives = f"{root}/archives"
    write_archives(_registry_lines(spark, sf), archives, "E")
    write_archives(_lookup_lines(spark, sf), archives, "M")
    cfg = RunConfig(
        archives=archives,
        bronze=f"{root}/bronze",
        silver=f"{root}/silver",
        ref_month=MONTH,
        columns=ColumnMap(),
        **options,
    )
    return run(spark, cfg)
