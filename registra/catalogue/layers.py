"""Queries: lookup join, silver, gold, run metrics and pending files."""

from __future__ import annotations

from pyspark.sql import functions as F

from registra.catalogue.registry import query
from registra.catalogue.tables import (
    CITY,
    COLUMNS,
    FACTS_SQL,
    KEYS,
    KINDS,
    LOOKUP_SQL,
    SILVER_SQL,
    digits_sql,
    facts,
    lookup,
    table,
)
from registra.functions import paths as P
from registra.operators import gold
from registra.operators.columns import add_clean_keys
from registra.operators.lookup import clean_lookup, join_lookup, keep_codes, repeated_codes
from registra.operators.metrics import run_metrics
from registra.operators.pending import first_pending, pending_files
from registra.operators.silver import build_silver, guarded
from registra.sources.listing import complete_files, manifest, routed, select_dataset

SILVER_COLUMNS = [*KEYS, "mun_clean", "sit_clean", "municipio_cod", "municipio_nome"]
SILVER_LIST = ", ".join(SILVER_COLUMNS)


@query(
    "join_lookup",
    f"""select l_orderkey, l_linenumber, municipio_cod, municipio_nome
        from ({FACTS_SQL}) f
        join ({LOOKUP_SQL}) m on {digits_sql("f.mun_raw")} = m.municipio_cod""",
)
def join_all(spark, sf):
    cities = clean_lookup(lookup(spark, sf))
    joined = join_lookup(add_clean_keys(facts(spark, sf), COLUMNS), cities)
    return joined.select(*KEYS, "municipio_cod", "municipio_nome")


@query(
    "join_duplicate_lookup",
    f"""select municipio_cod, count(*) as n
        from ({FACTS_SQL}) f
        join (({LOOKUP_SQL}) union all ({LOOKUP_SQL})) m
          on {digits_sql("f.mun_raw")} = m.municipio_cod
        group by municipio_cod""",
)
def join_duplicates(spark, sf):
    once = clean_lookup(lookup(spark, sf))
    counted = (
        add_clean_keys(facts(spark, sf), COLUMNS)
        .groupBy("mun_clean")
        .agg(F.count(F.lit(1)).alias("facts"))
    )
    copies = once.unionAll(once).groupBy("municipio_cod").agg(F.count(F.lit(1)).alias("copies"))
    return join_lookup(counted, copies).select(
        "municipio_cod", (F.col("facts") * F.col("copies")).alias("n")
    )


@query(
    "join_repeated_codes",
    f"""select l_orderkey, l_linenumber, municipio_cod, municipio_nome
        from ({FACTS_SQL}) f
        join (({LOOKUP_SQL}) union all ({LOOKUP_SQL})) m
          on {digits_sql("f.mun_raw")} = m.municipio_cod
        where municipio_cod <= 20""",
)
def join_repeated(spark, sf):
    once = keep_codes(clean_lookup(lookup(spark, sf)), range(21))
    joined = join_lookup(add_clean_keys(facts(spark, sf), COLUMNS), once.unionAll(once))
    return joined.select(*KEYS, "municipio_cod", "municipio_nome")


@query(
    "join_all_repeated_codes",
    f"""select municipio_cod, municipio_nome, count(*) as n,
               sum(l_orderkey)::bigint as orderkeys
        from ({FACTS_SQL}) f
        join (({LOOKUP_SQL}) union all ({LOOKUP_SQL})) m
          on {digits_sql("f.mun_raw")} = m.municipio_cod
        group by municipio_cod, municipio_nome""",
)
def join_all_repeated(spark, sf):
    once = clean_lookup(lookup(spark, sf))
    joined = join_lookup(add_clean_keys(facts(spark, sf), COLUMNS), once.unionAll(once))
    return joined.groupBy("municipio_cod", "municipio_nome").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("orderkeys")
    )


@query(
    "repeated_lookup_codes",
    f"""select municipio_cod, count(*) as copies
        from (({LOOKUP_SQL}) union all
              (select {digits_sql("s_name")}, s_name from supplier where s_nationkey < 10))
        where municipio_cod is not null group by 1 having count(*) > 1""",
)
def repeated(spark, sf):
    some = table(spark, sf, "supplier").filter("s_nationkey < 10")
    extra = some.select(F.col("s_name").alias("municipio_cod"), "s_name")
    return repeated_codes(clean_lookup(lookup(spark, sf).unionAll(extra)))


@query("silver", f"select {SILVER_LIST} from ({SILVER_SQL}) where municipio_cod = {CITY}")
def silver_one_city(spark, sf):
    silver = build_silver(facts(spark, sf), lookup(spark, sf), COLUMNS, [CITY])
    return silver.select(*SILVER_COLUMNS)


@query("silver_all_cities", f"select {SILVER_LIST} from ({SILVER_SQL})")
def silver_all_cities(spark, sf):
    silver = build_silver(facts(spark, sf), lookup(spark, sf), COLUMNS, None)
    return silver.select(*SILVER_COLUMNS)


def _guarded(spark, sf, value):
    raw = facts(spark, sf)
    silver = build_silver(raw, lookup(spark, sf), COLUMNS, [CITY]).select(*SILVER_COLUMNS)
    return guarded(silver, raw.select("mun_raw", "sit_raw", "kind_raw"), value)


def _guarded_sql(value: str) -> str:
    return f"""select {SILVER_LIST} from ({SILVER_SQL}) where municipio_cod = {CITY}
        and (select count(*) from ({FACTS_SQL})
             where list_contains([mun_raw, sit_raw, kind_raw], '{value}')) > 0"""


@query("silver_guarded", _guarded_sql("02"))
def silver_guard_hit(spark, sf):
    return _guarded(spark, sf, "02")


@query("silver_guarded_absent", _guarded_sql("2"))
def silver_guard_miss(spark, sf):
    return _guarded(spark, sf, "2")


def _city_counts(spark, sf, codes):
    return gold.active_by_city(facts(spark, sf), lookup(spark, sf), COLUMNS, codes)


@query(
    "gold_kind",
    f"""select kind_raw as kind, count(*) as n from ({SILVER_SQL})
        where municipio_cod = {CITY} group by 1""",
)
def gold_kind(spark, sf):
    return gold.total_by_kind(_city_counts(spark, sf, [CITY]))


@query(
    "gold_kind_from_silver",
    f"""select kind_raw as kind, count(*) as n,
               case kind_raw when 'F' then 'matriz' when 'O' then 'filial'
                             else 'unknown' end as label
        from ({SILVER_SQL}) where municipio_cod = {CITY} group by 1, 3""",
)
def gold_kind_from_silver(spark, sf):
    silver = build_silver(facts(spark, sf), lookup(spark, sf), COLUMNS, [CITY])
    return gold.with_labels(gold.by_kind(silver, "kind_raw"), KINDS)


CITY_COUNTS_SQL = f"""select municipio_cod, municipio_nome, kind_raw as kind, count(*) as n
        from ({SILVER_SQL}) group by 1, 2, 3"""


@query("gold_by_city", CITY_COUNTS_SQL)
def gold_by_city(spark, sf):
    return _city_counts(spark, sf, None)


@query("gold_by_city_from_silver", CITY_COUNTS_SQL)
def gold_by_city_from_silver(spark, sf):
    silver = build_silver(facts(spark, sf), lookup(spark, sf), COLUMNS, None)
    return gold.by_city(silver, "kind_raw")


@query(
    "gold_pivot",
    f"""select municipio_cod, count(*) filter (where kind_raw = 'F') as n_f,
               count(*) filter (where kind_raw = 'O') as n_o
        from ({SILVER_SQL}) group by 1""",
)
def gold_pivot(spark, sf):
    wide = gold.pivot_kinds(_city_counts(spark, sf, None), ["F", "O"], ["municipio_cod"])
    return wide.withColumnsRenamed({"F": "n_f", "O": "n_o"})


@query(
    "run_metrics",
    f"""select (select count(*) from ({LOOKUP_SQL}) where municipio_cod = {CITY}) as n_lookup,
               (select count(*) from ({FACTS_SQL})
                where list_contains([mun_raw, sit_raw, kind_raw], '07')) as n_search,
               (select count(*) from ({SILVER_SQL}) where municipio_cod = {CITY}) as n_final""",
)
def metrics(spark, sf):
    searched = ["mun_raw", "sit_raw", "kind_raw"]
    return run_metrics(
        facts(spark, sf), lookup(spark, sf), "07", COLUMNS, [CITY], search_columns=searched
    )


# Orders as listed files: the status picks the dataset, some names are empty.
LISTED_SQL = """
    select case when o_orderpriority = '5-LOW' then ''
                when o_orderstatus = 'P' then 'Municipios' || o_orderkey || '.zip'
                else 'Estabelecimentos' || o_orderkey || '.zip' end as name
    from orders"""
DONE_SQL = """
    select 'Estabelecimentos' || l_orderkey || '.zip' as name
    from lineitem where l_returnflag = 'R'"""
PENDING_SQL = f"""
    select name from ({LISTED_SQL}) l
    where name <> '' and contains(name, 'Estabelecimentos')
      and not exists (select 1 from ({DONE_SQL}) d where d.name = l.name)"""


def _files(spark, sf):
    key = F.col("o_orderkey").cast("string")
    name = (
        F.when(F.col("o_orderpriority") == "5-LOW", "")
        .when(F.col("o_orderstatus") == "P", F.concat(F.lit("Municipios"), key, F.lit(".zip")))
        .otherwise(F.concat(F.lit("Estabelecimentos"), key, F.lit(".zip")))
    )
    done = F.concat(F.lit("Estabelecimentos"), F.col("l_orderkey").cast("string"), F.lit(".zip"))
    landed = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(done.alias("name"))
    return table(spark, sf, "orders").select(name.alias("name")), landed


@query("pending_files", PENDING_SQL)
def pending(spark, sf):
    return pending_files(*_files(spark, sf), "Estabelecimentos")


@query("pending_files_first", f"{PENDING_SQL} order by name limit 1")
def pending_first(spark, sf):
    return first_pending(*_files(spark, sf), "Estabelecimentos")


# Documents as listed objects: the language picks finished and unfinished files.
OBJECTS_SQL = """
    select 's3a://bronze/lote' || (doc_id // 64) || '/' || case when n_chars < 2000 then 'municipios'
                                   else 'estabelecimentos' end
           || '_2025-' || lpad(regexp_extract(source, '[0-9]+'), 2, '0') || '/'
           || case when n_chars < 2000 then 'Municipios' else 'Estabelecimentos' end
           || doc_id || case lang when 'de' then '.zip.crdownload' when 'fr' then '.zip.tmp'
                                  else '.zip' end as path,
           n_chars * 4096 as length
    from documents"""
NAME_SQL = "regexp_extract(path, '[^/]*$')"
DATASET_SQL = r"regexp_extract(path, '([^/]+)_(\d{4}-\d{2})/[^/]+$', 1)"
MONTH_SQL = r"regexp_extract(path, '([^/]+)_(\d{4}-\d{2})/[^/]+$', 2)"
BUSY_SQL = "(path like '%.crdownload' or path like '%.tmp')"


def _objects(spark, sf):
    small = F.col("n_chars") < 2000
    suffix = F.when(F.col("lang") == "de", ".zip.crdownload").when(F.col("lang") == "fr", ".zip.tmp")
    path = F.concat(
        F.lit("s3a://bronze/lote"),
        F.shiftright("doc_id", 6).cast("string"),
        F.lit("/"),
        F.when(small, "municipios").otherwise("estabelecimentos"),
        F.lit("_2025-"),
        F.lpad(F.regexp_extract("source", "[0-9]+", 0), 2, "0"),
        F.lit("/"),
        F.when(small, "Municipios").otherwise("Estabelecimentos"),
        F.col("doc_id").cast("string"),
        suffix.otherwise(".zip"),
    )
    return table(spark, sf, "documents").select(
        path.alias("path"), (F.col("n_chars") * 4096).alias("length")
    )


@query(
    "files_manifest",
    f"""select {NAME_SQL} as name, length // 1048576 as size_mib
        from ({OBJECTS_SQL}) where not {BUSY_SQL}""",
)
def files_manifest(spark, sf):
    return manifest(complete_files(_objects(spark, sf)))


@query(
    "complete_folders",
    f"""with o as ({OBJECTS_SQL}), f as (select *, regexp_extract(path, '^(.*)/', 1) as d from o)
        select path, length from f where not {BUSY_SQL}
          and d not in (select d from f where {BUSY_SQL})""",
)
def complete_folders(spark, sf):
    return complete_files(_objects(spark, sf), rule="folder")


@query(
    "select_dataset_files",
    f"""select {DATASET_SQL} as dataset, {MONTH_SQL} as ref_month, {NAME_SQL} as name
        from ({OBJECTS_SQL}) where contains({NAME_SQL}, 'Estabelecimentos')""",
)
def select_dataset_files(spark, sf):
    wanted = select_dataset(_objects(spark, sf), "Estabelecimentos")
    return routed(wanted).select("dataset", "ref_month", "name")


@query(
    "dataset_months",
    f"""select {DATASET_SQL} as dataset, {MONTH_SQL} as ref_month, count(*) as files,
               cast(sum(length // 1048576) as bigint) as size_mib
        from ({OBJECTS_SQL}) group by 1, 2""",
)
def dataset_months(spark, sf):
    return (
        routed(_objects(spark, sf))
        .groupBy("dataset", "ref_month")
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum(P.whole_mib(F.col("length"))).alias("size_mib"),
        )
    )
