"""Queries: scalar cleaning, projections, filters and the value search."""

from __future__ import annotations

from pyspark.sql import functions as F

from registra.catalogue.registry import query
from registra.catalogue.tables import (
    CITY,
    COLUMNS,
    FACTS_SQL,
    KEYS,
    LOOKUP_SQL,
    digits_sql,
    facts,
    lookup,
    table,
)
from registra.functions.cleaning import digits_to_int
from registra.operators.columns import add_clean_keys, rename_positional, sample_rows
from registra.operators.lookup import clean_lookup, keep_codes
from registra.operators.search import any_column_equals, locate_value

SEARCHED = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"]
RAW = ["mun_raw", "sit_raw", "kind_raw"]


@query("digits_to_int", f"select p_partkey, {digits_sql('p_brand')} as n from part")
def digits_of_brand(spark, sf):
    return table(spark, sf, "part").select("p_partkey", digits_to_int(F.col("p_brand")).alias("n"))


@query(
    "digits_to_int_priority",
    f"select o_orderkey, {digits_sql('o_orderpriority')} as n from orders",
)
def digits_of_priority(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", digits_to_int(F.col("o_orderpriority")).alias("n")
    )


@query("digits_to_int_in_place", LOOKUP_SQL)
def digits_in_place(spark, sf):
    return clean_lookup(lookup(spark, sf))


@query(
    "lenient_cast_edges",
    f"""
    with noisy as (
        select l_orderkey, l_linenumber, case l_linenumber
            when 1 then ''
            when 2 then 'abc'
            when 3 then lpad(cast(l_partkey as varchar), 12, '0')
            when 4 then cast(l_partkey as varchar) || '-07.' || cast(l_suppkey as varchar)
            when 5 then '99999999' || cast(l_partkey as varchar) || '999'
            when 6 then null
            else ' -' || cast(l_partkey as varchar) || ' ' end as raw
        from lineitem)
    select l_orderkey, l_linenumber, raw, coalesce({digits_sql("raw")}, -1) as n,
           {digits_sql("raw")} is null as no_number from noisy""",
)
def lenient_cast_edges(spark, sf):
    part, supp = F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")
    line = F.col("l_linenumber")
    raw = (
        F.when(line == 1, F.lit(""))
        .when(line == 2, F.lit("abc"))
        .when(line == 3, F.lpad(part, 12, "0"))
        .when(line == 4, F.concat(part, F.lit("-07."), supp))
        .when(line == 5, F.concat(F.lit("99999999"), part, F.lit("999")))
        .when(line == 6, F.lit(None))
        .otherwise(F.concat(F.lit(" -"), part, F.lit(" ")))
    )
    noisy = table(spark, sf, "lineitem").select(*KEYS, raw.alias("raw"))
    number = digits_to_int(F.col("raw"))
    return noisy.withColumns(
        {"n": F.coalesce(number, F.lit(-1)), "no_number": number.isNull()}
    )


@query(
    "derive_columns",
    f"""select l_orderkey, l_linenumber, mun_raw, sit_raw,
               {digits_sql("mun_raw")} as mun_clean, {digits_sql("sit_raw")} as sit_clean
        from ({FACTS_SQL})""",
)
def derive_columns(spark, sf):
    return add_clean_keys(facts(spark, sf), COLUMNS).select(
        *KEYS, "mun_raw", "sit_raw", "mun_clean", "sit_clean"
    )


@query(
    "rename_positional",
    "select c_custkey as codigo_basico, c_name as nome, c_mktsegment as segmento from customer",
)
def rename_all(spark, sf):
    raw = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return rename_positional(raw.toDF("_c0", "_c1", "_c2"), ["codigo_basico", "nome", "segmento"])


@query(
    "rename_some_positions",
    "select c_custkey as codigo_basico, c_name as _c1, c_mktsegment as _c2 from customer",
)
def rename_some(spark, sf):
    raw = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return rename_positional(raw.toDF("_c0", "_c1", "_c2"), {"_c0": "codigo_basico"})


@query("filter_lookup_code", f"select * from ({LOOKUP_SQL}) where municipio_cod = {CITY}")
def filter_lookup_code(spark, sf):
    return keep_codes(clean_lookup(lookup(spark, sf)), [CITY])


@query("filter_lookup_codes", f"select * from ({LOOKUP_SQL}) where municipio_cod in (3, 5, 7)")
def filter_lookup_codes(spark, sf):
    return keep_codes(clean_lookup(lookup(spark, sf)), [3, 5, 7])


@query(
    "filter_status",
    f"""select l_orderkey, l_linenumber, {digits_sql("sit_raw")} as sit_clean
        from ({FACTS_SQL}) where {digits_sql("sit_raw")} = 2""",
)
def filter_status(spark, sf):
    alive = add_clean_keys(facts(spark, sf), COLUMNS).filter(F.col("sit_clean") == 2)
    return alive.select(*KEYS, "sit_clean")


def _search_sql(value: str, columns: list[str], source: str) -> str:
    texts = ", ".join(f"cast({c} as varchar)" for c in columns)
    return (
        f"select {', '.join(columns)} from ({source}) "
        f"where list_contains([{texts}], '{value}')"
    )


@query("any_column_equals", _search_sql("7", SEARCHED, "select * from lineitem"))
def search_numbers(spark, sf):
    return any_column_equals(table(spark, sf, "lineitem").select(*SEARCHED), "7")


@query("any_column_equals_text", _search_sql("07", RAW, FACTS_SQL))
def search_text(spark, sf):
    return any_column_equals(facts(spark, sf).select(*RAW), "07")


def _locate_sql(value: str, columns: list[str]) -> str:
    counts = ", ".join(
        f"count(*) filter (where cast({c} as varchar) = '{value}') as n_{c}" for c in columns
    )
    rows = " union all ".join(
        f"select '{c}' as col_name, n_{c} as matches from counted" for c in columns
    )
    return f"with counted as (select {counts} from lineitem) {rows}"


@query("locate_value", _locate_sql("7", SEARCHED))
def locate(spark, sf):
    return locate_value(table(spark, sf, "lineitem").select(*SEARCHED), "7")


@query(
    "sample_rows",
    f"select {', '.join(SEARCHED)} from lineitem order by {', '.join(SEARCHED)} limit 5",
)
def sample(spark, sf):
    return sample_rows(table(spark, sf, "lineitem").select(*SEARCHED), 5, SEARCHED)
