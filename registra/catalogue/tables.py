"""The driver tables in the role of the registry.

Line items play the establishments. Their codes are noisy on purpose: some are missing, empty,
without digits, too long for an int or of no municipality, and flags are missing or unknown.
Suppliers play the municipalities, whose code is the digits of their name; some come twice and
some have no code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registra.config import ColumnMap

CITY = 7
COLUMNS = ColumnMap(municipality="mun_raw", status="sit_raw", kind="kind_raw")
KINDS = {"F": "matriz", "O": "filial"}
KEYS = ["l_orderkey", "l_linenumber"]

FACTS_SQL = """
    select *,
           case l_partkey % 29
                when 0 then null
                when 1 then ''
                when 2 then 'abc'
                when 3 then '99999999' || cast(l_suppkey as varchar) || '99'
                when 4 then ' 0' || cast(l_suppkey as varchar) || '-. '
                when 5 then cast(l_suppkey + 1000000 as varchar)
                else 'S-0' || cast(l_suppkey as varchar) end as mun_raw,
           case l_partkey % 31
                when 0 then null
                when 1 then 'x'
                else lpad(cast(l_linenumber as varchar), 2, '0') end as sit_raw,
           case l_partkey % 23 when 0 then null when 1 then 'X' else l_linestatus end as kind_raw
    from lineitem"""


def digits_sql(text: str) -> str:
    return f"try_cast(regexp_replace({text}, '[^0-9]', '', 'g') as integer)"


LOOKUP_SQL = f"""
    select {digits_sql("code")} as municipio_cod, s_name as municipio_nome
    from (select s_name as code, s_name from supplier
          union all select s_name || '.', s_name from supplier where s_nationkey = 3
          union all select case when s_suppkey % 2 = 0 then 'none' end, s_name
                    from supplier where s_nationkey = 5)"""

SILVER_SQL = f"""
    select f.*, {digits_sql("mun_raw")} as mun_clean, {digits_sql("sit_raw")} as sit_clean,
           m.municipio_cod, m.municipio_nome
    from ({FACTS_SQL}) f
    join ({LOOKUP_SQL}) m on {digits_sql("f.mun_raw")} = m.municipio_cod
    where {digits_sql("f.sit_raw")} = 2"""


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def facts(spark: SparkSession, sf: str) -> DataFrame:
    supplier = F.col("l_suppkey").cast("string")
    code, status, kind = (F.col("l_partkey") % n for n in (29, 31, 23))
    missing = F.lit(None).cast("string")
    return table(spark, sf, "lineitem").withColumns(
        {
            "mun_raw": F.when(code == 0, missing)
            .when(code == 1, "")
            .when(code == 2, "abc")
            .when(code == 3, F.concat(F.lit("99999999"), supplier, F.lit("99")))
            .when(code == 4, F.concat(F.lit(" 0"), supplier, F.lit("-. ")))
            .when(code == 5, (F.col("l_suppkey") + 1000000).cast("string"))
            .otherwise(F.concat(F.lit("S-0"), supplier)),
            "sit_raw": F.when(status == 0, missing)
            .when(status == 1, "x")
            .otherwise(F.lpad(F.col("l_linenumber").cast("string"), 2, "0")),
            "kind_raw": F.when(kind == 0, missing).when(kind == 1, "X").otherwise(
                F.col("l_linestatus")
            ),
        }
    )


def lookup(spark: SparkSession, sf: str) -> DataFrame:
    cities = table(spark, sf, "supplier")
    name = F.col("s_name").alias("municipio_nome")
    uncoded = F.when(F.col("s_suppkey") % 2 == 0, "none").alias("municipio_cod")
    again = F.concat("s_name", F.lit(".")).alias("municipio_cod")
    return (
        cities.select(F.col("s_name").alias("municipio_cod"), name)
        .unionAll(cities.filter("s_nationkey = 3").select(again, name))
        .unionAll(cities.filter("s_nationkey = 5").select(uncoded, name))
    )
