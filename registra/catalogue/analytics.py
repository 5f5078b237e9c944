"""Queries: joins in time, subtotals, change from month to month, mergeable distinct counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from registra.catalogue.registry import query
from registra.catalogue.tables import (
    COLUMNS,
    SILVER_SQL,
    facts,
    lookup,
    table,
)
from registra.operators.columns import add_clean_keys
from registra.operators.lookup import clean_lookup, join_lookup
from registra.operators.search import any_column_equals, locate_value
from registra.operators.summaries import (
    distinct_sketches,
    merged_sketches,
    month_change,
    subtotals,
)
from registra.operators.temporal import as_of_join, interval_join, interval_steps
from registra.session import work_folder

# The span of the events, in seconds, over which the intervals below are dealt.
DAYS_30 = 30 * 86_400


@query(
    "order_before_shipping",
    """with shipped as (
           select l_orderkey, l_linenumber, o_custkey, l_shipdate as day
           from lineitem join orders on o_orderkey = l_orderkey),
       last as (select o_custkey, o_orderdate as day, max(o_orderkey) as last_order
                from orders group by all)
       select l_orderkey, l_linenumber, last_order, l.day as order_day
       from shipped s asof left join last l on s.o_custkey = l.o_custkey and s.day > l.day""",
)
def order_before_shipping(spark, sf):
    """Each line item with its customer's last order before the day it was shipped."""
    orders = table(spark, sf, "orders")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").alias("day"))
    owners = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    placed = orders.select(
        "o_custkey",
        F.col("o_orderdate").alias("day"),
        F.col("o_orderkey").alias("last_order"),
        F.col("o_orderdate").alias("order_day"),
    )
    found = as_of_join(
        lines.join(owners, "l_orderkey"),
        placed,
        ["o_custkey"],
        "day",
        ["last_order", "order_day"],
        lambda day: F.date_trunc("quarter", day),
    )
    return found.select("l_orderkey", "l_linenumber", "last_order", "order_day")


@query(
    "events_in_intervals",
    f"""with spans as (
            select o_orderkey, o_orderkey * 7919 % {DAYS_30} as low, low + o_custkey % 3600 as high
            from orders),
        moments as (
            select event_id, event_type,
                   (epoch_us(ts) - epoch_us(timestamp '2024-01-01')) // 1000000 as sec from events)
        select event_id, event_type, count(*) as n, sum(o_orderkey)::bigint as orders
        from moments join spans on sec >= low and sec < high group by all""",
)
def events_in_intervals(spark, sf):
    """Events with the intervals, derived from the orders, that they fall into."""
    start = (F.col("o_orderkey") * 7919) % DAYS_30
    spans = table(spark, sf, "orders").select(
        "o_orderkey", start.alias("low"), (start + F.col("o_custkey") % 3600).alias("high")
    )
    second = F.expr("timestampdiff(SECOND, timestamp_ntz'2024-01-01 00:00:00', ts)")
    moments = table(spark, sf, "events").select(
        "event_id", "event_type", second.alias("at"), (second + 1).alias("after")
    )
    steps = interval_steps(spans, ("low", "high"), width=3600, sums={"orders": "o_orderkey"})
    met = interval_join(moments, steps, ("at", "after"), ("low", "high"), width=60)
    return met.groupBy("event_id", "event_type").agg(
        F.sum("n").alias("n"), F.sum("orders").cast("long").alias("orders")
    )


def _counted(spark, sf, *keys):
    """Silver rows by key, counted before they meet the lookup."""
    rows = add_clean_keys(facts(spark, sf), COLUMNS).filter(F.col("sit_clean") == 2)
    some = rows.groupBy("mun_clean", *keys).agg(F.count(F.lit(1)).alias("facts"))
    cities = clean_lookup(lookup(spark, sf)).groupBy("municipio_cod").agg(
        F.count(F.lit(1)).alias("copies")
    )
    counted = join_lookup(some, cities).withColumn("n", F.col("facts") * F.col("copies"))
    return counted.drop("mun_clean", "facts", "copies")


def _monthly_kinds(spark, sf):
    month = F.date_format("l_shipdate", "yyyy-MM").alias("ref_month")
    return _counted(spark, sf, month, F.col("kind_raw").alias("kind"))


@query(
    "gold_rollup",
    f"""select ref_month, municipio_cod, kind, grouping(ref_month, municipio_cod, kind)::int as level,
               count(*) as n
        from (select strftime(l_shipdate, '%Y-%m') as ref_month, municipio_cod, kind_raw as kind
              from ({SILVER_SQL}))
        group by rollup(ref_month, municipio_cod, kind)""",
)
def gold_rollup(spark, sf):
    return subtotals(_monthly_kinds(spark, sf), ["ref_month", "municipio_cod", "kind"])


@query(
    "gold_grouping_sets",
    f"""select ref_month, municipio_cod, kind, grouping(ref_month, municipio_cod, kind)::int as level,
               count(*) as n
        from (select strftime(l_shipdate, '%Y-%m') as ref_month, municipio_cod, kind_raw as kind
              from ({SILVER_SQL}))
        group by grouping sets ((ref_month, kind), (municipio_cod), ())""",
)
def gold_grouping_sets(spark, sf):
    keys = ["ref_month", "municipio_cod", "kind"]
    return subtotals(_monthly_kinds(spark, sf), keys, [["ref_month", "kind"], ["municipio_cod"], []])


@query(
    "gold_month_change",
    f"""with counts as (
            select municipio_cod, date_trunc('month', l_shipdate)::date as first_day, count(*) as n
            from ({SILVER_SQL}) group by all),
        months as (
            select municipio_cod,
                   unnest(generate_series(min(first_day), max(first_day), interval 1 month))::date
                       as first_day
            from counts group by 1),
        filled as (
            select municipio_cod, first_day, coalesce(n, 0) as n
            from months left join counts using (municipio_cod, first_day))
        select *, n - lag(n) over w as change, (sum(n) over w)::bigint as total
        from filled window w as (partition by municipio_cod order by first_day)""",
)
def gold_month_change(spark, sf):
    first_day = F.trunc(F.col("l_shipdate").cast("date"), "month").alias("first_day")
    return month_change(_counted(spark, sf, first_day), "municipio_cod", "first_day")


@query(
    "distinct_parts_by_year",
    """select year(l_shipdate)::int as year, count(distinct l_partkey) as parts, true as near,
              true as as_at_once
       from lineitem group by 1""",
)
def distinct_parts_by_year(spark, sf):
    """Distinct parts of a year, exactly, and whether the merged sketches of its months are within 3 %
    of it and give what one sketch of the year gives."""
    lines = table(spark, sf, "lineitem").select(
        F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"), "l_partkey"
    )
    folder = work_folder(spark, "sketches")
    distinct_sketches(lines, ["year", "month"], "l_partkey").write.parquet(folder)
    stored = spark.read.schema("year int, month int, sketch binary").parquet(folder)
    merged = merged_sketches(stored, ["year"]).select("year", F.col("n").alias("merged"))
    once = distinct_sketches(lines, ["year"], "l_partkey")
    whole = once.select("year", F.theta_sketch_estimate("sketch").alias("whole"))
    exact = lines.groupBy("year").agg(F.countDistinct("l_partkey").alias("parts"))
    return exact.join(merged, "year").join(whole, "year").select(
        "year",
        "parts",
        (F.abs(F.col("merged") - F.col("parts")) <= 0.03 * F.col("parts")).alias("near"),
        (F.col("merged") == F.col("whole")).alias("as_at_once"),
    )


ALL_COLUMNS = """l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax
                 l_returnflag l_linestatus l_shipdate""".split()
# Columns of doubles, of text and of whole numbers hold what these read as.
AMOUNT = "17.0"
ANY_TEXT = " or ".join(f"cast({c} as varchar) = '{AMOUNT}'" for c in ALL_COLUMNS)


@query(
    "any_column_equals_all_columns",
    f"select l_orderkey, l_linenumber, l_quantity from lineitem where {ANY_TEXT}",
)
def search_all_columns(spark, sf):
    lines = table(spark, sf, "lineitem")
    assert lines.columns == ALL_COLUMNS
    return any_column_equals(lines, AMOUNT).select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "locate_value_all_columns",
    " union all ".join(
        f"select '{c}' as col_name, count(*) filter (cast({c} as varchar) = '{AMOUNT}') as matches "
        "from lineitem"
        for c in ALL_COLUMNS
    ),
)
def locate_all_columns(spark, sf):
    return locate_value(table(spark, sf, "lineitem"), AMOUNT)
