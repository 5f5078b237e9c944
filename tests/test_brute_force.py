"""Silver and gold over random noisy extracts against plain Python."""

import random
import re
from collections import Counter

import pytest

from registra.config import LOOKUP_SCHEMA, ColumnMap, text_schema
from registra.operators import gold
from registra.operators.metrics import run_metrics
from registra.operators.search import any_column_equals, locate_value
from registra.operators.silver import build_silver, guarded

COLUMNS = ColumnMap("_c2", "_c1", "_c3")
CODES = ["7107", "07107", " 7107", "71-07", "5", "005", "1", "", None, "x", "99999999999"]
STATUSES = ["2", "02", "8", "", None, "2 ", "a2"]
KINDS = ["1", "2", "3", None]


def number(text):
    digits = re.sub("[^0-9]", "", text or "")
    return int(digits) if digits and int(digits) < 2**31 else None


def text(value):
    return "" if value is None else str(value)


@pytest.mark.parametrize("seed", range(4))
def test_layers(spark, seed):
    pick = random.Random(seed)
    weights = [60] + [pick.randint(0, 10) for _ in CODES[1:]]
    facts = [
        (
            str(i),
            pick.choice(STATUSES),
            pick.choices(CODES, weights)[0],
            pick.choice(KINDS),
        )
        for i in range(400)
    ]
    lookup = [(pick.choice(CODES), pick.choice(["A", "B", None])) for _ in range(12)]
    wanted = pick.choice([None, [7107], [7107, 5]])

    cities = [(number(c), n) for c, n in lookup]
    cities = [c for c in cities if wanted is None or c[0] in wanted]
    silver = [
        (*f, number(f[2]), 2, c, n)
        for f in facts
        for c, n in cities
        if number(f[1]) == 2 and c is not None and number(f[2]) == c
    ]
    hits = [f for f in facts if "7107" in f]

    fact_table = spark.createDataFrame(facts, text_schema(4)).repartition(5)
    lookup_table = spark.createDataFrame(lookup, LOOKUP_SCHEMA)
    got = build_silver(fact_table, lookup_table, COLUMNS, wanted)
    assert Counter(map(tuple, got.collect())) == Counter(silver)
    assert Counter(map(tuple, any_column_equals(fact_table, "7107").collect())) == Counter(hits)
    located = dict(map(tuple, locate_value(fact_table, "7107").collect()))
    assert located == {f"_c{i}": sum(f[i] == "7107" for f in facts) for i in range(4)}

    by_kind = Counter(r[3] for r in silver)
    by_city = Counter((r[6], r[7], r[3]) for r in silver)
    direct = gold.active_by_city(fact_table, lookup_table, COLUMNS, wanted)
    for table in (direct, gold.by_city(got, "_c3")):
        rows = [tuple(r) for r in table.collect()]
        assert {r[:3]: r[3] for r in rows} == by_city and len(rows) == len(by_city)
    for table in (gold.total_by_kind(direct), gold.by_kind(got, "_c3")):
        assert dict(map(tuple, table.collect())) == by_kind
    metrics = run_metrics(fact_table, lookup_table, "7107", COLUMNS, wanted)
    assert tuple(metrics.first()) == (len(cities), len(hits), len(silver))
    assert guarded(got, fact_table, "no such value").isEmpty()
    assert guarded(got, fact_table, "2").count() == len(silver)
