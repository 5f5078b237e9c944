import random
import re

import pyarrow as pa
import pytest

from registra.llm.decontaminate import blocks, contaminated, drop_contaminated, find_contamination
from tests.llm.cases import by_id, edge_docs, texts

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [(m[0], m.span()) for m in WORD.finditer(lower)]


def plain(text, items, window):
    found = words(text)
    hit, names = set(), set()
    for item, item_text in items:
        own = [w for w, _ in words(item_text)]
        size = min(window, len(own))
        for at in range(len(own) - size + 1 if own else 0):
            for i in range(len(found) - size + 1):
                if [w for w, _ in found[i : i + size]] == own[at : at + size]:
                    hit.update(range(i, i + size))
                    names.add(str(item) if item is not None else "null")
    return len(found), len(hit), sorted(names), [found[i][1] for i in sorted(hit)]


def bench(spark, items):
    ids, values = zip(*items, strict=True) if items else ((), ())
    columns = {"item_id": pa.array(ids, pa.int64()), "text": pa.array(values, pa.string())}
    return spark.createDataFrame(pa.table(columns | {"words": pa.array(ids, pa.int64())}))


@pytest.mark.parametrize("block_words", [10**6, 5])
def test_against_brute_force(spark, block_words):
    rnd = random.Random(2)
    vocabulary = ["a", "B", "c1", "é", "zz", "the"]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 7)))) for i in range(12)]
    items += [(None, "the the the zz zz"), (3, "a a a a a a"), (50, None), (51, "--")]
    values = {
        i: "".join(rnd.choice(vocabulary) + rnd.choice([" ", ", ", "\n", "--"]) for _ in range(rnd.randint(0, 40)))
        for i in range(60)
    }
    got = by_id(find_contamination(texts(spark, values), bench(spark, items), window=4, block_words=block_words))
    for i, text in values.items():
        n, hit, names, spans = plain(text, items, 4)
        assert (got[i].n_words, got[i].n_hit, got[i].items) == (n, hit, names)
        covered = set().union(*(range(s["start"], s["end"]) for s in got[i].spans)) if got[i].spans else set()
        assert all(set(range(a, b)) <= covered for a, b in spans)
        assert sum(len(words(text[s["start"] : s["end"]])) for s in got[i].spans) == hit


def test_filter_leaves_what_is_hit_a_little(spark):
    item = " ".join(f"w{i}" for i in range(13))
    values = {1: item, 2: item + " x" * 300, 3: "clean", 4: None}
    docs = texts(spark, values)
    kept = drop_contaminated(docs, bench(spark, [(1, item)]))
    assert kept.schema == docs.schema and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4]


def test_edges(spark):
    nothing = bench(spark, [])
    for docs, n in ((edge_docs(spark), 12), (edge_docs(spark, []), 0)):
        report = find_contamination(docs, nothing).withColumn("bad", contaminated()).collect()
        assert len(report) == n and not any(r.bad or r.n_hit or r["items"] for r in report)
        assert drop_contaminated(docs, nothing).count() == n
    fox = bench(spark, [(1, "fox jumps")])
    rows = find_contamination(edge_docs(spark), fox).collect()
    assert sum(r.n_hit == 2 for r in rows) == 4


def test_blocks_come_one_at_a_time(spark):
    rows = [(i, f"w{i} " * 30) for i in range(9)]
    benchmark = spark.createDataFrame(rows, "item_id long, text string")
    found = blocks(benchmark, "item_id", "text", 100)
    assert iter(found) is found  # nothing is listed before it is asked for
    sizes = [len(block) for block in found]
    assert sizes == [3, 3, 3]
    assert list(blocks(benchmark.limit(0), "item_id", "text", 100)) == [[]]
