import random

import pyarrow.parquet as pq

from registra.llm.passage_dedup import drop_passages, drop_repeats
from tests.llm.cases import by_id, edge_docs, texts

SF = "/root/testdata/sf0.001"


def words(rnd, n):
    return [rnd.choice("abcdefghij") + str(rnd.randint(0, 9999)) for _ in range(n)]


def planted(passage, rnd, hosts=30, least=0):
    """Texts with the passage at random words, and its offsets."""
    values, spans = {}, {}
    for i in range(hosts):
        host = words(rnd, 80)
        at = rnd.randint(least, 80 - least)
        before, after = " ".join(host[:at]), " ".join(host[at:])
        head = before + " " * bool(before)
        values[i] = head + passage + " " * bool(after) + after
        spans[i] = len(head), len(head) + len(passage)
    return values, spans


def test_passages_at_any_word_go_whole(spark):
    rnd = random.Random(20)
    values, expected = {}, {}
    for k in range(10):  # 51-60 words: one sentence, then several
        own = words(rnd, 51 + k)
        if k % 2:
            own[10], own[25], own[40] = (own[x].capitalize() + "." for x in (10, 25, 40))
        some, spans = planted(" ".join(own), rnd)
        values |= {100 * k + i: t for i, t in some.items()}
        expected |= {100 * k + i: s for i, s in spans.items() if i}
    got = by_id(drop_repeats(texts(spark, values)))
    for i, text in values.items():
        spans = [tuple(s) for s in got[i].removed]
        assert spans == ([expected[i]] if i in expected else []), i
        s, e = expected.get(i, (0, 0))
        assert got[i].text == text[:s] + text[e:]


def test_nothing_that_units_found_is_lost(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    values = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    got, before = by_id(drop_repeats(docs)), by_id(drop_passages(docs))
    more = 0
    for i, text in values.items():
        covered = {x for s, e in got[i].removed for x in range(s, e)}
        assert covered >= {x for s, e in before[i].removed for x in range(s, e)}
        more += len(covered) - sum(e - s for s, e in before[i].removed)
    assert more > 0


def test_every_long_run_that_stands_earlier_is_cut(spark):
    rows = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    got = by_id(drop_repeats(spark.read.parquet(f"{SF}/documents.parquet")))
    seen, runs, lost = set(), 0, 0
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        text, at, places = r["text"], 0, []
        for w in text.split():
            at = text.index(w, at)
            places.append((at, at + len(w)))
            at += len(w)
        low = text.lower().split()
        gone = [tuple(s) for s in got[r["doc_id"]].removed]
        for i in range(len(low) - 49):
            run = tuple(low[i : i + 50])
            if run in seen:
                runs += 1
                inside = sum(any(s <= a and b <= e for s, e in gone) for a, b in places[i : i + 50])
                lost += inside < 50
            seen.add(run)
    assert runs > 100 and lost <= runs // 100


def test_scripts_without_spaces(spark):
    rnd = random.Random(21)
    signs = [chr(c) for c in range(0x4E00, 0x5E00)]
    passage = "".join(rnd.choice(signs) for _ in range(200))
    values = {}
    for i in range(6):
        a, b = ("".join(rnd.choice(signs) for _ in range(50)) for _ in range(2))
        values[i] = a + passage + b
    got = by_id(drop_repeats(texts(spark, values)))
    assert [[tuple(s) for s in got[i].removed] for i in range(6)] == [[]] + [[(50, 250)]] * 5


def test_short_lines_and_repeats_inside_a_text(spark):
    rnd = random.Random(22)
    line = "\nThis work is licensed under some license.\n"
    values = {i: " ".join(words(rnd, 20)) + line + " ".join(words(rnd, 20)) for i in range(30)}
    passage = " ".join(words(rnd, 40))
    values[50] = f"{passage} {' '.join(words(rnd, 9))} {passage}"
    got = by_id(drop_repeats(texts(spark, values)))
    end = len(values[50])
    assert [tuple(s) for s in got[50].removed] == [(end - len(passage), end)]
    assert not any(got[i].removed for i in range(30))


def test_edges(spark):
    got = drop_repeats(edge_docs(spark)).collect()
    assert len(got) == 12 and [r.text for r in got if r.doc_id == 3] == [None]
    kept = next(r for r in got if r.doc_id == 6)
    assert kept.removed and 0 < len(kept.text) < 400
    # The two rows of id 2 are one document, and equal in lower case to that of id 1.
    assert {str(r.doc_id) for r in got if r.removed} == {"2", "6"}
    assert drop_repeats(edge_docs(spark, [])).collect() == []
