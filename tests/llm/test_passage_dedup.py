import random

import pyarrow.parquet as pq

from registra.llm.passage_dedup import drop_passages, passages, segments, units
from tests.llm.cases import by_id, edge_docs, texts

SF = "/root/testdata/sf0.001"


def plain(values, unit_words, least):
    """Spans to remove, all units of all texts compared with those before."""
    seen, gone = {}, {i: [] for i in values}
    for i in sorted(values):
        for d1, d2, start, end, _ in sorted(units(values[i], unit_words), key=lambda u: u[2]):
            first = seen.setdefault((d1, d2), (i, start))
            if first != (i, start):
                gone[i].append((start, end))
    return {i: passages(values[i], g, least) if g else [] for i, g in gone.items()}


def sentence(rnd, n):
    return " ".join(rnd.choice("abcdefghij") + str(rnd.randint(0, 999)) for _ in range(n)).capitalize() + "."


def test_whole_table_against_brute_force(spark):
    values = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    got = by_id(drop_passages(spark.read.parquet(f"{SF}/documents.parquet")))
    expected = plain(values, 12, 30)
    assert sum(map(bool, expected.values())) > 5
    for i, spans in expected.items():
        assert [(s["start"], s["end"]) for s in got[i].removed] == spans
        left, at = "", 0
        for s, e in spans:
            left += values[i][at:s]
            at = e
        assert got[i].text == left + values[i][at:]


def test_passages_are_found_wherever_they_stand(spark):
    rnd = random.Random(8)
    passage = " ".join(sentence(rnd, 9) for _ in range(7))
    hosts = [" ".join(sentence(rnd, 11) for _ in range(6)) for _ in range(40)]
    values = {}
    for i, host in enumerate(hosts):
        words = host.split()
        at = rnd.randint(0, len(words))
        between = "\n" if i % 2 else " "
        values[i] = " ".join(words[:at]) + between + passage + between + " ".join(words[at:])
    values |= {100 + i: " ".join(sentence(rnd, 11) for _ in range(6)) for i in range(20)}
    got = by_id(drop_passages(texts(spark, values)))
    assert got[0].removed == [] and got[0].text == values[0]
    for i in range(1, 40):
        begin = values[i].index(passage)
        assert len(got[i].removed) == 1
        s, e = got[i].removed[0]
        assert begin <= s <= begin + 80 and begin + len(passage) - 80 <= e <= begin + len(passage)
    assert all(not got[100 + i].removed for i in range(20))


def test_short_repeats_stay(spark):
    rnd = random.Random(9)
    values = {i: sentence(rnd, 20) + "\nThis work is licensed under some license.\n" + sentence(rnd, 20)
              for i in range(30)}
    assert not any(r.removed for r in drop_passages(texts(spark, values)).collect())


def test_a_passage_repeated_inside_one_text_goes(spark):
    rnd = random.Random(10)
    passage = " ".join(sentence(rnd, 10) for _ in range(6))
    middle = sentence(rnd, 15)
    text = passage + "\n" + middle + "\n" + passage
    row = drop_passages(texts(spark, {1: text})).first()
    assert [tuple(s) for s in row.removed] == [(len(text) - len(passage), len(text))]


def test_segments_and_units():
    text = "One two. Three four\nfive Six SEVEN"
    assert [text[s:e] for s, e, _, _ in segments(text)] == ["One two.", "Three four", "five", "Six", "SEVEN"]
    assert [(text[s:e], n) for _, _, s, e, n in units(text, 3)] == [
        ("One two. Three four", 4), ("Three four\nfive", 3), ("five Six SEVEN", 3)
    ]
    assert units("a b", 3) == [] and units(None, 3) == [] and units("  \n ", 1) == []
    assert len(units("x" * 120_000, 1)) == 1 and len(units("A b. " * 20_000, 12)) == 19_995


def test_edges(spark):
    got = drop_passages(edge_docs(spark)).collect()
    assert len(got) == 12 and [r.text for r in got if r.doc_id == 3] == [None]
    removed = {str(r.doc_id) for r in got if r.removed}
    assert removed == {"6"}
    kept = next(r for r in got if r.doc_id == 6)
    assert 0 < len(kept.text) < 400
    assert drop_passages(edge_docs(spark, [])).collect() == []
