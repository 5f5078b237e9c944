import hashlib
import random
import re

import pytest

from registra.llm.pii import KINDS, base_spans, find_pii, hidden_spans, mask, pii_report
from tests.llm.cases import by_id, edge_docs, texts


def luhn(digits):
    odd = [int(d) for d in digits[::-1]]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(odd)) % 10 == 0


def plain(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


PARTS = ["a", "b.c", "@", "@x.org", ".", "..", "1", "255", "256", "10.0.0.1", "+", "+49 30 1234567", " ", "-",
         "4111 1111 1111 1111", "411111111111111", "(", ")", "é", "\U0001f600", "_", "%", "x@y", "\n", "0"]


def test_base_spans_against_the_patterns():
    rnd = random.Random(11)
    for _ in range(20_000):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 9)))
        assert base_spans(text) == plain(text), text


HIDDEN = [
    ("write to john dot smith at example dot com now", "email", "john dot smith at example dot com"),
    ("mail john [at] example [dot] com", "email", "john [at] example [dot] com"),
    ("mail john(at)example.com", "email", "john(at)example.com"),
    ("see аlex@exаmple.com ok", "email", "аlex@exаmple.com"),
    ("jo​hn@example.com", "email", "jo​hn@example.com"),
    ("plus one five five five one two three four five six seven", "phone",
     "plus one five five five one two three four five six seven"),
    ("ip one nine two dot one six eight dot one dot one", "ip",
     "one nine two dot one six eight dot one dot one"),
    ("192 dot 168 dot 1 dot 1", "ip", "192 dot 168 dot 1 dot 1"),
    ("４１１１ 1111 1111 1111", "card", "４１１１ 1111 1111 1111"),
    ("four one" + " one" * 14, "card", "four one" + " one" * 14),
]


@pytest.mark.parametrize("text,kind,span", HIDDEN)
def test_disguises_map_back_to_the_source(text, kind, span):
    text = "\U0001f600 " + text
    found = hidden_spans(text, base_spans(text))
    assert [(KINDS[k], text[s:e]) for s, k, e in found] == [(kind, span)]


@pytest.mark.parametrize("text", ["look at example.com today", "one two buckle my shoe", "résumé at noon",
                                  "Нас было двое", "dot dot dot", "plain a@b.co, 1.2.3.4"])
def test_ordinary_text_gains_nothing(text):
    assert hidden_spans(text, base_spans(text)) == []


@pytest.mark.parametrize("unit", ["a.", "1", "1 ", "+1", "@", "a@", "one ", " dot ", "а", "[at]"])
def test_time_is_linear_in_long_texts(unit):
    text = unit * 60_000
    hidden_spans(text, base_spans(text))


def test_table(spark):
    values = {i: t for i, (t, _, _) in enumerate(HIDDEN)} | {99: "a@b.co and c@d.eu"}
    got = by_id(pii_report(texts(spark, values)))
    assert got[99].n_email == 2 and got[99].n_disguised == 0 and got[99].spans == "email:0:6,email:11:17"
    assert got[99].base_sha256 == hashlib.sha256(b"email:0:6,email:11:17").hexdigest()
    assert all(got[i].n_disguised == 1 for i in range(len(HIDDEN)))
    masked = texts(spark, {1: "x a@b.co y"}).select("doc_id", "text")
    spans = find_pii(masked).join(masked, "doc_id").select(mask("text", "spans").alias("t")).first()
    assert spans.t == "x ****** y"


def test_edges(spark):
    got = pii_report(edge_docs(spark)).collect()
    assert len(got) == 12 and {r.spans for r in got} == {""}
    assert pii_report(edge_docs(spark, [])).collect() == []
