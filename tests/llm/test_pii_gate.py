import random

import pytest

from registra.llm.pii import (
    _NUMBER,
    _PLUS,
    _POINT,
    _SIGNS,
    KINDS,
    _lookalikes,
    base_spans,
    hidden_spans,
    rewritten,
)

ALONE = [
    ("plus 44 2079 460958", "phone", "plus 44 2079 460958"),
    ("call Plus 44 2079 460958 now", "phone", "Plus 44 2079 460958"),
    ("192 point 168 point 0 point 1", "ip", "192 point 168 point 0 point 1"),
    ("host 192 Point 168 point 0 POINT 1 is up", "ip", "192 Point 168 point 0 POINT 1"),
]


@pytest.mark.parametrize("text,kind,span", ALONE)
def test_plus_and_point_need_no_other_disguise(text, kind, span):
    assert text.isascii()
    found = hidden_spans(text, base_spans(text))
    assert [(KINDS[k], text[s:e]) for s, k, e in found] == [(kind, span)]


@pytest.mark.parametrize("text", ["a plus 3 points", "2 plus 2", "3 point 14", "surplus 44 2079 460958"])
def test_ordinary_plus_and_point_gain_nothing(text):
    assert hidden_spans(text, base_spans(text)) == []


def test_gate_opens_for_every_pattern_and_lookalike():
    table, odd, chars = _lookalikes()
    assert chars == {chr(code) for code in table}
    assert all(rewritten(f"a{c}b") is not None for c in chars)
    parts = ["plus ", " point ", " dot ", "PLUS ", " DOT ", " poİnt ", " Poınt ", "pluſ ", "(at)", "[ . ]",
             "4", "one", " two", "-three ", "nİne", "five", "x", " ", "İ", "é", "K", "[dot", "@"]
    rng = random.Random(7)
    opened = 0
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 7)))
        signs = any(sign.search(text) for sign in (_SIGNS, _NUMBER, _PLUS, _POINT))
        expected = signs or odd.search(text) is not None
        assert (rewritten(text) is not None) == expected, text
        opened += expected
    assert 2000 < opened < 19_000
