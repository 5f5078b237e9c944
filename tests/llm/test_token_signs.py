import random

import numpy as np
import pytest

from registra.llm import token_records
from registra.llm.token_records import SIGNS, Encoder
from tests.llm.test_token_records import PATH, ids, library  # noqa: F401

ODD = ["…", "—", "™", "®", "”", "\U0001f600", "e\u0301", "\u200d", "°", "€", "漢", "²", "ª", "Ⅷ"]


@pytest.mark.parametrize("cached", [500_000, 3])
def test_signs_after_other_signs(library, monkeypatch, cached):  # noqa: F811
    monkeypatch.setattr(token_records, "CACHED", cached)
    encoder, rnd = Encoder(PATH), random.Random(5)
    texts = [f"{lead}{odd}{sign}{more}" for odd in ODD for sign in SIGNS
             for lead in ("", " bar", "foo bar") for more in ("", '"', " x")]
    parts = [*ODD, *'".,)]-:!', " ", " ", "bar", "1", "\n", "'s"]
    texts += ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 9))) for _ in range(4000)]
    got = [np.frombuffer(x, "<u2").tolist() for x in encoder.encode(texts)]
    assert got == [ids(library, t) for t in texts]


def test_letters_and_digits_are_the_librarys(library):  # noqa: F811
    """Signs are only taken off where the library itself starts anew."""
    split = library.pre_tokenizer.pre_tokenize_str
    wrong = [c for c in map(chr, range(0x30000)) if c.isalnum() and len(split("a " + c + '"')) != 3]
    assert wrong == []
