import math
import zlib
from collections import Counter

import pyarrow.parquet as pq
import pytest

from registra.llm import lm_score
from registra.llm.lm_score import MU, score_documents
from tests.llm.cases import by_id
from tests.llm.test_lm_score import SF, tokens


def typical(c):
    low = 1 << (c.bit_length() - 1) if c else 0
    return (low + 2 * low - 1) / 2 if c else 0


def model(rows):
    """Scores from a count of each distinct token and pair, without a filter."""
    ones, twos = Counter(), Counter()
    own = {r["doc_id"]: [None, *tokens(r["text"]), None] for r in rows}
    for i, ts in own.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            ones.update(ts[1:])
            twos.update(zip(ts, ts[1:]))
    n, v = sum(ones.values()), len(ones)

    def p(b, t):
        both, alone = typical(twos[b, t]), (typical(ones[t]) + 1) / (n + v + 1)
        return (both + MU * alone) / (max(typical(ones[b]), both) + MU)

    return {i: sum(math.log10(p(b, t)) for b, t in zip(ts, ts[1:])) for i, ts in own.items()}


def test_every_token_has_its_own_count_whatever_the_dictionary(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "BITS_PER_ENTRY", 64)  # so that the filter hardly ever overstates
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    expected = model(pq.read_table(f"{SF}/documents.parquet").to_pylist())
    few, all_ = (by_id(score_documents(docs, dictionary=d)) for d in (50, 1 << 18))
    for i, score in expected.items():
        assert few[i].score == pytest.approx(all_[i].score, rel=1e-12)
        assert few[i].score == pytest.approx(score, rel=0.005)
