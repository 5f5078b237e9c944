"""Benchmark decontamination with one Aho-Corasick automaton over normalised test items.

Texts are normalised to words; the automaton's letters are words, numbered by a vocabulary of the
benchmark alone, so a pattern of 13 words is 13 steps and a word that no item has resets it. Each
document is scanned once; hits are ranges of words, and the words' offsets in the text as it
was are worked out only where something was hit.

The benchmark is a query set: it is read to the driver in blocks of a bounded number of words, one
automaton per block, built once per Python worker. Documents are scanned block by block only if
the benchmark is larger than one block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registra.llm.common import Shared, settled

WINDOW = 13
BLOCK_WORDS = 500_000
SHARE = 20  # contaminated: one word in so many is hit

_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
    for b in range(256)
)
_REPORT = (
    "n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>"
)


def words(text: str | None) -> list[bytes]:
    """Words of a text: runs of digits, ASCII letters in lower case, and all beyond ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()


def word_offsets(text: str) -> list[tuple[int, int]]:
    """Where the same words lie in the text, in code points."""
    return [m.span() for m in _WORD.finditer(_lower(text))]


def _lower(text: str) -> str:
    return text.translate({c: c + 32 for c in range(65, 91)})


class Items:
    """One block of test items as an automaton; pickled as texts, built where it is used."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        self.items, self.window = items, window
        self._built = None

    def __getstate__(self):
        return (self.items, self.window)

    def __setstate__(self, state):
        self.items, self.window = state
        self._built = None

    def built(self):
        if self._built is None:
            numbers: dict[bytes, int] = {}
            of: dict[tuple[int, ...], set[int]] = {}
            for k, (_, text) in enumerate(self.items):
                ids = [numbers.setdefault(w, len(numbers) + 1) for w in words(text)]
                size = min(self.window, len(ids))
                for at in range(len(ids) - size + 1) if ids else ():
                    of.setdefault(tuple(ids[at : at + size]), set()).add(k)
            automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
            for key, ks in of.items():
                automaton.add_word(key, (len(key), tuple(ks)))
            automaton.make_automaton()
            self._built = numbers, automaton if of else None
        return self._built

    def scan(self, found: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Ranges of words (merged, end exclusive) that lie in a window, and the items hit."""
        numbers, automaton = self.built()
        ranges: list[tuple[int, int]] = []
        hit: set[int] = set()
        if automaton is None:
            return ranges, hit
        number = numbers.get
        for last, (size, ks) in automaton.iter(tuple([number(w, 0) for w in found])):
            start, end = last + 1 - size, last + 1
            while ranges and start <= ranges[-1][1]:
                start = min(start, ranges.pop()[0])
            ranges.append((start, end))
            hit.update(ks)
        return ranges, hit


def blocks(benchmark: DataFrame, item_col: str, text_col: str, limit: int) -> Iterator[list]:
    """The benchmark in blocks of at most `limit` words (an item is never cut), at least one. Items
    are fetched one partition at a time, and no block is held once the next is asked for."""
    rows = benchmark.select(F.col(item_col).cast("string"), F.col(text_col)).filter(
        F.col(text_col).isNotNull()
    )
    out, size = [], 0
    for item, text in rows.toLocalIterator():
        n = len(words(text))
        if size and size + n > limit:
            yield out
            out, size = [], 0
        out.append((item, text))
        size += n
    yield out


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


_RANGES = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _single(shared):
    """Report of one block, with the offsets in the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            n_words, n_hit, items, spans = [], [], [], []
            for value in batch.column(1):
                text = value.as_py()
                found = words(text)
                ranges, hit = block.scan(found)
                at = word_offsets(text) if ranges else []
                n_words.append(len(found))
                n_hit.append(sum(e - s for s, e in ranges))
                items.append(sorted({block.items[k][0] or "null" for k in hit}))
                spans.append([{"start": at[s][0], "end": at[e - 1][1]} for s, e in ranges])
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_hit, pa.int64()),
                    pa.array(items, pa.list_(pa.string())),
                    pa.array(spans, _RANGES),
                ],
                names=["id", "n_words", "n_hit", "items", "spans"],
            )

    return run


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Per row of `docs`: id, n_words, n_hit, items (strings, sorted), spans (start and end of
    the hit passages in code points of the text as it is).

    A window is `window` consecutive words of an item, or all its words if they are fewer. Null
    texts have no words; an item without an id is listed as "null"; items that repeat an id
    count once. An empty benchmark hits nothing. Other columns are not read.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    found = blocks(benchmark, item_col, item_text_col, block_words)
    first, second = next(found), next(found, None)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    if second is None:
        shared = Shared(spark, Items(first, window))
        return texts.mapInArrow(_single(shared), f"id {kind}, {_REPORT}").withColumnRenamed(
            "id", id_col
        )
    found = chain(iter([first]), iter([second]), found)
    del first, second
    return _by_blocks(texts, found, window, kind).withColumnRenamed("id", id_col)


def _by_blocks(texts: DataFrame, found: Iterator[list], window: int, kind: str) -> DataFrame:
    """The same with several blocks: what a block finds rides along as a column, and the pass is
    written before the next one starts, so that a worker holds one automaton at a time."""
    spark = texts.sparkSession
    ranges = "array<struct<start:long,end:long>>"
    carried = texts.select(
        "id", "text", F.array().cast(ranges).alias("words"), F.array().cast("array<string>").alias("items")
    )
    for block in found:
        shared = Shared(spark, Items(block, window))
        carried = settled(
            carried.mapInArrow(
                _pass(shared), f"id {kind}, text string, words {ranges}, items array<string>"
            ),
            "hits",
        )
        shared.release()
    return carried.mapInArrow(_closing, f"id {kind}, {_REPORT}")


def _pass(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            ranges, items = [], []
            for text, before, names in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                now, hit = block.scan(words(text))
                both = _merged([(r["start"], r["end"]) for r in before] + now)
                ranges.append([{"start": s, "end": e} for s, e in both])
                items.append(sorted({*names, *(block.items[k][0] or "null" for k in hit)}))
            yield pa.record_batch(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(ranges, _RANGES),
                    pa.array(items, pa.list_(pa.string())),
                ],
                names=["id", "text", "words", "items"],
            )

    return run


def _closing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, n_hit, spans = [], [], []
        for text, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            at = word_offsets(text) if ranges else []
            n_words.append(len(words(text)))
            n_hit.append(sum(r["end"] - r["start"] for r in ranges))
            spans.append(
                [{"start": at[r["start"]][0], "end": at[r["end"] - 1][1]} for r in ranges]
            )
        yield pa.record_batch(
            [
                batch.column(0),
                pa.array(n_words, pa.int64()),
                pa.array(n_hit, pa.int64()),
                batch.column(3),
                pa.array(spans, _RANGES),
            ],
            names=["id", "n_words", "n_hit", "items", "spans"],
        )


def contaminated(share: int = SHARE) -> Column:
    """Hit in one of `share` words at least."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    share: int = SHARE,
) -> DataFrame:
    """The documents that are not contaminated, with all their columns. Documents without an id
    stay; rows that repeat an id share its worst verdict."""
    report = find_contamination(docs, benchmark, id_col, text_col)
    gone = settled(
        report.filter(contaminated(share)).select(F.col(id_col).alias("gone")).distinct(),
        "contaminated",
    )
    return docs.join(gone, docs[id_col] == gone["gone"], "left_anti")
