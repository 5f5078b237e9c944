"""Repeated passages: hashing of normalised units, the earliest ranked occurrence stays.

A text is cut into segments at line ends, paragraph ends included, after sentences, and where a
capital follows a small letter; each of these shows in the few characters around it, so a passage is
cut alike wherever it stands. Hashing whole lines would miss a passage inside a longer line,
which is how passages repeat here. A unit begins at each segment and runs on, over line
ends, to the first segment end with `unit_words` words or more; a last unit reaches the end of the
text. So a unit is never a short phrase that texts share by chance.

Digests (128 bits of the lower-cased words) are grouped globally; of equal units the one with the
smallest id, then place, stays. Units that do not stay, joined where they touch, are a passage, and
passages of `passage_words` words or more are removed. Offsets are those of the source.

That is `drop_passages`. `drop_repeats` does not depend on where a passage is cut. Beside the units it
takes anchors: of each `ANCHOR_REACH` neighbouring runs of `ANCHOR_WORDS` words the one with the
smallest hash, so equal runs of 30 words share one wherever they stand. Every unit or anchor
that stands earlier goes, without a second floor, and is extended word by word by what surrounds
its earliest occurrence. Characters of scripts without spaces are words of their own there.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registra.llm.common import settled, worker_state

UNIT_WORDS = 12
PASSAGE_WORDS = 30
ANCHOR_WORDS, ANCHOR_REACH = 12, 19
# The same where characters are words: an equal run of 50 shares an anchor.
DENSE_WORDS, DENSE_REACH = 24, 27

# A line end, a space after a sentence, a space between a small letter or comma and a capital.
_CUT = re.compile(
    r"\s*\n\s*|[ ](?:(?<=[.!?] )|(?<=[a-zß-öø-ÿ,;] )(?=[A-ZÀ-ÖØ-Þ]))\s*"
)


def segments(text: str) -> list[tuple[int, int, str, int]]:
    """(start, end, normalised, words) of the segments that have words."""
    out = []
    start = 0
    for m in _CUT.finditer(text):
        out.append((start, m.start()))
        start = m.end()
    out.append((start, len(text)))
    found = []
    for s, e in out:
        words = text[s:e].lower().split()
        if words:
            found.append((s, e, " ".join(words), len(words)))
    return found


def units(text: str | None, unit_words: int) -> list[tuple[int, int, int, int, int]]:
    """(digest, digest, start, end, words) of the units, by start."""
    parts = segments(text or "")
    out = []

    def add(i: int, j: int, n: int) -> None:
        joined = " ".join([p[2] for p in parts[i : j + 1]]) if j > i else parts[i][2]
        d = xxhash.xxh3_128_intdigest(joined.encode("utf-8", "surrogatepass"))
        out.append((d >> 64, d & 0xFFFFFFFFFFFFFFFF, parts[i][0], parts[j][1], n))

    last, j, n = len(parts) - 1, -1, 0
    for i in range(len(parts)):
        while n < unit_words and j < last:
            j += 1
            n += parts[j][3]
        if n < unit_words:
            break
        add(i, j, n)
        n -= parts[i][3]
    if out and out[-1][3] < parts[last][1]:
        i, n = last, parts[last][3]
        while n < unit_words:
            i -= 1
            n += parts[i][3]
        add(i, last, n)
    return out


_UNIT_KIND = "d1 long, d2 long, id long, start int, end int, words int"


def _units(unit_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            owners: list[int] = []
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = units(value.as_py(), unit_words)
                rows += found
                owners += [doc_id] * len(found)
            d1, d2, start, end, words = zip(*rows, strict=True) if rows else [()] * 5
            yield pa.record_batch(
                [
                    pa.array(np.array(d1, np.uint64).view(np.int64)),
                    pa.array(np.array(d2, np.uint64).view(np.int64)),
                    pa.array(owners, pa.int64()),
                    pa.array(start, pa.int32()),
                    pa.array(end, pa.int32()),
                    pa.array(words, pa.int32()),
                ],
                names=["d1", "d2", "id", "start", "end", "words"],
            )

    return run


def passages(text: str, found: list[tuple[int, int]], least: int) -> list[tuple[int, int]]:
    """Spans that touch or overlap as one, if it has `least` words."""
    out: list[list[int]] = []
    for s, e in sorted(found):
        if out and (s <= out[-1][1] or text[out[-1][1] : s].isspace()):
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out if len(text[s:e].split()) >= least]


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _cutter(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, texts = [], []
            for value, found in zip(batch.column(1), batch.column(2), strict=True):
                text, found = value.as_py(), found.as_py()
                gone = passages(text, [(f["start"], f["end"]) for f in found], least) if found else []
                kept, at = [], 0
                for s, e in gone:
                    kept.append(text[at:s])
                    at = e
                texts.append("".join([*kept, text[at:]]) if gone else text)
                spans.append([{"start": s, "end": e} for s, e in gone])
            yield pa.record_batch(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(spans, _SPANS)],
                names=["id", "text", "removed"],
            )

    return run


def repeated_units(docs: DataFrame, id_col: str, text_col: str, unit_words: int) -> DataFrame:
    """Units that have an earlier equal one: id, start, end."""
    rows = docs.filter(docs[id_col].isNotNull()).select(docs[id_col].cast("long"), docs[text_col])
    found = settled(rows.mapInArrow(_units(unit_words), _UNIT_KIND), "units")
    place = F.struct("id", "start")
    first = (
        found.groupBy("d1", "d2")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .filter("first != last")
        .select("d1", "d2", "first")
    )
    # With both sides plain shuffles, adaptive execution can split a very common passage.
    return (
        found.join(settled(first, "first_units"), ["d1", "d2"])
        .filter(F.struct("id", "start") != F.col("first"))
        .select("id", "start", "end")
    )


def drop_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    unit_words: int = UNIT_WORDS,
    passage_words: int = PASSAGE_WORDS,
) -> DataFrame:
    """Per row of `docs`: id, text without repeated passages, removed (start and end of each, in
    code points of the source).

    Ids are integers and rank the documents. Rows that repeat an id are one document and cut
    alike, where their texts agree. Rows without an id are neither cut nor counted; null texts stay
    null. A text of fewer words than a unit has none. Other columns are not read.
    """
    gone = repeated_units(docs, id_col, text_col, unit_words)
    gone = gone.groupBy("id").agg(F.collect_list(F.struct("start", "end")).alias("found"))
    gone = settled(gone.withColumnRenamed("id", "gone"), "repeated")
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    joined = rows.join(gone, rows["id"] == gone["gone"], "left").select("id", "text", "found")
    kind = docs.schema[id_col].dataType.simpleString()
    return joined.mapInArrow(
        _cutter(passage_words),
        f"id {kind}, text string, removed array<struct<start:long,end:long>>",
    ).toDF(id_col, "text", "removed")


# Thai to Tibetan, Myanmar, Khmer, kana to ideographs, and the wide forms.
_DENSE = [
    (0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3001, 0x312F), (0x31A0, 0x9FFF),
    (0xF900, 0xFAFF), (0xFF01, 0xFFEF), (0x20000, 0x3FFFF),
]
_HAS_DENSE = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in _DENSE) + "]")
_BASES = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def _spaces() -> np.ndarray:
    """Of each code point below 65536, whether it is white space; no other one is."""
    kept = worker_state()
    if "spaces" not in kept:
        kept["spaces"] = np.array([chr(c).isspace() for c in range(1 << 16)])
    return kept["spaces"]


class Words:
    """The words of a text: where they start and end, and their hashes."""

    def __init__(self, text: str):
        self.dense = _HAS_DENSE.search(text) is not None
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        inside = ~_spaces()[np.minimum(codes, 0xFFFF)]
        single = np.zeros(len(codes), bool)
        for a, b in _DENSE if self.dense else ():
            single |= (codes >= a) & (codes <= b)
        single &= inside
        before = np.concatenate([[False], (inside & ~single)[:-1]])
        after = np.concatenate([(inside & ~single)[1:], [False]])
        self.starts = np.flatnonzero(inside & (single | ~before))
        self.ends = np.flatnonzero(inside & (single | ~after)) + 1
        found = [] if self.dense else text.lower().split()
        if len(found) != len(self.starts):
            found = [text[s:e].lower() for s, e in zip(self.starts.tolist(), self.ends.tolist())]
        self.hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in found], np.uint64)
        self.around = (DENSE_REACH if self.dense else ANCHOR_REACH) - 1

    def runs(self, size: int, base: int) -> np.ndarray:
        """A hash of each run of `size` words."""
        n = len(self.hashes)
        powers = np.cumprod(np.full(n, base, np.uint64))
        back = np.cumprod(np.full(n, pow(base, -1, 1 << 64), np.uint64))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.hashes * powers)])
        x = (sums[size:] - sums[:-size]) * back[: n - size + 1]
        x = (x ^ x >> np.uint64(32)) * np.uint64(_BASES[0])
        return x ^ x >> np.uint64(29)

    def anchors(self, size: int, reach: int) -> list[tuple[int, int, int]]:
        """(digest, start, end) of the runs that are the smallest of `reach` neighbours."""
        if len(self.hashes) < size:
            return []
        x = self.runs(size, _BASES[0])
        reach = min(reach, len(x))
        least = np.pad(_sliding(np.minimum, x, reach), reach - 1)
        places = np.flatnonzero(x == _sliding(np.maximum, least, reach))
        d = self.runs(size, _BASES[1])[places].view(np.int64)
        ends = self.ends[places + size - 1]
        return list(zip(d.tolist(), self.starts[places].tolist(), ends.tolist(), strict=True))

    def sides(self, start: int, end: int) -> tuple[int, int]:
        """First word of a span, and the one after its last."""
        i, j = np.searchsorted(self.starts, [start, end]).tolist()
        return i, j

    def digests(self, start: int, end: int) -> list[int]:
        """Digest of a span as an anchor."""
        i, j = self.sides(start, end)
        part = Words.__new__(Words)
        part.hashes = self.hashes[i:j]
        return part.runs(j - i, _BASES[1]).view(np.int64).tolist() if j > i else []

    def context(self, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words before a span, the nearest first, and of those after it."""
        i, j = self.sides(start, end)
        before = self.hashes[max(0, i - self.around) : i][::-1]
        return before.astype("<u4"), self.hashes[j : j + self.around].astype("<u4")

    def extended(self, start: int, end: int, before: bytes, after: bytes) -> tuple[int, int]:
        """The span and the words beside it that equal those of another context."""
        i, j = self.sides(start, end)
        left, right = (
            _equal(a, np.frombuffer(b, "<u4"))
            for a, b in zip(self.context(start, end), (before, after), strict=True)
        )
        start = int(self.starts[i - left]) if left else start
        return start, int(self.ends[j + right - 1]) if right else end


def _sliding(best: np.ufunc, x: np.ndarray, size: int) -> np.ndarray:
    """The best of each `size` neighbours, by doubling."""
    done = 1
    while done < size:
        step = min(done, size - done)
        x = best(x[:-step], x[step:])
        done += step
    return x


def _equal(a: np.ndarray, b: np.ndarray) -> int:
    """How many first elements are equal."""
    n = min(len(a), len(b))
    odd = np.flatnonzero(a[:n] != b[:n])
    return int(odd[0]) if len(odd) else n


def digest(text: str, start: int, end: int) -> tuple[int, bytes]:
    """Digest of a span as a unit: its first half, signed, and the whole."""
    words = " ".join(text[start:end].lower().split())
    d = xxhash.xxh3_128_digest(words.encode("utf-8", "surrogatepass"))
    return int.from_bytes(d[:8], signed=True), d


def marks(text: str | None, unit_words: int) -> list[tuple[int, int, int]]:
    """(digest, start, end) of units and anchors."""
    text = text or ""
    words = Words(text)
    found = [(d - (d >> 63 << 64), s, e) for d, _, s, e, _ in units(text, unit_words)]
    own = words.anchors(ANCHOR_WORDS, ANCHOR_REACH)
    if words.dense:
        own = [a for a in own if not _HAS_DENSE.search(text, a[1], a[2])]
        own += words.anchors(DENSE_WORDS, DENSE_REACH)
    return found + own


def _marks(unit_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ds, owners, places = [], [], []
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for d, s, e in marks(value.as_py(), unit_words):
                    ds.append(d)
                    owners.append(doc_id)
                    places.append(s << 32 | e)
            yield pa.record_batch(
                [pa.array(x, pa.int64()) for x in (ds, owners, places)], names=["d", "id", "at"]
            )

    return run


_LOW = (1 << 32) - 1
_EDGES = pa.schema([("d", pa.int64()), ("id", pa.int64()), ("at", pa.int64())])
_CONTEXTS = pa.schema(
    [("d", pa.int64()), ("check", pa.binary()), ("before", pa.binary()), ("after", pa.binary())]
)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.record_batch(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First and last marks of each stretch of marks that overlap."""
    for batch in batches:
        rows = []
        for doc_id, found in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            items = found.values
            at, d = items.field("at").to_numpy(), items.field("d").to_numpy()
            order = np.argsort(at, kind="stable")
            at, d = at[order], d[order]
            reach = np.maximum.accumulate(at & _LOW)
            cuts = np.flatnonzero((at >> 32)[1:] > reach[:-1]) + 1
            chosen = set()
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)], strict=True):
                chosen |= {a, a + int((at[a:b] & _LOW).argmax())}
            rows += [(int(d[i]), doc_id, int(at[i])) for i in sorted(chosen)]
        yield _rows(rows, _EDGES)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What surrounds the earliest occurrences in a text."""
    for batch in batches:
        rows = []
        for value, found in zip(batch.column(0), batch.column(1), strict=True):
            text = value.as_py() or ""
            words = Words(text)
            for d, at in ((m["d"], m["at"]) for m in found.as_py()):
                start, end = at >> 32, at & _LOW
                own, check = digest(text, start, end)
                if d == own or d in words.digests(start, end):  # an id's rows may differ in text
                    before, after = words.context(start, end)
                    rows.append((d, check, before.tobytes(), after.tobytes()))
        yield _rows(rows, _CONTEXTS)


def _dropper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans, texts = [], []
        for value, found, edges in zip(*batch.columns[1:], strict=True):
            text, found, gone = value.as_py(), found.as_py(), []
            if found and text:
                words, beside = Words(text), {(m["at"], m["d"]): m for m in edges.as_py() or ()}
                for at, d in ((m["at"], m["d"]) for m in found):
                    start, end = at >> 32, at & _LOW
                    m = beside.get((at, d))
                    if m is None:
                        gone.append((start, end))
                    elif digest(text, start, end)[1] == m["check"]:
                        gone.append(words.extended(start, end, m["before"], m["after"]))
                gone = passages(text, gone, 0)
            kept, at = [], 0
            for s, e in gone:
                kept.append(text[at:s])
                at = e
            texts.append("".join([*kept, text[at:]]) if gone else text)
            spans.append([{"start": s, "end": e} for s, e in gone])
        yield pa.record_batch(
            [batch.column(0), pa.array(texts, pa.string()), pa.array(spans, _SPANS)],
            names=["id", "text", "removed"],
        )


def drop_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit_words: int = UNIT_WORDS
) -> DataFrame:
    """Per row of `docs` what `drop_passages` gives, for passages at any word.

    Every equal run of 30 words (50 characters in scripts without spaces) is found wherever it
    stands, and shorter ones if they are whole units or hold an anchor. Its later occurrences go from
    their first word to their last, as far as the earliest occurrence of an anchor there goes on.
    Ids, null texts and other columns are as for `drop_passages`.
    """
    rows = docs.filter(docs[id_col].isNotNull()).select(
        docs[id_col].cast("long").alias("id"), docs[text_col].alias("text")
    )
    found = settled(rows.mapInArrow(_marks(unit_words), "d long, id long, at long"), "marks")
    # Only digests and counts are dealt for all marks; what follows has the repeated ones alone.
    # With both sides plain shuffles, adaptive execution can split a very common passage.
    several = found.groupBy("d").count().filter("count > 1").select("d")
    common = settled(found.join(settled(several, "several"), "d"), "common")
    first = common.groupBy("d").agg(F.min(F.struct("id", "at")).alias("first"))
    first = settled(first.select("d", "first.id", "first.at"), "first")
    later = (
        common.join(first.toDF("d", "first_id", "first_at"), "d")
        .filter((F.col("id") != F.col("first_id")) | (F.col("at") != F.col("first_at")))
        .groupBy("id")
        .agg(F.collect_set(F.struct("at", "d")).alias("found"))
    )
    later = settled(later, "later")
    # Words beside the marks at the ends of each stretch, as at their earliest occurrence.
    edges = settled(later.mapInArrow(_edges, "d long, id long, at long"), "edges")
    asked = (
        first.join(edges.select("d").distinct(), "d")
        .groupBy(F.col("id").alias("asked"))
        .agg(F.collect_list(F.struct("d", "at")).alias("marks"))
    )
    around = (
        rows.join(asked, rows["id"] == asked["asked"])
        .select("text", "marks")
        .mapInArrow(_contexts, "d long, check binary, before binary, after binary")
        .dropDuplicates(["d"])
    )
    beside = (
        edges.join(settled(around, "contexts"), "d")
        .groupBy("id")
        .agg(F.collect_list(F.struct("at", "d", "check", "before", "after")).alias("edges"))
    )
    gone = later.join(beside, "id", "left").withColumnRenamed("id", "gone")
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    joined = rows.join(settled(gone, "repeated"), F.col("id") == F.col("gone"), "left")
    joined = joined.select("id", "text", "found", "edges")
    kind = docs.schema[id_col].dataType.simpleString()
    return joined.mapInArrow(
        _dropper, f"id {kind}, text string, removed array<struct<start:long,end:long>>"
    ).toDF(id_col, "text", "removed")
