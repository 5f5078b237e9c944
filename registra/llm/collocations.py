"""Frequent phrases whose words belong together.

Texts are normalised once and written as chunks of one language each, a word apart by a space, a
piece by a line break. From there on a phrase is a range of a chunk, and its fingerprint comes from
prefix polynomials of the chunk's bytes in the manner of Rabin and Karp: the polynomial of a range
is the difference of two prefixes, divided by the power of the base at its start. All ranges of a
chunk are taken at once in numpy, modulo 2^64. A second polynomial of 32 bits goes with each
fingerprint to tell collisions apart.

A first pass finds which words and pairs may be frequent: tasks add up the leading bits of their
fingerprints, and what is shuffled are the differences between neighbours in sorted order, some two
bytes each. The result is a bit map of fixed size that can let through too much, never too little.
A second pass does the same for the longer phrases all of whose pairs the map lets through. The third
counts what is left by whole fingerprints. Every task adds up equal ones of its
chunks, with two of the places where they occur, before they are shuffled, so a phrase costs
one entry a task however common it is. Entries travel packed, by slices of the fingerprint. Frequent fingerprints only are then looked up
at both places; where the texts differ, the fingerprint is shared, and its occurrences are counted
anew by their text. What stays unseen is two texts of one language and size that agree in all 96 bits
and do not stand at different ends: for 10^13 phrases a chance of less than one in a thousand.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registra.llm.common import batch_rows, read_rows, settled, shuffle_tasks, worker_state

# Small enough that neither Python nor the JVM has to hold large arrays for one.
CHUNK_BYTES = 1 << 17
# Chunks that a task is handed at once, and rows that it reads at once where there are chunks among them.
CHUNK_ROWS = 16
READ_ROWS = 64
# Different entries, or keys alone, that a task holds before it hands them on.
HELD = 3 << 18
KEYS_HELD = 1 << 20
# How many more of them it takes before it adds equal ones up.
MORE = 1 << 18
KEYS_MORE = 1 << 20
# Bits of the map of phrases that may be frequent: 16 for each, as long as these are enough.
MOST_BITS = 1 << 28

# What ends a piece and what is between words.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + PIECE_ENDS + b"\t",
    b"abcdefghijklmnopqrstuvwxyz" + b"\n" * len(PIECE_ENDS) + b" ",
)
_SPACE, _BREAK = 32, 10

_ENTRY = [
    ("fp", np.uint64), ("check", np.uint32), ("count", np.uint32), ("first", np.int64),
    ("first_at", np.uint32), ("last", np.int64), ("last_at", np.uint32), ("size", np.uint32),
    ("words", np.uint8),
]
_LAST = ("last", "last_at")


def normalised(text: str) -> bytes:
    """Words apart by one space, pieces by one line break, and one at the end."""
    raw = np.frombuffer(text.encode().translate(_TABLE) + b"\n", np.uint8)
    apart = (raw == _SPACE) | (raw == _BREAK)
    ends = np.flatnonzero(apart[1:] & ~apart[:-1]) + 1
    if not len(ends):
        return b""
    starts = np.flatnonzero(~apart[1:] & apart[:-1]) + 1
    until = np.append(starts[1:] if apart[0] else starts, len(raw))
    breaks = np.cumsum(raw == _BREAK)
    # The gap after a word is a line break if there is one in it; after the last there always is.
    out = raw.copy()
    out[ends] = np.where(breaks[until - 1] > breaks[ends - 1], _BREAK, _SPACE)
    keep = ~apart
    keep[ends] = True
    return out[keep].tobytes()


def _parts(text: bytes, size: int, longest: int) -> Iterator[tuple[bytes, int]]:
    """A long text in parts of about `size`, cut between pieces. A piece that is itself far longer
    is cut between words; the part then goes on for the `longest - 1` words that phrases of it reach
    into, and the number of these comes with it."""
    start = 0
    while len(text) - start > size:
        cut = text.find(b"\n", start + size) + 1
        space = text.find(b" ", start + size, cut) + 1
        if cut - start <= 2 * size or not space:
            yield text[start:cut], 0
            start = cut
            continue
        end, more = space, 0
        while more < longest - 1 and end < cut:
            after = text.find(b" ", end, cut) + 1
            end, more = after or cut, more + 1
        yield text[start : end - 1] + b"\n", more
        start = space
    if start < len(text):
        yield text[start:], 0


def chunked(
    docs: DataFrame, text_col: str, group_col: str, none: str, longest: int, size: int = CHUNK_BYTES
) -> DataFrame:
    """chunk, lang, body, words, tail: the normalised texts, in chunks of about 128 KiB. The last
    `tail` words of a chunk are those of the next one, and are not counted in `words`."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        total = 0

        def chunk(lang: str, tail: int = 0) -> pa.RecordBatch:
            nonlocal number, total
            body = b"".join(held.pop(lang))
            total -= sizes.pop(lang)
            words = body.count(b" ") + body.count(b"\n") - tail
            number += 1
            columns = zip([number - 1, lang, body, words, tail], _CHUNK.types)
            return pa.record_batch([pa.array([c], t) for c, t in columns], schema=_CHUNK)

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for part, tail in _parts(normalised(text.as_py()), size, longest):
                    held.setdefault(lang, []).append(part)
                    sizes[lang] = sizes.get(lang, 0) + len(part)
                    total += len(part)
                    if tail or sizes[lang] >= size:
                        yield chunk(lang, tail)
                while total > 16 * size:  # many languages with little text each
                    yield chunk(max(sizes, key=sizes.get))
        for lang in list(held):
            yield chunk(lang)

    texts = docs.select(
        F.coalesce(F.col(group_col).cast("string"), F.lit(none)).alias("lang"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    return texts.mapInArrow(pack, "chunk long, lang string, body binary, words long, tail int")


_CHUNK = pa.schema(
    [
        ("chunk", pa.int64()),
        ("lang", pa.string()),
        ("body", pa.binary()),
        ("words", pa.int64()),
        ("tail", pa.int32()),
    ]
)


class Polynomials:
    """Prefix polynomials of two kinds: byte values drawn from a fixed seed, odd bases, and modulo
    the word size, so that a base has an inverse and a sum of products is a cumulative sum."""

    def __init__(self) -> None:
        rng = np.random.default_rng(1987)
        self.kinds = []
        for kind, bits in ((np.uint64, 64), (np.uint32, 32)):
            base = int(rng.integers(1 << 31, 1 << 32)) * 8 + 5
            values = rng.integers(1, 1 << bits, 256, dtype=kind)
            self.kinds.append([kind, base % (1 << bits), values, np.ones(1, kind), np.ones(1, kind)])

    def _grow(self, own: list, length: int) -> None:
        kind, base = own[0], own[1]
        bits = np.dtype(kind).itemsize * 8
        for at, b in ((3, base), (4, pow(base, -1, 1 << bits))):
            powers = np.full(length, b, kind)
            powers[0] = 1
            own[at] = np.multiply.accumulate(powers)

    def prefixes(self, body: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each kind the polynomials of all prefixes, and the inverse powers."""
        out = []
        for own in self.kinds:
            if len(own[3]) <= len(body):
                self._grow(own, 1 << (len(body) + 1).bit_length())
            terms = own[2][body] * own[3][: len(body)]
            sums = np.zeros(len(body) + 1, own[0])
            np.cumsum(terms, dtype=own[0], out=sums[1:])
            out.append((sums, own[4]))
        return out


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread what distinguishes polynomials over all 64 bits; one to one."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Ranges:
    """All phrases of a chunk, by the word they begin with."""

    def __init__(self, body: bytes, lang: str, tail: int, bits: int):
        kept = worker_state()
        polynomials = kept.get("polynomials") or kept.setdefault("polynomials", Polynomials())
        self.body = np.frombuffer(body, np.uint8)
        gaps = (self.body == _SPACE) | (self.body == _BREAK)
        self.ends = np.flatnonzero(gaps)
        self.starts = np.append(0, self.ends[:-1] + 1)
        self.piece = np.cumsum(self.body[self.ends] == _BREAK)
        self.piece = np.append(0, self.piece[:-1])
        self.prefixes = polynomials.prefixes(self.body)
        seed = np.frombuffer(lang.encode(), np.uint8)
        # Of a language, too, the polynomial counts, but so that no phrase can take its part.
        seeds = polynomials.prefixes(seed)
        self.seeds = [mixed(sums[-1:].astype(np.uint64)).astype(sums.dtype) for sums, _ in seeds]
        self.masks = [np.uint64((1 << bits) - 1), np.uint32((1 << bits // 2) - 1)]
        self.own = len(self.starts) - tail

    def firsts(self, words: int) -> np.ndarray:
        """Words that have `words - 1` more behind them in their piece."""
        count = max(0, len(self.starts) - words + 1)
        return np.flatnonzero(self.piece[:count] == self.piece[words - 1 :][:count])

    def counted(self, words: int) -> np.ndarray:
        """Of these the ones that are counted here and not in the next chunk."""
        first = self.firsts(words)
        return first[: np.searchsorted(first, self.own)]

    def keys(self, first: np.ndarray, words: int, lead: int) -> np.ndarray:
        """The first `lead` bits of the fingerprints."""
        return self.fingerprints(first, words) >> np.uint64(64 - lead)

    def chosen(
        self, sizes: tuple[int, ...], lead: int, pairs: np.ndarray | None, may: np.ndarray | None
    ) -> Iterator[tuple[int, np.ndarray]]:
        """For each number of words the phrases whose pairs and whose own key the maps let through."""
        through = None
        if pairs is not None and max(sizes) > 2:
            first = self.firsts(2)
            through = np.zeros(len(self.starts) + 1, bool)
            through[first] = has_bit(pairs, self.keys(first, 2, lead))
        for words in sizes:
            first = self.counted(words)
            if through is not None and words > 2:
                for k in range(words - 1):
                    first = first[through[first + k]]
            if may is not None:
                first = first[has_bit(may, self.keys(first, words, lead))]
            yield words, first

    def fingerprints(self, first: np.ndarray, words: int, kind: int = 0) -> np.ndarray:
        sums, inverse = self.prefixes[kind]
        start, end = self.starts[first], self.ends[first + words - 1]
        found = (sums[end] - sums[start]) * inverse[start] + self.seeds[kind]
        return (mixed(found) if kind == 0 else found) & self.masks[kind]

    def entries(self, chunk: int, first: np.ndarray, words: int) -> np.ndarray:
        """Entries of the phrases that begin with `first`, equal ones that stand next to each other
        in order of fingerprint as one."""
        fp = self.fingerprints(first, words)
        order = np.argsort(fp, kind="stable")
        first, fp = first[order], fp[order]
        check = self.fingerprints(first, words, kind=1)
        start = self.starts[first]
        size = self.ends[first + words - 1] - start
        new = np.ones(len(first), bool)
        new[1:] = False
        for column in (fp, check, size):
            new[1:] |= column[1:] != column[:-1]
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], len(first)) - 1 if len(heads) else heads
        out = np.empty(len(heads), _ENTRY)
        out["fp"], out["check"], out["size"] = fp[heads], check[heads], size[heads]
        out["count"] = tails - heads + 1
        out["first"] = out["last"] = chunk
        out["first_at"], out["last_at"] = start[heads], start[tails]
        out["words"] = words
        return out


def added_up(parts: list[np.ndarray]) -> np.ndarray:
    """One entry for equal ones, with the sum of counts and two of the places, the ends of the
    order they came in. The words of a phrase follow from its text."""
    entries = np.concatenate(parts)
    parts.clear()  # else all entries are held twice
    return entries[: _add_up(entries)]


def _add_up(entries: np.ndarray) -> int:
    """Add equal entries up in their own array, a column after another, and tell how many are left."""
    if not len(entries):
        return 0

    def changes(column: str) -> np.ndarray:
        own = entries[column][order]
        return own[1:] != own[:-1]

    # Any two places will do, so the fingerprint alone is sorted, unless texts share one.
    order = np.argsort(entries["fp"], kind="stable")
    new, other = changes("fp"), changes("check") | changes("size")
    if (other & ~new).any():
        order = np.lexsort((entries["size"], entries["check"], entries["fp"]))
        new, other = changes("fp"), changes("check") | changes("size")
    heads = np.append(0, np.flatnonzero(new | other) + 1)
    del new, other
    left = len(heads)
    entries["count"][:left] = np.add.reduceat(entries["count"][order], heads)
    tails = order[np.append(heads[1:], len(entries)) - 1]
    heads = order[heads]
    del order
    for column, _ in _ENTRY:
        if column != "count":
            entries[column][:left] = entries[column][tails if column in _LAST else heads]
    return left


def _planes(values: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, as those of small numbers are mostly zero."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _from_planes(blob: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(size, -1).T).view(kind).ravel()


_PACKED = "slice int, entries binary"


def _packed(entries: np.ndarray, shift: int) -> Iterator[pa.RecordBatch]:
    """Entries, in order of fingerprint, by its leading bits: a column after another, fingerprints
    as differences and last places by how they differ from the first."""
    if not len(entries):
        return
    part = (entries["fp"] >> np.uint64(shift)).astype(np.int64)
    cuts = np.flatnonzero(part[1:] != part[:-1]) + 1
    for own, number in zip(np.split(entries, cuts), part[np.append(0, cuts)]):
        columns = {name: own[name].copy() for name, _ in _ENTRY}
        columns["fp"] = np.diff(columns["fp"], prepend=np.uint64(0))
        columns["last"] ^= columns["first"]
        columns["last_at"] ^= columns["first_at"]
        blob = b"".join(map(_planes, columns.values()))
        yield pa.record_batch(
            [pa.array([int(number)], pa.int32()), pa.array([blob])], names=["slice", "entries"]
        )


def _unpacked(blob: bytes) -> np.ndarray:
    count = len(blob) // np.dtype(_ENTRY).itemsize
    out, at = np.empty(count, _ENTRY), 0
    for name, kind in _ENTRY:
        size = np.dtype(kind).itemsize * count
        out[name] = _from_planes(blob[at : at + size], kind)
        at += size
    out["fp"] = np.cumsum(out["fp"], dtype=np.uint64)
    out["last"] ^= out["first"]
    out["last_at"] ^= out["first_at"]
    return out


def _room(held: np.ndarray, count: int, needed: int, limit: int) -> np.ndarray:
    """An array with the first `count` rows of another, and room for `needed` or some beyond the limit."""
    if needed <= len(held):
        return held
    out = np.empty(max(needed, limit + limit // 8), held.dtype)
    out[:count] = held[:count]
    return out


class Adder:
    """Adds entries up whenever there are some more than were left the last time. They lie in one array,
    so that small ones of many chunks neither stay between large ones nor are held twice."""

    def __init__(self) -> None:
        self.entries = np.empty(0, _ENTRY)
        self.clear()

    def add(self, entries: np.ndarray) -> bool:
        until = self.held + len(entries)
        self.entries = _room(self.entries, self.held, until, self.limit)
        self.entries[self.held : until] = entries
        self.held = until
        return self.held >= self.limit

    def total(self) -> np.ndarray:
        """What is left; it holds until more is added."""
        self.held = _add_up(self.entries[: self.held])
        self.limit = self.held + max(MORE, self.held // 4)
        return self.entries[: self.held]

    def clear(self) -> None:
        self.held, self.limit = 0, MORE


class KeyAdder:
    """Adds up counts of keys, in the manner of :class:`Adder`."""

    def __init__(self, more: int | None = None) -> None:
        self.keys, self.counts = np.empty(0, np.uint64), np.empty(0, np.uint32)
        self.more = more or KEYS_MORE
        self.clear()

    def add(self, keys: np.ndarray, counts: np.ndarray | None = None) -> bool:
        until = self.held + len(keys)
        self.keys = _room(self.keys, self.held, until, self.limit)
        self.counts = _room(self.counts, self.held, until, self.limit)
        self.keys[self.held : until] = keys
        self.counts[self.held : until] = 1 if counts is None else counts
        self.held = until
        return self.held >= self.limit

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        """What is left; it holds until more is added."""
        keys, counts = self.keys[: self.held], self.counts[: self.held]
        if (counts == 1).all():
            keys.sort()
        else:
            order = np.argsort(keys)
            keys[:] = keys[order]
            counts[:] = counts[order]
            del order
        heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else keys.astype(int)
        # What is beyond 32 bits is frequent by any measure.
        sums = np.add.reduceat(counts, heads, dtype=np.uint64) if len(keys) else counts
        self.held = len(heads)
        self.limit = self.held + max(self.more, self.held // 4)
        counts[: self.held] = np.minimum(sums, 0xFFFFFFFF)
        del sums
        keys[: self.held] = keys[heads]
        return keys[: self.held], counts[: self.held]

    def clear(self) -> None:
        self.held, self.limit = 0, self.more


_KEYS = pa.schema([("slice", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def _key_slices(keys: np.ndarray, counts: np.ndarray, shift: int) -> Iterator[pa.RecordBatch]:
    """Sorted keys, as differences, by their leading bits."""
    if not len(keys):
        return
    part = (keys >> np.uint64(shift)).astype(np.int64)
    cuts = np.flatnonzero(part[1:] != part[:-1]) + 1
    for number, k, c in zip(part[np.append(0, cuts)], np.split(keys, cuts), np.split(counts, cuts)):
        steps = np.diff(k, prepend=np.uint64(int(number) << shift))
        columns = zip([int(number), _planes(steps), _planes(c)], _KEYS.types)
        yield pa.record_batch([pa.array([x], t) for x, t in columns], schema=_KEYS)


def leading_bits(words: int) -> int:
    """Bits of a fingerprint that tell most of the phrases of so many words and their pairs apart."""
    return min(60, max(16, (2 * words).bit_length() + 4))


def leading_slices(tasks: int) -> int:
    """Leading bits that make several slices for a task, so that tasks have about the same."""
    return (4 * tasks - 1).bit_length()


def maybe_frequent(
    chunks: DataFrame, sizes: tuple[int, ...], least: int, bits: int, lead: int, tasks: int, pairs=None
) -> DataFrame:
    """key: the first `lead` bits of the fingerprints that `least` phrases or more of `sizes` words
    have in common, be they equal or not.

    `pairs` is a broadcast bit map; phrases with a pair that it does not let through are left out.
    """
    shift = lead - min(lead, leading_slices(tasks))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        adder = KeyAdder()
        for batch in batches:
            for lang, body, tail in zip(*batch.columns):
                ranges = Ranges(body.as_py(), lang.as_py(), tail.as_py(), bits)
                for words, first in ranges.chosen(sizes, lead, pairs and pairs.value, None):
                    if adder.add(ranges.keys(first, words, lead)):
                        summed = adder.total()
                        if len(summed[0]) > KEYS_HELD:
                            yield from _key_slices(*summed, shift)
                            adder.clear()
        yield from _key_slices(*adder.total(), shift)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # No two slices have a key in common, so each is sorted alone.
        adders: dict[int, KeyAdder] = {}
        for batch in batches:
            for number, keys, counts in zip(*batch.columns):
                number = number.as_py()
                steps = _from_planes(keys.as_py(), np.uint64)
                keys = np.cumsum(steps, dtype=np.uint64) + np.uint64(number << shift)
                adder = adders.get(number) or adders.setdefault(number, KeyAdder(KEYS_MORE // 8))
                if adder.add(keys, _from_planes(counts.as_py(), np.uint32)):
                    adder.total()
        for adder in adders.values():
            keys, counts = adder.total()
            yield pa.record_batch([pa.array(keys[counts >= least].view(np.int64))], names=["key"])

    sliced = chunks.select("lang", "body", "tail").mapInArrow(
        scan, "slice int, keys binary, counts binary"
    )
    return sliced.repartitionById(tasks, "slice").mapInArrow(merge, "key long")


def counted(
    chunks: DataFrame, longest: int, least: int, bits: int, lead: int, tasks: int, may
) -> DataFrame:
    """Entries of phrases of up to `longest` words whose fingerprint occurs `least` times or more.

    `may` is a broadcast bit map of the phrases that may be frequent. One entry for a fingerprint, its
    check and its size in bytes.
    """
    shift = 64 - leading_slices(tasks)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        adder = Adder()
        for batch in batches:
            for chunk, lang, body, tail in zip(*batch.columns):
                ranges = Ranges(body.as_py(), lang.as_py(), tail.as_py(), bits)
                sizes = tuple(range(1, longest + 1))
                for words, first in ranges.chosen(sizes, lead, may.value, may.value):
                    if adder.add(ranges.entries(chunk.as_py(), first, words)):
                        summed = adder.total()
                        if len(summed) > HELD:
                            yield from _packed(summed, shift)
                            adder.clear()
        yield from _packed(adder.total(), shift)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        adder = Adder()
        for batch in batches:
            for blob in batch.column(1):
                if adder.add(_unpacked(blob.as_py())):
                    adder.total()
        entries = adder.total()
        # A fingerprint is frequent if its occurrences are, whether or not all are one phrase.
        same = np.append(0, np.flatnonzero(entries["fp"][1:] != entries["fp"][:-1]) + 1)
        if len(entries):
            sums = np.add.reduceat(entries["count"].astype(np.int64), same)
            per = np.repeat(sums, np.diff(np.append(same, len(entries))))
            entries = entries[per >= least]
        for at in range(0, len(entries), 1 << 16):
            part = entries[at : at + (1 << 16)]
            columns = [pa.array(part[n].astype(np.int64)) for n, _ in _ENTRY[1:]]
            names = [n for n, _ in _ENTRY[1:]]
            fp = pa.array(part["fp"].view(np.int64))
            yield pa.record_batch([fp, *columns], names=["fp", *names])

    columns = ", ".join(f"{name} long" for name, _ in _ENTRY)
    packed = chunks.select("chunk", "lang", "body", "tail").mapInArrow(scan, _PACKED)
    return packed.repartitionById(tasks, "slice").mapInArrow(merge, columns)


def has_bit(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = mixed(keys) % np.uint64(len(bits) * 64)
    return (bits[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def bit_map(keys: DataFrame, most_bits: int = MOST_BITS) -> np.ndarray:
    """A map with the bit of each key set, `most_bits` long at most. Tasks set the bits of
    their own rows; words of the map that several set are joined before they come here, so what comes
    is bounded by the map."""
    count = keys.count()
    size = min(most_bits, max(1 << 10, 1 << (16 * count).bit_length()))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            at = mixed(own) % np.uint64(size)
            bits = np.uint64(1) << (at & np.uint64(63))
            columns = [(at >> np.uint64(6)).astype(np.int64), bits.view(np.int64)]
            yield pa.record_batch([pa.array(c) for c in columns], names=["at", "bits"])

    placed = keys.select("key").mapInArrow(place, "at long, bits long")
    table = placed.groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(size // 64, np.uint64)
    out[table["at"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
    return out


def texts_at(entries: DataFrame, chunks: DataFrame) -> DataFrame:
    """The entries with `lang`, `phrase` and whether the text is the same at both places.

    The places of a chunk are gathered, at most as many as it has phrases, and meet it in one row.
    """
    places = F.explode(
        F.array(
            F.struct(F.col("first").alias("chunk"), F.col("first_at").alias("at")),
            F.struct(F.col("last").alias("chunk"), F.col("last_at").alias("at")),
        )
    )
    keys = ["fp", "check", "size", "words", "count"]
    asked = entries.select(*keys, places.alias("p")).select(*keys, "p.*")
    lists = asked.groupBy("chunk").agg(*(F.collect_list(c).alias(c) for c in [*keys, "at"]))
    joined = lists.join(chunks.select("chunk", "lang", "body"), "chunk")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                *columns, lang, body = (c[row] for c in batch.columns)
                starts, sizes = (columns[k].values.to_numpy() for k in (5, 2))
                body = body.as_py()
                texts = [body[s : s + n].decode() for s, n in zip(starts, sizes)]
                own = [c.values for c in columns[:5]]
                langs = [lang.as_py()] * len(texts)
                yield pa.record_batch(
                    [*own, pa.array(langs), pa.array(texts)], names=[*keys, "lang", "text"]
                )

    found = joined.select(*keys, "at", "lang", "body").mapInArrow(
        read, ", ".join(f"{k} long" for k in keys) + ", lang string, text string"
    )
    same = (F.min("text") == F.max("text")) & (F.min("lang") == F.max("lang"))
    return found.groupBy(*keys).agg(
        F.min("lang").alias("lang"), F.min("text").alias("phrase"), same.alias("same")
    )


def texts_at(entries: DataFrame, chunks: DataFrame) -> DataFrame:
    """The entries with `lang`, `phrase` and whether the text is the same at the last place.

    Only chunks that a first or last place lies in are joined, each with its own places at once.
    """
    places = F.explode(
        F.array(
            F.struct(F.col("first").alias("chunk"), F.col("first_at").alias("at"), F.lit(0).alias("end")),
            F.struct(F.col("last").alias("chunk"), F.col("last_at").alias("at"), F.lit(1).alias("end")),
        )
    )
    keys = ["fp", "check", "size", "words"]
    asked = entries.select(*keys, "count", places.alias("p")).select(*keys, "count", "p.*")
    joined = asked.join(chunks.select("chunk", "lang", "body"), "chunk")
    read = joined.select(
        *keys,
        "count",
        "lang",
        "end",
        F.expr("decode(substring(body, cast(at + 1 as int), cast(size as int)), 'UTF-8')").alias("text"),
    )
    same = (F.min("text") == F.max("text")) & (F.min("lang") == F.max("lang"))
    return read.groupBy(*keys).agg(
        F.max("count").alias("count"),
        F.min("lang").alias("lang"),
        F.min("text").alias("phrase"),
        same.alias("same"),
    )


def recounted(
    chunks: DataFrame, shared: DataFrame, longest: int, bits: int, block: int = 1 << 20
) -> DataFrame:
    """Counts by text of all phrases whose fingerprint several texts share.

    Their fingerprints are handed out in blocks of a bounded number, one pass over the chunks each.
    """
    spark = chunks.sparkSession
    count = shared.count()
    passes = math.ceil(count / block)
    out = None
    for number in range(passes):
        own = shared.filter(F.pmod(F.xxhash64("fp"), F.lit(passes)) == number)
        fps = np.sort(own.toArrow()["fp"].to_numpy().view(np.uint64))
        broadcast = spark.sparkContext.broadcast(fps)

        def scan(batches, broadcast=broadcast):
            wanted = broadcast.value
            for batch in batches:
                for lang, body, tail in ((x.as_py() for x in row) for row in zip(*batch.columns)):
                    ranges = Ranges(body, lang, tail, bits)
                    found: dict[tuple[int, str], int] = {}
                    for words in range(1, longest + 1):
                        first = ranges.counted(words)
                        fp = ranges.fingerprints(first, words)
                        at = np.searchsorted(wanted, fp)
                        hit = wanted[np.minimum(at, len(wanted) - 1)] == fp
                        for f in first[hit]:
                            text = body[ranges.starts[f] : ranges.ends[f + words - 1]].decode()
                            found[words, text] = found.get((words, text), 0) + 1
                    if found:
                        columns = [[lang] * len(found), [t for _, t in found], [w for w, _ in found]]
                        yield pa.record_batch(
                            [*map(pa.array, columns), pa.array(list(found.values()), pa.int64())],
                            names=["lang", "phrase", "words", "count"],
                        )

        texts = chunks.select("lang", "body", "tail").mapInArrow(
            scan, "lang string, phrase string, words long, count long"
        )
        sums = texts.groupBy("lang", "phrase", "words").agg(F.sum("count").alias("count"))
        out = sums if out is None else out.unionByName(sums)
    return out


def frequent_phrases(
    chunks: DataFrame, longest: int = 4, least: int = 30, bits: int = 64, tasks: int | None = None
) -> DataFrame:
    """lang, phrase, words, count of all phrases of up to `longest` words that occur `least` times."""
    spark = chunks.sparkSession
    size = chunks.agg(F.sum(F.length("body")), F.sum("words")).first()
    tasks = tasks or shuffle_tasks(spark, size[0] or 0, 16 << 20)
    lead = leading_bits(size[1] or 0)
    keys, may = None, None
    for sizes in ((1, 2), tuple(range(3, longest + 1))):
        sizes = tuple(n for n in sizes if n <= longest)
        if sizes:
            own = maybe_frequent(chunks, sizes, least, bits, lead, tasks, may)
            own = settled(own, "maybe-frequent")
            keys = own if keys is None else keys.unionByName(own)
            may = spark.sparkContext.broadcast(bit_map(keys))
    entries = settled(counted(chunks, longest, least, bits, lead, tasks, may), "entries")
    read = settled(texts_at(entries, chunks), "phrases")
    alone = read.filter("same")
    wrong = read.filter("not same").select("fp").distinct()
    names = ["lang", "phrase", "words", "count"]
    if not wrong.isEmpty():
        alone = alone.join(wrong, "fp", "left_anti")
        again = recounted(chunks, wrong, longest, bits)
        return alone.select(names).unionByName(again.select(names)).filter(F.col("count") >= least)
    return alone.select(names).filter(F.col("count") >= least)


def _part(words: Column, start: Column | int, length: Column | int) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(
    docs: DataFrame, text_col: str = "text", group_col: str = "lang", no_group: str = "und",
    longest: int = 4, least: int = 30, covered: int = 80, scale: int = 2_000_000, top: int = 2000,
    bits: int = 64,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: for each language the `top` phrases of 2 to `longest`
    words.

    Letters A-Z are lower-cased, pieces end at `.,;:!?` and line breaks, words are what spaces and
    tabs leave. a is the count of the phrase, which is at least `least`; l and r are those of its two
    parts at the cut with the lowest floor(`scale` * a / (l + r)), which is the score, and n the
    words of the language. A phrase that a longer frequent phrase holds, with `covered` percent of its
    count or more, is left out. Order: score, a (both falling), phrase.

    A null language counts as `no_group`, a null or empty text has no words, repeated rows count as
    often as they come, an empty table gives no rows. Other columns are not read. Texts of any length
    are read whole, also where they are counted in several chunks.
    """
    chunks = settled(chunked(docs, text_col, group_col, no_group, longest), "chunks")
    spark = docs.sparkSession
    with batch_rows(spark, CHUNK_ROWS), read_rows(spark, READ_ROWS):
        phrases = settled(frequent_phrases(chunks, longest, least, bits), "frequent")
    words = F.split("phrase", " ")
    candidates = phrases.filter("words > 1").withColumn("parts", words)
    cuts = candidates.select(
        "lang",
        "phrase",
        F.col("count").alias("a"),
        F.explode(
            F.transform(
                F.sequence(F.lit(1), (F.col("words") - 1).cast("int")),
                lambda k: F.struct(
                    k.alias("k"),
                    _part(F.col("parts"), 1, k).alias("left"),
                    _part(F.col("parts"), k + 1, F.col("words").cast("int") - k).alias("right"),
                ),
            )
        ).alias("cut"),
    ).select("lang", "phrase", "a", "cut.*")
    lefts = phrases.select("lang", F.col("phrase").alias("left"), F.col("count").alias("l"))
    rights = phrases.select("lang", F.col("phrase").alias("right"), F.col("count").alias("r"))
    scaled = F.col("a").cast("decimal(19,0)") * F.lit(scale).cast("decimal(10,0)")
    both = F.col("l").cast("decimal(19,0)") + F.col("r").cast("decimal(19,0)")
    scored = (
        cuts.join(lefts, ["lang", "left"])
        .join(rights, ["lang", "right"])
        .withColumn("score", F.call_function("div", scaled, both))
    )
    lowest = scored.groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("best")
    )
    inner = candidates.filter("words > 2").select(
        "lang",
        F.explode(
            F.flatten(
                F.transform(
                    F.sequence(F.lit(2), (F.col("words") - 1).cast("int")),
                    lambda n: F.transform(
                        F.sequence(F.lit(1), F.col("words").cast("int") - n + 1),
                        lambda i: _part(F.col("parts"), i, n),
                    ),
                )
            )
        ).alias("phrase"),
        F.col("count").alias("longer"),
    )
    holders = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    held = F.col("longer").isNotNull() & (F.lit(100) * F.col("longer") >= F.lit(covered) * F.col("a"))
    left = lowest.join(holders, ["lang", "phrase"], "left").filter(~held)
    order = Window.partitionBy("lang").orderBy(
        F.col("score").desc(), F.col("a").desc(), F.col("phrase")
    )
    ranked = left.select(
        "lang", "phrase", "a", "best.l", "best.r", "best.score"
    ).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    totals = chunks.groupBy("lang").agg(F.sum("words").alias("n"))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
