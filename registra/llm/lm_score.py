"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

Counting. Tokens of the training texts are counted exactly, by partial counts per task and one
grouped aggregation. The most frequent `DICTIONARY` tokens, a bounded number, are broadcast; rarer
tokens of each document meet their count in a join, so the base score is exact for all.

Model. Events are tokens and pairs of neighbouring tokens, each by a 64-bit hash of its own, so every
distinct one of the training texts has its own count however rare it is. The dictionary only
saves hashing. A count c is stored as level 1 + floor(log2 c): the event is
put into the filter once for each level up to its own, and a lookup probes level after
level until one is missing. The filter is made of slices by hash, sized by what they hold, and each
slice is built by the task that its events are shuffled to.

Scoring. p(word | before) = (c(before, word) + MU p(word)) / (c(before) + MU), with p(word) =
(c(word) + 1) / (tokens + distinct tokens + 1), all counts from their levels. A filter larger
than `filter_bytes` is broadcast in several shards, one after the other; each pass notes the levels
of the events in its shard, and the scores are worked out from the levels at the end.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registra.llm.common import Shared, most_frequent, settled, shuffle_tasks
from registra.session import work_folder
from registra.sources.filesystem import drop_folder

DICTIONARY = 1 << 18
LONGEST = 64  # bytes of a token in the dictionary
MU = 200.0
BITS_PER_ENTRY = 8
PROBES = 4
FILTER_BYTES = 256 << 20
EVENTS_PER_SLICE = 1_000_000
CHUNK = 1_000_000  # events that are sorted at once in a task
GROUP_CHARS = 1_000_000  # characters of texts that are scored at once
KEPT_TOKENS = 250_000  # distinct tokens that a task counts before it passes them on
HELD_OUT = 2  # remainder of the documents that are not learnt from
FOLDS = 7

_MIX_A = 0xBF58476D1CE4E5B9
_MIX_B = 0x94D049BB133111EB
_STEP = 0x9E3779B97F4A7C15
_END = 0xD6E8FEB86659FD93  # in place of a hash, the end of a text


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def held_out(id_col: str):
    """Documents of one fold by the checksum of their id; one without an id is learnt from."""
    fold = F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == HELD_OUT
    return F.coalesce(fold, F.lit(False))


# --- counting -----------------------------------------------------------------------------------


def _token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def flush() -> pa.RecordBatch:
        return pa.record_batch(
            [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())],
            names=["token", "n"],
        )

    for batch in batches:
        for value in batch.column(0):
            counts.update(tokens(value.as_py()))
            if len(counts) > KEPT_TOKENS:
                yield flush()
                counts.clear()
    yield flush()


def count_tokens(texts: DataFrame) -> DataFrame:
    """(token, c) of one column of texts."""
    found = texts.mapInArrow(_token_counts, "token binary, n long")
    return settled(found.groupBy("token").agg(F.sum("n").alias("c")), "token_counts")


class Vocabulary:
    """The most frequent tokens with their counts and hashes, and the hash of any token."""

    def __init__(self, found: list[tuple[bytes, int]]):
        found = sorted(found, key=lambda x: (-x[1], x[0]))
        self.index = {t: i for i, (t, _) in enumerate(found)}
        self.counts = np.array([c for _, c in found], np.int64)
        self.hashes = np.array([xxhash.xxh3_64_intdigest(t) for t, _ in found], np.uint64)

    def look_up(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Places in the dictionary (-1: not there), and hashes."""
        get = self.index.get
        at = np.array([get(t, -1) for t in found], np.int64)
        hashes = self.hashes[at] if len(self.hashes) else np.zeros(len(at), np.uint64)
        outside = np.flatnonzero(at < 0)
        hashes[outside] = [xxhash.xxh3_64_intdigest(found[i]) for i in outside.tolist()]
        return at, hashes


def frequent(counts: DataFrame, limit: int) -> list[tuple[bytes, int]]:
    """The most frequent tokens, `limit` at most."""
    found = most_frequent(counts.filter(F.octet_length("token") <= LONGEST), "c", limit).toArrow()
    return list(
        zip(found.column("token").to_pylist(), found.column("c").to_pylist(), strict=True)
    )


# --- the filter ---------------------------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ x >> np.uint64(30)
    x = x * np.uint64(_MIX_A)
    x = x ^ x >> np.uint64(27)
    x = x * np.uint64(_MIX_B)
    return x ^ x >> np.uint64(31)


def slice_of(keys: np.ndarray, slices: int) -> np.ndarray:
    return (mix(keys + np.uint64(_STEP)) >> np.uint64(40)).astype(np.int64) % slices


def places(keys: np.ndarray, level: int, sizes: np.ndarray | np.uint64) -> Iterator[np.ndarray]:
    """Bits of one level, probe by probe."""
    h = mix(keys + np.uint64(level * _STEP & (1 << 64) - 1))
    first, step = h & np.uint64(0xFFFFFFFF), h >> np.uint64(32) | np.uint64(1)
    for i in range(PROBES):
        yield (first + np.uint64(i) * step) % sizes


def levels_of(counts: np.ndarray) -> np.ndarray:
    return np.frexp(counts.astype("f8"))[1]


def typical(levels: np.ndarray) -> np.ndarray:
    """The middle of the counts that share a level; no count at level 0."""
    power = np.exp2(levels.astype("f8"))
    return np.where(levels > 0, (power / 2 + power - 1) / 2, 0.0)


def build_slice(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Bits, packed in bytes, of one slice."""
    levels = levels_of(counts)
    size = max(64, -(-int(levels.sum()) * BITS_PER_ENTRY // 8) * 8)
    bits = np.zeros(size, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        keys, levels = keys[levels >= level], levels[levels >= level]
        for at in places(keys, level, np.uint64(size)):
            bits[at] = True
    return np.packbits(bits, bitorder="little")


class Shard:
    """Some slices of the filter, side by side."""

    def __init__(self, slices: int, parts: dict[int, bytes]):
        self.arrays = self.of(slices, parts)

    @classmethod
    def made(cls, arrays: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Shard:
        shard = cls.__new__(cls)
        shard.arrays = arrays
        return shard

    @staticmethod
    def of(slices: int, parts: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sizes and starts of the slices in bits, and all bits: arrays that travel as they are."""
        sizes = np.zeros(slices, np.int64)
        starts = np.zeros(slices, np.int64)
        at = 0
        for number, data in sorted(parts.items()):
            sizes[number], starts[number] = len(data) * 8, at * 8
            at += len(data)
        return sizes, starts, np.frombuffer(b"".join(d for _, d in sorted(parts.items())), np.uint8)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Level of each event in this shard; 0 for events that are not in it."""
        all_sizes, all_starts, packed = self.arrays
        out = np.zeros(len(keys), np.uint8)
        number = slice_of(keys, len(all_sizes))
        alive = np.flatnonzero(all_sizes[number] > 0)
        level = 0
        while len(alive) and level < 64:
            level += 1
            sizes = all_sizes[number[alive]].astype(np.uint64)
            starts = all_starts[number[alive]]
            hit = np.ones(len(alive), bool)
            for at in places(keys[alive], level, sizes):
                bit = starts + at.astype(np.int64)
                hit &= (packed[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)
            alive = alive[hit]
            out[alive] = level
        return out


def single(hashes: np.ndarray) -> np.ndarray:
    return mix(hashes)


def pair(before: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return mix(mix(before ^ np.uint64(_STEP)) + hashes)


class Texts:
    """Several texts as one sequence of tokens, each text closed by an end, so what stands
    before a text's first token is an end too."""

    def __init__(self, vocabulary: Vocabulary, texts: list[str | None]):
        self.found = [tokens(t) for t in texts]
        sizes = np.fromiter(map(len, self.found), np.int64, len(texts))
        self.ends = np.cumsum(sizes + 1) - 1
        self.starts = self.ends - sizes
        length = int(self.ends[-1]) + 1
        inner = np.ones(length, bool)
        inner[self.ends] = False
        self.at = np.full(length, -1, np.int64)
        self.hashes = np.full(length, _END, np.uint64)
        self.at[inner], self.hashes[inner] = vocabulary.look_up(
            [t for found in self.found for t in found]
        )
        self.before = np.concatenate([self.hashes[-1:], self.hashes[:-1]])

    def sums(self, values: np.ndarray) -> list:
        return np.add.reduceat(values, self.starts).tolist()


def groups(column: pa.Array, chars: int = GROUP_CHARS) -> Iterator[tuple[int, list[str | None]]]:
    """Texts of a column a few at a time, with the place of the first."""
    start, size, texts = 0, 0, []
    for i, value in enumerate(column):
        text = value.as_py()
        texts.append(text)
        size += len(text or "")
        if size > chars:
            yield start, texts
            start, size, texts = i + 1, 0, []
    if texts:
        yield start, texts


def _events(shared, slices: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(waiting), return_counts=True)
            number = slice_of(keys, slices)
            order = np.argsort(number, kind="stable")
            cuts = np.searchsorted(number[order], np.arange(slices + 1))
            keys, counts = keys[order], counts[order].astype("<u4")
            rows = [
                {"slice": s, "keys": keys[a:b].tobytes(), "counts": counts[a:b].tobytes()}
                for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))
                if a < b
            ]
            return pa.RecordBatch.from_pylist(rows, schema=_EVENTS)

        for batch in batches:
            for _, some in groups(batch.column(0)):
                texts = Texts(shared.value, some)
                waiting += [single(texts.hashes), pair(texts.before, texts.hashes)]
                size += 2 * len(texts.hashes)
                if size > CHUNK:
                    yield flush()
                    waiting.clear()
                    size = 0
        if waiting:
            yield flush()

    return run


_EVENTS = pa.schema([("slice", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def _building(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices arrive one after the other; only one is held."""
    now, parts = None, []

    def built() -> pa.RecordBatch:
        keys = np.concatenate([np.frombuffer(k, np.uint64) for k, _ in parts])
        counts = np.concatenate([np.frombuffer(c, "<u4") for _, c in parts])
        parts.clear()
        order = np.argsort(keys)
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        counts = np.add.reduceat(counts[order], first, dtype=np.int64)
        del order
        keys = keys[first]
        del first
        bits = build_slice(keys, counts)
        return pa.record_batch(
            [pa.array([now], pa.int32()), pa.array([bits.tobytes()], pa.binary())],
            names=["slice", "bits"],
        )

    for batch in batches:
        for number, keys, counts in zip(*batch.columns, strict=True):
            if now is not None and number.as_py() != now:
                yield built()
            now = number.as_py()
            parts.append((keys.as_py(), counts.as_py()))
    if parts:
        yield built()


def build_filter(
    texts: DataFrame, vocabulary, events: int, per_slice: int = EVENTS_PER_SLICE
) -> tuple[DataFrame, int]:
    """(slice, bits) of all events of one column of texts, and the number of slices."""
    slices = max(8, math.ceil(events / per_slice))
    tasks = min(slices, max(shuffle_tasks(texts.sparkSession), slices // 4))
    found = (
        texts.mapInArrow(_events(vocabulary, slices), "slice int, keys binary, counts binary")
        .repartition(tasks, "slice")
        .sortWithinPartitions("slice")
        .mapInArrow(_building, "slice int, bits binary")
    )
    return settled(found, "filter"), slices


def shards(table: DataFrame, slices: int, limit: int) -> Iterator[tuple]:
    """The filter in shards of at most `limit` bytes (a slice is never cut), fetched one by one."""
    sizes = table.select("slice", F.length("bits").alias("n")).orderBy("slice").collect()
    group: list[int] = []
    total = 0
    groups = [group]
    for number, n in sizes:
        if group and total + n > limit:
            group, total = [], 0
            groups.append(group)
        group.append(number)
        total += n
    for group in groups:
        low, high = (group[0], group[-1]) if group else (0, -1)
        rows = table.filter(F.col("slice").between(low, high)).toArrow().to_batches()
        yield Shard.of(slices, {n.as_py(): b.as_py() for r in rows for n, b in zip(*r.columns)})


# --- scoring ------------------------------------------------------------------------------------


def log_probability(own: np.ndarray, both: np.ndarray, n: int, v: int) -> np.ndarray:
    """Of each token, from its level and that of the pair with the token before it; `n` tokens were
    learnt from, `v` of them distinct."""
    alone = (typical(own) + 1) / (n + v + 1)
    pairs = typical(both)
    before = np.concatenate([[typical(own[-1:])[0]], typical(own[:-1])])
    return np.log10((pairs + MU * alone) / (np.maximum(before, pairs) + MU))


_TAIL = pa.list_(pa.struct([("token", pa.binary()), ("n", pa.int64())]))
_SCORED = (
    "n_tokens long, n_known long, base double, score double, "
    "tail array<struct<token:binary,n:long>>"
)


def _look_up(shard: Shard, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Levels of the tokens and of the pairs; equal ones are probed once."""
    used, at = np.unique(single(texts.hashes), return_inverse=True)
    own = shard.levels(used)[at]
    used, at = np.unique(pair(texts.before, texts.hashes), return_inverse=True)
    return own, shard.levels(used)[at]


def _scorer(shared, shard, n: int, v: int, carried: bool):
    """Scores, from a shard to probe or from levels noted before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.append(np.log10(shared.value.counts + 1.0), 0.0)
        for batch in batches:
            for start, some in groups(batch.column(3)):
                texts = Texts(shared.value, some)
                if carried:
                    noted = batch.column(4).slice(start, len(some)).to_pylist()
                    pairs = [np.frombuffer(x, np.uint8).reshape(2, -1) for x in noted]
                    own, both = np.concatenate(pairs, axis=1)
                else:
                    own, both = _look_up(Shard.made(shard.value), texts)
                rare: list[list[dict]] = []
                outside = np.flatnonzero(texts.at < 0)
                cuts = np.searchsorted(outside, texts.starts).tolist()
                for i, found in enumerate(texts.found):
                    until = np.searchsorted(outside, texts.ends[i])
                    places = (outside[cuts[i] : until] - texts.starts[i]).tolist()
                    tail = Counter([found[k] for k in places])
                    rare.append([{"token": t, "n": k} for t, k in tail.items()])
                score = log_probability(own, both, n, v)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(c.slice(start, len(some)) for c in batch.columns[:3]),
                        pa.array(texts.ends - texts.starts + 1, pa.int64()),
                        pa.array(texts.sums((texts.at >= 0).astype(np.int64)), pa.int64()),
                        pa.array(texts.sums(counts[texts.at]), pa.float64()),
                        pa.array(texts.sums(score), pa.float64()),
                        pa.array(rare, _TAIL),
                    ],
                    names=["row", "id", "held_out", "n_tokens", "n_known", "base", "score", "tail"],
                )

    return run


def _noting(shared, shard):
    """One pass of several: the highest levels so far, as bytes (tokens, then pairs)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, some in groups(batch.column(3)):
                texts = Texts(shared.value, some)
                levels = np.stack(_look_up(Shard.made(shard.value), texts))
                out = []
                old = batch.column(4).slice(start, len(some)).to_pylist()
                for a, b, noted in zip(texts.starts, texts.ends + 1, old, strict=True):
                    now = levels[:, a:b]
                    if noted is not None:
                        now = np.maximum(now, np.frombuffer(noted, np.uint8).reshape(2, -1))
                    out.append(now.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        *(c.slice(start, len(some)) for c in batch.columns[:4]),
                        pa.array(out, pa.binary()),
                    ],
                    names=["row", "id", "held_out", "text", "levels"],
                )

    return run


def score_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    dictionary: int = DICTIONARY,
    filter_bytes: int = FILTER_BYTES,
    per_slice: int = EVENTS_PER_SLICE,
) -> DataFrame:
    """Per row of `docs`: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are words without ASCII white space, A-Z lower-cased, and one end per text; a null
    text has the end alone. base_score is the add-one log10 probability from exact counts, score
    that of the model. Rows that repeat an id are scored each. With nothing to learn from, every
    token is unknown. Other columns are not read.
    """
    spark = docs.sparkSession
    context = spark.sparkContext
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        held_out(id_col).alias("held_out"),
        F.col(text_col).alias("text"),
    )
    train = docs.filter(~held_out(id_col)).select(text_col)
    counts = count_tokens(train)
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    ends = train.count()
    n, v = total + ends, distinct + (ends > 0)

    shared = Shared(spark, Vocabulary(frequent(counts, dictionary)))
    table, slices = build_filter(train, shared, 2 * n, per_slice)
    parts = shards(table, slices, filter_bytes)
    first, second = next(parts), next(parts, None)
    names = f"row long, id {kind}, held_out boolean"
    if second is None:
        scorer = _scorer(shared, context.broadcast(first), n, v, False)
        scored = rows.mapInArrow(scorer, f"{names}, {_SCORED}")
    else:
        noted = rows.withColumn("levels", F.lit(None).cast("binary"))
        before = None
        for part in chain((first, second), parts):
            probed = context.broadcast(part)
            passed = noted.mapInArrow(_noting(shared, probed), f"{names}, text string, levels binary")
            folder = work_folder(spark, "levels")
            passed.write.parquet(folder)
            noted = spark.read.schema(passed.schema).parquet(folder)
            # One pass lies on disk at a time, and one shard in the executors.
            probed.unpersist()
            if before:
                drop_folder(before)
            before = folder
        scored = noted.mapInArrow(_scorer(shared, None, n, v, True), f"{names}, {_SCORED}")
    scored = settled(scored, "lm_scores")

    # Tokens outside the dictionary: one row per document and token, joined with their counts.
    tail = scored.select("row", F.explode("tail").alias("t")).select("row", "t.token", "t.n")
    rare = (
        tail.join(counts, "token")
        .groupBy("row")
        .agg(
            F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("rare_base"),
            F.sum("n").alias("rare_known"),
        )
    )
    lost = math.log10(n + v + 1)
    end_known = 1 if ends else 0
    end_base = math.log10(ends + 1)
    return scored.drop("tail").join(rare, "row", "left").select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("n_known") + end_known + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (
            F.col("base") + end_base + F.coalesce("rare_base", F.lit(0.0))
            - F.col("n_tokens") * F.lit(lost)
        ).alias("base_score"),
        "score",
    )
