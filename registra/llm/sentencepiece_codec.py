"""SentencePiece encoding as a relational lattice, and decoding.

The segmentation is the best-scoring one over the model's pieces (Viterbi), with byte pieces for
characters that no piece has.

Units. A text is cut wherever no piece has the two neighbouring characters inside, so no piece
spans a cut and the best path of a text is that of its units, one after the other. Most cuts lie
before spaces and around signs. Every distinct unit of the corpus is encoded once:

* each unit is exploded into its substrings up to the longest piece's length;
* substrings meet the piece table in an equi-join; the table is the model's vocabulary, whose size
  is fixed, so it is broadcast; a character without a piece stays as an edge of its own;
* edges are grouped by unit, sorted by end and start, and folded: the state has the best scores
  of the last few places and the best last edge of each place, in blocks, so that a fold
  over a very long unit stays linear; a second fold walks back from the end.

Texts. A task numbers the words of its texts and writes, per chunk of its documents, the texts as
numbers of words and, in a file beside them, the chunk's words as numbers of units. The task
that fills a chunk's ids in reads that file, so texts are never shuffled, and a chunk has a bounded
number of words. Ids of units reach the tasks as a sorted table of hashes if its measured size is
within `TABLE_BYTES` and no two hashes are equal; beyond that the chunks' units are joined with the
encoded ones, and the answers are written by chunk.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from itertools import pairwise
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registra.llm.common import Shared, settled, shuffle_tasks
from registra.session import qualify, work_folder
from registra.sources.filesystem import resolve

SPACE = "▁"
NORMAL, UNKNOWN, USER, BYTE = 1, 2, 4, 6
PENALTY = 10.0  # of a character without a piece, below the worst score
CHUNK_WORDS = 400_000  # distinct words of a chunk
TABLE_BYTES = 128 << 20  # of the units' ids that are broadcast
TASKS_PER_CHUNK = 2
BLOCK = 256
CODES = 1 << 21  # above all code points, so that they fit below zero
ROWS = 512  # texts that are passed on at once
MOST_CHARS = 6000  # of pieces, for a table of their pairs
WORDS_AT_ONCE = 50_000  # words that are looked at as arrays
TOLD_CHUNKS = 2  # chunks whose units all tasks are told


class Model:
    """Pieces, scores and kinds of a SentencePiece model file without text normalisation."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as stream:
            proto.ParseFromString(stream.read())
        spec = proto.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces:
            raise ValueError("the model rewrites texts; only the identity is supported")
        if not spec.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("the model must write spaces before words")
        self.prefix = spec.add_dummy_prefix
        self.pieces = [p.piece for p in proto.pieces]
        self.scores = [p.score for p in proto.pieces]
        self.kinds = [p.type for p in proto.pieces]
        self.unknown = self.kinds.index(UNKNOWN)
        self.bytes = [-1] * 256
        for i, (piece, kind) in enumerate(zip(self.pieces, self.kinds, strict=True)):
            if kind == BYTE:
                self.bytes[int(piece[1:-1], 16)] = i
        if min(self.bytes) < 0:
            self.bytes = []
        normal = [s for s, k in zip(self.scores, self.kinds, strict=True) if k == NORMAL]
        self.best, self.worst = max(normal), min(normal) - PENALTY
        used = [p for p, k in zip(self.pieces, self.kinds, strict=True) if k in (NORMAL, USER)]
        self.longest = max(map(len, used))
        self.joined = {a + b for p in used for a, b in zip(p, p[1:])}
        # Words can be cut off first if no piece goes over a space or a line end.
        self.by_space = not any(b == SPACE != a for a, b in self.joined)
        self.by_line = not any("\n" in ab for ab in self.joined)

    def table(self, spark: SparkSession) -> DataFrame:
        """Pieces that a text can have: piece, id, score."""
        rows = [
            (p, i, len(p.encode()) * self.best - 0.1 if k == USER else float(s))
            for i, (p, s, k) in enumerate(
                zip(self.pieces, self.scores, self.kinds, strict=True)
            )
            if k in (NORMAL, USER)
        ]
        piece, number, score = zip(*rows, strict=True)
        columns = [pa.array(piece), pa.array(number, pa.int32()), pa.array(score, pa.float64())]
        return spark.createDataFrame(
            pa.Table.from_arrays(columns, names=["piece", "id", "score"])
        )


class Cutter:
    """Words of a text, and units of a word."""

    def __init__(self, model: Model):
        self.joined, self.prefix = model.joined, model.prefix
        self.by_space, self.by_line = model.by_space, model.by_line
        self.spaced = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        # Characters that pieces join, as numbers, and which pairs of numbers are joined.
        chars = sorted({c for pair in self.joined for c in pair})
        self.pairs = None
        if len(chars) <= MOST_CHARS:
            places = {c: i for i, c in enumerate(chars, 1)}
            self.number = np.zeros(max(map(ord, chars), default=0) + 2, np.uint16)
            self.number[list(map(ord, chars))] = np.arange(1, len(chars) + 1)
            self.pairs = np.zeros((len(chars) + 1, len(chars) + 1), bool)
            for first, second in self.joined:
                self.pairs[places[first], places[second]] = True

    def words(self, text: str) -> list[str]:
        """Pieces never cross from one word to the next."""
        out: list[str] = []
        for i, line in enumerate(self.lines(text)):
            out += ["\n"] * (i > 0)
            out += self.of_line(line, i == 0)
        return out

    def lines(self, text: str) -> list[str]:
        return (text.split("\n") if self.by_line else [text]) if text else []

    def of_line(self, line: str, first: bool) -> list[str]:
        """Words of one line; before the first of a text the model may put a space."""
        lead = SPACE if first and self.prefix else ""
        parts = line.split(" ")
        if self.plain(line, parts):
            out = [lead + parts[0], *(SPACE + p for p in parts[1:])]
            return out if out[0] else out[1:]
        whole = lead + line.replace(" ", SPACE)
        return self.spaced.findall(whole) if self.by_space else [whole]

    def plain(self, line: str, parts: list[str]) -> bool:
        """Whether the line's parts between spaces are its words."""
        return self.by_space and SPACE not in line and ("" not in parts or len(parts) == 1)

    def units(self, word: str) -> list[str]:
        held = list(map(self.joined.__contains__, map(add, word, word[1:])))
        if all(held):
            return [word]
        cuts = [0, *(i for i, h in enumerate(held, 1) if not h), len(word)]
        return [word[a:b] for a, b in pairwise(cuts)]


    def cut(self, words: list[str]) -> tuple[list[str], np.ndarray]:
        """Units of all words one after the other, and how many each word has."""
        if self.pairs is None:
            parts = [self.units(w) if w else [] for w in words]
            return [u for own in parts for u in own], np.fromiter(map(len, parts), "<u4", len(parts))
        text = "".join(words)
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        known = self.number[np.minimum(codes, len(self.number) - 1)]
        last = np.zeros(len(codes) + 1, bool)  # whether a unit ends before a character
        last[1:-1] = ~self.pairs[known[:-1], known[1:]]
        last[ends] = True
        cuts = np.flatnonzero(last[1:]) + 1
        units = [text[a:b] for a, b in pairwise([0, *cuts.tolist()])]
        return units, np.diff(np.searchsorted(cuts, ends, "right"), prepend=0).astype("<u4")


# --- the lattice --------------------------------------------------------------------------------


def edges(units: DataFrame, model: Model) -> DataFrame:
    """Substrings of each unit (h1, h2, unit) that are pieces, and single characters that are none.

    A long unit is cut into blocks, each with the characters that a piece from its last place may
    need, so a row's size is bounded; the unit itself rides on its very first substring only.
    """
    step, reach = F.lit(BLOCK), F.lit(BLOCK + model.longest)
    blocks = units.select(
        "h1", "h2", "unit", F.explode(F.sequence(F.lit(0), F.length("unit") - 1, step)).alias("from")
    ).select(
        "h1",
        "h2",
        "from",
        F.substring("unit", F.col("from") + 1, reach).alias("block"),
        F.when(F.col("from") == 0, F.col("unit")).alias("unit"),
    )
    starts = blocks.select(
        "*", F.explode(F.sequence(F.lit(0), F.least(step, F.length("block")) - 1)).alias("at")
    ).withColumn("unit", F.when(F.col("at") == 0, F.col("unit")))
    left = F.length("block") - F.col("at")
    substrings = starts.select(
        "*", F.explode(F.sequence(F.lit(1), F.least(F.lit(model.longest), left))).alias("length")
    ).select(
        "h1",
        "h2",
        F.when(F.col("length") == 1, F.col("unit")).alias("unit"),
        (F.col("from") + F.col("at")).alias("start"),
        "length",
        F.substring("block", F.col("at") + 1, F.col("length")).alias("piece"),
    )
    pieces = F.broadcast(model.table(units.sparkSession))  # the vocabulary, of a fixed size
    return substrings.join(pieces, "piece", "left").filter(
        F.col("id").isNotNull() | (F.col("length") == 1)
    ).select(
        "h1",
        "h2",
        "unit",
        F.struct(
            (F.col("start") + F.col("length")).alias("end"),
            "start",
            edge_code(F.col("start"), F.coalesce("id", -1 - F.ascii("piece"))).alias("code"),
            F.coalesce("score", F.lit(model.worst)).alias("score"),
        ).alias("edge"),
    )


def _blocks(array: Column) -> Column:
    starts = F.sequence(F.lit(1), F.greatest(F.size(array), F.lit(1)), F.lit(BLOCK))
    return F.transform(starts, lambda i: F.slice(array, i, F.lit(BLOCK)))


def _in_blocks(blocks: Column, state: Column, step) -> Column:
    """Fold over an array in blocks, for the list that its steps append to: as appending copies,
    the list starts anew in each block. Gives the last state and the whole list."""
    none, no_blocks = F.array().cast("array<bigint>"), F.array().cast("array<array<bigint>>")

    def block(outer: Column, items: Column) -> Column:
        start = F.struct(outer["state"].alias("state"), none.alias("list"))
        # The inner fold goes into a one-element array, so that it is worked out once.
        inner = F.transform(
            F.array(F.aggregate(items, start, step)),
            lambda r: F.struct(
                r["state"].alias("state"),
                F.concat(outer["blocks"], F.array(r["list"])).alias("blocks"),
            ),
        )
        return F.get(inner, F.lit(0))

    start = F.struct(state.alias("state"), no_blocks.alias("blocks"))
    return F.aggregate(
        blocks, start, block,
        lambda o: F.struct(o["state"].alias("state"), F.flatten(o["blocks"]).alias("list")),
    )


def viterbi(found: Column) -> Column:
    """Best last edge of each place from 1 on, from edges sorted by end and start.

    An edge is its start and its id in one number (see `edge_code`). Of equal scores the edge that
    starts first wins. The state is the best score of each place so far and the best last edges.
    """

    def step(acc: Column, edge: Column) -> Column:
        score = F.get(acc["best"], edge["start"]) + edge["score"]
        further = F.struct(
            F.concat(acc["best"], F.array(score)).alias("best"),
            F.concat(acc["last"], F.array(edge["code"])).alias("last"),
        )
        better = F.struct(
            F.concat(F.slice(acc["best"], F.lit(1), edge["end"]), F.array(score)).alias("best"),
            F.concat(
                F.slice(acc["last"], F.lit(1), edge["end"] - 1), F.array(edge["code"])
            ).alias("last"),
        )
        return (
            F.when(edge["end"] >= F.size(acc["best"]), further)
            .when(score > F.element_at(acc["best"], -1), better)
            .otherwise(acc)
        )

    start = F.struct(
        F.array(F.lit(0.0)).alias("best"), F.array().cast("array<bigint>").alias("last")
    )
    return F.aggregate(found, start, step, lambda s: s["last"])


def viterbi_of_long(found: Column, longest: int) -> Column:
    """The same for a unit of any length: only the scores that an edge can reach are kept, and the
    last edges of places that are done lie in blocks."""

    def step(acc: Column, edge: Column) -> Column:
        s = acc["state"]
        seen = F.size(s["best"])
        score = F.get(s["best"], seen - 1 - (s["at"] - edge["start"])) + edge["score"]

        def state(at: Column, kept: Column) -> Column:
            return F.struct(
                at.alias("at"),
                F.concat(kept, F.array(score)).alias("best"),
                edge["code"].alias("last"),
            ).alias("state")

        window = F.slice(s["best"], F.greatest(seen - longest + 1, F.lit(1)), F.lit(longest))
        further = F.struct(
            state(edge["end"], window), F.concat(acc["list"], F.array(s["last"])).alias("list")
        )
        same = F.slice(s["best"], F.lit(1), seen - 1)
        better = F.struct(state(s["at"], same), acc["list"].alias("list"))
        return (
            F.when(edge["end"] > s["at"], further)
            .when(score > F.element_at(s["best"], -1), better)
            .otherwise(acc)
        )

    start = F.struct(
        F.lit(0).alias("at"),
        F.array(F.lit(0.0)).alias("best"),
        F.lit(-1).cast("bigint").alias("last"),
    )
    # The list begins with the place before the unit, and the last place is still in the state.
    folded = F.transform(
        F.array(_in_blocks(_blocks(found), start, step)),
        lambda r: F.concat(F.slice(r["list"], F.lit(2), F.size(r["list"])), F.array(r["state"]["last"])),
    )
    return F.get(folded, F.lit(0))


def edge_code(start: Column, number: Column) -> Column:
    """An edge's start and its piece's id in one number; a character without a piece has -1 less
    its code point for an id."""
    return F.shiftleft(start.cast("bigint"), 32) + number + CODES


def code_start(code: Column) -> Column:
    return F.shiftright(code, 32).cast("int")


def code_id(code: Column) -> Column:
    return code.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int") - CODES


def utf8(point: Column) -> Column:
    """Bytes of one code point."""

    def tail(shift: int) -> Column:
        return F.shiftright(point, shift).bitwiseAND(F.lit(0x3F)) + 0x80

    return (
        F.when(point < 0x80, F.array(point))
        .when(point < 0x800, F.array(F.shiftright(point, 6) + 0xC0, tail(0)))
        .when(point < 0x10000, F.array(F.shiftright(point, 12) + 0xE0, tail(6), tail(0)))
        .otherwise(F.array(F.shiftright(point, 18) + 0xF0, tail(12), tail(6), tail(0)))
    )


def places(last: Column) -> Column:
    """The places of a unit from the last to the first, with their best last edges."""
    return F.reverse(F.transform(last, lambda c, i: F.struct((i + 1).alias("at"), c.alias("code"))))


def walk_back(found: Column) -> Column:
    """Edges of the best path, the last one first, from the places of a unit."""

    def step(acc: Column, place: Column) -> Column:
        hit = F.struct(
            code_start(place["code"]).alias("state"),
            F.concat(acc["list"], F.array(place["code"])).alias("list"),
        )
        return F.when(acc["state"] == place["at"], hit).otherwise(acc)

    end = F.size(found)
    start = F.struct(end.alias("state"), F.array().cast("array<bigint>").alias("list"))
    short = F.aggregate(found, start, step, lambda s: s["list"])
    long = _in_blocks(_blocks(found), end, step)["list"]
    return F.when(end <= BLOCK, short).otherwise(long)


def encode_units(units: DataFrame, model: Model, tasks: int = 0) -> DataFrame:
    """(unit, ids) of the distinct units, ids in the order of the text.

    Units are dealt by a hash once, and everything up to their ids stays with them. Edges are
    grouped by 96 bits of hash; should two units ever share them, the job fails.
    """
    tasks = max(tasks, shuffle_tasks(units.sparkSession))
    dealt = units.select(F.xxhash64("unit").alias("h1"), "unit").repartition(tasks, "h1").distinct()
    distinct = dealt.select("h1", F.hash("unit").alias("h2"), "unit")
    one = F.when(F.min("unit") == F.max("unit"), F.max("unit")).otherwise(
        F.raise_error(F.lit("two units have the same hashes")).cast("string")
    )
    found = F.col("edges")
    best = F.when(F.size(found) <= BLOCK, viterbi(found)).otherwise(
        viterbi_of_long(found, model.longest)
    )
    paths = (
        edges(distinct, model)
        .groupBy("h1", "h2")
        .agg(one.alias("unit"), F.sort_array(F.collect_list("edge")).alias("edges"))
        .select("unit", best.alias("last"))
        .select("unit", places(F.col("last")).alias("places"))
        .select("unit", F.reverse(walk_back(F.col("places"))).alias("path"))
    )
    if model.bytes:
        table = F.split(F.lit(",".join(map(str, model.bytes))), ",").cast("array<int>")

    def in_pieces(edge: Column) -> Column:
        number = code_id(edge)
        if not model.bytes:
            return F.array(F.when(number < 0, F.lit(model.unknown)).otherwise(number))
        in_bytes = F.transform(utf8(-1 - number), lambda b: F.get(table, b))
        return F.when(number < 0, in_bytes).otherwise(F.array(number))

    # Most units have a piece for each character.
    plain = ~F.exists("path", lambda e: code_id(e) < 0)
    ids = F.when(plain, F.transform("path", code_id)).otherwise(
        F.flatten(F.transform("path", in_pieces))
    )
    return settled(paths.select("unit", ids.alias("ids")), "encoded_units")


# --- texts --------------------------------------------------------------------------------------


class Chunk:
    """Texts of one task as numbers of words, and words as numbers of units."""

    def __init__(self, cutter: Cutter):
        self.cutter = cutter
        self.after_space: dict[str, int] = {}  # words, without the space before them
        self.bare: dict[str, int] = {}
        self.size = 0

    def numbers(self, text: str) -> np.ndarray:
        """The words of a text as numbers."""
        cutter, spaced, out = self.cutter, self.after_space, []
        for i, line in enumerate(cutter.lines(text)):
            parts = line.split(" ")
            if i == 0 or not cutter.plain(line, parts):
                self._bare(["\n"] * (i > 0) + cutter.of_line(line, i == 0), out)
                continue
            lead, rest = parts[0], parts[1:]
            self._bare(("\n", lead) if lead else ("\n",), out)
            found = list(map(spaced.get, rest))
            if None in found:
                for k, number in enumerate(found):
                    if number is None:
                        word = rest[k]
                        number = spaced.get(word)  # again, if it is in this line twice
                        if number is None:
                            spaced[word] = number = self.size
                            self.size += 1
                        found[k] = number
            out += found
        return np.array(out, "<u4")

    def _bare(self, words: list[str], out: list[int]) -> None:
        bare = self.bare
        for word in words:
            number = bare.get(word)
            if number is None:
                bare[word] = number = self.size
                self.size += 1
            out.append(number)

    def composition(self) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The chunk's units, the units of all words one after the other, and how many each has."""
        words = [""] * self.size
        for word, number in self.bare.items():
            words[number] = word
        for word, number in self.after_space.items():
            words[number] = SPACE + word
        units: dict[str, int] = {}
        flat: list[int] = []
        sizes = [np.zeros(0, "<u4")]
        for start in range(0, len(words), WORDS_AT_ONCE):
            own, counts = self.cutter.cut(words[start : start + WORDS_AT_ONCE])
            flat += [units.setdefault(u, len(units)) for u in own]
            sizes.append(counts)
        return list(units), np.array(flat, "<u4"), np.concatenate(sizes)


class Lists:
    """Lists of numbers, one after the other."""

    def __init__(self, flat: np.ndarray, sizes: np.ndarray):
        self.flat, self.sizes = flat, sizes.astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists with some numbers one after the other, and the size of each."""
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        # Each place of the result: the start of its list, and how far into the list it is.
        kind = np.int32 if max(total, len(self.flat)) < 1 << 31 else np.int64
        at = np.repeat((self.starts[numbers] - (ends - sizes)).astype(kind), sizes)
        at += np.arange(total, dtype=kind)
        return self.flat[at], sizes


def _planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers byte by byte, which packs better."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _whole(planes: bytes) -> np.ndarray:
    return np.frombuffer(planes, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


def _write_words(folder: str, chunk: int, units: list[str], flat: np.ndarray, sizes: np.ndarray):
    """A chunk's file: written under a name of its own, and renamed when whole."""
    store, base, _ = resolve(folder)
    store.create_dir(base, recursive=True)
    own = f"{base}/.{chunk}.{TaskContext.get().taskAttemptId()}"
    columns = {
        "units": pa.array([units], pa.list_(pa.string())),
        "flat": pa.array([_planes(flat)], pa.binary()),
        "sizes": pa.array([_planes(sizes)], pa.binary()),
    }
    with store.open_output_stream(own) as stream:
        pq.write_table(pa.table(columns), stream, compression="zstd", use_dictionary=False)
    store.move(own, f"{base}/{chunk}")


def read_words(folder: str, chunk: int) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
    store, base, _ = resolve(folder)
    with store.open_input_file(f"{base}/{chunk}") as stream:
        row = pq.read_table(stream).to_batches()[0]
    units, flat, sizes = (row.column(c)[0] for c in ("units", "flat", "sizes"))
    return units.values, _whole(flat.as_py()), _whole(sizes.as_py())


def _drafts(shared, folder: str):
    """A row per text; the words of a chunk of texts go to a file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        chunk, number, task = Chunk(shared.value), 0, TaskContext.get().partitionId()

        def close(kind: pa.DataType) -> pa.RecordBatch:
            """A row without texts, which says that the chunk's file is there."""
            _write_words(folder, task << 32 | number, *chunk.composition())
            kinds = pa.list_(kind), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()
            return pa.RecordBatch.from_arrays(
                [pa.array([task << 32 | number], pa.int64()), *(pa.nulls(1, k) for k in kinds)],
                names=["chunk", "ids", "sources", "sizes", "draft"],
            )

        used = False
        for batch in batches:
            for start in range(0, len(batch), ROWS):
                some = batch.slice(start, ROWS)
                texts = [x.as_py() or "" for x in some.column(1)]
                drafts = [chunk.numbers(t) for t in texts]
                used = True
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([task << 32 | number], pa.int64()),
                        pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), some.column(0)),
                        pa.array([list(map(check, texts))], pa.list_(pa.int64())),
                        pa.array([list(map(len, drafts))], pa.list_(pa.int32())),
                        pa.array([packer.compress(_planes(np.concatenate(drafts)))], pa.binary()),
                    ],
                    names=["chunk", "ids", "sources", "sizes", "draft"],
                )
                if chunk.size > CHUNK_WORDS:
                    yield close(some.column(0).type)
                    chunk, number, used = Chunk(shared.value), number + 1, False
        if used:
            yield close(some.column(0).type)

    return run


def check(text: str) -> int:
    """Checksum of a text as decoding gives it: the sign that stands for a space is one."""
    return zlib.crc32(text.replace(SPACE, " ").encode("utf-8", "surrogatepass"))


def _chunk_units(folder: str, told=None, told_by: list[int] | None = None):
    """The units of chunks. Those of the chunks `told_by` are told all tasks, one list for each, and
    a chunk leaves out what a list before it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = told.value if told else []
        known = set().union(*lists)
        for batch in batches:
            for chunk in batch.column(0).to_pylist():
                units = read_words(folder, chunk)[0].to_pylist()
                if told and chunk in told_by:
                    before = set().union(*lists[: told_by.index(chunk)])
                    units = [u for u in units if u not in before]
                elif known:
                    units = [u for u in units if u not in known]
                yield pa.record_batch(
                    [
                        pa.array([chunk] * len(units), pa.int64()),
                        pa.array(np.arange(len(units), dtype="i4")),
                        pa.array(units, pa.string()),
                    ],
                    names=["chunk", "pos", "unit"],
                )

    return run


def _small(numbers: np.ndarray) -> np.ndarray:
    """Numbers from 0 on in the least bytes that hold the largest, as every executor gets them."""
    return numbers.astype(np.min_scalar_type(int(numbers.max(initial=0))))


class Table:
    """Ids of units by the hash of the unit."""

    def __init__(self, hashes: np.ndarray, sizes: np.ndarray, flat: np.ndarray):
        self.hashes, self.sizes, self.flat = hashes, sizes, flat

    @classmethod
    def sorted(cls, found: pa.Table) -> Table:
        hashes = found.column("hash").to_numpy()
        order = np.argsort(hashes)
        lists = found.column("ids").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        lists = lists.take(pa.array(order))
        sizes = pc.list_value_length(lists).to_numpy()
        return cls(hashes[order], _small(sizes), _small(lists.flatten().to_numpy()))

    def exact(self) -> bool:
        return bool((self.hashes[1:] != self.hashes[:-1]).all())

    def of(self, units: pa.StringArray) -> Lists:
        seeded = [xxhash.xxh64_intdigest(u, 42) for u in units.cast(pa.binary()).to_pylist()]
        wanted = np.array(seeded, np.uint64).view(np.int64)
        return Lists(*Lists(self.flat, self.sizes).gather(np.searchsorted(self.hashes, wanted)))


def _joined_ids(folder: str, chunk: int) -> Lists:
    """Ids of a chunk's units, from the files that the join has written."""
    store, path, _ = resolve(f"{folder}/chunk={chunk}")
    rows: list[tuple[int, list[int]]] = []
    for file in store.get_file_info(fs.FileSelector(path)):
        if file.path.endswith(".parquet"):
            with store.open_input_file(file.path) as stream:
                found = pq.read_table(stream, columns=["pos", "ids"])
            rows += zip(found.column("pos").to_pylist(), found.column("ids").to_pylist(), strict=True)
    lists = [ids for _, ids in sorted(rows)]
    return Lists(
        np.array([i for ids in lists for i in ids], "i4"), np.array(list(map(len, lists)), np.int64)
    )


def _filled(words: str, table, answers: str | None):
    """Ids of all texts, from the broadcast table or else from the folder of answers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        now, known = None, None
        for batch in batches:
            for i, chunk in enumerate(batch.column(0).to_pylist()):
                if chunk != now:
                    units, flat, sizes = read_words(words, chunk)
                    found = Table(*table.value).of(units) if answers is None else _joined_ids(answers, chunk)
                    ids, lengths = found.gather(flat)
                    ends = np.concatenate([[0], np.cumsum(lengths)])
                    last = np.cumsum(sizes.astype(np.int64))
                    known = Lists(ids, np.diff(ends[last], prepend=0))
                    now = chunk
                drafts = _whole(unpack(batch.column(4)[i].as_py()))
                cuts = np.cumsum([0, *batch.column(3)[i].as_py()])
                ids, lengths = known.gather(drafts)
                offsets = np.concatenate([[0], np.cumsum(lengths)])[cuts]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(1)[i].values,
                        pa.ListArray.from_arrays(
                            pa.array(offsets, pa.int32()), pa.array(ids.astype("i4", copy=False))
                        ),
                        batch.column(2)[i].values,
                    ],
                    names=["id", "ids", "source"],
                )

    return run


def encode_documents(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    table_bytes: int = TABLE_BYTES,
    then: Callable | None = None,
    columns: str = "ids array<int>, source long",
) -> DataFrame:
    """Per row of `docs`: id, ids (array of ints), source (checksum of the text).

    Null texts are empty and have no ids. Rows that repeat an id are encoded each, in no order.
    An empty table gives none. Other columns are not read. `then` is a function of batches that
    takes the result further in the same worker, to id and the named columns.
    """
    spark = docs.sparkSession
    model = Model(path)
    shared = Shared(spark, Cutter(model))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    words = qualify(spark, work_folder(spark, "words"))
    written = settled(
        rows.mapInArrow(
            _drafts(shared, words),
            f"chunk long, ids array<{kind}>, sources array<long>, sizes array<int>, draft binary",
        ),
        "drafts",
    )
    closed = written.filter("draft is null").select("chunk")
    columns_listed = "chunk long, pos int, unit string"
    listed = closed.mapInArrow(_chunk_units(words), columns_listed)
    # Most units of a chunk are in most chunks. Those of a few chunks, of which there is a bounded
    # number, are told to all tasks, so that the others pass on only what they have beside them.
    count = closed.count()
    fresh = listed
    if count > TOLD_CHUNKS:
        some = [r[0] for r in closed.orderBy("chunk").limit(TOLD_CHUNKS).collect()]
        told = spark.sparkContext.broadcast([read_words(words, c)[0].to_pylist() for c in some])
        fresh = closed.mapInArrow(_chunk_units(words, told, some), columns_listed)
    encoded = encode_units(fresh.select("unit"), model, TASKS_PER_CHUNK * count)
    n, ids = encoded.agg(F.count("*"), F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()
    table = answers = None
    if 12 * n + 4 * ids <= table_bytes:  # so the table and what is collected are bounded
        found = Table.sorted(encoded.select(F.xxhash64("unit").alias("hash"), "ids").toArrow())
        if found.exact():
            table = spark.sparkContext.broadcast((found.hashes, found.sizes, found.flat))
    if table is None:
        answers = work_folder(spark, "answers")
        listed.join(encoded, "unit").select("chunk", "pos", "ids").repartition(
            "chunk"
        ).sortWithinPartitions("chunk").write.partitionBy("chunk").parquet(answers)
        answers = qualify(spark, answers)
    fill = _filled(words, table, answers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return then(fill(batches)) if then else fill(batches)

    drafts = written.filter("draft is not null")
    return drafts.mapInArrow(run, f"id {kind}, {columns}").withColumnRenamed("id", id_col)


_SPACE_BYTES = SPACE.encode()
DECODED_AT_ONCE = 64  # texts whose bytes are gathered at once


class Decoder:
    """Texts from ids."""

    def __init__(self, model: Model):
        self.prefix = model.prefix
        self.table = []
        for piece, kind in zip(model.pieces, model.kinds, strict=True):
            if kind == BYTE:
                self.table.append(bytes([int(piece[1:-1], 16)]))
            elif kind == UNKNOWN:
                self.table.append(" \u2047 ".encode())
            else:
                self.table.append(piece.encode() if kind in (NORMAL, USER) else b"")

        sizes = np.fromiter(map(len, self.table), np.int64, len(self.table))
        self.lists = Lists(np.frombuffer(b"".join(self.table), np.uint8), sizes)

    def decode(self, ids: list[int]) -> str:
        return next(self.decoded(pa.array([ids], pa.list_(pa.int32())))).decode("utf-8", "replace")

    def decoded(self, lists: pa.ListArray) -> Iterator[bytes]:
        """Texts of lists of ids, as the bytes of their pieces with spaces for the sign."""
        for start in range(0, len(lists), DECODED_AT_ONCE):
            some = lists.slice(start, DECODED_AT_ONCE)
            found, sizes = self.lists.gather(some.flatten().to_numpy())
            data = found.tobytes()
            ends = np.concatenate([[0], np.cumsum(sizes)])
            cuts = np.concatenate([[0], np.cumsum(some.value_lengths().fill_null(0).to_numpy())])
            for a, b in pairwise(ends[cuts].tolist()):
                text = data[a:b].replace(_SPACE_BYTES, b" ")
                yield text[1:] if self.prefix and text.startswith(b" ") else text


_DECODED = "ids array<int>, text string, round_trip boolean"


def _decoding(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(shared.value.decoded(batch.column(1)))
            # Bytes that are no text cannot have the checksum of one.
            sources = batch.column(2).to_pylist()
            same = [zlib.crc32(t) == s for t, s in zip(found, sources, strict=True)]
            texts = [t.decode("utf-8", "replace") for t in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(texts, pa.string()), pa.array(same, pa.bool_())],
                names=["id", "ids", "text", "round_trip"],
            )

    return run


def decode_documents(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """Per row: id, ids, text, and round_trip: whether the text is the one that was encoded."""
    shared = Shared(encoded.sparkSession, Decoder(Model(path)))
    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, "ids", "source").mapInArrow(
        _decoding(shared), f"id {kind}, {_DECODED}"
    ).withColumnRenamed("id", id_col)


def encode_and_decode(docs: DataFrame, path: str, id_col: str = "doc_id", **options) -> DataFrame:
    """Both, in one worker: id, ids, text as decoded, and round_trip."""
    shared = Shared(docs.sparkSession, Decoder(Model(path)))
    return encode_documents(
        docs, path, id_col, then=_decoding(shared), columns=_DECODED, **options
    )


def codec_report(docs: DataFrame, path: str, id_col: str = "doc_id", **options) -> DataFrame:
    """Encode and decode: id, n_pieces, ids_crc32 (ids as 32 bits each), round_trip."""
    shared = Shared(docs.sparkSession, Decoder(Model(path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, checks, same = [], [], []
            texts = shared.value.decoded(batch.column(1))
            sources = batch.column(2).to_pylist()
            for ids, text, source in zip(batch.column(1), texts, sources, strict=True):
                found = ids.values.to_numpy()
                sizes.append(len(found))
                checks.append(zlib.crc32(found.astype("<u4").tobytes()))
                same.append(zlib.crc32(text) == source)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(checks, pa.int64()),
                    pa.array(same, pa.bool_()),
                ],
                names=["id", "n_pieces", "ids_crc32", "round_trip"],
            )

    columns = "n_pieces long, ids_crc32 long, round_trip boolean"
    return encode_documents(docs, path, id_col, then=run, columns=columns, **options)
