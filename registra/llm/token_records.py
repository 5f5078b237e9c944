"""Token ids as files of length-delimited records, with a separate index for shuffled reads.

A data file is a header (magic, bytes per id) and records. A record is the length of its body
(8 bytes), a masked checksum of the length, the body, and a masked checksum of the body. The body
is a flag and 8 bytes for the document's id, and the token ids in little-endian order. The
index beside it has one entry of 16 bytes per record: where it starts, and how many ids it has.
The checksum is CRC-32, rotated and offset so that a checksum stored in data that is checked
again cannot match by itself.

Documents are dealt by ranges of their ids, so files in the order of their numbers hold ascending
ids. Files are written under a name of their own per attempt and renamed when whole, so a task
that is run again after a lost executor replaces its file by an equal one.
"""

from __future__ import annotations

import io
import random
import struct
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registra.llm.common import settled, shuffle_tasks, worker_state
from registra.session import work_folder
from registra.sources.filesystem import READ_BUFFER, resolve

MAGIC = b"RGTOKENS"
HEADER, LENGTH, CHECK, KEY, ENTRY = "<8sB", "<Q", "<I", "<Bq", "<QQ"
CACHED = 500_000  # words per Python worker, after a space or not
SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
JOINED = 2000  # new words that the library gets at once
SHARD_ROWS = 256


def masked(data: bytes) -> int:
    check = zlib.crc32(data)
    return ((check >> 15 | check << 17) + 0xA282EAD8) & 0xFFFFFFFF


class Encoder:
    """Ids of whole texts, from the library, with what it has said about words remembered.

    A byte-level tokenizer that splits words before a single space never makes a piece across
    such a space or a single line end, nor between a letter or digit and the signs after it. So a
    text whose white space is of that kind is a sequence of words and the signs that trail a letter or
    digit, and the library is asked once for each. After any other character signs stay
    with their word. Any other text (other or repeated white space, special tokens
    written out) goes to the library as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.width = 2 if size <= 1 << 16 else 4
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.first: dict[str, bytes] = {}
        self.after_space: dict[str, bytes] = {}
        self.signs: dict[str, bytes] = {"": b""}
        self.line_end = self._encode(["\n"])[0]
        self.starts = {mark: np.zeros(size, bool) for mark in " \n"}
        for piece, number in self.tokenizer.get_vocab().items():
            self.starts[" "][number] = piece.startswith("Ġ")  # how vocabularies write a space
            self.starts["\n"][number] = piece == "Ċ"  # and a line end

    @classmethod
    def of(cls, path: str) -> Encoder:
        kept = worker_state().setdefault("encoders", {})
        if path not in kept:
            kept[path] = cls(path)
        return kept[path]

    def _encode(self, texts: list[str]) -> list[bytes]:
        kind = f"<u{self.width}"
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, kind).tobytes() for x in found]

    def _learn(self, known: dict[str, bytes], words: set[str], lead: str) -> dict[str, bytes]:
        """Ids of new words: remembered while there is room, and given back."""
        new = [w for w in words if w not in known and w.split() == [w]]
        said: dict[str, bytes] = {}
        for at in range(0, len(new), JOINED):
            said.update(self._joined(new[at : at + JOINED], lead))
        if len(known) + len(said) <= CACHED:
            known.update(said)
        return said

    def _joined(self, words: list[str], lead: str) -> Iterator[tuple[str, bytes]]:
        """Words and their ids, encoded as one text with a space or a line end before each."""
        mark = lead or "\n"
        ids = self.tokenizer.encode_batch_fast(
            [mark + mark.join(words)], add_special_tokens=False
        )[0].ids
        found = np.array(ids, f"<u{self.width}")
        cuts = np.flatnonzero(self.starts[mark][found])
        if len(cuts) != len(words):  # a word has a line end or special token in it
            return zip(words, self._encode([lead + w for w in words]), strict=True)
        data = found.tobytes()
        ends = [*(cuts[1:] * self.width).tolist(), len(data)]
        starts = ((cuts + (not lead)) * self.width).tolist()
        return zip(words, (data[a:b] for a, b in zip(starts, ends, strict=True)), strict=True)

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = [b"" if not t else None for t in texts]
        # Per text: ids, or a word, its signs and whether a space is before, if not known yet.
        drafts: dict[int, list[bytes | tuple[str, str, bool]]] = {}
        new_first, new_after, new_signs = set(), set(), set()
        first, after, signs = self.first.get, self.after_space.get, self.signs.get
        for at, text in enumerate(texts):
            if not text or any(s in text for s in self.special):
                continue
            draft = []
            for line in text.split("\n"):
                parts = line.split(" ")
                found = list(map(after, parts))
                found[0] = first(parts[0])
                if None in found:
                    for i, ids in enumerate(found):
                        if ids is None:
                            chunk = parts[i]
                            word = chunk.rstrip(SIGNS)
                            if not word[-1:].isalnum():  # other signs go on over these
                                word = chunk
                            tail = chunk[len(word) :]
                            head = after(word) if i else first(word)
                            end = signs(tail)
                            if head is not None and end is not None:
                                found[i] = ids = head + end
                                if i and len(self.after_space) < CACHED:
                                    self.after_space[chunk] = ids
                            else:
                                found[i] = word, tail, i > 0
                                (new_after if i else new_first).add(word)
                                new_signs.add(tail)
                draft.append(self.line_end)
                draft += found
            drafts[at] = draft
        heads = self._learn(self.first, new_first, "")
        spaced = self._learn(self.after_space, new_after, " ")
        ends = self._learn(self.signs, new_signs, "") | self.signs

        def known(word: str, tail: str, after_space: bool) -> bytes:
            new, old = (spaced, self.after_space) if after_space else (heads, self.first)
            return (new.get(word) or old[word]) + ends[tail]

        for at, draft in drafts.items():
            try:
                out[at] = b"".join([x if type(x) is bytes else known(*x) for x in draft[1:]])
            except KeyError:  # white space that the library must see in its text
                pass
        whole = [at for at, ids in enumerate(out) if ids is None]
        for at, ids in zip(whole, self._encode([texts[at] for at in whole]), strict=True):
            out[at] = ids
        return out


def record(doc_id: int | None, ids: bytes) -> bytes:
    body = struct.pack(KEY, doc_id is not None, doc_id or 0) + ids
    length = struct.pack(LENGTH, len(body))
    return b"".join((length, struct.pack(CHECK, masked(length)), body, struct.pack(CHECK, masked(body))))


def read_record(stream: io.BufferedReader) -> tuple[int | None, bytes] | None:
    """The next record's document and ids, both checksums verified; None at the end."""
    length = stream.read(struct.calcsize(LENGTH))
    if not length:
        return None
    check = stream.read(struct.calcsize(CHECK))
    if len(check) < struct.calcsize(CHECK) or struct.unpack(CHECK, check)[0] != masked(length):
        raise ValueError("a record's length is damaged")
    size = struct.unpack(LENGTH, length)[0]
    body = stream.read(size)
    check = stream.read(struct.calcsize(CHECK))
    if len(body) < size or len(check) < struct.calcsize(CHECK) or struct.unpack(CHECK, check)[0] != masked(body):
        raise ValueError("a record's body is damaged")
    known, doc_id = struct.unpack_from(KEY, body)
    return (doc_id if known else None), body[struct.calcsize(KEY) :]


def _open(uri: str) -> tuple[io.BufferedReader, int]:
    store, path, _ = resolve(uri)
    stream = io.BufferedReader(store.open_input_file(path), READ_BUFFER)
    magic, width = struct.unpack(HEADER, stream.read(struct.calcsize(HEADER)))
    if magic != MAGIC:
        raise ValueError(f"{uri} is no file of token records")
    return stream, width


def read_file(uri: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """Documents and ids of one file, in the order written."""
    stream, width = _open(uri)
    with stream:
        while (found := read_record(stream)) is not None:
            yield found[0], np.frombuffer(found[1], f"<u{width}")


def read_index(uri: str) -> np.ndarray:
    """Offsets and numbers of ids of a data file's records, one row each."""
    store, path, _ = resolve(uri + ".index")
    with store.open_input_file(path) as stream:
        return np.frombuffer(stream.read(), "<u8").reshape(-1, 2)


def read_shuffled(uri: str, seed: int) -> Iterator[tuple[int | None, np.ndarray]]:
    """The same records in a random order that the seed fixes, through the index."""
    offsets = read_index(uri)[:, 0].tolist()
    random.Random(seed).shuffle(offsets)
    stream, width = _open(uri)
    with stream:
        for offset in offsets:
            stream.seek(offset)
            doc_id, ids = read_record(stream)
            yield doc_id, np.frombuffer(ids, f"<u{width}")


def _writer(folder: str, path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path)
        end = end_id.to_bytes(encoder.width, "little")
        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}.tokens"
        store, base, _ = resolve(folder)
        store.create_dir(base, recursive=True)
        own = f"{base}/.{name}.{task.taskAttemptId()}"
        docs = tokens = 0
        at = struct.calcsize(HEADER)
        with store.open_output_stream(own) as data, store.open_output_stream(own + ".i") as index:
            data.write(struct.pack(HEADER, MAGIC, encoder.width))
            for batch in batches:
                for start in range(0, len(batch), SHARD_ROWS):
                    part = batch.slice(start, SHARD_ROWS)
                    texts = [x.as_py() or "" for x in part.column(1)]
                    for doc_id, ids in zip(
                        part.column(0).to_pylist(), encoder.encode(texts), strict=True
                    ):
                        framed = record(doc_id, ids + end)
                        n = len(ids) // encoder.width + 1
                        data.write(framed)
                        index.write(struct.pack(ENTRY, at, n))
                        at += len(framed)
                        docs += 1
                        tokens += n
        store.move(own, f"{base}/{name}")
        store.move(own + ".i", f"{base}/{name}.index")
        row = {"part": task.partitionId(), "file": f"{folder}/{name}", "docs": docs,
               "tokens": tokens}
        yield pa.RecordBatch.from_pylist([row], _MANIFEST)

    return run


_MANIFEST = pa.schema(
    [("part", pa.int32()), ("file", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())]
)


def write_token_records(
    docs: DataFrame,
    tokenizer: str,
    folder: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 0,
    files: int | None = None,
) -> DataFrame:
    """Encode whole texts, append `end_id`, write them in ascending order of id.

    Gives the manifest: part, file, docs, tokens per file. Null texts are empty and have the end
    id alone; rows without an id come first; rows that repeat an id lie side by side, ordered by
    text. An empty table gives files without records or no file at all. Other columns are not read.
    """
    spark = docs.sparkSession
    folder = folder or work_folder(spark, "tokens")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    dealt = rows.repartitionByRange(files or shuffle_tasks(spark), "id").sortWithinPartitions(
        "id", "text"
    )
    kind = "part int, file string, docs long, tokens long"
    return settled(dealt.mapInArrow(_writer(folder, tokenizer, end_id), kind), "manifest")


def read_token_records(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Documents back from their files: id, start, n_tokens, ids_crc32 (of ids as 32 bits each).

    `start` counts the ids of all files and records before. Only one row per file is collected.
    """
    files = sorted(
        (r.part, r.file, r.tokens) for r in manifest.filter("docs > 0").collect()
    )
    starts = [0, *accumulate(t for _, _, t in files)]
    shared = spark.sparkContext.broadcast(
        [(f, s) for (_, f, _), s in zip(files, starts, strict=False)]
    )
    names = ["id", "start", "n_tokens", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else [()] * len(names)
            return pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=names)

        for batch in batches:
            for number in batch.column(0).to_pylist():
                file, start = shared.value[number]
                rows: list[tuple] = []
                for doc_id, ids in read_file(file):
                    check = zlib.crc32(ids.astype("<u4").tobytes())
                    rows.append((doc_id, start, len(ids), check))
                    start += len(ids)
                    if len(rows) == SHARD_ROWS:
                        yield flush(rows)
                        rows = []
                yield flush(rows)

    kind = "id long, start long, n_tokens long, ids_crc32 long"
    return spark.range(0, len(files), 1, max(1, len(files))).mapInArrow(run, kind)


def shuffled_sequences(spark: SparkSession, manifest: DataFrame, seed: int) -> DataFrame:
    """Id and token ids of all records, files and records in an order that the seed fixes."""
    files = sorted((r.part, r.file) for r in manifest.filter("docs > 0").collect())
    random.Random(seed).shuffle(files)
    shared = spark.sparkContext.broadcast([f for _, f in files])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column(0).to_pylist():
                for doc_id, ids in read_shuffled(shared.value[number], seed + number):
                    yield pa.record_batch(
                        [pa.array([doc_id], pa.int64()), pa.array([ids.astype("i4")])],
                        names=["id", "ids"],
                    )

    return spark.range(0, len(files), 1, max(1, len(files))).mapInArrow(
        run, "id long, ids array<int>"
    )
