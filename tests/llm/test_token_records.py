import io
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from registra.llm import token_records
from registra.llm.token_records import (
    Encoder,
    masked,
    read_file,
    read_index,
    read_record,
    read_token_records,
    record,
    shuffled_sequences,
    write_token_records,
)
from tests.llm.cases import edge_docs

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


PARTS = [" ", "\n", "a", "b", " the", "'s", "é", "1", "23", ".", "!?", "\t", "  ", " ", "<|endoftext|>", "漢",
         "x\n", "\r\n", "Ü", "²", " \n", "don't", "\x1c", "　", "\x85", "word.", " word,", "###", ""]


@pytest.mark.parametrize("cached", [500_000, 3])
def test_encoder_agrees_with_the_library(library, monkeypatch, cached):
    monkeypatch.setattr(token_records, "CACHED", cached)
    encoder, rnd = Encoder(PATH), random.Random(4)
    for _ in range(300):
        texts = ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 9))) for _ in range(40)]
        got = [np.frombuffer(x, "<u2").tolist() for x in encoder.encode(texts)]
        assert got == [ids(library, t) for t in texts]


def test_whole_table(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    manifest = write_token_records(docs, PATH, files=3)
    got = {r.id: r for r in read_token_records(spark, manifest).collect()}
    start = 0
    for row in sorted(pq.read_table(f"{SF}/documents.parquet").to_pylist(), key=lambda r: r["doc_id"]):
        own = [*ids(library, row["text"]), 0]
        crc = zlib.crc32(np.array(own, "<u4").tobytes())
        assert tuple(got[row["doc_id"]])[1:] == (start, len(own), crc)
        start += len(own)
    files = [r.file for r in manifest.orderBy("part").collect()]
    order = [doc_id for f in files for doc_id, _ in read_file(f)]
    assert order == sorted(order) and len(order) == docs.count()
    index = read_index(files[0])
    assert index[:, 1].tolist() == [len(x) for _, x in read_file(files[0])]


def test_shuffled_reads_have_all_records(spark):
    manifest = write_token_records(spark.read.parquet(f"{SF}/documents.parquet"), PATH, files=2)
    straight = {r.id: r.n_tokens for r in read_token_records(spark, manifest).collect()}
    first = [(r.id, len(r.ids)) for r in shuffled_sequences(spark, manifest, 1).collect()]
    second = [(r.id, len(r.ids)) for r in shuffled_sequences(spark, manifest, 2).collect()]
    assert dict(first) == straight == dict(second) and first != second


def test_records_and_damage():
    framed = record(7, b"\x01\x00") + record(None, b"")
    stream = io.BytesIO(framed)
    assert read_record(stream) == (7, b"\x01\x00")
    assert read_record(stream) == (None, b"") and read_record(stream) is None
    for at in range(len(record(7, b"\x01\x00"))):
        broken = bytearray(framed)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            read_record(io.BytesIO(bytes(broken)))
    assert masked(b"") == 0xA282EAD8


def test_edges(spark, library):
    manifest = write_token_records(edge_docs(spark), PATH)
    got = read_token_records(spark, manifest).orderBy("start").collect()
    assert [r.id for r in got] == [None, None, 1, 2, 2, 3, 4, 5, 6, 7, 8, 9]
    assert [r.n_tokens for r in got if r.id in (3, 4)] == [1, 1]
    nothing = write_token_records(edge_docs(spark, []), PATH)
    assert read_token_records(spark, nothing).collect() == []
    assert shuffled_sequences(spark, nothing, 1).collect() == []
