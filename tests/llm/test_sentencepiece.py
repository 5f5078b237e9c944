import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from registra.llm import sentencepiece_codec
from registra.llm.sentencepiece_codec import (
    Cutter,
    Decoder,
    Model,
    codec_report,
    decode_documents,
    encode_documents,
    encode_units,
)
from tests.llm.cases import ROWS, by_id, edge_docs, texts

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return Model(PATH)


@pytest.fixture(scope="module")
def lattice():
    """The library's own lattice over the same pieces."""
    proto = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as stream:
        proto.ParseFromString(stream.read())
    proto.trainer_spec.model_type = 1
    return sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())


def best_path(model, text):
    """Plain Viterbi over a whole text, as ids."""
    if not text:
        return []
    text = ("▁" if model.prefix else "") + text.replace(" ", "▁")
    score = {p: (s, i) for i, (p, s, k) in enumerate(zip(model.pieces, model.scores, model.kinds)) if k == 1}
    best, back = [0.0], [None]
    for end in range(1, len(text) + 1):
        found = None
        for start in range(max(0, end - model.longest), end):
            s, i = score.get(text[start:end], (model.worst, -1) if end - start == 1 else (None, None))
            if s is not None and (found is None or best[start] + s > found[0]):
                found = best[start] + s, start, i
        best.append(found[0])
        back.append(found[1:])
    out, end = [], len(text)
    while end:
        start, i = back[end]
        out.append([i] if i >= 0 else [model.bytes[b] for b in text[start:end].encode()])
        end = start
    return [i for ids in out[::-1] for i in ids]


def test_whole_table_against_a_plain_viterbi(spark, model):
    sf = "/root/testdata/sf0.001"
    got = by_id(codec_report(spark.read.parquet(f"{sf}/documents.parquet"), PATH))
    for row in pq.read_table(f"{sf}/documents.parquet").to_pylist():
        ids = np.array(best_path(model, row["text"]), "<u4")
        r = got[row["doc_id"]]
        assert (r.n_pieces, r.ids_crc32, r.round_trip) == (len(ids), zlib.crc32(ids.tobytes()), True)


def test_path_scores_as_the_library_lattice(lattice, model):
    rnd, alphabet = random.Random(3), "abcdeth ing,."
    for _ in range(200):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 14))).strip() or "a"
        if "  " in text:
            continue
        ours = best_path(model, text)
        theirs = lattice.nbest_encode(text, nbest_size=2)[0]
        assert sum(model.scores[i] for i in ours) == sum(model.scores[i] for i in theirs)


@pytest.mark.parametrize("words", [400_000, 0])
def test_chunks_of_any_size(spark, model, words, monkeypatch):
    monkeypatch.setattr(sentencepiece_codec, "CHUNK_WORDS", words)
    monkeypatch.setattr(sentencepiece_codec, "ROWS", 1 if words == 0 else 512)
    values = {1: "the cat and the  dog\n\n é漢\U0001f600 ▁x", 2: " lead\ntrail ", 3: "\n", 4: " ", 5: "zqxjk " * 300,
              6: "the the the cat"}
    for limit in (1 << 20, 0):
        got = by_id(encode_documents(texts(spark, values), PATH, table_bytes=limit))
        assert {i: got[i].ids for i in values} == {i: best_path(model, t) for i, t in values.items()}
    for i, text in values.items():
        assert got[i].ids == best_path(model, text), text


def test_cuts_never_go_through_a_piece(model):
    cutter, rnd = Cutter(model), random.Random(6)
    for _ in range(2000):
        text = "".join(rnd.choice(["a", "th", " ", "  ", "\n", ".", "é", "▁", "\t", "\r"]) for _ in range(rnd.randint(0, 9)))
        words = cutter.words(text)
        assert "".join(words) == (("▁" + text.replace(" ", "▁")) if text else "")
        found = [u for w in words for u in cutter.units(w)]
        assert "".join(found) == "".join(words)
        assert all(a[-1] + b[0] not in model.joined for a, b in zip(found, found[1:]))


def test_very_long_unit_takes_blocks(spark, model):
    unit = "".join(random.Random(7).choice("thean") for _ in range(5000))
    rows = spark.createDataFrame(pa.table({"unit": [unit, "▁the"]}))
    got = {r.unit: r.ids for r in encode_units(rows, model).collect()}
    bare = Model(PATH)
    bare.prefix = False
    assert got[unit] == best_path(bare, unit) and got["▁the"] == best_path(model, "the")


def test_decoding_agrees_with_the_library(model):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    decoder, rnd = Decoder(model), random.Random(5)
    for _ in range(300):
        ids = [rnd.randrange(260, 32000) for _ in range(rnd.randint(0, 12))]
        assert decoder.decode(ids) == library.decode(ids)


def test_edges(spark, model):
    encoded = encode_documents(edge_docs(spark), PATH)
    rows = decode_documents(encoded, PATH).collect()
    assert len(rows) == len(ROWS) and all(r.round_trip for r in rows)
    assert {tuple(r.ids) for r in rows if r.doc_id in (3, 4)} == {()}
    assert sorted(r.text for r in rows) == sorted((t or "").replace("▁", " ") for _, t, _ in ROWS)
    assert decode_documents(encode_documents(edge_docs(spark, []), PATH), PATH).collect() == []


def test_words_cut_together_are_cut_as_alone(model):
    cutter = Cutter(model)
    rng = random.Random(8)
    chars = "abcdeétsZ ▁漢字\U0001f600\n\x00.,1ßñ"
    words = ["", "a", *("".join(rng.choice(chars) for _ in range(rng.randint(0, 6))) for _ in range(5000))]
    words += ["the", "▁thing", "▁über", ""] * 20
    alone = [cutter.units(w) if w else [] for w in words]
    for pairs in (cutter.pairs, None):
        cutter.pairs = pairs
        for some, own in ((words, alone), (words[2:3], alone[2:3]), ([], []), ([""], [[]])):
            units, sizes = cutter.cut(some)
            assert units == [u for part in own for u in part]
            assert sizes.tolist() == [len(part) for part in own]
