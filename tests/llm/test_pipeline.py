import public_tokenizers
import pyarrow.parquet as pq

import corpus_pipeline
from registra.llm import catalogue
from registra.llm.common import settled
from registra.llm.sentencepiece_codec import Decoder, Model
from tests.llm.cases import edge_docs
from tests.llm.test_decontaminate import plain as hits
from tests.llm.test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"


def normal(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()]
    (_, identify), (_, exact), (_, near), (_, clean), (_, encode) = corpus_pipeline.STAGES
    now = settled(identify(spark, docs, SF), "t")
    assert now.schema == docs.schema and now.count() == docs.count()

    rows = {r.doc_id: r.text for r in now.collect()}
    last = {}
    for i in sorted(rows):
        last[normal(rows[i])] = i
    now = settled(exact(spark, now, SF), "t")
    assert now.columns == docs.columns and {r.doc_id for r in now.collect()} == set(last.values())

    prints = {i: plain_fingerprint(rows[i], 3) for i in sorted(last.values())}
    stay = {i for i, root in plain_components(prints).items() if i == root}
    now = settled(near(spark, now, SF), "t")
    assert now.columns == docs.columns and {r.doc_id for r in now.collect()} == stay

    def bad(text):
        n, hit, _, _ = hits(text, bench, 13)
        return hit > 0 and 20 * hit >= n

    stay = {i for i in stay if not bad(rows[i])}
    now = settled(clean(spark, now, SF), "t")
    assert now.columns == docs.columns and {r.doc_id for r in now.collect()} == stay

    out = {r.doc_id: r for r in encode(spark, now, SF).collect()}
    decoder = Decoder(Model(public_tokenizers.path(corpus_pipeline.MODEL)))
    assert set(out) == stay
    assert all(out[i].text == rows[i] == decoder.decode(out[i].ids) and out[i].round_trip for i in stay)


def test_run_is_the_stages_in_order(spark):
    ids = {r.doc_id for r in corpus_pipeline.run(spark, SF).select("doc_id").collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = settled(stage(spark, docs, SF), "t")
    assert ids == {r.doc_id for r in docs.collect()}


def test_stages_survive_odd_rows(spark):
    for rows in (None, []):
        docs = edge_docs(spark) if rows is None else edge_docs(spark, rows)
        columns = docs.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = settled(stage(spark, docs, SF), "t")
            assert docs.columns == columns
        out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
        assert all(r.round_trip for r in out) and (rows is None) == bool(out)


def test_names():
    names = set(catalogue.QUERIES)
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
