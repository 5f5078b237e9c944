import math
import random

import pyarrow as pa

from registra.llm.language_id import (
    drop_unidentified,
    fit_text_model,
    identify_pages,
    trigrams,
    visible_text,
)
from tests.llm.cases import by_id, edge_docs

SF = "/root/testdata/sf0.01"


def test_text_alone_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = fit_text_model(docs.filter("doc_id % 5 != 0"))
    held = docs.filter("doc_id % 5 = 0").collect()
    right = sum(
        model.languages[int(model.score(r.text)[0].argmax())] == r.lang for r in held
    )
    assert model.languages == ["de", "en", "es", "fr", "und"]
    assert right >= 0.97 * len(held)


def page(lang, text):
    return f'<!DOCTYPE html><html lang="{lang}"><head><script>var x="</p>";</script></head><body>{text}</body></html>'


def pages(spark, rows):
    ids, urls, htmls = zip(*rows, strict=True) if rows else ((), (), ())
    columns = {"page_id": pa.array(ids, pa.int64()), "url": pa.array(urls, pa.string()),
               "html": pa.array(htmls, pa.string()), "host": pa.array(ids, pa.int64()),
               "declared": pa.array(ids, pa.int64())}
    return spark.createDataFrame(pa.table(columns))


def test_host_and_declaration_decide_where_the_text_does_not(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sample = {lang: [r.text for r in docs.filter(f"lang = '{lang}'").limit(40).collect()] for lang in ("de", "fr")}
    rows = []
    for k, lang in enumerate(("de", "fr")):
        host = f"http://www.site{k}.{lang}/"
        rows += [(100 * k + i, host + str(i), page(lang, t)) for i, t in enumerate(sample[lang])]
        rows.append((900 + k, host + "short", page("", "en")))
    rows.append((950, "http://other.org/", page("fr-FR", "en")))
    got = by_id(identify_pages(pages(spark, rows), docs), "page_id")
    assert got[900].lang == "de" and got[901].lang == "fr" and got[950].lang == "fr"
    assert got[950].declared == "fr" and got[900].declared == "none" and got[900].suffix == "de"
    assert sum(got[i].lang == "de" for i in range(40)) >= 39
    assert all(0 < r.confidence <= 1 and math.isfinite(r.confidence) for r in got.values())


def test_text_in_no_known_language_is_rejected(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    rnd = random.Random(1)
    other = "".join(chr(rnd.randint(0x4E00, 0x9000)) for _ in range(400))
    rows = [(i, f"http://h{i}.org/", page("xx", t)) for i, t in
            enumerate([other, "12345 67 --", "", "!!! ???"])]
    rows.append((9, "http://h9.org/", None))
    got = by_id(identify_pages(pages(spark, rows), docs), "page_id")
    assert {r.lang for r in got.values()} == {"und"} and not any(r.accepted for r in got.values())


def test_pages_of_the_table(spark):
    got = identify_pages(spark.read.parquet(f"{SF}/pages.parquet"), spark.read.parquet(f"{SF}/documents.parquet"))
    rows = got.collect()
    assert len(rows) == 250 and sum(r.lang == r.declared for r in rows) > 200


def test_filter_keeps_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = drop_unidentified(docs)
    assert kept.schema == docs.schema
    assert kept.count() >= 0.99 * docs.filter("length(text) > 0").count()


def test_visible_text_and_trigrams():
    assert visible_text("a<b>c</b>&amp;d").split() == ["a", "c", "&d"]
    assert visible_text("x<!-- <p>no --> y <SCRIPT>no</SCRIPT><style>no</style>z").split() == ["x", "y", "z"]
    assert visible_text("x <!-- open") == "x " and visible_text("x <script>open") == "x "
    assert visible_text("İ<p>y").split() == ["İ", "y"]
    assert visible_text("<" * 200_000) == "" and visible_text("<!--" * 50_000) == ""
    assert len(trigrams("")) == 0 and len(trigrams("1 2!")) == 0
    assert trigrams("Ab").tolist() == trigrams("ab ").tolist() and len(trigrams("ab")) == 2


def test_edges(spark):
    docs = edge_docs(spark)
    kept = drop_unidentified(docs)
    assert kept.schema == docs.schema
    ids = {r.doc_id for r in kept.collect()}
    assert {1, 2, None} <= ids and not {3, 4, 5} & ids
    assert drop_unidentified(edge_docs(spark, [])).collect() == []
    assert identify_pages(pages(spark, []), docs).collect() == []
    nothing = edge_docs(spark, [])
    rows = identify_pages(pages(spark, [(1, None, None), (1, "http://a.b/", page("en", "x y"))]), nothing)
    assert [r.lang for r in rows.collect()] == ["und", "und"]


def test_long_tags_and_bare_signs(spark):
    attributes = " ".join(f'data-a{i}="x"' for i in range(400))
    html = f'<html {attributes} lang="de"><body>5 < 6 and a<b>c</b> if x <y or <3'
    assert visible_text("5 < 6 <b>x</b> <3 and more").split() == ["5", "6", "x", "3", "and", "more"]
    pages = spark.createDataFrame([(1, "http://a.de/", html)], "page_id long, url string, html string")
    docs = spark.createDataFrame([("der und das ist " * 9, "de"), ("the of and is " * 9, "en")], "text string, lang string")
    found = identify_pages(pages, docs).first()
    assert len(html) > 2000 and found["declared"] == "de"
