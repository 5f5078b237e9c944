"""Every page's language and confidence against the rule written out in plain Python."""

import math
import re
from collections import Counter, defaultdict
from html.parser import HTMLParser
from urllib.parse import urlsplit

import pyarrow.parquet as pq
import pytest

from registra.llm.language_id import ALPHA, BUCKETS, KAPPA, TEMPER, identify_pages
from tests.llm.cases import by_id

SF = "/root/testdata/sf0.01"


class Visible(HTMLParser):
    def __init__(self):
        super().__init__()
        self.silent, self.found = 0, []

    def handle_starttag(self, tag, attrs):
        self.silent += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.silent -= tag in ("script", "style")

    def handle_data(self, data):
        if not self.silent:
            self.found.append(data)


def visible(page):
    parser = Visible()
    parser.feed(page or "")
    parser.close()
    return " ".join(parser.found)


def buckets(text):
    words = re.findall(rb"[a-z\x80-\xff]+", (text or "").lower().encode())
    padded = b" " + b" ".join(words) + b" "
    grams = (padded[i : i + 3] for i in range(len(padded) - 2))
    return Counter((int.from_bytes(g) * 2654435761 % 2**32) >> 17 for g in grams)


def tag_of(said):
    found = re.fullmatch(r"([A-Za-z]{2,3})(?:[-_].*)?", (said or "").strip(" "))
    return found.group(1).lower() if found else None


def shares(logs):
    top = max(logs)
    parts = [math.exp(x - top) for x in logs]
    return [x / sum(parts) for x in parts]


def added(rows, size):
    return [sum(r[i] for r in rows) for i in range(size)]


def plain(pages, docs):
    seen = defaultdict(Counter)
    for doc in docs:
        if tag := tag_of(doc["lang"]):
            seen[tag].update(buckets(doc["text"]))
    known = sorted(seen)
    size = len(known) + 1
    all_of = {k: seen[k].total() + ALPHA * BUCKETS for k in known}
    evidence = []
    for page in pages:
        counts = buckets(visible(page["html"]))
        n = counts.total()
        logs = [
            sum(c * math.log((seen[k][b] + ALPHA) / all_of[k]) for b, c in counts.items())
            for k in known
        ] + [-n * math.log(BUCKETS)]
        logs = [x * min(n, TEMPER) / n for x in logs] if n else logs
        html = re.search(r"""<html[^>]*\slang\s*=\s*["']?([A-Za-z_-]+)""", page["html"] or "", re.I)
        tag = tag_of(html and html.group(1))
        host = (urlsplit(page["url"] or "").hostname or "").lower()
        labels = host.split(".")
        keys = [
            (labels[-1],),
            (labels[-1], ".".join(labels[-2:]) if len(labels) > 1 else ""),
            (host, "host"),
        ]
        declared = "none" if tag is None else tag if tag in known else "other"
        evidence.append((page["page_id"], n, logs, shares(logs), declared, keys))

    total = added([e[3] for e in evidence], size)
    prior = [(t + ALPHA) / (sum(total) + ALPHA * size) for t in total]
    sums = defaultdict(lambda: [0.0] * size)
    for _, _, _, p, declared, keys in evidence:
        for key in ("said", declared), *keys:
            sums[key] = [a + b for a, b in zip(sums[key], p)]
    result = {}
    for page_id, n, logs, p, declared, keys in evidence:
        share = prior
        for key in keys:
            rest = [max(a - b, 0.0) for a, b in zip(sums[key], p)]
            share = [(r + KAPPA * s) / (sum(rest) + KAPPA) for r, s in zip(rest, share)]
        said = sums["said", declared]
        often = (sum(said) + 1) / (sum(total) + size + 1)
        posterior = shares([
            x + math.log(s) + math.log((d + KAPPA * often) / (t + KAPPA))
            for x, s, d, t in zip(logs, share, said, total)
        ])
        best = max(range(size), key=posterior.__getitem__)
        lang = [*known, "und"][best] if n else "und"
        result[page_id] = lang, posterior[best] if n else 0.0, declared
    return result


def test_all_pages_against_the_plain_rule(spark):
    pages, docs = (pq.read_table(f"{SF}/{t}.parquet").to_pylist() for t in ("pages", "documents"))
    got = by_id(
        identify_pages(
            spark.read.parquet(f"{SF}/pages.parquet"), spark.read.parquet(f"{SF}/documents.parquet")
        ),
        "page_id",
    )
    expected = plain(pages, docs)
    assert got.keys() == expected.keys()
    for page_id, (lang, confidence, declared) in expected.items():
        r = got[page_id]
        assert (r.lang, r.declared) == (lang, declared)
        assert r.confidence == pytest.approx(confidence, abs=1e-4)


def test_hosts_tags_and_short_texts_against_the_plain_rule(spark):
    docs = [{"text": t * 20, "lang": k} for k, t in
            (("de", "der Hund und die Katze "), ("en", "the dog and the cat "), ("pt-BR", "o gato e a casa "))]
    rows = []
    for i in range(60):
        lang = ("de", "en", "PT-br", "xx", "")[i % 5]
        text = ("und die", "the cat", "a casa", "", "o e")[i % 4]
        host = ("a.b.de", "b.de", "c.co.uk", "localhost", "X.b.DE")[i % 5 if i % 3 else 0]
        rows.append({"page_id": i, "url": f"http://{host}/{i}", "html": f'<html lang="{lang}"><p>{text}</p></html>'})
    rows.append({"page_id": 99, "url": None, "html": None})
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    labelled = spark.createDataFrame(docs, "text string, lang string")
    got = by_id(identify_pages(pages, labelled), "page_id")
    for page_id, (lang, confidence, declared) in plain(rows, docs).items():
        assert (got[page_id].lang, got[page_id].declared) == (lang, declared)
        assert got[page_id].confidence == pytest.approx(confidence, abs=1e-4)
