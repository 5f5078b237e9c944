"""Language identification: Bayesian fusion of text, declared language, suffix and host.

The text likelihood is a multinomial over hashed letter trigrams, counted by grouped aggregation
over all labelled texts; a text counts like `TEMPER` independent trigrams at most, as neighbours
depend on each other. A further class, "und", draws trigrams uniformly: text of no
known language is likelier there.

Other evidence is learnt from the pages themselves, weighted by the text's posterior: how often
pages of a language declare which tag, and how the languages spread over address suffixes,
domains and hosts. Priors are smoothed down that hierarchy (all, suffix, domain, host), each
level taking `KAPPA` pages' worth from the one above, and always without the page in question.

The model has a row per trigram bucket and a column per language, both bounded, so it is
broadcast; tables per host grow with the data and are joined.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registra.llm.common import Shared, settled

BUCKETS = 1 << 15
TEMPER = 150
KAPPA = 5.0
ALPHA = 0.1
SLICE = 1 << 20
UNKNOWN = "und"

_TO_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)


def trigrams(text: str | None) -> np.ndarray:
    """Buckets of all byte trigrams of the letters, words parted by one space."""
    letters = (text or "").lower().encode("utf-8", "surrogatepass").translate(_TO_LETTERS)
    padded = b" " + b" ".join(letters.split()) + b" "
    b = np.frombuffer(padded, np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.uint32)
    code = b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]
    return code * np.uint32(2654435761) >> np.uint32(17)


# What begins markup: a name, an end, a comment or declaration, an instruction.
_MARKUP = re.compile("<[A-Za-z/!?]")


def visible_text(page: str | None) -> str:
    """Text of a page without tags, comments, scripts and styles. One pass, however broken. A "<"
    that begins none of these only parts what is before it from what is after it."""
    page = page or ""
    low, out, at = page.lower(), [], 0
    if len(low) != len(page):  # a few characters grow when lower-cased
        low = page
    while (lt := page.find("<", at)) >= 0:
        if not _MARKUP.match(page, lt):
            if lt > at:
                out.append(page[at:lt])
            at = lt + 1
            continue
        out.append(page[at:lt])
        if page.startswith("<!--", lt):
            end, skip = page.find("-->", lt + 4), 3
        elif low.startswith(("<script", "<style"), lt):
            end, skip = low.find("</s" + low[lt + 2 : lt + 4], lt), 0
        else:
            end, skip = page.find(">", lt), 1
        if end < 0:
            return html.unescape(" ".join(out))
        at = end + skip
    if at < len(page):
        out.append(page[at:])
    return html.unescape(" ".join(out))


class TextModel:
    """Languages and their log-probabilities per bucket, "und" last."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = [*languages, UNKNOWN]
        smooth = counts + ALPHA
        known = np.log(smooth / smooth.sum(axis=0))
        self.log = np.column_stack([known, np.full(BUCKETS, -np.log(BUCKETS))]).astype("f4")

    def score(self, text: str | None) -> tuple[np.ndarray, int]:
        """Tempered log-likelihood per language, and the number of trigrams."""
        codes = trigrams(text)
        n = len(codes)
        total = np.zeros(len(self.languages))
        for at in range(0, n, SLICE):
            total += self.log[codes[at : at + SLICE]].sum(axis=0, dtype="f8")
        return (total * (min(n, TEMPER) / n) if n else total), n


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for label, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            codes = trigrams(value.as_py())
            own = counts.setdefault(label, np.zeros(BUCKETS, np.int64))
            for at in range(0, len(codes), SLICE):
                own += np.bincount(codes[at : at + SLICE], minlength=BUCKETS)
    for label, own in counts.items():
        used = np.flatnonzero(own)
        yield pa.record_batch(
            [pa.array([label] * len(used), pa.string()), pa.array(used, pa.int32()),
             pa.array(own[used])],
            names=["label", "bucket", "n"],
        )


def primary_tag(tag: Column) -> Column:
    """The language of a tag such as en-GB in lower case, null if it is none."""
    tag = F.lower(F.regexp_extract(F.trim(tag), "^([A-Za-z]{2,3})(?:[-_].*)?$", 1))
    return F.when(tag != "", tag)


def fit_text_model(labelled: DataFrame, text_col: str = "text", label_col: str = "lang") -> TextModel:
    """Count trigrams per language over all rows that have a language tag.

    Tags have two or three letters, so there are a bounded number of languages; what is
    collected is at most one number per language and bucket.
    """
    rows = labelled.select(primary_tag(labelled[label_col]).alias("label"), labelled[text_col])
    found = (
        rows.filter("label is not null")
        .mapInArrow(_counter, "label string, bucket int, n long")
        .groupBy("label", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    languages = sorted(found.column("label").unique().to_pylist())
    counts = np.zeros((BUCKETS, len(languages)))
    column = np.array([languages.index(x) for x in found.column("label").to_pylist()], int)
    if len(languages):
        counts[found.column("bucket").to_numpy(), column] = found.column("n").to_numpy()
    return TextModel(languages, counts)


def _softmax(logs: np.ndarray) -> np.ndarray:
    shares = np.exp(logs - logs.max(axis=1, keepdims=True))
    return shares / shares.sum(axis=1, keepdims=True)


def _matrix(column: pa.ListArray, size: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, size)


def _lists(matrix: np.ndarray) -> pa.ListArray:
    offsets = np.arange(len(matrix) + 1, dtype="i4") * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel(), pa.float64()))


def _sums(size: int, of: str = "p") -> Column:
    return F.array(*(F.sum(F.get(of, F.lit(i))) for i in range(size)))


def _smoothed(counts: np.ndarray, own: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Shares at one level without the page itself, drawn towards the level above."""
    rest = np.maximum(counts - own, 0.0)
    return (rest + KAPPA * above) / (rest.sum(axis=1, keepdims=True) + KAPPA)


def _fuser(languages: list[str], prior: np.ndarray, said: dict[str, np.ndarray], kept: int):
    """Posterior of each page from its text, its host's levels and its declaration."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(languages)
        labels = np.array(languages, object)
        for batch in batches:
            column = dict(zip(batch.schema.names, batch.columns, strict=True))
            logs, p, *levels = (
                _matrix(column[c], size)
                for c in ("logs", "p", "in_suffix", "in_domain", "in_host")
            )
            share = prior
            for counts in levels:
                share = _smoothed(counts, p, share)
            declared = np.array([said[t] for t in column["declared"].to_pylist()])
            posterior = _softmax(logs + np.log(share) + declared.reshape(-1, size))
            with_text = column["n"].to_numpy() > 0
            lang = np.where(with_text, labels[posterior.argmax(axis=1)], UNKNOWN)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:kept],
                    pa.array(lang, pa.string()),
                    pa.array(np.where(with_text, posterior.max(axis=1), 0.0)),
                    pa.array(lang != UNKNOWN, pa.bool_()),
                    pa.array(np.where(with_text, labels[p.argmax(axis=1)], UNKNOWN), pa.string()),
                    *(column[c] for c in ("declared", "host", "suffix")),
                ],
                names=[*batch.schema.names[:kept], "lang", "confidence", "accepted", "text_lang",
                       "declared", "host", "suffix"],
            )

    return run


def identify(
    rows: DataFrame,
    model: TextModel,
    text: Column,
    markup: bool,
    declared: Column,
    host: Column,
    keep: list[str],
) -> DataFrame:
    """Columns `keep` and lang, confidence, accepted, text_lang, declared, host, suffix.

    `markup` says that the text is a page whose visible text counts. Rows without text are "und"
    and not accepted; null declarations and hosts are evidence like others ("none", no host).
    Repeated rows come out as often as they go in. With no labelled texts all is "und".
    """
    size = len(model.languages)
    shared = Shared(rows.sparkSession, model)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    tag = primary_tag(declared)
    known = [*model.languages[:-1]]
    tag = F.when(tag.isNull(), "none").when(tag.isin(known), tag).otherwise("other")
    inner = [f"k{i}" for i in range(len(keep))]
    given = rows.select(
        *(rows[c].alias(i) for c, i in zip(keep, inner, strict=True)),
        tag.alias("declared"),
        F.lower(F.coalesce(host, F.lit(""))).alias("host"),
        text.alias("text"),
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logs, ns = [], []
            for value in batch.column(batch.num_columns - 1):
                body = value.as_py()
                log, n = shared.value.score(visible_text(body) if markup else body)
                logs.append(log)
                ns.append(n)
            found = np.array(logs).reshape(-1, size)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    _lists(found),
                    _lists(_softmax(found) if ns else found),
                    pa.array(ns, pa.int64()),
                ],
                names=[*batch.schema.names[:-1], "logs", "p", "n"],
            )

    kept = "".join(f"{i} {kinds[c]}, " for c, i in zip(keep, inner, strict=True))
    scored = given.mapInArrow(
        score,
        f"{kept}declared string, host string, logs array<double>, p array<double>, n long",
    )
    scored = settled(
        scored.select(
            "*",
            F.regexp_extract("host", r"([^.]+)$", 1).alias("suffix"),
            F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1).alias("domain"),
        ),
        "language_scores",
    )
    # One row per tag that is known, and one for all: bounded by the languages.
    tags = {r[0]: r[1] for r in scored.groupBy("declared").agg(_sums(size)).collect()}
    total = np.sum([v for v in tags.values()], axis=0) if tags else np.zeros(size)
    pages = total.sum()
    prior = (total + ALPHA) / (pages + ALPHA * size)
    names = [*known, "none", "other"]
    log_said = {}
    for t in names:
        n = np.array(tags.get(t, np.zeros(size)))
        share = (n.sum() + 1) / (pages + len(names))
        log_said[t] = np.log((n + KAPPA * share) / (total + KAPPA))

    # Levels of the hierarchy are aggregated from the level below. The table of hosts is written,
    # so that the join has two plain sides and a very common host can be split or broadcast.
    hosts = scored.groupBy("suffix", "domain", "host").agg(_sums(size).alias("in_host"))
    domains = hosts.groupBy("suffix", "domain").agg(_sums(size, "in_host").alias("in_domain"))
    suffixes = domains.groupBy("suffix").agg(_sums(size, "in_domain").alias("in_suffix"))
    levels = (
        hosts.join(domains, ["suffix", "domain"]).join(suffixes, "suffix").drop("suffix", "domain")
    )
    joined = scored.join(settled(levels, "hosts"), "host").select(
        *inner, "declared", "host", "suffix", "logs", "p", "n", "in_suffix", "in_domain", "in_host"
    )
    fused = joined.mapInArrow(
        _fuser(model.languages, prior, log_said, len(inner)),
        f"{kept}lang string, confidence double, accepted boolean, text_lang string, "
        "declared string, host string, suffix string",
    )
    return fused.toDF(*keep, *fused.columns[len(keep) :])


def identify_pages(
    pages: DataFrame,
    labelled: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Language of each page, with the texts of `labelled` (text, lang) as training data."""
    declared = F.regexp_extract(pages[html_col], r"""(?i)<html[^>]*\slang\s*=\s*["']?([A-Za-z_-]+)""", 1)
    host = F.regexp_extract(
        pages[url_col], r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1
    )
    return identify(
        pages, fit_text_model(labelled), pages[html_col], True, declared, host, [id_col]
    )


def drop_unidentified(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    declared_col: str = "lang",
    host_col: str = "source",
) -> DataFrame:
    """Documents in a language that the model knows, with all their columns. The model is fitted on
    the documents' own declarations. Documents without an id stay; rows that repeat an id stay if
    one of them is accepted."""
    model = fit_text_model(docs, text_col, declared_col)
    found = identify(
        docs, model, docs[text_col], False, docs[declared_col], docs[host_col], [id_col]
    )
    verdict = found.groupBy(F.col(id_col).alias("gone")).agg(F.max("accepted").alias("ok"))
    gone = settled(verdict.filter(~F.col("ok")).select("gone"), "unidentified")
    return docs.join(gone, docs[id_col] == gone["gone"], "left_anti")
