"""Queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from registra.catalogue.registry import Run
from registra.llm.collocations import collocations
from registra.llm.common import joined_digest, small_batches
from registra.llm.decontaminate import contaminated, find_contamination
from registra.llm.exact_dedup import exact_dedup
from registra.llm.hard_negatives import hard_negatives
from registra.llm.language_id import identify_pages
from registra.llm.lm_score import score_documents
from registra.llm.passage_dedup import drop_repeats
from registra.llm.pii import pii_report
from registra.llm.quality import quality_report
from registra.llm.secrets import secret_report
from registra.llm.sentencepiece_codec import codec_report
from registra.llm.simhash import simhash_components
from registra.llm.token_records import read_token_records, write_token_records

QUERIES: dict[str, Run] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run: Run) -> Run:
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op3_simhash")
def simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash_components(table(spark, sf, "documents"), shingle=3, radius=3)


@query(
    "op4_exact_dedup",
    """
    with normalised as (
        select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz') as t
        from documents
    )
    select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
           doc_id = max(doc_id) over same as kept, sha256(t) as text_sha256
    from normalised window same as (partition by t)
    """,
)
def exact(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup(table(spark, sf, "documents"), keep="largest")


DECONTAMINATE_SQL = r"""
    with item_words as (
        select item_id, regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
        from benchmark
    ), item_windows as (
        select distinct item_id, least(13, len(w)) as size, unnest(list_transform(
            range(1, len(w) - least(13, len(w)) + 2),
            lambda i: list_slice(w, i, i + least(13, len(w)) - 1))) as win
        from item_words where len(w) > 0
    ), doc_words as (
        select doc_id, regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
        from documents
    ), sizes as (select distinct size from item_windows),
    doc_windows as (
        select doc_id, size, unnest(range(1, len(w) - size + 2)) as pos,
            unnest(list_transform(range(1, len(w) - size + 2),
                lambda i: list_slice(w, i, i + size - 1))) as win
        from doc_words, sizes where len(w) >= size
    ), hits as (
        select doc_id, pos, d.size, item_id
        from doc_windows d join item_windows i on d.win = i.win
    ), covered as (
        select doc_id, count(distinct p) as n_hit
        from (select doc_id, unnest(range(pos, pos + size)) as p from hits) group by doc_id
    ), listed as (
        select doc_id, count(*) as n_items, sha256(string_agg(item, ',' order by item)) as digest
        from (select distinct doc_id, item_id::varchar as item from hits) group by doc_id
    )
    select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit,
        coalesce(n_items, 0) as n_items, coalesce(digest, sha256('')) as items_sha256,
        coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
    from doc_words left join covered using (doc_id) left join listed using (doc_id)
"""


@query("op6_decontaminate", DECONTAMINATE_SQL)
def decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    report = find_contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return report.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        joined_digest(F.col("items")).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


@query("op9_token_records")
def token_records(spark: SparkSession, sf: str) -> DataFrame:
    manifest = write_token_records(
        table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )
    return read_token_records(spark, manifest).withColumnRenamed("id", "doc_id")


@query("op2_secrets")
def secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secret_report(table(spark, sf, "documents"))


@query("op5_pii")
def pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii_report(table(spark, sf, "documents"))


@query("op10_passages")
def repeated_passages(spark: SparkSession, sf: str) -> DataFrame:
    found = drop_repeats(table(spark, sf, "documents"))
    spans = F.transform("removed", lambda s: F.concat_ws(":", s["start"], s["end"]))
    return found.select(
        "doc_id",
        F.size("removed").cast("long").alias("n_removed"),
        F.array_join(spans, ",").alias("removed"),
        "text",
    )


@query("op8_language_id")
def language_id(spark: SparkSession, sf: str) -> DataFrame:
    return identify_pages(table(spark, sf, "pages"), table(spark, sf, "documents"))


@query("op7_lm_score")
def lm_score(spark: SparkSession, sf: str) -> DataFrame:
    return score_documents(table(spark, sf, "documents"))


@query("op1_sentencepiece")
def sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return codec_report(table(spark, sf, "documents"), model)


@query("op11_quality")
def quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality_report(table(spark, sf, "documents"), table(spark, sf, "labels"))


HARD_NEGATIVES_SQL = """
    with vectors as (
        select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
            list_transform(embedding, lambda x: floor(256 * x::double)) as v
        from embeddings
        where vec_id is not null and label is not null and embedding is not null
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ), scored as (
        select a.vec_id as anchor_id, r.vec_id, a.label = r.label as same,
            list_inner_product(a.v, r.v)::bigint as score
        from vectors a, vectors r where a.vec_id % 50 = 0 and a.vec_id <> r.vec_id
    ), positives as (
        select anchor_id, vec_id as positive_id, score as positive_score from scored where same
        qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
    )
    select anchor_id, positive_id,
        (row_number() over (partition by anchor_id, positive_id order by score desc, vec_id))::int
            as rank,
        vec_id as negative_id, positive_score, score as negative_score
    from positives join scored using (anchor_id)
    where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
    qualify rank <= 3
"""


@query("op12_hard_negatives", HARD_NEGATIVES_SQL)
def mined_negatives(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)


COLLOCATIONS_SQL = r"""
    with pieces as (
        select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
        from documents
    ), worded as (
        select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
    ), totals as (
        select lang, sum(len(w))::bigint as n from worded group by lang
    ), grams as (
        select lang, k, unnest(list_transform(range(1, len(w) - k + 2),
            lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) as phrase
        from worded, range(1, 5) as t(k) where len(w) >= k
    ), f as (
        select lang, k, phrase, count(*) as a from grams group by all having count(*) >= 30
    ), candidates as (
        select *, string_split(phrase, ' ') as w from f where k > 1
    ), cuts as (
        select lang, phrase, a, i, array_to_string(list_slice(w, 1, i), ' ') as left_part,
            array_to_string(list_slice(w, i + 1, k), ' ') as right_part
        from candidates, range(1, 4) as t(i) where i < k
    ), scored as (
        select c.lang, c.phrase, c.a, x.a as l, y.a as r,
            (2000000::hugeint * c.a // (x.a + y.a))::bigint as score
        from cuts c join f x on x.lang = c.lang and x.phrase = left_part
            join f y on y.lang = c.lang and y.phrase = right_part
        qualify row_number() over (partition by c.lang, c.phrase order by score, i) = 1
    ), inner_phrases as (
        select lang, a as longer, array_to_string(list_slice(w, s, s + m - 1), ' ') as phrase
        from candidates, range(2, 4) as t(m), range(1, 4) as u(s) where m < k and s + m - 1 <= k
    ), holders as (
        select lang, phrase, max(longer) as longer from inner_phrases group by all
    )
    select s.lang, row_number() over (partition by s.lang
            order by s.score desc, s.a desc, s.phrase)::bigint as rank,
        s.phrase, s.a, s.l, s.r, n, s.score
    from scored s join totals using (lang) left join holders h
        on h.lang = s.lang and h.phrase = s.phrase
    where h.longer is null or 100 * h.longer < 80 * s.a
    qualify rank <= 2000
"""


@query("op13_collocations", COLLOCATIONS_SQL)
def phrase_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations(table(spark, sf, "documents"))


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
