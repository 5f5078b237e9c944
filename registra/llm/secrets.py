"""Secret scan: base rules, and character Markov models for what they miss; DataFrame only.

The base rules are three patterns. What they find, and ordinary words of documents where they find
nothing, are the labelled samples of two first-order Markov models over characters. A long token
outside the base finds is reported when its log-likelihood as a random string exceeds that as an
ordinary identifier by `min_ratio`.

One pass over the texts finds base spans and long tokens; both are small and are written, so
training and scoring never read the texts of all documents again. The fitted table has one number
per pair of characters, so it is a literal in the plan however large the corpus is.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registra.llm.common import joined_digest, match_starts, matches, settled

# The patterns of the base rules and the lengths they ask for.
ASSIGN = (
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
    r"""([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 8, 16, 32
KINDS = ["assign", "access", "hex", "random"]

# A run of fewer than 32 hex digits fails at each of its places, so asking for 32 loses no match.
_HEX_RUN = rf"(?<![0-9a-f])[0-9a-f]{{{MIN_HEX},}}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_TOKEN = r"[A-Za-z0-9+/_=-]{%d,}"
START = "^"
MIN_TOKEN = 20
MIN_RATIO = 12.0
SMOOTHING = 20.0  # pairs' worth of a character's own share
TRAIN_TOKENS = 20_000  # labelled tokens of each kind that the models are fitted on
TRAIN_DOCS = 2_000  # documents that the ordinary ones are taken from

_SPAN = "struct<start:bigint,rank:int,end:bigint,token:string>"


def _spans(starts: Column, found: Column, rank: int, good) -> Column:
    """Spans of one kind whose match, given with its number, passes a test."""
    pairs = F.transform(
        found,
        lambda m, i: F.struct(
            F.get(starts, i).alias("start"),
            F.lit(rank).alias("rank"),
            (F.get(starts, i) + F.length(m)).alias("end"),
            m.alias("token"),
            i.alias("i"),
        ),
    )
    kept = F.filter(pairs, lambda p: good(p["token"], p["i"]))
    return F.transform(
        kept, lambda p: F.struct(p["start"], p["rank"], p["end"], p["token"])
    ).cast(f"array<{_SPAN}>")


def scanned(docs: DataFrame, id_col: str, text_col: str, min_token: int) -> DataFrame:
    """Per row: id, base (spans with their tokens, sorted), long (tokens outside them)."""
    token = _TOKEN % min_token
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": _HEX_RUN, "long": token}
    none = F.array().cast(f"array<{_SPAN}>")
    text = F.col("text")
    rows = docs.select(
        docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text")
    ).select("*", *(matches(text, p).alias(k) for k, p in patterns.items()))

    def placed(kind: str, rank: int, good) -> Column:
        found = F.col(kind)
        spans = _spans(match_starts(text, patterns[kind], found), found, rank, good)
        return F.when(F.size(found) > 0, spans).otherwise(none)

    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    long_value = F.when(F.size("assign") > 0, F.transform(values, F.length))
    rows = rows.select(
        "id",
        placed("assign", 0, lambda m, i: F.get(long_value, i) >= MIN_ASSIGN).alias("assign"),
        placed("access", 1, lambda m, i: F.length(m) >= MIN_ACCESS).alias("access"),
        placed("hex", 2, lambda m, i: F.length(m) >= MIN_HEX).alias("hex"),
        placed("long", 3, lambda m, i: F.lit(True)).alias("long"),
    ).select("id", "long", F.array_sort(F.concat("assign", "access", "hex")).alias("base"))
    outside = F.filter(
        "long",
        lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])),
    )
    return rows.select("id", "base", outside.alias("long"))


def _pairs(tokens: DataFrame) -> DataFrame:
    marked = F.concat(F.lit(START), F.col("token"))
    return tokens.select(
        "label",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.length("token")), lambda i: F.substring(marked, i, 2)
            )
        ).alias("pair"),
    )


def fit(
    found: DataFrame,
    docs: DataFrame,
    id_col: str,
    text_col: str,
    min_token: int = MIN_TOKEN,
    train_tokens: int = TRAIN_TOKENS,
    train_docs: int = TRAIN_DOCS,
) -> dict[str, float] | None:
    """Log-likelihood ratio (random against ordinary) of each pair of characters, or None if
    either label has no sample. Samples are the tokens with the smallest hashes."""
    only = rf"[^{ALPHABET}]"  # the hyphen is last, so it stands for itself
    value = F.regexp_extract(F.col("s.token"), ASSIGN, 2)
    random = (
        found.select("id", F.explode("base").alias("s"))
        .select("id", F.when(F.col("s.rank") == 0, value).otherwise(F.col("s.token")).alias("token"))
        .select("id", F.lit(0).alias("pos"), F.regexp_replace("token", only, "").alias("token"))
        .distinct()
    )
    quiet = (
        found.filter((F.size("base") == 0) & F.col("id").isNotNull())
        .select("id")
        .distinct()
        .orderBy(F.xxhash64("id"), "id")
        .limit(train_docs)
    )
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).join(
        F.broadcast(quiet), "id", "left_semi"  # `train_docs` ids at most
    )
    # Tokens too short to be judged, so none is its own evidence; all occurrences, as they are.
    inside = "[A-Za-z0-9+/_=-]"
    short = rf"(?<!{inside}){inside}{{{MIN_ASSIGN},{min_token - 1}}}(?!{inside})"
    ordinary = texts.select("id", F.posexplode(matches(F.col("text"), short)).alias("pos", "token"))

    def sample(tokens: DataFrame, label: str) -> DataFrame:
        few = tokens.filter("length(token) > 0")
        few = few.orderBy(F.xxhash64("id", "pos", "token"), "token").limit(train_tokens)
        return few.select(F.lit(label).alias("label"), "token")

    pairs = _pairs(sample(random, "random").unionAll(sample(ordinary, "ordinary")))
    # At most one row per label and pair of the alphabet's characters.
    counts: dict[str, dict[str, int]] = defaultdict(dict)
    for label, pair, n in pairs.groupBy("label", "pair").count().collect():
        counts[label][pair] = n
    if len(counts) < 2:
        return None
    # A pair's share is drawn towards its second character's own share, so a model does not
    # take what follows a character that it has never met for equally likely.
    table = {}
    own = {}
    for label, found_pairs in counts.items():
        total = sum(found_pairs.values()) + len(ALPHABET)
        own[label] = {
            b: (sum(found_pairs.get(a + b, 0) for a in START + ALPHABET) + 1) / total
            for b in ALPHABET
        }
    for a in START + ALPHABET:
        after = {k: sum(c.get(a + b, 0) for b in ALPHABET) + SMOOTHING for k, c in counts.items()}
        for b in ALPHABET:
            p = {
                k: (c.get(a + b, 0) + SMOOTHING * own[k][b]) / after[k] for k, c in counts.items()
            }
            table[a + b] = math.log(p["random"] / p["ordinary"])
    return table


def log_ratio(token: Column, table: dict[str, float]) -> Column:
    """Sum of the pairs' ratios over a token of the alphabet's characters."""
    size = len(ALPHABET)
    codes = ["-1"] * 128
    for i, c in enumerate(ALPHABET):
        codes[ord(c)] = str(i)
    code = F.split(F.lit(",".join(codes)), ",").cast("array<int>")
    order = [table[a + b] for a in ALPHABET + START for b in ALPHABET]
    ratio = F.split(F.lit(",".join(map(repr, order))), ",").cast("array<double>")

    def step(state: Column, c: Column) -> Column:
        now = F.get(code, F.ascii(c))
        return F.struct(
            now.alias("last"), (state["sum"] + F.get(ratio, state["last"] * size + now)).alias("sum")
        )

    start = F.struct(F.lit(size).alias("last"), F.lit(0.0).alias("sum"))
    return F.aggregate(F.split(token, ""), start, step, lambda s: s["sum"])


def scan_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_token: int = MIN_TOKEN,
    min_ratio: float = MIN_RATIO,
    train_tokens: int = TRAIN_TOKENS,
    train_docs: int = TRAIN_DOCS,
) -> DataFrame:
    """Per row of `docs`: id, and spans sorted by start and kind: kind, start, end, token.

    Kinds are assign, access, hex and random; offsets are code points, end exclusive. A random
    span never overlaps a base span. Null texts are empty; repeated rows come out as often as they
    go in; without samples of both labels there are base spans only. Other columns are not read.
    """
    found = settled(scanned(docs, id_col, text_col, min_token), "secrets")
    table = fit(found, docs, id_col, text_col, min_token, train_tokens, train_docs)
    spans = F.col("base")
    if table is not None:
        likely = F.filter("long", lambda t: log_ratio(t["token"], table) >= min_ratio)
        spans = F.array_sort(F.concat("base", likely))
    kinds = F.array(*map(F.lit, KINDS))
    return found.select(
        F.col("id").alias(id_col),
        F.transform(
            spans,
            lambda s: F.struct(
                F.get(kinds, s["rank"]).alias("kind"), s["start"], s["end"], s["token"]
            ),
        ).alias("spans"),
    )


def written(spans: Column) -> Column:
    """Spans as an array of kind:start:end."""
    return F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))


def secret_report(docs: DataFrame, **options) -> DataFrame:
    """Counts per base kind, a digest of the base spans, and all spans as text."""
    found = scan_secrets(docs, **options)
    base = F.filter("spans", lambda s: s["kind"] != "random")

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        found.columns[0],
        *(number(k).alias(f"n_{k}") for k in KINDS[:3]),
        joined_digest(written(base)).alias("base_sha256"),
        F.array_join(written(F.col("spans")), ",").alias("spans"),
        number("random").alias("n_random"),
    )
