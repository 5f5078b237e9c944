"""Personal data in texts, with disguises undone and offsets kept.

Base identifiers are found in the text as it is. A text with signs of a disguise also runs through a
transducer of a few rewriting steps; each character that it writes remembers where it came
from, so identifiers found in the rewritten text are reported at their place in the source:

1. characters that only look like ASCII (compatibility forms, digits of other scripts, letters of
   a fixed list) become that character, invisible ones go;
2. bracketed "at" and "dot" become @ and a full stop;
3. "name at host dot com" in words becomes an address, if it has a spelled dot;
4. spelled digits in a row become digits, a "plus" before and a "dot" between them their signs.

A span of the rewritten text counts only if a rewritten character is in it, and only if no base
span of its kind holds all of it. Every step is linear in the text.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registra.llm.common import joined_digest, worker_state

KINDS = ["email", "ip", "card", "phone"]

# The rules of the base identifiers.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9]){11,}")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")

# Letters that look like ASCII ones and are no compatibility forms of them.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k",
    "ӏ": "l", "м": "m", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v",
    "ԝ": "w", "х": "x", "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J",
    "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "У": "Y", "Х": "X",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
    "χ": "x", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M",
    "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ı": "i", "ɑ": "a", "ɡ": "g",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "․": ".", "。": ".",
}
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
# Digits as words.
SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5",
    "six": "6", "seven": "7", "eight": "8", "nine": "9",
}

_WORDS = "|".join(SPELLED)
_NUMBER = re.compile(
    rf"(?i)(?<![A-Za-z])(?:{_WORDS})(?:[ -](?:(?:dot|point)[ ])?(?:{_WORDS}))++(?![A-Za-z])"
)
_NUMBER_PART = re.compile(rf"(?i)[ ](dot|point)[ ]|[ -]|({_WORDS})")
_PLUS = re.compile(r"(?i)(?<![A-Za-z])plus[ ](?=[0-9])")
_POINT = re.compile(r"(?i)(?<=[0-9])[ ](?:dot|point)[ ](?=[0-9])")
_BRACKETED = re.compile(r"(?i)[ \t]?[\[({<][ \t]?(at|dot|@|\.)[ \t]?[\])}>][ \t]?")
_SPOKEN = re.compile(
    rf"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:[ ]dot[ ][A-Za-z0-9._%+-]++)*"
    r"(?:[ ]at[ ]|@)[A-Za-z0-9-]++(?:(?:[ ]dot[ ]|\.)[A-Za-z0-9-]++)+"
)
_SEPARATOR = re.compile(r"(?i)[ ](at|dot)[ ]")
_DOT = re.compile(r"(?i)[ ]dot[ ]")
_SIGNS = re.compile(r"(?i)[\[({<][ \t]?(?:at|dot|@|\.)[ \t]?[\])}>]|[ ]dot[ ]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            free = found.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and (not part or int(part) <= 255)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base identifiers, sorted."""
    out: list[tuple[int, int, int]] = []
    if "@" in text:
        out += [(s, 0, e) for s, e in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(map(_small, m[0].split("."))):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c.isdecimal() for c in m[0]) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def _lookalikes() -> tuple[dict[int, str], re.Pattern, frozenset[str]]:
    """All characters that step 1 rewrites, as a table, a pattern and a set; from Unicode's own
    tables but for the fixed list."""
    kept = worker_state()
    if "lookalikes" not in kept:
        table = dict.fromkeys(map(ord, INVISIBLE), "") | {ord(k): v for k, v in LOOKALIKES.items()}
        for code in range(0x80, 0x20000):
            c = chr(code)
            digit = unicodedata.decimal(c, None)
            plain = str(digit) if digit is not None else unicodedata.normalize("NFKC", c)
            if len(plain) == 1 and "!" <= plain <= "~":
                table.setdefault(code, plain)
        odd = frozenset(map(chr, table))
        kept["lookalikes"] = table, re.compile("[" + "".join(sorted(odd)) + "]"), odd
    return kept["lookalikes"]


class Tape:
    """A text being rewritten, and where each of its characters came from."""

    def __init__(self, text: str):
        self.text = text
        self.starts = array("q", range(len(text)))
        self.ends = array("q", range(1, len(text) + 1))
        self.fresh = bytearray(len(text))

    def rewrite(self, pieces: Iterator[tuple[int, int, str]]) -> None:
        """Replace ranges, given in order, by strings."""
        texts: list[str] = []
        starts, ends = array("q"), array("q")
        fresh = bytearray()
        done = 0
        for s, e, new in pieces:
            texts += self.text[done:s], new
            starts += self.starts[done:s]
            ends += self.ends[done:s]
            fresh += self.fresh[done:s]
            starts += array("q", [self.starts[s]]) * len(new)
            ends += array("q", [self.ends[e - 1]]) * len(new)
            fresh += b"\x01" * len(new)
            if fresh and not new:
                fresh[-1] = 1  # what went is part of the character before
            done = e
        if done:
            self.text = "".join(texts) + self.text[done:]
            self.starts = starts + self.starts[done:]
            self.ends = ends + self.ends[done:]
            self.fresh = fresh + self.fresh[done:]


def _spoken(text: str) -> Iterator[tuple[int, int, str]]:
    for m in _SPOKEN.finditer(text):
        if _DOT.search(m[0]):
            for s in _SEPARATOR.finditer(text, m.start(), m.end()):
                yield s.start(), s.end(), "@" if s[1].lower() == "at" else "."


def _numbers(text: str) -> Iterator[tuple[int, int, str]]:
    for m in _NUMBER.finditer(text):
        for part in _NUMBER_PART.finditer(text, m.start(), m.end()):
            new = "." if part[1] else SPELLED[_folded(part[2])] if part[2] else ""
            yield part.start(), part.end(), new


def _folded(text: str) -> str:
    """Small letters; patterns that ignore case take U+0130 for an "i"."""
    return text.replace("\u0130", "i").lower()


def _disguised(text: str) -> bool:
    """Whether a text without look-alikes has a sign of any other step. Plain search for the words
    of a sign comes first, as a pattern costs far more."""
    plain = _folded(text)
    if " dot " in plain or _SIGNS.search(text):
        return True
    if "plus " in plain and _PLUS.search(text):
        return True
    if " point " in plain and _POINT.search(text):
        return True
    return any(word in plain for word in SPELLED) and _NUMBER.search(text) is not None


def rewritten(text: str) -> Tape | None:
    """The text after all steps, or None if it shows no sign of a disguise."""
    alike = False
    if not text.isascii():
        table, odd, chars = _lookalikes()
        alike = not chars.isdisjoint(text)
    if not (alike or _disguised(text)):
        return None
    tape = Tape(text)
    if alike:
        tape.rewrite((m.start(), m.end(), table[ord(m[0])]) for m in odd.finditer(text))
    brackets = {"at": "@", "@": "@", "dot": ".", ".": "."}
    tape.rewrite(
        (m.start(), m.end(), brackets[m[1].lower()]) for m in _BRACKETED.finditer(tape.text)
    )
    tape.rewrite(_spoken(tape.text))
    tape.rewrite(_numbers(tape.text))
    tape.rewrite((m.start(), m.end(), "+") for m in _PLUS.finditer(tape.text))
    tape.rewrite((m.start(), m.end(), ".") for m in _POINT.finditer(tape.text))
    return tape


def hidden_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans that only the rewritten text shows, at their place in the source."""
    tape = rewritten(text)
    if tape is None:
        return []
    known: dict[int, list[tuple[int, int]]] = {}
    for s, k, e in base:
        known.setdefault(k, []).append((s, e))
    out = []
    for s, k, e in base_spans(tape.text):
        if not any(tape.fresh[s:e]):
            continue
        start, end = tape.starts[s], tape.ends[e - 1]
        own = known.get(k, [])
        while own and own[0][1] <= start:  # both lists ascend
            own.pop(0)
        if not (own and own[0][0] <= start and end <= own[0][1]):
            out.append((start, k, end))
    return out


_SPANS = pa.list_(
    pa.struct([("start", pa.int64()), ("rank", pa.int32()), ("end", pa.int64()),
               ("base", pa.bool_())])
)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`: id, and spans sorted by start and kind: kind, start, end, base.

    Kinds are email, ip, card and phone; offsets are code points of the text as it is, end
    exclusive; `base` is false for identifiers that were disguised. Null texts are empty, repeated
    rows come out as often as they go in, an empty table gives none. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(1):
                text = value.as_py() or ""
                base = base_spans(text)
                found = [(*s, True) for s in base] + [(*s, False) for s in hidden_spans(text, base)]
                found.sort(key=lambda s: s[:3])
                rows.append([dict(zip(("start", "rank", "end", "base"), s)) for s in found])
            yield pa.record_batch([batch.column(0), pa.array(rows, _SPANS)], names=["id", "found"])

    kind = docs.schema[id_col].dataType.simpleString()
    spans = "array<struct<start:long,rank:int,end:long,base:boolean>>"
    names = F.array(*map(F.lit, KINDS))
    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, found {spans}").select(
        F.col("id").alias(id_col),
        F.transform(
            "found",
            lambda s: F.struct(
                F.get(names, s["rank"]).alias("kind"), s["start"], s["end"], s["base"]
            ),
        ).alias("spans"),
    )


def mask(text: Column, spans: Column, mark: str = "*") -> Column:
    """The text with every character of the spans replaced, so that offsets stay valid."""
    return F.aggregate(
        spans,
        text,
        lambda t, s: F.overlay(
            t,
            F.repeat(F.lit(mark), (s["end"] - s["start"]).cast("int")),
            (s["start"] + 1).cast("int"),
            (s["end"] - s["start"]).cast("int"),
        ),
    )


def pii_report(docs: DataFrame, **options) -> DataFrame:
    """Counts per base kind, a digest of the base spans, and all spans as text."""
    found = find_pii(docs, **options)
    base = F.filter("spans", lambda s: s["base"])

    def written(spans: Column) -> Column:
        return F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))

    def number(kind: str) -> Column:
        own = F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))
        return F.size(own).cast("long")

    return found.select(
        found.columns[0],
        *(number(k).alias(f"n_{k}") for k in KINDS),
        joined_digest(written(base)).alias("base_sha256"),
        F.array_join(written(F.col("spans")), ",").alias("spans"),
        F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_disguised"),
    )
