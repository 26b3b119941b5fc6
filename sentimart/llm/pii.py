"""Personal data with offset-preserving deobfuscation.

Plain detection finds e-mail addresses, IPv4 addresses, payment cards (12 to 19 digits passing Luhn) and phone
numbers (+, 9 to 15 digits) in the text as it is: the base spans. A transducer then rewrites disguises, keeping
for every character of the normalised text the range of source characters it came from:

* look-alike letters, full-width forms and invisible characters become their plain letters or nothing;
* "(at)", "[dot]" and their kin become "@" and "."; bare " at " counts only with a " dot " after it;
* runs of spelled digits ("four one one", "plus four four") become digits: first runs of LONG_RUN or more, then, on a
  copy of its own, runs of any length, which with dots, brackets and figures between them may make up one number.

The same detectors run on the normalised texts; a finding is mapped back to source offsets and added if it used
at least one rewritten character and overlaps no base span and no span of the copy before. Offsets are code points, end exclusive.

Cases: null and empty texts have no spans; repeated rows and ids give a row each; an empty table gives an empty
table; spans that begin together are listed in the order e-mail, IP, card, phone. Only the named columns are
read, so further columns may have any name. Every scan is linear in the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A match can only begin at the start of a run of digits: from within one the same continuation fails.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# Letters that look like Latin ones (Cyrillic, Greek), in natural order.
LOOK_ALIKES = {
    "А": "A", "В": "B", "Е": "E", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Ѕ": "S", "Т": "T", "У": "Y", "Х": "X",
    "а": "a", "е": "e", "і": "i", "ј": "j", "о": "o", "р": "p", "с": "c", "ѕ": "s", "у": "y", "х": "x", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ο": "o", "ν": "v", "ι": "i", "α": "a", "․": ".", "。": ".", "﹒": ".", "﹫": "@", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-",
}
INVISIBLE = "­​‌‍⁠﻿"
FULL_WIDTH = {chr(c + 0xFEE0): chr(c) for c in range(0x21, 0x7F)}
# Spelled digits in English, Spanish, French and German.
SPELLED = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
}

_CHARS = {**LOOK_ALIKES, **FULL_WIDTH, **{c: "" for c in INVISIBLE}}
_WORD = "|".join(sorted(SPELLED, key=len, reverse=True))
_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
#: Blanks inside and behind a disguise; those before it are taken back from the bracket, so that no blank is read twice.
_GAP = r"[\x20\t]*+"
LONG_RUN = 7
_DISGUISE = (
    rf"(?P<char>[{re.escape(''.join(_CHARS))}])"
    rf"|(?P<at>{_OPEN}{_GAP}(?:at|@|arroba|arobase){_GAP}{_CLOSE}{_GAP})"
    rf"|(?P<dot>{_OPEN}{_GAP}(?:dot|\.|point|punto|punkt){_GAP}{_CLOSE}{_GAP})"
    rf"|(?P<bare_at>(?<=[A-Za-z0-9])[\x20\t]at[\x20\t](?=[A-Za-z0-9-]{{1,63}}[\x20\t]dot[\x20\t]))"
    rf"|(?P<bare_dot>(?<=[A-Za-z0-9])[\x20\t]dot[\x20\t](?=[A-Za-z0-9]))"
    rf"|(?P<spelled>\b(?:plus[\x20-])?(?:(?:{_WORD}|[0-9])[\x20,-]{{1,2}}){{LEAST,}}(?:{_WORD}|[0-9])\b)"
)
_LONG_RUNS, _ALL_RUNS = (re.compile(_DISGUISE.replace("LEAST", str(n)), re.IGNORECASE) for n in (LONG_RUN - 1, 0))
# Texts without any of these need no rewriting, and texts without a digit or @ have no plain finding (RE2 syntax).
_TRIGGER = rf"(?i)[{''.join(_CHARS)}]|{_OPEN}[ \t]*(at|@|arroba|arobase|dot|\.|point|punto|punkt)[ \t]*{_CLOSE}|[ \t]dot[ \t]|(({_WORD}|[0-9])[ ,-]{{1,2}}){{5}}"
# Texts without these have no run that only counts on the second copy: a spelled digit next to another or to a figure.
_NEIGHBOURS = rf"(?i)({_WORD}|[0-9])[^a-z0-9]+({_WORD})|({_WORD})[^a-z0-9]+[0-9]|({_WORD})[^a-z0-9]+(dot|point|punto|punkt)[^a-z0-9]|(dot|point|punto|punkt)[^a-z0-9]+({_WORD})"
_BETWEEN = re.compile(_NEIGHBOURS)
_PLAIN = "[0-9@]"
_SPELLED_DIGIT = re.compile(rf"{_WORD}|[0-9]|plus", re.IGNORECASE)


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
    return (odd + even) % 10 == 0


def detect(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the identifiers written plainly, leftmost and non-overlapping for each kind."""
    found = []
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append(("email", start, m.end()))
            last = m.end()
        else:
            last = max(last, at + 1)  # no address can reach back over this sign
        at = text.find("@", max(at + 1, last))
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x[-4:]) <= 255 for x in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := _digits(m[0])) <= 19 and _luhn(d):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                found.append(("phone", *m.span()))
    return found


def normalise(text: str, disguise: re.Pattern = _LONG_RUNS) -> tuple[str, list[int], list[int], list[bool]]:
    """The text without disguises; for each of its characters the source range it stands for and whether it was rewritten."""
    out, begin, end, new = [], [], [], []

    def take(made: str, a: int, b: int, changed: bool) -> None:
        out.append(made)
        begin.extend([a] * len(made) if changed else range(a, b))
        end.extend([b] * len(made) if changed else range(a + 1, b + 1))
        new.extend([changed] * len(made))

    done = 0
    for m in disguise.finditer(text):
        kind = m.lastgroup
        if kind == "char":
            made = _CHARS.get(m[0], m[0])
        elif kind == "spelled":
            parts = _SPELLED_DIGIT.findall(m[0])
            if len(parts) < LONG_RUN and all("0" <= x <= "9" for x in parts):
                continue  # a few plain figures stay as they are
            made = "".join("+" if (w := x.lower()) == "plus" else SPELLED.get(w, w) for x in parts)
        else:
            made = "@" if "at" in kind else "."
        start = m.start()
        if kind in ("at", "dot"):
            while start > done and text[start - 1] in " \t":
                start -= 1
        take(text[done:start], done, start, False)
        take(made, start, m.end(), True)
        done = m.end()
    take(text[done:], done, len(text), False)
    return "".join(out), begin, end, new


def spans_of(text: str, disguised: bool = True) -> list[tuple[str, int, int, bool]]:
    """All spans (kind, start, end, base) of a text by start, then kind as listed; disguised: look for rewritten ones too."""
    found = [(*s, True) for s in detect(text)]
    if disguised:
        for disguise in (_LONG_RUNS, _ALL_RUNS) if _BETWEEN.search(text) else (_LONG_RUNS,):
            clean, begin, end, new = normalise(text, disguise)
            before = sorted(s[1:3] for s in found if s[3] or disguise is _ALL_RUNS)
            for kind, a, b in detect(clean):
                # A finding counts if a character of it was rewritten, or one inside it removed.
                if any(new[a:b]) or end[b - 1] - begin[a] != b - a:
                    x, y = begin[a], end[b - 1]
                    if not any(p < y and q > x for p, q in before):
                        found.append((kind, x, y, False))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def spans_column(col: pa.Array) -> list[list[tuple[str, int, int, bool]]]:
    """spans_of each text of an Arrow array; a null has none."""
    hidden = pc.or_(pc.match_substring_regex(col, _TRIGGER), pc.match_substring_regex(col, _NEIGHBOURS)).fill_null(False)
    some = pc.or_(hidden, pc.match_substring_regex(col, _PLAIN).fill_null(False))
    out: list = [[] for _ in range(len(col))]
    for i in pc.indices_nonzero(some).to_pylist():
        out[i] = spans_of(col[i].as_py(), hidden[i].as_py())
    return out


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("base", T.BooleanType())])


def find_pii(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, spans array<kind, start, end, base>) for each row."""
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("spans", T.ArrayType(SPAN, False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
        for b in batches:
            spans = [[dict(zip(SPAN.names, s)) for s in row] for row in spans_column(b.column("__text"))]
            yield pa.RecordBatch.from_arrays([b.column("__key"), pa.array(spans, kind)], names=schema.names)

    return df.select(df[key].alias("__key"), df[text].alias("__text")).mapInArrow(run, schema)


def masked(text: str, spans: list[tuple[str, int, int, bool]]) -> str:
    """The text with each span (overlapping ones together) replaced by its kind in angle brackets."""
    out, done = [], 0
    for kind, start, end, _ in spans:
        if start >= done:
            out += [text[done:start], f"<{kind}>"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def mask_pii(df: DataFrame, text: str = "text") -> DataFrame:
    """df with personal data in its text column replaced; every row and column stays."""

    @F.pandas_udf(T.StringType())
    def mask(col):
        texts = pa.array(col, pa.string(), from_pandas=True)
        return pd.Series([masked(x, s) if s else x for x, s in zip(texts.to_pylist(), spans_column(texts))], dtype=object)

    return df.withColumn(text, mask(F.col(text)))


def digest(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
