"""Text cleaning as native Column -> Column functions (no Python UDF on the default path).

The chain mirrors the reference's ``clean_and_preprocess_text`` step by step and in the same
order: lower-case, HTML to text, URLs, emoji, contractions, keep letters and blanks, tokenize,
stopwords. Lemmas and scores need lookups in tables, so they are joins (``operators``), not
expressions.

Every pattern here is written so that Java regex (Spark) and RE2 (the DuckDB oracle) read it the
same way: no back-references, no look-behind, explicit character classes instead of ``\\s``.
"""

from __future__ import annotations

import re
from functools import reduce
from html.entities import html5
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentimart import resources as R

# Python's ``str.isspace`` set, which is what the reference's ``\s`` (on str) and ``split()``
# use. Java's ``\s`` is ASCII unless (?U), RE2's ``\s`` is ASCII and lacks \x0B: spell it out.
WS_CLASS = (
    r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)

HTML_COMMENT = r"(?s)<!--.*?-->"
HTML_SCRIPT = r"(?s)<script(?:[^a-z0-9>][^>]*)?>.*?</script[^>]*>"
HTML_STYLE = r"(?s)<style(?:[^a-z0-9>][^>]*)?>.*?</style[^>]*>"
# A quoted attribute value may hold ">".
HTML_TAG = r"""</?[a-z!](?:[^>"']+|"[^"]*"|'[^']*')*>"""
# What stands where markup was until references are decoded, so that no reference is read across a tag. No character.
MARK = "\uffff"
# Character references, each decoded once. Names: the HTML 5 set in lower case (the text is), from the standard library;
# those of the older sets are also known without ";" and as the beginning of a longer word.
ENTITIES: dict[str, str] = {name[:-1]: text for name, text in sorted(html5.items()) if name == name.lower() and name.endswith(";")}
BARE_ENTITIES: tuple[str, ...] = tuple(sorted((n for n in html5 if n == n.lower() and not n.endswith(";")), key=lambda n: (-len(n), n)))
NAMED = "^([a-z0-9]{1,32});"
BARE_NAMED = "^(" + "|".join(BARE_ENTITIES) + ")"
NUMBER, HEX_NUMBER = "^#([0-9]+);?", "^#x([0-9a-f]+);?"
# Numbers that stand for another character: the C1 range as Windows reads it, 0 and the carriage return.
RENUMBERED: dict[int, str] = {0: "\ufffd", 13: "\r"} | {
    code: bytes([code]).decode("cp1252", errors="ignore") or chr(code) for code in range(0x80, 0xA0)}

URL = rf"http[^{WS_CLASS}]+|www[^{WS_CLASS}]+"
# Union of the reference's emoji ranges: {U+200D, U+231A, U+23CF, U+23E9} and U+24C2..U+10FFFF.
EMOJI = r"[\x{200D}\x{231A}\x{23CF}\x{23E9}\x{24C2}-\x{10FFFF}]+"
NON_LETTER = rf"[^a-zA-Z{WS_CLASS}]+"
BLANKS = rf"[{WS_CLASS}]+"
# Java tests a class's ranges one by one through nested calls, for every character. Characters below U+0100 that are listed
# one by one are a single table look-up, and a range that stands first in an intersection keeps the rest from being tested.
_HIGH_WS = r"\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_LOW_WS = {*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0}
_LOW_DROPPED = [i for i in range(0x100) if i not in _LOW_WS and not (i < 0x80 and chr(i).isalpha())]


def _listed(codes: Iterable[int]) -> str:
    return "".join(f"\\x{i:02X}" for i in sorted(codes))


# The same characters as NON_LETTER, EMOJI and BLANKS.
DROPPED = rf"[{_listed(_LOW_DROPPED)}[\x{{100}}-\x{{10FFFF}}&&[^{_HIGH_WS}]]]+"
EMOJI_RUN = r"[\x{200D}-\x{10FFFF}&&[\x{200D}\x{231A}\x{23CF}\x{23E9}\x{24C2}-\x{10FFFF}]]+"
BLANK_RUN = rf"[{_listed(_LOW_WS)}[\x{{1680}}-\x{{3000}}&&[{_HIGH_WS}]]]+"
# Blanks other than " " and "\n".
ODD_BLANK = rf"[{_listed(_LOW_WS - {0x0A, 0x20})}[\x{{1680}}-\x{{3000}}&&[{_HIGH_WS}]]]"
# One pass for all tokenizer splits: the first part of a split word, when followed by its rest.
# The first letters are tested before the word's edge, which is dearer.
TOKEN_SPLIT = "(?=[" + "".join(sorted({a[0] for _, a, _ in R.TOKEN_SPLITS})) + r"])\b(" + "|".join(
    f"{a}(?={b}\\b)" for _, a, b in R.TOKEN_SPLITS
) + r")"


def _quoted(text: str) -> str:
    """A string literal of Spark SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def contraction_regex(pattern: str) -> str:
    """Regex for a contraction rule; an apostrophe matches the straight and the curly one, "=" marks a whole word."""
    if pattern.startswith("="):
        edge = "" if pattern[1] == "'" else r"\b"
        return edge + contraction_regex(pattern[1:]) + r"\b"
    return "".join("['’]" if ch == "'" else re.escape(ch) for ch in pattern)


def _bound(c: Column, step) -> Column:
    """``step`` of a text that is worked out once, however often ``step`` names it."""
    return F.get(F.transform(F.array(c), step), F.lit(0))


def _holds(c: Column, triggers: Iterable[str]) -> Column:
    """Whether the text holds one of the substrings: a byte search."""
    return reduce(lambda a, b: a | b, [c.contains(t) for t in triggers])


def lower_text(c: Column) -> Column:
    """X1 + F14: non-string -> '' then lower-case."""
    return F.lower(F.coalesce(c.cast("string"), F.lit("")))


def strip_html(c: Column) -> Column:
    """HTML to text: comments, script/style blocks, tags, then character references."""
    def to_text(x: Column) -> Column:
        out = x
        for pattern in (HTML_COMMENT, HTML_SCRIPT, HTML_STYLE, HTML_TAG):
            out = F.regexp_replace(out, pattern, MARK)
        return F.replace(_bound(out, decode_entities), F.lit(MARK), F.lit(""))

    return _bound(c, lambda x: F.when(_holds(x, ("<", "&", MARK)), to_text(x)).otherwise(x))


def _string_table(entries: dict) -> Column:
    """A struct literal of two lists, each folded from one string. Not a map: Spark finds no two maps inside a literal equal, and
    then runs what stands twice in a plan (a shuffle of texts) twice."""
    keys, values = (F.split(F.lit("\u001f".join(x)), "\u001f") for x in zip(*entries.items()))
    return F.struct(keys.alias("keys"), values.alias("values"))


def _value_of(table: Column, key: Column) -> Column:
    """The value of a key in a string table, null without one."""
    return F.get(table["values"], F.array_position(table["keys"], key).cast("int") - 1)


def decode_entities(c: Column) -> Column:
    """Named and numeric character references, by longest prefix where ";" lacks; unknown ones stay as they are."""
    def char(digits: Column, base: int, numbers: Column) -> Column:
        significant = F.regexp_replace(digits, "^0+(?=.)", "")
        code = F.when(F.length(significant) <= 7, F.conv(significant, base, 10).cast("long")).otherwise(F.lit(0x110000))
        dropped = (code.between(0x1, 0x8) | (code == 0xB) | code.between(0xE, 0x1F) | code.between(0x7F, 0x9F)
                   | code.between(0xFDD0, 0xFDEF) | ((code % 0x10000) >= 0xFFFE))
        kept = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        other = (F.when(code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), F.lit("\ufffd"))
                 .when(dropped, F.lit("")).otherwise(kept))
        return F.coalesce(_value_of(numbers, code.cast("string")), other)

    def decoded(tables: Column) -> Column:
        names, numbers = tables["names"], tables["numbers"]

        def part(p: Column, i: Column) -> Column:
            number, hexed = F.regexp_extract(p, NUMBER, 1), F.regexp_extract(p, HEX_NUMBER, 1)
            full, bare = F.regexp_extract(p, NAMED, 1), F.regexp_extract(p, BARE_NAMED, 1)

            def rest(pattern: str) -> Column:
                return F.regexp_replace(p, pattern, "")

            # What begins no reference is told by its first character, before any pattern and table is tried.
            return (F.when(i == 0, p)
                    .when(~F.substring(p, 1, 1).rlike("[a-z0-9#]"), F.concat(F.lit("&"), p))
                    .when(hexed != "", F.concat(char(hexed, 16, numbers), rest(HEX_NUMBER)))
                    .when(number != "", F.concat(char(number, 10, numbers), rest(NUMBER)))
                    .when((full != "") & _value_of(names, full).isNotNull(), F.concat(_value_of(names, full), rest(NAMED)))
                    .when(bare != "", F.concat(_value_of(names, bare), rest(BARE_NAMED)))
                    .otherwise(F.concat(F.lit("&"), p)))

        return F.array_join(F.transform(F.split(c, "&"), part), "")

    # The tables stand in the plan once: a lambda over an array of one struct names them.
    tables = F.array(F.struct(_string_table(ENTITIES).alias("names"), _string_table({str(k): v for k, v in RENUMBERED.items()}).alias("numbers")))
    return F.when(c.contains("&"), F.get(F.transform(tables, decoded), F.lit(0))).otherwise(c)


def strip_urls(c: Column) -> Column:
    """X3."""
    return _bound(c, lambda x: F.when(_holds(x, ("http", "www")), F.regexp_replace(x, URL, "")).otherwise(x))


def strip_emoji(c: Column) -> Column:
    """X4."""
    return F.regexp_replace(c, EMOJI_RUN, "")


def expand_contractions(c: Column, rules: Iterable[tuple[int, str, str]] = R.CONTRACTIONS) -> Column:
    """Ordered rules; the rule table is tiny and fixed per job, so it unrolls into the plan.

    A rule's pattern and edges lie between two blanks, so the rules go over the pieces between blanks, and only over those
    with an apostrophe or one of the whole words.
    """
    ordered = sorted(rules)
    if any(" " in pattern for _, pattern, _ in ordered):
        raise ValueError("a contraction rule's pattern holds no blank")
    triggers = ("'", "’", *(p.removeprefix("=") for _, p, _ in ordered if "'" not in p))

    def piece(x: Column) -> Column:
        out = x
        for _, pattern, replacement in ordered:
            out = F.regexp_replace(out, contraction_regex(pattern), replacement)
        return F.when(_holds(x, triggers), out).otherwise(x)

    return _bound(c, lambda x: F.when(_holds(x, triggers), F.array_join(F.transform(F.split(x, " ", -1), piece), " ")).otherwise(x))


# A run of word characters and apostrophes is cut before each suffix of a contraction: "shouldn't've" -> should, n't, 've.
WORD_RUN = "[a-zA-Z0-9_'’]+"
RUN_CUT = "(?<=.)(?=n['’]t)|(?<=.)(?=['’](?!t))|(?<=[^n])(?=['’]t)"


def contraction_tables(rules: Iterable[tuple[int, str, str]] = R.CONTRACTIONS) -> tuple[dict[str, str], dict[str, str], dict[str, str]]:
    """(stem and suffix -> words, suffix -> words, whole word -> words) of the rules, with straight apostrophes."""
    cut = re.compile(RUN_CUT)
    pairs: dict[str, str] = {}
    singles: dict[str, str] = {}
    words: dict[str, str] = {}
    for _, pattern, replacement in sorted(rules):
        parts = cut.split(pattern.removeprefix("="))
        if len(parts) == 2:
            pairs[" ".join(parts)] = replacement
        elif "'" in pattern:
            singles[parts[0]] = replacement.strip()
        else:
            words[parts[0]] = replacement
    return pairs, singles, words


def expand_words(c: Column, rules: Iterable[tuple[int, str, str]] = R.CONTRACTIONS) -> Column:
    """X5 in one pass: each candidate word is cut into stem and suffixes, and the longest entry of the rule table wins.

    A stem with its suffix ("wo n't") goes before the suffix alone ("n't"); what is in no table stays. The
    result has single blanks, which is all that the tokenizer needs.
    """
    pairs, singles, words = contraction_tables(rules)

    def table(entries: dict[str, str]) -> Column:
        return F.expr("map(" + ", ".join(f"{_quoted(k)}, {_quoted(v)}" for k, v in (entries or {"": ""}).items()) + ")")

    pair_of, single_of, word_of = table(pairs), table(singles), table(words)

    def word(run: Column) -> Column:
        parts = F.split(F.regexp_replace(run, "’", "'"), RUN_CUT)

        def part(p: Column, i: Column) -> Column:
            after = F.try_element_at(pair_of, F.concat_ws(" ", p, F.get(parts, i + 1)))
            before = F.try_element_at(pair_of, F.concat_ws(" ", F.get(parts, i - 1), p))
            suffix = F.try_element_at(single_of, p)
            return (F.when(after.isNotNull(), after).when(before.isNotNull(), F.lit(""))
                    .when(suffix.isNotNull(), F.concat(F.lit(" "), suffix)).otherwise(p))

        return F.coalesce(F.try_element_at(word_of, run), F.array_join(F.transform(parts, part), ""))

    def run_or_rest(piece: Column) -> Column:
        candidate = piece.rlike("^[a-zA-Z0-9_'’]") & (piece.contains("'") | piece.contains("’") | piece.isin(*words))
        return F.when(candidate, word(piece)).otherwise(piece)

    pieces = F.regexp_extract_all(c, F.lit(f"(?s){WORD_RUN}|[^a-zA-Z0-9_'’]+"), F.lit(0))
    return F.array_join(F.transform(pieces, run_or_rest), "")


def keep_letters(c: Column) -> Column:
    """Everything but ASCII letters and blanks is deleted (not replaced by a blank)."""
    return F.regexp_replace(c, DROPPED, "")


def tokenize(c: Column) -> Column:
    """Letters-only text -> tokens, with the word tokenizer's whole-word splits."""
    split_words = F.regexp_replace(c, TOKEN_SPLIT, "$1 ")
    return F.filter(F.split(split_words, BLANK_RUN), lambda t: t != F.lit(""))


def remove_stopwords(tokens: Column, stopwords: Iterable[str] = R.STOPWORDS) -> Column:
    """Order and repeats kept (``array_except`` would dedupe).

    ``isin`` over a literal list becomes a hash-set lookup (InSet) in the optimizer.
    """
    words = list(stopwords)
    if not words:
        return tokens
    return F.filter(tokens, lambda t: ~t.isin(words))


def pre_clean(c: Column) -> Column:
    """X1-X6 on one text column: the string that the tokenizer sees."""
    out = lower_text(c)
    out = strip_html(out)
    out = strip_urls(out)
    out = strip_emoji(out)
    out = expand_contractions(out)
    return keep_letters(out)


def clean_tokens(c: Column, stopwords: Iterable[str] = R.STOPWORDS) -> Column:
    """Tokens before lemmas."""
    return remove_stopwords(tokenize(pre_clean(c)), stopwords)


def _guarded(df: DataFrame, col: str, triggers: tuple[str, ...], step) -> DataFrame:
    """Apply ``step`` only to rows whose text holds one of the trigger substrings.

    The step is a chain of regex passes that can only change text containing a trigger, so
    the cheap byte search skips it for most rows. Each step is its own projection: the input
    column is referenced three times, so Catalyst keeps it as a separate projection instead of
    inlining (and re-evaluating) the expression below it.
    """
    c = F.col(col)
    return df.withColumn(col, F.when(_holds(c, triggers), step(c)).otherwise(c))


def add_clean_tokens(df: DataFrame, src: str, dst: str, stopwords: Iterable[str] = R.STOPWORDS) -> DataFrame:
    """X1-X8 as staged projections on a DataFrame: the tokens of :func:`clean_tokens`, faster."""
    t = f"{dst}__text"
    df = df.withColumn(t, lower_text(F.col(src)))
    df = _guarded(df, t, ("<", "&"), strip_html)
    df = _guarded(df, t, ("http", "www"), strip_urls)
    df = df.withColumn(t, strip_emoji(F.col(t)))
    df = _guarded(df, t, ("'", "’", *R.SLANG), expand_words)
    df = df.withColumn(t, keep_letters(F.col(t)))
    df = _guarded(df, t, tuple(w for w, _, _ in R.TOKEN_SPLITS),
                  lambda c: F.regexp_replace(c, TOKEN_SPLIT, "$1 "))
    # Only letters and blanks are left. Cut at " ", no pattern is compiled and run for each text.
    df = df.withColumn(t, F.replace(F.col(t), F.lit("\n"), F.lit(" ")))
    df = df.withColumn(t, F.when(F.col(t).rlike(ODD_BLANK), F.regexp_replace(t, BLANK_RUN, " ")).otherwise(F.col(t)))
    kept = ", ".join(_quoted(w) for w in ("", *stopwords))
    return df.withColumn(dst, F.expr(f"filter(split({t}, ' '), x -> x not in ({kept}))")).drop(t)


def join_tokens(tokens: Column) -> Column:
    """X10."""
    return F.array_join(tokens, " ")


def ngram_tokens(text: Column, stopwords: Iterable[str] = R.STOPWORDS) -> Column:
    """tokens the dashboard counts: lower-case, word-tokenized, alphabetic, no stopword.

    The input is cleaned text (letters and blanks only), so the alphabetic test keeps every
    token; it is still applied so any text column can be passed.
    """
    words = list(stopwords)
    splits = tuple(w for w, _, _ in R.TOKEN_SPLITS)

    def plain(c: Column) -> Column:
        """Of letters and single blanks only: cut at " ", no pattern is tried on each token."""
        c = F.when(_holds(c, splits), F.regexp_replace(c, TOKEN_SPLIT, "$1 ")).otherwise(c)
        return F.filter(F.split(c, " "), lambda t: ~t.isin("", *words))

    def any_text(c: Column) -> Column:
        return F.filter(tokenize(c), lambda t: t.rlike("^[A-Za-z]+$") & ~t.isin(words))

    return _bound(F.lower(text), lambda c: F.when(c.rlike("^[a-z ]*$"), plain(c)).otherwise(any_text(c)))


def bigrams(tokens: Column) -> Column:
    """Adjacent pairs inside one token list (empty for fewer than two tokens)."""
    return F.transform(
        F.slice(tokens, 1, F.greatest(F.size(tokens) - 1, F.lit(0))),
        lambda t, i: F.concat_ws(" ", t, F.element_at(tokens, i + 2)),
    )
