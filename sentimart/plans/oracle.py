"""DuckDB SQL for the oracle check: the same results written as plain SQL over the driver views.

The text chain is generated from the same pattern constants as the Spark chain (the patterns
are valid RE2 and Java regex with one meaning), but the plan is the naive one: unnest every
token, left join the lemma/lexicon table, and re-aggregate with ``string_agg ... ORDER BY``.
"""

from __future__ import annotations

from sentimart import resources as R
from sentimart.functions import text as TF
from sentimart.sources import tables as ST


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def lit(v) -> str:
    if v is None:
        return "NULL"
    return q(v) if isinstance(v, str) else repr(v)


def values(rows, cols: str) -> str:
    body = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)
    return f"(SELECT * FROM (VALUES {body}) t({cols}))"


def str_list(words) -> str:
    return "[" + ", ".join(q(w) for w in words) + "]"


def ts(literal: str) -> str:
    return f"TIMESTAMP {q(literal)}"


# ------------------------------------------------------------------------------ views
RAW_REVIEWS = f"""SELECT doc_id AS raw_id, source AS app_name, md5(text) AS review_id,
  CAST(1 + n_chars % 5 AS INT) AS rating,
  {ts(ST.REVIEW_EPOCH)} + to_hours(CAST((doc_id*37) % 8760 AS INT)) AS review_ts,
  text AS review_text
FROM documents"""

DIRTY_REVIEWS = """SELECT raw_id,
  CASE WHEN raw_id % 53 = 0 THEN NULL WHEN raw_id % 50 = 0 THEN ' ' ELSE app_name END AS app_name,
  CASE WHEN raw_id % 41 = 0 THEN NULL ELSE review_id END AS review_id,
  CAST(CASE WHEN raw_id % 43 = 0 THEN NULL ELSE length(review_text) % 7 END AS INT) AS rating,
  review_ts, CASE WHEN raw_id % 47 = 0 THEN '  ' ELSE review_text END AS review_text
FROM raw_reviews"""

GOLDEN = values(R.GOLDEN_TEXT, "raw_id, review_text")


# ------------------------------------------------------------------------------ text chain
def lower_text(x: str) -> str:
    return f"lower(coalesce(CAST({x} AS VARCHAR), ''))"


def rx(x: str, pattern: str, repl: str = "") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(repl)}, 'g')"


def strip_html(x: str) -> str:
    mark = f"chr({ord(TF.MARK)})"
    out = x
    for pattern in (TF.HTML_COMMENT, TF.HTML_SCRIPT, TF.HTML_STYLE, TF.HTML_TAG):
        out = f"regexp_replace({out}, {q(pattern)}, {mark}, 'g')"
    table = "MAP {" + ", ".join(f"'{k}': {' || '.join(f'chr({ord(c)})' for c in v)}" for k, v in TF.ENTITIES.items()) + "}"
    numbers = "MAP {" + ", ".join(f"{k}: chr({ord(v)})" for k, v in TF.RENUMBERED.items()) + "}"

    def extract(pattern: str) -> str:
        return f"regexp_extract(p, {q(pattern)}, 1)"

    def rest(pattern: str) -> str:
        return f"regexp_replace(p, {q(pattern)}, '')"

    def char(code: str) -> str:
        return (f"(CASE WHEN {code} IS NULL THEN chr(65533) WHEN map_contains({numbers}, {code}) THEN {numbers}[{code}] "
                f"WHEN {code} BETWEEN 55296 AND 57343 OR {code} > 1114111 THEN chr(65533) "
                f"WHEN {code} BETWEEN 1 AND 8 OR {code} = 11 OR {code} BETWEEN 14 AND 31 OR {code} BETWEEN 127 AND 159 "
                f"OR {code} BETWEEN 64976 AND 65007 OR {code} % 65536 >= 65534 THEN '' ELSE chr({code}) END)")

    hexed, number, full, bare = (extract(r) for r in (TF.HEX_NUMBER, TF.NUMBER, TF.NAMED, TF.BARE_NAMED))
    part = (f"CASE WHEN i = 1 THEN p "
            f"WHEN {hexed} <> '' THEN {char(f'TRY_CAST(concat(chr(48), chr(120), {hexed}) AS INT)')} || {rest(TF.HEX_NUMBER)} "
            f"WHEN {number} <> '' THEN {char(f'TRY_CAST({number} AS INT)')} || {rest(TF.NUMBER)} "
            f"WHEN map_contains({table}, {full}) THEN {table}[{full}] || {rest(TF.NAMED)} "
            f"WHEN {bare} <> '' THEN {table}[{bare}] || {rest(TF.BARE_NAMED)} ELSE '&' || p END")
    return f"(CASE WHEN contains({out}, '&') THEN replace(array_to_string(list_transform(string_split({out}, '&'), lambda p, i: {part}), ''), {mark}, '') ELSE replace({out}, {mark}, '') END)"


def strip_urls(x: str) -> str:
    return rx(x, TF.URL)


def strip_emoji(x: str) -> str:
    return rx(x, TF.EMOJI)


def expand_contractions(x: str) -> str:
    out = x
    for _, pattern, replacement in sorted(R.CONTRACTIONS):
        out = rx(out, TF.contraction_regex(pattern), replacement)
    return out


def keep_letters(x: str) -> str:
    return rx(x, TF.NON_LETTER)


def pre_clean(x: str) -> str:
    return keep_letters(expand_contractions(strip_emoji(strip_urls(strip_html(lower_text(x))))))


def tokenize(x: str) -> str:
    out = x
    for word, a, b in R.TOKEN_SPLITS:
        out = rx(out, rf"\b{word}\b", f"{a} {b}")
    return f"list_filter(string_split_regex({out}, {q(TF.BLANKS)}), lambda t: t <> '')"


def remove_stopwords(toks: str, stopwords=R.STOPWORDS) -> str:
    return f"list_filter({toks}, lambda t: NOT list_contains({str_list(stopwords)}, t))"


def clean_tokens(x: str) -> str:
    return remove_stopwords(tokenize(pre_clean(x)))


def ngram_tokens(x: str) -> str:
    toks = tokenize(f"lower({x})")
    return (f"list_filter({toks}, lambda t: regexp_full_match(t, '[A-Za-z]+') "
            f"AND NOT list_contains({str_list(R.STOPWORDS)}, t))")


def compound(vsum: str) -> str:
    s = f"coalesce({vsum}, 0.0)"
    return f"round(greatest(least({s} / sqrt({s} * {s} + {R.VADER_ALPHA}), 1.0), -1.0), 4)"


def label(score: str) -> str:
    return (f"CASE WHEN {score} >= {R.POSITIVE_THRESHOLD} THEN 'Positive' "
            f"WHEN {score} <= {R.NEGATIVE_THRESHOLD} THEN 'Negative' ELSE 'Neutral' END")


def vader_ctes(p: str) -> list[tuple[str, str]]:
    """CTEs from ``{p}_mark`` (raw_id, pos, word, valence) of all occurrences to ``{p}_vsum`` (raw_id, vsum).

    Every neighbour is a self join on (document, position).
    """
    from sentimart.operators.score import DAMPING, WINDOWS
    joins = " ".join(f"LEFT JOIN {p}_mark m{k} ON m{k}.raw_id = h.raw_id AND m{k}.pos = h.pos + {k}".replace("m-", "b").replace("+ -", "- ")
                     for k in (-3, -2, -1, 1, 2))
    cols = ["h.raw_id", "h.pos", "h.word AS w0", "h.valence"]
    cols += [f"b{k}.word AS l{k}, b{k}.valence IS NOT NULL AS known{k}, coalesce(s{k}.scalar, 0.0) * {DAMPING[k - 1]!r} AS add{k}, "
             f"b{k}.word IN (SELECT token FROM {p}_neg) AS neg{k}" for k in (1, 2, 3)]
    cols += ["m1.word AS r1", "m2.word AS r2"]
    scal = " ".join(f"LEFT JOIN {p}_boost s{k} ON s{k}.token = b{k}.word" for k in (1, 2, 3))
    doubt = {1: "false", 2: "(l2 = 'without' AND l1 = 'doubt')", 3: "(l3 = 'without' AND (l2 = 'doubt' OR l1 = 'doubt'))"}
    out = [
        (f"{p}_boost", values(R.BOOSTER_SEED, "token, scalar")),
        (f"{p}_neg", values([(w,) for w in R.NEGATOR_SEED], "token")),
        (f"{p}_phr", values(R.PHRASE_SEED, "phrase, valence")),
        (f"{p}_v0", f"""SELECT {', '.join(cols)} FROM {p}_mark h {joins} {scal}
WHERE h.valence IS NOT NULL AND h.word NOT IN (SELECT token FROM {p}_boost)"""),
    ]
    prev = "valence"
    for k in (1, 2, 3):
        moved = f"({prev} + CASE WHEN {prev} < 0 THEN -add{k} ELSE add{k} END)"
        out.append((f"{p}_v{k}", f"""SELECT *, CASE WHEN pos < {k} OR known{k} THEN {prev}
WHEN coalesce(neg{k}, false) AND NOT coalesce({doubt[k]}, false) THEN {moved} * {R.NEGATION_SCALAR!r} ELSE {moved} END AS x{k} FROM {p}_v{k - 1}"""))
        prev = f"x{k}"
    word = {-3: "l3", -2: "l2", -1: "l1", 0: "w0", 1: "r1", 2: "r2"}
    found = ", ".join(f"(SELECT valence FROM {p}_phr WHERE phrase = {' || chr(32) || '.join(word[o] for o in w)})" for w in WINDOWS)
    out.append((f"{p}_v4", f"SELECT *, CASE WHEN pos >= 3 AND NOT known3 THEN coalesce({found}, x3) ELSE x3 END AS x4 FROM {p}_v3"))
    out.append((f"{p}_vsum", f"""SELECT raw_id, sum(x4 * CASE WHEN l1 = 'least' AND NOT known1 AND NOT coalesce(l2 IN ('at', 'very'), false)
  THEN {R.NEGATION_SCALAR!r} ELSE 1.0 END) AS vsum FROM {p}_v4 GROUP BY raw_id"""))
    return out


def year_month(x: str) -> str:
    return f"CAST(date_trunc('month', {x}) AS DATE)"


# ------------------------------------------------------------------------------ processing CTEs
def lemma_ctes(prefix: str, docs: str) -> list[tuple[str, str]]:
    """CTEs from a docs relation (raw_id, toks) to ``{prefix}_lem`` (raw_id, cleaned_text,
    word_count, vsum)."""
    cand_structs = ["{'ord': 0, 'cand': token}"]
    for i, (suffix, repl) in enumerate(R.NOUN_SUFFIX_RULES, start=1):
        cand_structs.append(
            f"{{'ord': {i}, 'cand': CASE WHEN suffix(token, {q(suffix)}) "
            f"THEN left(token, length(token) - {len(suffix)}) || {q(repl)} END}}"
        )
    p = prefix
    return [
        (f"{p}_occ", f"SELECT raw_id, unnest(toks) AS token, unnest(range(len(toks))) AS pos FROM {docs}"),
        (f"{p}_vocab", f"SELECT DISTINCT token FROM {p}_occ"),
        (f"{p}_cand", f"""SELECT token, struct_extract(c, 'ord') AS ord, struct_extract(c, 'cand') AS cand
FROM (SELECT token, unnest([{', '.join(cand_structs)}]) AS c FROM {p}_vocab)
WHERE struct_extract(c, 'cand') IS NOT NULL AND struct_extract(c, 'cand') <> ''"""),
        (f"{p}_rule", f"""SELECT token, cand AS lemma FROM {p}_cand
WHERE list_contains({str_list(R.DICTIONARY_SEED)}, cand)
QUALIFY row_number() OVER (PARTITION BY token ORDER BY length(cand), ord) = 1"""),
        (f"{p}_irr", f"SELECT token, lemma FROM {values(R.LEMMA_SEED, 'token, lemma')} "
                     f"WHERE token IN (SELECT token FROM {p}_vocab)"),
        (f"{p}_lm", f"""SELECT token, lemma FROM {p}_rule
WHERE lemma <> token AND token NOT IN (SELECT token FROM {p}_irr)
UNION ALL SELECT token, lemma FROM {p}_irr"""),
        (f"{p}_lex", values(R.LEXICON_SEED, "token, valence")),
        (f"{p}_tok", f"""SELECT v.token, m.lemma, x.valence FROM {p}_vocab v
LEFT JOIN {p}_lm m ON m.token = v.token
LEFT JOIN {p}_lex x ON x.token = coalesce(m.lemma, v.token)"""),
        (f"{p}_mark", f"SELECT o.raw_id, o.pos, coalesce(t.lemma, o.token) AS word, t.valence FROM {p}_occ o JOIN {p}_tok t ON t.token = o.token"),
        *vader_ctes(p),
        (f"{p}_agg", f"""SELECT raw_id, string_agg(word, ' ' ORDER BY pos) AS cleaned_text, count(*) AS word_count, sum(valence) AS lsum
FROM {p}_mark GROUP BY raw_id"""),
        (f"{p}_lem", f"SELECT a.*, v.vsum FROM {p}_agg a LEFT JOIN {p}_vsum v ON v.raw_id = a.raw_id"),
    ]


def processed_ctes(raw: str = "raw_reviews", name: str = "processed") -> list[tuple[str, str]]:
    """CTEs: raw relation -> ``name`` with the processed-table columns (no processed_at)."""
    p = name
    ctes = [
        (f"{p}_dedup", f"""SELECT * FROM {raw} WHERE app_name IS NOT NULL AND rating BETWEEN 1 AND 5
QUALIFY row_number() OVER (PARTITION BY coalesce(review_id, chr(0) || 'null:' || CAST(raw_id AS VARCHAR))
                           ORDER BY raw_id) = 1"""),
        (f"{p}_docs", f"SELECT *, {clean_tokens('review_text')} AS toks FROM {p}_dedup"),
    ]
    ctes += lemma_ctes(p, f"{p}_docs")
    ctes.append((p, f"""SELECT d.raw_id, d.app_name, d.review_id, d.rating, d.review_ts, d.review_text,
  coalesce(l.cleaned_text, '') AS cleaned_text, CAST(coalesce(l.word_count, 0) AS INT) AS word_count,
  {compound('l.vsum')} AS sentiment_score, {label(compound('l.vsum'))} AS sentiment,
  {year_month('d.review_ts')} AS year_month
FROM {p}_docs d LEFT JOIN {p}_lem l ON l.raw_id = d.raw_id"""))
    return ctes


def with_ctes(ctes: list[tuple[str, str]], body: str) -> str:
    if not ctes:
        return body
    parts = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in ctes)
    return f"WITH {parts}\n{body}"


BASE = [("raw_reviews", RAW_REVIEWS)]
DIRTY = BASE + [("dirty_reviews", DIRTY_REVIEWS)]
PROCESSED = BASE + processed_ctes()
