"""One registered query for each operator: it applies the operator to the whole table and derives the digests."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentimart.llm import collocations, decontaminate, licenses, minhash_dedup, ngram_join, pieces, pii, spelling, suffix_dedup, token_counts, topk, toxicity, url_filter
from sentimart.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@_query("op2_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


@_query("op10_sentencepiece")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(pieces.encode_decode(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")))


@_query("op9_pii")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_* and base_sha256 tell of the base spans, spans and n_added of what the method adds to them."""
    found = pii.find_pii(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        "doc_id",
        *[pii.count_of(base, k).alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(pii.digest(base), 256).alias("base_sha256"),
        pii.digest(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size(base)).cast("long").alias("n_added"),
    )


#: (verdict, host, path) of the rules.
URL_RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))


def _shrunk_sql(level: str, keys: str, parent: str, on: str) -> str:
    """A level (keys, n, k) with prior m: its prior weight by moments, then a, b and mean."""
    return f"""
{level}_p AS (SELECT {keys}, n, k, m FROM {level} JOIN {parent} ON {on}),
{level}_w AS (
  SELECT coalesce(1 / greatest(1 / 1001.0, least(0.5, (spread - noise) / greatest(room - noise, 1e-9))) - 1, 1000.0) AS w
  FROM (SELECT sum(n * (k::DOUBLE / n - m) * (k::DOUBLE / n - m)) AS spread, sum(m * (1 - m)) AS noise, sum(n * m * (1 - m)) AS room FROM {level}_p WHERE n > 0)
),
{level}_r AS (SELECT {keys.replace(level + '.', '')}, k + w * m AS a, n - k + w * (1 - m) AS b, (k + w * m) / (n + w) AS m FROM {level}_p, {level}_w)"""


OP6_SQL = rf"""
WITH lab AS (SELECT doc_id, min(quality) AS good FROM labels GROUP BY doc_id),
p AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path,
    try_cast(regexp_extract(url, '://[^/?#]*/[a-z]+/([0-9]+)', 1) AS BIGINT) AS number
  FROM pages
),
l AS (SELECT p.*, good FROM p LEFT JOIN lab ON number = doc_id),
c AS (SELECT host, string_split(host, '.') AS parts, count(good) AS n, coalesce(sum(good), 0) AS k FROM l GROUP BY host),
t AS (SELECT *, array_to_string(parts[-2:], '.') IN ({", ".join(f"'{x}'" for x in url_filter.TWO_LABEL_SUFFIXES)}) AS two FROM c),
h AS (SELECT host, n, k, array_to_string(CASE WHEN two THEN parts[-2:] ELSE parts[-1:] END, '.') AS suffix, array_to_string(CASE WHEN two THEN parts[-3:] ELSE parts[-2:] END, '.') AS domain FROM t),
d AS (SELECT suffix, domain, sum(n) AS n, sum(k) AS k FROM h GROUP BY ALL),
s AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM d GROUP BY ALL),
g AS (SELECT (sum(k) + 1) / (sum(n) + 2)::DOUBLE AS m FROM s),
{_shrunk_sql("s", "s.suffix", "g", "true")},
{_shrunk_sql("d", "d.suffix, d.domain", "s_r", "d.suffix = s_r.suffix")},
{_shrunk_sql("h", "h.host", "d_r", "h.suffix = d_r.suffix AND h.domain = d_r.domain")},
judged AS (
  SELECT l.page_id, l.host, l.path, m, least(1.0, m + {url_filter.Z} * sqrt(m * (1 - m) / (a + b + 1))) AS bound,
    CASE {" ".join(f"WHEN (l.host = '{h}' OR l.host LIKE '%.{h}') AND starts_with(l.path, '{p}') THEN '{h}{p}:{what}'" for what, h, p in sorted(URL_RULES, key=lambda r: -len(r[1] + r[2])))} END AS won
  FROM l JOIN h_r ON l.host = h_r.host
)
SELECT page_id, host, path, split_part(won, ':', 1) AS rule, coalesce(split_part(won, ':', 2), CASE WHEN bound < 0.5 THEN 'block' ELSE 'allow' END) AS verdict, round(m, 6) AS good_rate
FROM judged
"""


@_query("op6_url_filters", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcome is the quality label of the document whose number its path gives (/lang/number)."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    labels = _table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min("quality").alias("good"))
    number = F.expr("try_cast(regexp_extract(url, '://[^/?#]*/[a-z]+/([0-9]+)', 1) as bigint)")
    labelled = pages.withColumn("number", number).join(labels, F.col("number") == F.col("doc_id"), "left")
    return url_filter.judge_urls(labelled, URL_RULES, "good").select("page_id", "host", "path", "rule", "verdict", F.round("good_rate", 6).alias("good_rate"))


def _canonical_sql(text: str) -> str:
    out = f"trim(regexp_replace(lower(regexp_replace({text}, {_quoted(licenses._COPYRIGHT_LINE.replace('(?imd)', '(?im)'))}, ' ', 'g')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
    for a, b in licenses.SPELLINGS:
        out = f"replace({out}, {_quoted(a)}, {_quoted(b)})"
    return out


OP5_SQL = f"""
WITH known AS (
  SELECT sha256({_canonical_sql("t")}) AS d, min(id) AS id FROM (VALUES {", ".join(f"({_quoted(i)}, {_quoted(t)})" for i, t in licenses.NOTICES)}) AS v(id, t) GROUP BY 1
),
forms AS (SELECT doc_id, {_canonical_sql("text")} AS form FROM documents),
lines AS (SELECT DISTINCT doc_id, {_canonical_sql("line")} AS form FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)),
hits AS (SELECT doc_id, array_to_string(list_sort(list(DISTINCT id)), ',') AS ids FROM lines JOIN known ON sha256(form) = d GROUP BY doc_id)
SELECT f.doc_id, CASE WHEN form <> '' THEN sha256(form) END AS digest, known.id AS text_license, coalesce(ids, '') AS line_licenses
FROM forms f LEFT JOIN known ON form <> '' AND sha256(form) = d LEFT JOIN hits ON hits.doc_id = f.doc_id
"""


@_query("op5_license_scans", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(_table(spark, sf_dir, "documents"), licenses.known_notices(spark))
    return found.select("doc_id", "digest", "text_license", F.array_join("line_licenses", ",").alias("line_licenses"))


def _template_sql(name: str, source: str, key: str) -> str:
    """Steps that give (key, at, tokens, vals) for each window of a table's texts; a shorter text is one window at -1."""
    units = ", ".join(map(_quoted, decontaminate.UNITS))
    number = "substring({0}, 1, 1) BETWEEN '0' AND '9'".format
    return f"""
{name}_w AS (SELECT {key}, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words FROM {source}),
{name}_b AS (SELECT *, list_transform(words, lambda w: trim(w, {_quoted(decontaminate.PUNCTUATION)})) AS bares FROM {name}_w),
{name}_t AS (
  SELECT {key}, list_transform(bares, lambda b: lower(b)) AS vals, list_transform(bares, lambda b, i: CASE
    WHEN {number("b")} THEN '<num>'
    WHEN lower(b) = b THEN CASE WHEN b IN ({units}) AND i > 1 AND {number("bares[i - 1]")} THEN '<unit>' ELSE b END
    WHEN i > 1 AND right(words[i - 1], 1) NOT IN ('.', '!', '?', ':') AND substring(b, 1, 1) <> substring(lower(b), 1, 1) THEN '<name>'
    ELSE lower(b) END) AS tokens
  FROM {name}_b
),
{name} AS (
  SELECT {key}, place, tokens[place:place + {decontaminate.WINDOW - 1}] AS tokens, vals[place:place + {decontaminate.WINDOW - 1}] AS vals
  FROM (SELECT *, unnest(range(1, len(tokens) - {decontaminate.WINDOW - 2})) AS place FROM {name}_t WHERE len(tokens) >= {decontaminate.WINDOW})
  UNION ALL SELECT {key}, 1, tokens, vals FROM {name}_t WHERE len(tokens) BETWEEN 1 AND {decontaminate.WINDOW - 1}
)"""


_SLOTS = "len(list_distinct(list_filter(list_transform(d.tokens, lambda t, i: CASE WHEN t IN ('<num>', '<unit>', '<name>') THEN [t, {0}] END), lambda s: s IS NOT NULL)))".format
OP4_SQL = f"""
WITH {_template_sql("d", "documents", "doc_id")}, {_template_sql("m", "benchmark", "item_id")},
told AS (SELECT DISTINCT item_id, tokens, vals FROM m WHERE len(list_filter(tokens, lambda t: t NOT IN ('<num>', '<unit>', '<name>', ''))) >= least({decontaminate.LEXICAL}, len(tokens))),
met AS (
  SELECT doc_id, place, item_id FROM d JOIN told ON d.tokens = told.tokens
  WHERE {_SLOTS("d.vals[i], told.vals[i]")} = {_SLOTS("d.vals[i]")} AND {_SLOTS("d.vals[i], told.vals[i]")} = {_SLOTS("told.vals[i]")}
),
said AS (SELECT DISTINCT item_id, vals FROM m WHERE len(list_filter(vals, lambda v: v <> '')) > 0),
runs AS (
  SELECT doc_id, place, vals FROM d
  UNION ALL SELECT doc_id, place, vals[place:place + n - 1] FROM (
    SELECT doc_id, vals, n, unnest(range(1, len(vals) - n + 2)) AS place FROM (SELECT doc_id, vals, unnest(range({decontaminate.INSIDE}, {decontaminate.WINDOW})) AS n FROM d_t) WHERE len(vals) >= n)
),
both_ways AS (SELECT * FROM met UNION ALL SELECT doc_id, place, item_id FROM runs JOIN said ON runs.vals = said.vals),
leaks AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, count(DISTINCT place) AS n_windows, min(item_id) AS item FROM both_ways GROUP BY doc_id)
SELECT doc_id, coalesce(n_items, 0) AS n_items, coalesce(n_windows, 0) AS n_windows, item, n_windows IS NOT NULL AS contaminated
FROM documents LEFT JOIN leaks USING (doc_id)
"""


@_query("op4_benchmark_decontamination", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


OP7_SQL = """
WITH v AS (
  SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.id AS query_id, b.id AS vec_id, CAST(list_dot_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.id <> b.id WHERE a.id % 20 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@_query("op7_exact_top_k", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


@_query("op8_suffix_array_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), length=50)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def _classes_sql(width: int, percent: int, more: str = "") -> str:
    """Words, shingles, links and their closure, each by its definition."""
    shingle = " || ' ' || ".join(f"words[i + {j}]" if j else "words[i]" for j in range(width))
    return rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN []
    WHEN len(words) < {width} THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - {width - 2}), lambda i: {shingle})) END AS sh
  FROM w
), e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS an, b.n AS bn, count(*) AS i FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs WHERE 100 * i >= {percent} * (an + bn - i)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, m.c AS component_id{more}
FROM s JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) m ON s.doc_id = m.a
"""


@_query("op1_ngram_jaccard_join", _classes_sql(3, 90))
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_classes(_table(spark, sf_dir, "documents"), width=3, percent=90).select("doc_id", "n_shingles", "component_id")


@_query("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@_query("op13_minhash_near_dedup", _classes_sql(4, 80, ", s.doc_id = m.c AS kept"))
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"), width=4, percent=80)


@_query("op11_spelling_variants")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(_table(spark, sf_dir, "documents"))


def _phrases_sql() -> str:
    """Every phrase of one to four words with its count, then cuts, subsumption and ranks by their definitions."""
    grams = " UNION ALL ".join(f"SELECT lang, ws[i : i + {size - 1}] AS p FROM (SELECT lang, ws, unnest(range(1, len(ws) - {size - 2})) AS i FROM w WHERE len(ws) >= {size})" for size in range(1, 5))
    return rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS piece
  FROM documents
), w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ 	]+'), lambda x: x <> '') AS ws FROM pieces),
total AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
f AS (SELECT lang, p, count(*) AS f FROM ({grams}) GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, p, f AS a FROM f WHERE len(p) > 1),
inner_of AS (
  SELECT lang, p[i : i + s - 1] AS p, max(a) AS around
  FROM (SELECT lang, p, a, s, unnest(range(1, len(p) - s + 2)) AS i FROM (SELECT lang, p, a, unnest(range(2, len(p))) AS s FROM c WHERE len(p) > 2))
  GROUP BY ALL
),
kept AS (SELECT c.* FROM c LEFT JOIN inner_of USING (lang, p) WHERE around IS NULL OR 100 * around::HUGEINT < 80 * a::HUGEINT),
cuts AS (SELECT lang, p, a, k, p[1 : k] AS x, p[k + 1 :] AS y FROM (SELECT lang, p, a, unnest(range(1, len(p))) AS k FROM kept)),
scored AS (
  SELECT cuts.*, x.f AS l, y.f AS r, (2000000 * a::HUGEINT) // (x.f + y.f) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.p = cuts.x JOIN f y ON y.lang = cuts.lang AND y.p = cuts.y
),
low AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score
FROM (SELECT *, array_to_string(p, ' ') AS phrase, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank FROM low) JOIN total USING (lang)
WHERE rank <= 2000
"""


@_query("op12_phrase_collocations", _phrases_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))
