"""Queries for sources, scans and the text / sentiment steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentimart.functions import formats as FF
from sentimart.functions import sentiment as SF
from sentimart.functions import text as TF
from sentimart.operators import process as P
from sentimart.plans import oracle as O
from sentimart.plans.catalog import register
from sentimart.sources import feed as FD
from sentimart.sources import tables as ST

PROCESSED_COLS = ("raw_id, app_name, review_id, rating, review_ts, review_text, cleaned_text, "
                  "word_count, sentiment_score, sentiment, year_month")


def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The processed table, computed from raw_reviews (no processed_at column)."""
    return P.process_reviews(ST.raw_reviews(spark, sf_dir)).drop("processed_at")


# ------------------------------------------------------------------------------ scans
@register("scan_reviews", O.with_ctes(O.BASE, """SELECT app_name AS app, review_id AS "reviewId",
  CAST(NULL AS VARCHAR) AS "userName", CAST(NULL AS VARCHAR) AS "userImage", CAST(NULL AS VARCHAR) AS title,
  review_text AS content, rating AS score, CAST(NULL AS INT) AS "thumbsUpCount",
  CAST(NULL AS VARCHAR) AS "reviewCreatedVersion", review_ts AS at, CAST(NULL AS VARCHAR) AS "replyContent",
  CAST(NULL AS TIMESTAMP) AS "repliedAt", raw_id AS feed_pos FROM raw_reviews"""))
def scan_reviews(spark, sf_dir):
    """The review feed of all apps in one scan, in the source's record shape."""
    return ST.as_feed(ST.raw_reviews(spark, sf_dir))


@register("map_feed_record", O.with_ctes(O.BASE, f"""SELECT raw_id, app_name, review_id,
  CAST(NULL AS VARCHAR) AS user_name, CAST(NULL AS VARCHAR) AS user_image_url, rating, review_ts,
  CAST(NULL AS VARCHAR) AS review_title, review_text, CAST(NULL AS INT) AS thumbs_up,
  CAST(NULL AS VARCHAR) AS app_version, CAST(NULL AS VARCHAR) AS reply_text,
  CAST(NULL AS TIMESTAMP) AS replied_ts, {O.ts(ST.RUN_TS)} AS scraped_ts FROM raw_reviews"""))
def map_feed_record(spark, sf_dir):
    """S3: feed record -> raw row (renames, app name, scrape time)."""
    feed = ST.as_feed(ST.raw_reviews(spark, sf_dir))
    return FD.map_feed_record(feed, scraped_at=ST.RUN_TS).drop("ingested_at")


@register("scan_raw", O.with_ctes(O.BASE, "SELECT * FROM raw_reviews"))
def scan_raw(spark, sf_dir):
    """Full scan of the raw table."""
    return ST.raw_reviews(spark, sf_dir)


@register("scan_processed", O.with_ctes(O.PROCESSED, f"SELECT {PROCESSED_COLS} FROM processed"))
def scan_processed(spark, sf_dir):
    """S5 + the whole transform stage: raw -> processed."""
    return processed(spark, sf_dir)


# ------------------------------------------------------------------------------ text steps
GOLDEN_DOCS = [("golden_docs", f"""SELECT doc_id AS raw_id, text AS review_text FROM documents
UNION ALL SELECT raw_id, review_text FROM {O.GOLDEN}""")]


def _golden(spark, sf_dir):
    return ST.reviews_with_golden(spark, sf_dir)


def _step_sql(expr: str) -> str:
    return O.with_ctes(GOLDEN_DOCS, f"SELECT raw_id, {expr} AS text FROM golden_docs")


_LOW = O.lower_text("review_text")
_HTML = O.strip_html(_LOW)
_URL = O.strip_urls(_HTML)
_EMO = O.strip_emoji(_URL)
_CON = O.expand_contractions(_EMO)
_LET = O.keep_letters(_CON)


@register("strip_html", O.with_ctes([], f"SELECT page_id, {O.strip_html(O.lower_text('html'))} AS text FROM pages"))
def strip_html(spark, sf_dir):
    """X2 on raw web pages: lower-case, then comments, script/style, tags, entities."""
    pages = ST.table(spark, sf_dir, "pages")
    return pages.select("page_id", TF.strip_html(TF.lower_text(F.col("html"))).alias("text"))


@register("strip_urls", _step_sql(_URL))
def strip_urls(spark, sf_dir):
    """X1-X3."""
    c = TF.strip_urls(TF.strip_html(TF.lower_text(F.col("review_text"))))
    return _golden(spark, sf_dir).select("raw_id", c.alias("text"))


@register("strip_emoji", _step_sql(_EMO))
def strip_emoji(spark, sf_dir):
    """X1-X4."""
    c = TF.strip_emoji(TF.strip_urls(TF.strip_html(TF.lower_text(F.col("review_text")))))
    return _golden(spark, sf_dir).select("raw_id", c.alias("text"))


@register("expand_contractions", _step_sql(_CON))
def expand_contractions(spark, sf_dir):
    """X1-X5."""
    c = TF.expand_contractions(TF.strip_emoji(TF.strip_urls(TF.strip_html(TF.lower_text(F.col("review_text"))))))
    return _golden(spark, sf_dir).select("raw_id", c.alias("text"))


def _listed_tokens(docs: DataFrame) -> DataFrame:
    """The tokens, a column of their own that is made once, joined by a blank, and their count."""
    return docs.select("raw_id", F.array_join("toks", " ").alias("tokens"), F.size("toks").cast("int").alias("n_tokens"))


@register("tokenize", O.with_ctes(GOLDEN_DOCS, f"""SELECT raw_id, array_to_string(toks, ' ') AS tokens,
  CAST(len(toks) AS INT) AS n_tokens FROM (SELECT raw_id, {O.tokenize(_LET)} AS toks FROM golden_docs)"""))
def tokenize(spark, sf_dir):
    """Tokens, joined by a blank, and their count."""
    toks = TF.tokenize(TF.pre_clean(F.col("review_text")))
    return _listed_tokens(_golden(spark, sf_dir).select("raw_id", toks.alias("toks")))


@register("remove_stopwords", O.with_ctes(GOLDEN_DOCS, f"""SELECT raw_id, array_to_string(toks, ' ') AS tokens,
  CAST(len(toks) AS INT) AS n_tokens FROM (SELECT raw_id, {O.clean_tokens('review_text')} AS toks FROM golden_docs)"""))
def remove_stopwords(spark, sf_dir):
    """X1-X8."""
    toks = TF.clean_tokens(F.col("review_text"))
    return _listed_tokens(_golden(spark, sf_dir).select("raw_id", toks.alias("toks")))


_GOLDEN_TOKS = GOLDEN_DOCS + [("g_docs", f"SELECT raw_id, {O.clean_tokens('review_text')} AS toks FROM golden_docs")]
_GOLDEN_LEM = _GOLDEN_TOKS + O.lemma_ctes("g", "g_docs")


@register("lemmatize", O.with_ctes(_GOLDEN_LEM, """SELECT v.token, m.lemma FROM g_vocab v JOIN g_lm m ON m.token = v.token"""))
def lemmatize(spark, sf_dir):
    """The lemma map (token -> lemma, changed tokens only) over the corpus vocabulary."""
    from sentimart.operators.lemmas import lemma_map
    from sentimart import resources as R
    docs = P.tokenized(_golden(spark, sf_dir))
    vocab = P.token_occurrences(docs).select("token").distinct()
    return lemma_map(vocab, R.lemmas_df(spark))


@register("clean_text", O.with_ctes(_GOLDEN_LEM, """SELECT d.raw_id, coalesce(l.cleaned_text, '') AS cleaned_text
FROM g_docs d LEFT JOIN g_lem l ON l.raw_id = d.raw_id"""))
def clean_text(spark, sf_dir):
    """The cleaned text of every document and golden row."""
    return P.clean_text_only(_golden(spark, sf_dir)).select("raw_id", "cleaned_text")


@register("word_count", O.with_ctes(_GOLDEN_LEM, """SELECT d.raw_id, CAST(coalesce(l.word_count, 0) AS INT) AS word_count
FROM g_docs d LEFT JOIN g_lem l ON l.raw_id = d.raw_id"""))
def word_count(spark, sf_dir):
    """X11: words of the cleaned text."""
    return P.clean_text_only(_golden(spark, sf_dir)).select("raw_id", "word_count")


@register("sentiment_score", O.with_ctes(_GOLDEN_LEM, f"""SELECT d.raw_id, {O.compound('l.vsum')} AS sentiment_score
FROM g_docs d LEFT JOIN g_lem l ON l.raw_id = d.raw_id"""))
def sentiment_score(spark, sf_dir):
    """X13 (N2): lexicon join + per-document sum + normalisation."""
    return P.clean_text_only(_golden(spark, sf_dir)).select("raw_id", "sentiment_score")


@register("sentiment_label", O.with_ctes(_GOLDEN_LEM, f"""SELECT d.raw_id, {O.label(O.compound('l.vsum'))} AS sentiment
FROM g_docs d LEFT JOIN g_lem l ON l.raw_id = d.raw_id"""))
def sentiment_label(spark, sf_dir):
    """X12."""
    s = P.clean_text_only(_golden(spark, sf_dir))
    return s.select("raw_id", SF.sentiment_label(F.col("sentiment_score")).alias("sentiment"))


# ------------------------------------------------------------------------------ types and dates
@register("year_month", O.with_ctes(O.BASE, f"SELECT raw_id, review_ts, {O.year_month('review_ts')} AS year_month FROM raw_reviews"))
def year_month(spark, sf_dir):
    """Month bucket of the review time."""
    r = ST.raw_reviews(spark, sf_dir)
    return r.select("raw_id", "review_ts", FF.year_month(F.col("review_ts")).alias("year_month"))


@register("coerce_types", """SELECT event_id,
  TRY_CAST(regexp_extract(props, ':[ ]*([^}]*)', 1) AS DOUBLE) AS k_value,
  TRY_CAST(event_type AS DOUBLE) AS bad_number,
  TRY_CAST(CAST(ts AS VARCHAR) AS TIMESTAMP) AS ts_parsed,
  TRY_CAST(event_type AS TIMESTAMP) AS bad_ts
FROM events""")
def coerce_types(spark, sf_dir):
    """Parse numbers and times from text; a bad value becomes null, never an error."""
    ev = ST.table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        FF.try_double(F.regexp_extract("props", ":[ ]*([^}]*)", 1)).alias("k_value"),
        FF.try_double(F.col("event_type")).alias("bad_number"),
        FF.try_timestamp(F.col("ts").cast("string")).alias("ts_parsed"),
        FF.try_timestamp(F.col("event_type")).alias("bad_ts"),
    )


@register("sentiment_score_lexicon", O.with_ctes(_GOLDEN_LEM, f"""SELECT d.raw_id, {O.compound('l.lsum')} AS sentiment_score
FROM g_docs d LEFT JOIN g_lem l ON l.raw_id = d.raw_id"""))
def sentiment_score_lexicon(spark, sf_dir):
    """X13 without the heuristics: the plain sum of valences."""
    return P.clean_text_only(_golden(spark, sf_dir), P.TextResources(mode="lexicon")).select("raw_id", "sentiment_score")


_TURNS = [("turn_docs", f"SELECT conv_id * 1048576 + turn AS raw_id, {O.clean_tokens('text')} AS toks FROM conversations")]


@register("sentiment_score_vader", O.with_ctes(_TURNS + O.lemma_ctes("t", "turn_docs"), f"""SELECT d.raw_id,
  {O.compound('l.vsum')} AS sentiment_score FROM turn_docs d LEFT JOIN t_lem l ON l.raw_id = d.raw_id"""))
def sentiment_score_vader(spark, sf_dir):
    """X13 on the turns of conversations: boosters (damped), negators, phrases, 'without doubt', 'least'."""
    turns = ST.table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1048576 + F.col("turn")).alias("raw_id"), F.col("text").alias("review_text"))
    return P.clean_text_only(turns, P.TextResources(mode="vader")).select("raw_id", "sentiment_score")
