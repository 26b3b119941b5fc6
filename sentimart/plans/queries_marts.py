"""Queries for the dashboard marts, README analytics and data-quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from sentimart import resources as R
from sentimart.operators import marts as M
from sentimart.operators import ngrams as N
from sentimart.operators import process as PR
from sentimart.operators import quality as Q
from sentimart.plans import oracle as O
from sentimart.plans.catalog import register
from sentimart.plans.queries_text import processed
from sentimart.sources import tables as ST

W = O.with_ctes
P = O.PROCESSED
EX_COLS = "app_name, rank, raw_id, rating, review_ts, sentiment, sentiment_score, review_text"


def raw(spark, sf_dir):
    return ST.raw_reviews(spark, sf_dir)


def examples(spark, sf_dir):
    return M.join_examples(raw(spark, sf_dir), processed(spark, sf_dir))


# ------------------------------------------------------------------------------ A1-A9
@register("kpi_overview", W(P + [
    ("r", "SELECT app_name, count(*) AS total_reviews, avg(rating) AS avg_rating FROM raw_reviews GROUP BY app_name"),
    ("p", """SELECT app_name, (CAST(count(*) FILTER (WHERE sentiment = 'Positive') AS DOUBLE) / count(*)) * 100.0 AS positive_pct
FROM processed GROUP BY app_name"""),
    ("m", """SELECT app_name, sentiment AS dominant_sentiment FROM (
  SELECT app_name, sentiment, count(*) AS n FROM processed WHERE sentiment IS NOT NULL GROUP BY app_name, sentiment)
QUALIFY row_number() OVER (PARTITION BY app_name ORDER BY n DESC, sentiment) = 1"""),
], """SELECT coalesce(r.app_name, p.app_name) AS app_name, r.total_reviews, r.avg_rating, p.positive_pct,
  m.dominant_sentiment
FROM r FULL JOIN p ON r.app_name = p.app_name LEFT JOIN m ON m.app_name = coalesce(r.app_name, p.app_name)"""))
def kpi_overview(spark, sf_dir):
    """A1-A4: total reviews, mean rating, positive share, dominant sentiment per app."""
    return M.kpi_overview(raw(spark, sf_dir), processed(spark, sf_dir))


@register("kpi_formatted", W(P + [
    ("r", "SELECT app_name, count(*) AS n, avg(rating) AS m FROM raw_reviews GROUP BY app_name"),
    ("c", "SELECT app_name, sentiment, count(*) AS n FROM processed GROUP BY app_name, sentiment"),
    ("s", """SELECT app_name, 100.0 * coalesce(sum(n) FILTER (WHERE sentiment = 'Positive'), 0) / sum(n) AS pct,
  min_by(sentiment, {'less': -n, 'name': sentiment}) FILTER (WHERE sentiment IS NOT NULL) AS top FROM c GROUP BY app_name"""),
], """SELECT app_name, coalesce(CAST(r.n AS VARCHAR), 'N/A') AS total_reviews,
  coalesce(CAST(round(CAST(m AS DECIMAL(18,6)), 2) AS VARCHAR), 'N/A') AS avg_rating,
  coalesce(CAST(round(CAST(pct AS DECIMAL(18,6)), 1) AS VARCHAR) || '%', 'N/A') AS positive_pct,
  coalesce(top, 'N/A') AS dominant_sentiment FROM r FULL JOIN s USING (app_name)"""))
def kpi_formatted(spark, sf_dir):
    """The overview figures in the forms the dashboard prints."""
    return M.kpi_formatted(raw(spark, sf_dir), processed(spark, sf_dir))


@register("rating_distribution", W(O.BASE, """SELECT app_name, rating, count(*) AS review_count,
  CAST(row_number() OVER (PARTITION BY app_name ORDER BY rating) AS INT) AS rating_order
FROM raw_reviews WHERE rating IS NOT NULL GROUP BY app_name, rating"""))
def rating_distribution(spark, sf_dir):
    """Rating histogram per app."""
    return M.rating_distribution(raw(spark, sf_dir))


_LAB_SQL = " UNION ALL ".join(
    f"SELECT app_name, '{lab}' AS sentiment, {i} AS label_order, n{i} AS review_count FROM agg"
    for i, lab in enumerate(R.SENTIMENT_LABELS))


@register("sentiment_distribution", W(P + [("agg", "SELECT app_name, " + ", ".join(
    f"count(*) FILTER (WHERE sentiment = '{lab}') AS n{i}" for i, lab in enumerate(R.SENTIMENT_LABELS))
    + " FROM processed WHERE sentiment IS NOT NULL GROUP BY app_name")], _LAB_SQL))
def sentiment_distribution(spark, sf_dir):
    """Label histogram per app, re-indexed to Negative/Neutral/Positive with zero fill."""
    return M.sentiment_distribution(processed(spark, sf_dir))


@register("sentiment_trend_monthly", W(P, """SELECT app_name, year_month, sentiment, count(*) AS review_count
FROM processed WHERE year_month IS NOT NULL AND sentiment IS NOT NULL GROUP BY app_name, year_month, sentiment"""))
def sentiment_trend_monthly(spark, sf_dir):
    """A7 (flagship): reviews per app, month and label over the processed table."""
    return M.sentiment_trend_monthly(processed(spark, sf_dir))


@register("processed_total", W(P, "SELECT count(*) AS total_processed FROM processed"))
def processed_total(spark, sf_dir):
    """A8."""
    return M.processed_total(processed(spark, sf_dir))


@register("sentiment_counts_global", W(P, """SELECT sentiment, count(*) AS review_count,
  CAST(row_number() OVER (ORDER BY count(*) DESC, sentiment) AS INT) AS count_order
FROM processed WHERE sentiment IS NOT NULL GROUP BY sentiment"""))
def sentiment_counts_global(spark, sf_dir):
    """A9."""
    return M.sentiment_counts_global(processed(spark, sf_dir))


# ------------------------------------------------------------------------------ n-grams
NG = P + [("nd", f"SELECT app_name, raw_id, {O.ngram_tokens('cleaned_text')} AS toks FROM processed "
                 "WHERE cleaned_text IS NOT NULL")]
UNI = ("SELECT app_name, raw_id, unnest(toks) AS ngram, unnest(range(len(toks))) AS pos FROM nd")
BI = ("SELECT app_name, raw_id, unnest(list_transform(range(len(toks) - 1), lambda i: toks[i + 1] || ' ' || toks[i + 2])) AS ngram, "
      "unnest(range(len(toks) - 1)) AS pos FROM nd")
BRIDGE = ("SELECT app_name, raw_id, ngram, pos FROM (SELECT app_name, raw_id, len(toks) - 1 AS pos, "
          "toks[-1] || ' ' || lead(toks[1]) OVER (PARTITION BY app_name ORDER BY raw_id) AS ngram "
          "FROM nd WHERE len(toks) > 0) WHERE ngram IS NOT NULL")


def topk_sql(items: str, k: int) -> str:
    return f"""SELECT app_name, CAST(rank AS INT) AS rank, ngram, ngram_count FROM (
  SELECT app_name, ngram, ngram_count,
    row_number() OVER (PARTITION BY app_name ORDER BY ngram_count DESC, first) AS rank
  FROM (SELECT app_name, ngram, count(*) AS ngram_count, min({{'raw_id': raw_id, 'pos': pos}}) AS first
        FROM ({items}) GROUP BY app_name, ngram))
WHERE rank <= {k}"""


@register("top_unigrams", W(NG, topk_sql(UNI, 20)))
def top_unigrams(spark, sf_dir):
    """20 most frequent words per app (ties: first seen)."""
    return N.top_unigrams(processed(spark, sf_dir))


@register("top_bigrams", W(NG, topk_sql(BI, 20)))
def top_bigrams(spark, sf_dir):
    """20 most frequent adjacent pairs inside reviews per app."""
    return N.top_bigrams(processed(spark, sf_dir))


@register("top_bigrams_corpus", W(NG, topk_sql(f"{BI} UNION ALL {BRIDGE}", 20)))
def top_bigrams_corpus(spark, sf_dir):
    """Pairs over each app's concatenated corpus, including across reviews."""
    return N.top_bigrams_corpus(processed(spark, sf_dir))


@register("term_weights", W(NG, f"""SELECT *, CAST(ngram_count AS DOUBLE) / max(ngram_count) OVER (PARTITION BY app_name) AS weight
FROM ({topk_sql(UNI, 100)})"""))
def term_weights(spark, sf_dir):
    """A16 (re-aimed word cloud): top 100 words per app with relative weight."""
    return N.term_weights(processed(spark, sf_dir))


# The given texts are invented prose with licence lines and insults; the golden rows hold the shop words.
_THEME_ROWS = R.THEMES + R.TEXT_THEMES
_THEMED = P + [("gt_docs", f"SELECT raw_id, {O.clean_tokens('review_text')} AS toks FROM {O.values(R.GOLDEN_TEXT, 'raw_id, review_text')}")]
_THEMED += O.lemma_ctes("gt", "gt_docs") + [
    ("themed", "SELECT app_name, raw_id, cleaned_text FROM processed UNION ALL SELECT 'golden', raw_id, cleaned_text FROM gt_lem"),
    ("nd", f"SELECT app_name, raw_id, {O.ngram_tokens('cleaned_text')} AS toks FROM themed WHERE cleaned_text IS NOT NULL"),
    ("themes", O.values(_THEME_ROWS, "theme, token"))]


@register("theme_counts", W(_THEMED, """SELECT app_name, theme, count(DISTINCT raw_id) AS review_count
FROM (SELECT app_name, raw_id, unnest(list_distinct(toks)) AS token FROM nd) x JOIN themes USING (token)
GROUP BY app_name, theme"""))
def theme_counts(spark, sf_dir):
    """Reviews per app mentioning price, shipping, product, app, service."""
    golden = PR.clean_text_only(R.golden_text_df(spark)).select(F.lit("golden").alias("app_name"), "raw_id", "cleaned_text")
    docs = processed(spark, sf_dir).select("app_name", "raw_id", "cleaned_text").unionByName(golden)
    return N.theme_counts(docs, R.seed_df(spark, _THEME_ROWS, "theme string, token string"))


# ------------------------------------------------------------------------------ joins and examples
JX = P + [("ex", """SELECT r.raw_id, r.app_name, r.review_id, r.rating, r.review_ts, r.review_text,
  CASE WHEN h.app_name IS NULL THEN 'Unknown' ELSE p.sentiment END AS sentiment,
  CASE WHEN h.app_name IS NULL THEN NULL ELSE p.sentiment_score END AS sentiment_score
FROM raw_reviews r
LEFT JOIN processed p ON p.app_name = r.app_name
  AND (p.review_id = r.review_id OR (p.review_id IS NULL AND r.review_id IS NULL AND p.raw_id = r.raw_id))
LEFT JOIN (SELECT DISTINCT app_name FROM processed) h ON h.app_name = r.app_name""")]


@register("join_examples", W(JX, "SELECT * FROM ex"))
def join_examples(spark, sf_dir):
    """Raw rows with the same app's processed label and score ('Unknown' fallback)."""
    return examples(spark, sf_dir)


@register("join_unknown", W(P + [
    ("kept", "SELECT * FROM processed WHERE app_name <> (SELECT min(app_name) FROM raw_reviews)")],
    """SELECT r.app_name, CASE WHEN h.app_name IS NULL THEN 'Unknown' ELSE k.sentiment END AS sentiment, count(*) AS review_count,
  count(CASE WHEN h.app_name IS NOT NULL THEN k.sentiment_score END) AS n_scores
FROM raw_reviews r LEFT JOIN kept k ON k.app_name = r.app_name AND k.review_id = r.review_id
LEFT JOIN (SELECT DISTINCT app_name FROM kept) h ON h.app_name = r.app_name GROUP BY 1, 2"""))
def join_unknown(spark, sf_dir):
    """An app without any processed row shows 'Unknown' and no scores; others keep their labels."""
    r = raw(spark, sf_dir)
    first = F.broadcast(M.first_app(r, r))  # one row
    ex = M.join_examples(r, processed(spark, sf_dir).join(first, "app_name", "left_anti"))
    return ex.groupBy("app_name", "sentiment").agg(F.count(F.lit(1)).alias("review_count"), F.count("sentiment_score").alias("n_scores"))


def _ex_body(where: str, order: str) -> str:
    return f"""SELECT {EX_COLS} FROM (SELECT *, CAST(row_number() OVER (PARTITION BY app_name ORDER BY {order}) AS INT) AS rank
FROM ex WHERE {where}) WHERE rank <= 5"""


def _ex_sql(where: str, order: str) -> str:
    return W(JX, _ex_body(where, order))


NEUTRAL_WHERE = ("sentiment = 'Neutral' AND (sentiment_score IS NOT NULL OR app_name NOT IN "
                 "(SELECT app_name FROM ex WHERE sentiment = 'Neutral' AND sentiment_score IS NOT NULL))")
NEUTRAL_ORDER = f"md5('{R.SAMPLE_SEED}:' || CAST(raw_id AS VARCHAR)), raw_id"


@register("examples_positive", _ex_sql("sentiment = 'Positive' AND sentiment_score IS NOT NULL",
                                       "sentiment_score DESC, raw_id"))
def examples_positive(spark, sf_dir):
    """Five most positive reviews per app."""
    return M.examples_positive(examples(spark, sf_dir)).select(*[c.strip() for c in EX_COLS.split(",")])


@register("examples_negative", _ex_sql("sentiment = 'Negative' AND sentiment_score IS NOT NULL",
                                       "sentiment_score ASC, raw_id"))
def examples_negative(spark, sf_dir):
    """Five most negative reviews per app."""
    return M.examples_negative(examples(spark, sf_dir)).select(*[c.strip() for c in EX_COLS.split(",")])


@register("examples_neutral", _ex_sql(NEUTRAL_WHERE, NEUTRAL_ORDER))
def examples_neutral(spark, sf_dir):
    """Five seeded-random neutral reviews per app (md5 order, same in any engine)."""
    return M.examples_neutral(examples(spark, sf_dir)).select(*[c.strip() for c in EX_COLS.split(",")])


def _title_sql(rel: str, tab: str) -> str:
    return (f"SELECT app_name, '{tab}' AS tab, rank, 'Rating: ' || coalesce(CAST(rating AS VARCHAR), 'N/A') || "
            f"' ⭐ | VADER Score: ' || coalesce(CAST(round(CAST(sentiment_score AS DECIMAL(18, 4)), 3) AS VARCHAR), 'N/A') || "
            f"' | Date: ' || coalesce(strftime(review_ts, '%Y-%m-%d'), 'N/A') AS title FROM ({rel})")


@register("examples_formatted", W(JX, " UNION ALL ".join([
    _title_sql(_ex_body("sentiment = 'Positive' AND sentiment_score IS NOT NULL", "sentiment_score DESC, raw_id"), "Positive"),
    _title_sql(_ex_body("sentiment = 'Negative' AND sentiment_score IS NOT NULL", "sentiment_score ASC, raw_id"), "Negative"),
    _title_sql(_ex_body(NEUTRAL_WHERE, NEUTRAL_ORDER), "Neutral"),
])))
def examples_formatted(spark, sf_dir):
    """The example headers as the dashboard prints them (3 decimals, %Y-%m-%d, N/A), in one ranked pass."""
    return M.examples_formatted(examples(spark, sf_dir))


@register("sample_processed", W(P, """SELECT raw_id, app_name, rating, review_text, cleaned_text, sentiment
FROM processed ORDER BY raw_id LIMIT 10"""))
def sample_processed(spark, sf_dir):
    """First ten processed rows, display columns."""
    return M.sample_processed(processed(spark, sf_dir))


@register("filter_app", W(P, f"""SELECT {', '.join(c.strip() for c in
    'raw_id, app_name, review_id, rating, review_ts, review_text, cleaned_text, word_count, sentiment_score, sentiment, year_month'.split(','))}
FROM processed WHERE app_name = (SELECT min(app_name) FROM (SELECT app_name FROM raw_reviews UNION SELECT app_name FROM processed))"""))
def filter_app(spark, sf_dir):
    """the processed rows of the selected app (default: first app name); only its texts are read and scored."""
    r = raw(spark, sf_dir)
    # Processed rows have no other app names than raw ones. One-row relation: broadcasting it is bounded.
    return PR.process_reviews(r, apps=F.broadcast(M.first_app(r, r))).drop("processed_at")


@register("drop_null_score", W(JX, """SELECT app_name, sentiment, count(*) AS review_count FROM ex
WHERE sentiment_score IS NOT NULL GROUP BY app_name, sentiment"""))
def drop_null_score(spark, sf_dir):
    """example rows with a score, counted per app and label."""
    ex = examples(spark, sf_dir).na.drop(subset=["sentiment_score"])
    return ex.groupBy("app_name", "sentiment").agg(F.count(F.lit(1)).alias("review_count"))


@register("app_names", W(P, """SELECT app_name, CAST(row_number() OVER (ORDER BY app_name) AS INT) AS name_order
FROM (SELECT app_name FROM raw_reviews UNION SELECT app_name FROM processed) WHERE app_name IS NOT NULL"""))
def app_names(spark, sf_dir):
    """Distinct app names of both tables, sorted, with their place."""
    return M.app_list(raw(spark, sf_dir), processed(spark, sf_dir))


# ------------------------------------------------------------------------------ R1-R3, R5
# One app is kept to every third month, so that months without reviews occur at every scale.
_GAPS = O.BASE + [
    ("v", "SELECT * FROM raw_reviews WHERE app_name <> (SELECT min(app_name) FROM raw_reviews) OR month(review_ts) % 3 = 1"),
    ("m", f"SELECT app_name, {O.year_month('review_ts')} AS year_month, count(*) AS n FROM v WHERE review_ts IS NOT NULL GROUP BY ALL"),
    ("cal", "SELECT app_name, CAST(unnest(generate_series(min(year_month), max(year_month), INTERVAL 1 MONTH)) AS DATE) AS year_month FROM m GROUP BY app_name"),
    ("full_m", "SELECT app_name, year_month, coalesce(n, 0) AS review_count FROM cal LEFT JOIN m USING (app_name, year_month)")]


@register("volume_trend_monthly", W(_GAPS, """SELECT app_name, year_month, review_count, lag(review_count) OVER w AS prev_count,
  review_count - lag(review_count) OVER w AS change
FROM full_m WINDOW w AS (PARTITION BY app_name ORDER BY year_month)"""))
def volume_trend_monthly(spark, sf_dir):
    """Monthly review volume per app, months without reviews included, and change from the month before."""
    r = raw(spark, sf_dir)
    first = r.agg(F.min("app_name").alias("app_name")).withColumn("thinned", F.lit(True))
    r = r.join(F.broadcast(first), "app_name", "left").filter(F.col("thinned").isNull() | (F.month("review_ts") % 3 == 1))
    return M.volume_trend_monthly(r)


@register("rating_patterns", W(O.BASE + [("a", """SELECT app_name, count(*) AS n_ratings, avg(rating) AS avg_rating,
  avg(CASE WHEN rating = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS share_1star,
  avg(CASE WHEN rating = 5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS share_5star,
  avg(CASE WHEN rating IN (1, 5) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS polarisation
FROM raw_reviews WHERE rating IS NOT NULL GROUP BY app_name""")],
    "SELECT *, CAST(rank() OVER (ORDER BY avg_rating DESC) AS INT) AS rating_rank FROM a"))
def rating_patterns(spark, sf_dir):
    """R2: mean rating per app, rank, and polarisation (share of 1 and 5 stars)."""
    return M.rating_patterns(raw(spark, sf_dir))


@register("sentiment_share", W(P + [("c", """SELECT app_name, sentiment, count(*) AS review_count FROM processed
WHERE sentiment IS NOT NULL GROUP BY app_name, sentiment""")], """SELECT *, CAST(rank() OVER (PARTITION BY sentiment ORDER BY share DESC) AS INT) AS share_rank
FROM (SELECT *, CAST(review_count AS DOUBLE) / sum(review_count) OVER (PARTITION BY app_name) AS share FROM c)"""))
def sentiment_share(spark, sf_dir):
    """Label share per app and rank of apps within each label."""
    return M.sentiment_share(processed(spark, sf_dir))


def _corr(a: str, b: str) -> str:
    c = f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))"
    return f"CASE WHEN isnan({c}) THEN NULL ELSE round({c}, 6) END"


@register("length_correlation", W(P, f"""SELECT app_name, count(*) AS n_reviews,
  {_corr('word_count', 'rating')} AS corr_length_rating,
  {_corr('word_count', 'sentiment_score')} AS corr_length_score,
  {_corr('rating', 'sentiment_score')} AS corr_rating_score,
  avg(CASE WHEN sentiment = 'Negative' THEN word_count END) AS avg_len_negative,
  avg(CASE WHEN sentiment = 'Neutral' THEN word_count END) AS avg_len_neutral,
  avg(CASE WHEN sentiment = 'Positive' THEN word_count END) AS avg_len_positive
FROM processed GROUP BY app_name"""))
def length_correlation(spark, sf_dir):
    """Correlation of length, rating and score; mean length per label."""
    return M.length_correlation(processed(spark, sf_dir))


# ------------------------------------------------------------------------------ data quality
def _report_sql(agg_rel: str, checks: list[tuple[str, str, int, str]]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS "check", CAST({col} AS BIGINT) AS value, CAST({thr} AS BIGINT) AS threshold,
  '{cmp}' AS comparison, CAST({col} AS BIGINT) {cmp} {thr} AS passed FROM {agg_rel}"""
        for name, col, thr, cmp in checks)


def _blank(c: str) -> str:
    return f"({c} IS NULL OR trim({c}, ' ') = '')"


DUP_SQL = """SELECT app_name, review_id, count(*) AS dup_count FROM {rel} WHERE review_id IS NOT NULL
GROUP BY app_name, review_id HAVING count(*) > 1"""


@register("dq_report", W(O.DIRTY + [
    ("a", f"""SELECT count(*) FILTER (WHERE {_blank('app_name')}) AS blank_app_name,
  count(*) FILTER (WHERE {_blank('review_text')}) AS blank_review_text,
  count(*) FILTER (WHERE review_ts > {O.ts(ST.DQ_AS_OF)}) AS future_review_ts,
  count(*) FILTER (WHERE rating < 1 OR rating > 5) AS invalid_rating FROM dirty_reviews"""),
    ("d", f"SELECT count(*) AS duplicate_groups FROM ({DUP_SQL.format(rel='dirty_reviews')})"),
], _report_sql("a", [("blank_app_name", "blank_app_name", 0, "<="), ("blank_review_text", "blank_review_text", 0, "<="),
                     ("invalid_rating", "invalid_rating", 0, "<="), ("future_review_ts", "future_review_ts", 0, "<=")])
   + " UNION ALL " + _report_sql("d", [("duplicate_review_id", "duplicate_groups", 0, "<=")])))
def dq_report(spark, sf_dir):
    """Five checks on the dirty raw view (warn only)."""
    return Q.dq_report(ST.dirty_reviews(spark, sf_dir), as_of=ST.DQ_AS_OF)


@register("dq_duplicates", W(O.DIRTY, DUP_SQL.format(rel="dirty_reviews")))
def dq_duplicates(spark, sf_dir):
    """Duplicate (app, review id) groups with their size."""
    return Q.duplicates(ST.dirty_reviews(spark, sf_dir))


@register("dq_gate_raw", W(O.DIRTY + [
    ("a", """SELECT count(*) AS row_count, count(*) FILTER (WHERE app_name IS NULL) AS null_app_name,
  count(*) FILTER (WHERE rating IS NULL) AS null_rating, count(*) FILTER (WHERE review_text IS NULL) AS null_review_text,
  count(*) FILTER (WHERE NOT (rating BETWEEN 1 AND 5)) AS rating_out_of_range FROM dirty_reviews"""),
    ("d", f"SELECT count(*) AS d FROM ({DUP_SQL.format(rel='dirty_reviews')})"),
], _report_sql("a", [("row_count", "row_count", 100, ">="), ("null_app_name", "null_app_name", 0, "<="),
                     ("null_rating", "null_rating", 0, "<="), ("null_review_text", "null_review_text", 0, "<="),
                     ("rating_out_of_range", "rating_out_of_range", 0, "<=")])
   + " UNION ALL " + _report_sql("d", [("duplicate_review_id", "d", 0, "<=")])))
def dq_gate_raw(spark, sf_dir):
    """Q2: raw gate report (the pipeline raises when a row fails)."""
    return Q.dq_gate_raw(ST.dirty_reviews(spark, sf_dir))


@register("dq_gate_processed", W(P + [("a", f"""SELECT count(*) AS row_count,
  count(*) FILTER (WHERE cleaned_text IS NULL) AS null_cleaned_text,
  count(*) FILTER (WHERE sentiment_score IS NULL) AS null_score,
  count(*) FILTER (WHERE sentiment_score < -1.0 OR sentiment_score > 1.0) AS score_out_of_range,
  count(*) FILTER (WHERE sentiment_score IS NOT NULL AND sentiment <> {O.label('sentiment_score')}) AS label_mismatch,
  count(*) FILTER (WHERE NOT (sentiment IN ('Negative', 'Neutral', 'Positive'))) AS label_not_in_domain
FROM processed""")], _report_sql("a", [
    ("row_count", "row_count", 50, ">="), ("null_cleaned_text", "null_cleaned_text", 0, "<="),
    ("null_score", "null_score", 0, "<="), ("score_out_of_range", "score_out_of_range", 0, "<="),
    ("label_mismatch", "label_mismatch", 0, "<="), ("label_not_in_domain", "label_not_in_domain", 0, "<=")])))
def dq_gate_processed(spark, sf_dir):
    """Q3: processed gate report."""
    return Q.dq_gate_processed(processed(spark, sf_dir))
