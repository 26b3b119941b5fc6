"""Analytics marts over the raw and processed tables (dashboard panels and reported results).

Every mart is computed for all apps at once with ``app_name`` in the grouping key; picking one
app is a filter that Catalyst pushes into the scan. Aggregates are hash aggregates with a
partial (map-side) step; windows run only over already aggregated rows or behind a
``row_number <= k`` filter, which Spark turns into a partial top-k before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sentimart import resources as R
from sentimart.functions import formats as FF

LABELS = R.SENTIMENT_LABELS


def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


# ------------------------------------------------------------------------------ A1-A4
def kpi_overview(raw: DataFrame, processed: DataFrame) -> DataFrame:
    """Per app: total reviews and mean rating (raw); positive share and dominant label (processed).

    positive_pct is over all processed rows of the app; dominant_sentiment is the most frequent
    label, the alphabetically first one on a tie. An app missing on one side gets nulls there.
    """
    r = raw.groupBy("app_name").agg(
        F.count(F.lit(1)).alias("total_reviews"),
        F.avg("rating").alias("avg_rating"),
    )
    p = processed.groupBy("app_name").agg(
        (count_if(F.col("sentiment") == "Positive").cast("double") / F.count(F.lit(1)) * 100.0)
        .alias("positive_pct"),
        F.mode("sentiment", deterministic=True).alias("dominant_sentiment"),
    )
    return r.join(p, "app_name", "full")


def kpi_formatted(raw: DataFrame, processed: DataFrame) -> DataFrame:
    """The four figures as the dashboard prints them; 'N/A' where a side has no rows."""
    k = kpi_overview(raw, processed)
    return k.select(
        "app_name", F.coalesce(F.col("total_reviews").cast("string"), F.lit("N/A")).alias("total_reviews"),
        FF.fmt_mean(F.col("avg_rating")).alias("avg_rating"), FF.fmt_share(F.col("positive_pct")).alias("positive_pct"),
        F.coalesce("dominant_sentiment", F.lit("N/A")).alias("dominant_sentiment"))


# ------------------------------------------------------------------------------ A5-A9
def rating_distribution(raw: DataFrame) -> DataFrame:
    """Per app, ratings in ascending order with their place."""
    counts = (raw.filter(F.col("rating").isNotNull())
              .groupBy("app_name", "rating").agg(F.count(F.lit(1)).alias("review_count")))
    w = Window.partitionBy("app_name").orderBy("rating")
    return counts.withColumn("rating_order", F.row_number().over(w)).orderBy("app_name", "rating")


def sentiment_distribution(processed: DataFrame) -> DataFrame:
    """Negative/Neutral/Positive per app with zero fill, for apps that have labelled rows.

    One aggregate with a conditional count per label, then the three counts are unpivoted.
    """
    agg = processed.filter(F.col("sentiment").isNotNull()).groupBy("app_name").agg(
        *[count_if(F.col("sentiment") == lab).alias(f"n{i}") for i, lab in enumerate(LABELS)]
    )
    rows = F.array(*[
        F.struct(F.lit(lab).alias("sentiment"), F.lit(i).alias("label_order"), F.col(f"n{i}").alias("review_count"))
        for i, lab in enumerate(LABELS)
    ])
    return agg.select("app_name", F.inline(rows))


def sentiment_trend_monthly(processed: DataFrame) -> DataFrame:
    # A label is never null (X12), so only the month can drop a row.
    return (processed.filter(F.col("year_month").isNotNull())
            .groupBy("app_name", "year_month", "sentiment")
            .agg(F.count(F.lit(1)).alias("review_count")).orderBy("app_name", "year_month", "sentiment"))


def processed_total(processed: DataFrame) -> DataFrame:
    return processed.agg(F.count(F.lit(1)).alias("total_processed"))


def sentiment_counts_global(processed: DataFrame) -> DataFrame:
    """Label counts, most frequent first; ties by label. One row per label: the window sees those only."""
    counts = (processed.filter(F.col("sentiment").isNotNull())
              .groupBy("sentiment").agg(F.count(F.lit(1)).alias("review_count")))
    w = Window.orderBy(F.desc("review_count"), "sentiment")
    return counts.withColumn("count_order", F.row_number().over(w)).orderBy("count_order")


# ------------------------------------------------------------------------------ J1, J2, A15
def app_names(raw: DataFrame, processed: DataFrame) -> DataFrame:
    """Distinct app names found in either table."""
    return raw.select("app_name").union(processed.select("app_name")).distinct()


def app_list(raw: DataFrame, processed: DataFrame) -> DataFrame:
    """The app names in sorted order with their place (one row per app)."""
    w = Window.orderBy("app_name")
    return app_names(raw, processed).filter(F.col("app_name").isNotNull()).withColumn("name_order", F.row_number().over(w)).orderBy("name_order")


def join_examples(raw: DataFrame, processed: DataFrame, pair_null_ids: bool = False) -> DataFrame:
    """Raw rows of each app with the label and score of the same app's processed row.

    Rows match on the review id; rows without one match on their own ``raw_id``, so an app's
    null ids never meet each other. ``pair_null_ids=True`` pairs all of them, as a null-safe merge
    does (raw nulls x processed nulls of an app). An app without any processed row gets 'Unknown'.
    """
    p = processed.select(
        F.col("app_name").alias("_p_app"), F.col("review_id").alias("_p_rid"), F.col("raw_id").alias("_p_raw"),
        "sentiment", "sentiment_score")
    if pair_null_ids:
        id_match = raw.review_id.eqNullSafe(p._p_rid)
    else:
        def own(rid, row):
            return F.coalesce(rid, F.concat(F.lit("\u0000null:"), row.cast("string")))
        id_match = own(raw.review_id, raw.raw_id) == own(p._p_rid, p._p_raw)
    j = raw.join(p, (raw.app_name == p._p_app) & id_match, "left")
    has_processed = processed.select(F.col("app_name").alias("_h_app")).distinct() \
        .withColumn("_has", F.lit(True))
    j = j.join(has_processed, j.app_name == has_processed._h_app, "left")
    sentiment = F.when(F.col("_has").isNull(), F.lit("Unknown")).otherwise(F.col("sentiment"))
    score = F.when(F.col("_has").isNull(), F.lit(None).cast("double")).otherwise(F.col("sentiment_score"))
    return j.select(
        "raw_id", "app_name", "review_id", "rating", "review_ts", "review_text",
        sentiment.alias("sentiment"), score.alias("sentiment_score"))


def sample_key(seed: int = R.SAMPLE_SEED) -> Column:
    """Repeatable pseudo-random order: md5 of seed and row id (same in any engine)."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col("raw_id").cast("string")))


def ranked_examples(examples: DataFrame, k: int = 5, seed: int = R.SAMPLE_SEED) -> DataFrame:
    """T5-T7 in one ranked pass: the first k rows of each app and label.

    Positive: highest scores; Negative: lowest scores; both only with a score, ties in original (raw_id)
    order. Neutral: a seeded-random sample of the rows with a score; of all rows if none has one. Rows with a
    score are ranked first, so whether an app has any is seen among its first k rows.
    """
    label, score = F.col("sentiment"), F.col("sentiment_score")
    shown = examples.filter(((label == "Neutral") | score.isNotNull()) & label.isin(*LABELS))
    by_score = F.when(label == "Positive", -score).when(label == "Negative", score)
    mixed = F.when(label == "Neutral", sample_key(seed))
    w = Window.partitionBy("app_name", "sentiment").orderBy(score.isNull(), by_score, mixed, F.col("raw_id"))
    top = shown.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    any_score = F.max(score.isNotNull()).over(Window.partitionBy("app_name", "sentiment"))  # k rows at most
    return top.withColumn("_any", any_score).filter(score.isNotNull() | ~F.col("_any")).drop("_any")


def _of_label(examples: DataFrame, label: str, k: int, seed: int = R.SAMPLE_SEED) -> DataFrame:
    return ranked_examples(examples.filter(F.col("sentiment") == label), k, seed)


def examples_positive(examples: DataFrame, k: int = 5) -> DataFrame:
    """T5: k highest scores among Positive rows with a score; ties in original (raw_id) order."""
    return _of_label(examples, "Positive", k)


def examples_negative(examples: DataFrame, k: int = 5) -> DataFrame:
    """K lowest scores among Negative rows with a score."""
    return _of_label(examples, "Negative", k)


def examples_neutral(examples: DataFrame, k: int = 5, seed: int = R.SAMPLE_SEED) -> DataFrame:
    """K seeded-random Neutral rows; rows with a score, all Neutral rows if none has one."""
    return _of_label(examples, "Neutral", k, seed)


def examples_formatted(examples: DataFrame, k: int = 5) -> DataFrame:
    """(app_name, tab, rank, title) of all examples, from one ranked pass."""
    unscored = (F.col("sentiment") == "Neutral") & F.col("sentiment_score").isNull()
    title = FF.example_title(F.col("rating"), F.col("sentiment_score"), F.col("review_ts"), unscored)
    return ranked_examples(examples, k).select("app_name", F.col("sentiment").alias("tab"), "rank", title.alias("title"))


def sample_processed(processed: DataFrame, n: int = 10) -> DataFrame:
    """First n processed rows (by raw_id), five display columns."""
    return (processed.orderBy("raw_id").limit(n)
            .select("raw_id", "app_name", "rating", "review_text", "cleaned_text", "sentiment"))


def first_app(raw: DataFrame, processed: DataFrame) -> DataFrame:
    """The dashboard's default selection: the first app name in sorted order (one row)."""
    return app_names(raw, processed).agg(F.min("app_name").alias("app_name"))


# ------------------------------------------------------------------------------ R1-R3, R5
def volume_trend_monthly(raw: DataFrame) -> DataFrame:
    """Reviews per app and month, with the previous month's count and the change.

    Every month from an app's first to its last counts, so a month without reviews is a row of zero and the
    change is always against the month before. The calendar is one row per app and month.
    """
    m = (raw.filter(F.col("review_ts").isNotNull())
         .groupBy("app_name", F.trunc(F.col("review_ts").cast("date"), "month").alias("year_month"))
         .agg(F.count(F.lit(1)).alias("n")))
    span = m.groupBy(F.col("app_name").alias("_app")).agg(F.min("year_month").alias("lo"), F.max("year_month").alias("hi"))
    months = span.select("_app", F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("_month"))
    full = months.join(m, months._app.eqNullSafe(m.app_name) & (months._month == m.year_month), "left").select(
        F.col("_app").alias("app_name"), F.col("_month").alias("year_month"), F.coalesce("n", F.lit(0)).alias("review_count"))
    w = Window.partitionBy("app_name").orderBy("year_month")
    prev = F.lag("review_count").over(w)
    return full.select("app_name", "year_month", "review_count", prev.alias("prev_count"),
                       (F.col("review_count") - prev).alias("change"))


def rating_patterns(raw: DataFrame) -> DataFrame:
    """R2: mean rating per app, ranked; polarisation = share of 1- and 5-star ratings."""
    a = raw.filter(F.col("rating").isNotNull()).groupBy("app_name").agg(
        F.count(F.lit(1)).alias("n_ratings"),
        F.avg("rating").alias("avg_rating"),
        F.avg(F.when(F.col("rating") == 1, 1.0).otherwise(0.0)).alias("share_1star"),
        F.avg(F.when(F.col("rating") == 5, 1.0).otherwise(0.0)).alias("share_5star"),
        F.avg(F.when(F.col("rating").isin(1, 5), 1.0).otherwise(0.0)).alias("polarisation"),
    )
    # One row per app: the ranking window sees aggregated rows only.
    w = Window.orderBy(F.col("avg_rating").desc())
    return a.withColumn("rating_rank", F.rank().over(w))


def sentiment_share(processed: DataFrame) -> DataFrame:
    """Label share per app, and each app's rank within a label by that share."""
    c = (processed.filter(F.col("sentiment").isNotNull())
         .groupBy("app_name", "sentiment").agg(F.count(F.lit(1)).alias("review_count")))
    total = F.sum("review_count").over(Window.partitionBy("app_name"))
    c = c.withColumn("share", F.col("review_count") / total)
    w = Window.partitionBy("sentiment").orderBy(F.col("share").desc())
    return c.withColumn("share_rank", F.rank().over(w))


def length_correlation(processed: DataFrame) -> DataFrame:
    """Correlation of review length, rating and score per app; mean length per label."""
    def rcorr(a: str, b: str) -> Column:
        # Pearson r = cov / (sd_a * sd_b). ``corr`` itself raises DIVIDE_BY_ZERO under ANSI
        # mode when one side is constant; try_divide returns null there instead.
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        return F.round(F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)), 6)

    def mean_len(label: str) -> Column:
        return F.avg(F.when(F.col("sentiment") == label, F.col("word_count")))

    return processed.groupBy("app_name").agg(
        F.count(F.lit(1)).alias("n_reviews"),
        rcorr("word_count", "rating").alias("corr_length_rating"),
        rcorr("word_count", "sentiment_score").alias("corr_length_score"),
        rcorr("rating", "sentiment_score").alias("corr_rating_score"),
        mean_len("Negative").alias("avg_len_negative"),
        mean_len("Neutral").alias("avg_len_neutral"),
        mean_len("Positive").alias("avg_len_positive"),
    )
