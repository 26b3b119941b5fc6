"""Driver tables and the review views built on them (FIXTURES.md section 3).

All views are lazy DataFrames over the parquet files, so Catalyst prunes columns and pushes
filters into the scan.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentimart import resources as R
from sentimart import schemas as S

# Start of the synthetic review calendar and the cut between history and increment.
REVIEW_EPOCH = "2024-01-01 00:00:00"
FEED_SPLIT_TS = "2024-09-01 00:00:00"
DQ_AS_OF = "2024-10-01 00:00:00"
# Fixed "now" used where the reference stamps wall-clock time, so results are repeatable.
RUN_TS = "2025-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def review_ts_from_id(doc_id: Column) -> Column:
    hours = ((doc_id * 37) % 8760).cast("int")
    return F.lit(REVIEW_EPOCH).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hours, F.lit(0), F.lit(0))


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_reviews view: one review per document, 20 apps (sources), md5(text) as review id."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("raw_id"),
        F.col("source").alias("app_name"),
        F.md5(F.col("text")).alias("review_id"),
        (F.lit(1) + F.col("n_chars") % 5).cast("int").alias("rating"),
        review_ts_from_id(F.col("doc_id")).alias("review_ts"),
        F.col("text").alias("review_text"),
    )


def raw_reviews_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_reviews with every column of the raw table; fields the feed does not carry are null."""
    r = raw_reviews(spark, sf_dir)
    cols = []
    for f in S.RAW.fields:
        if f.name in r.columns:
            cols.append(F.col(f.name))
        elif f.name in ("ingested_at",):
            cols.append(F.lit(RUN_TS).cast("timestamp").alias(f.name))
        elif f.name == "scraped_ts":
            cols.append(F.lit(RUN_TS).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return r.select(*cols)


def dirty_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_reviews with blanks, nulls, bad ratings and null ids planted by rule."""
    r = raw_reviews(spark, sf_dir)
    rid = F.col("raw_id")
    return r.select(
        rid,
        F.when(rid % 53 == 0, F.lit(None)).when(rid % 50 == 0, F.lit(" "))
        .otherwise(F.col("app_name")).alias("app_name"),
        F.when(rid % 41 == 0, F.lit(None)).otherwise(F.col("review_id")).alias("review_id"),
        F.when(rid % 43 == 0, F.lit(None)).otherwise(F.length("review_text") % 7)
        .cast("int").alias("rating"),
        F.col("review_ts"),
        F.when(rid % 47 == 0, F.lit("  ")).otherwise(F.col("review_text")).alias("review_text"),
    )


def feed_history(df: DataFrame) -> DataFrame:
    return df.filter(F.col("review_ts") < F.lit(FEED_SPLIT_TS).cast("timestamp_ntz"))


def feed_increment(df: DataFrame) -> DataFrame:
    return df.filter(F.col("review_ts") >= F.lit(FEED_SPLIT_TS).cast("timestamp_ntz"))


def reviews_with_golden(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(raw_id, review_text) of all documents plus the golden edge rows (negative ids)."""
    docs = raw_reviews(spark, sf_dir).select("raw_id", "review_text")
    return docs.unionByName(R.golden_text_df(spark))


def as_feed(raw: DataFrame) -> DataFrame:
    """raw_reviews in the shape of the source feed (S1): the fields a scraper would receive."""
    return raw.select(
        F.col("app_name").alias("app"),
        F.col("review_id").alias("reviewId"),
        F.lit(None).cast("string").alias("userName"),
        F.lit(None).cast("string").alias("userImage"),
        F.lit(None).cast("string").alias("title"),
        F.col("review_text").alias("content"),
        F.col("rating").alias("score"),
        F.lit(None).cast("int").alias("thumbsUpCount"),
        F.lit(None).cast("string").alias("reviewCreatedVersion"),
        F.col("review_ts").alias("at"),
        F.lit(None).cast("string").alias("replyContent"),
        F.lit(None).cast("timestamp_ntz").alias("repliedAt"),
        F.col("raw_id").alias("feed_pos"),
    )
