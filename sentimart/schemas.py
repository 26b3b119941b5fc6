
from __future__ import annotations

from pyspark.sql import types as T

# Review feed record as landed (JSON lines), every field optional.
FEED = T.StructType([
    T.StructField("reviewId", T.StringType()),
    T.StructField("userName", T.StringType()),
    T.StructField("userImage", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("score", T.IntegerType()),
    T.StructField("thumbsUpCount", T.IntegerType()),
    T.StructField("reviewCreatedVersion", T.StringType()),
    T.StructField("at", T.TimestampNTZType()),
    T.StructField("replyContent", T.StringType()),
    T.StructField("repliedAt", T.TimestampNTZType()),
])

RAW = T.StructType([
    T.StructField("raw_id", T.LongType(), False),
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("app_name", T.StringType()),
    T.StructField("review_id", T.StringType()),
    T.StructField("user_name", T.StringType()),
    T.StructField("user_image_url", T.StringType()),
    T.StructField("rating", T.IntegerType()),
    T.StructField("review_ts", T.TimestampNTZType()),
    T.StructField("review_title", T.StringType()),
    T.StructField("review_text", T.StringType()),
    T.StructField("thumbs_up", T.IntegerType()),
    T.StructField("app_version", T.StringType()),
    T.StructField("reply_text", T.StringType()),
    T.StructField("replied_ts", T.TimestampNTZType()),
    T.StructField("scraped_ts", T.TimestampNTZType()),
])

PROCESSED = T.StructType([
    T.StructField("raw_id", T.LongType(), False),
    T.StructField("app_name", T.StringType()),
    T.StructField("review_id", T.StringType()),
    T.StructField("rating", T.IntegerType()),
    T.StructField("review_ts", T.TimestampNTZType()),
    T.StructField("review_text", T.StringType()),
    T.StructField("cleaned_text", T.StringType()),
    T.StructField("word_count", T.IntegerType()),
    T.StructField("sentiment_score", T.DoubleType()),
    T.StructField("sentiment", T.StringType()),
    T.StructField("year_month", T.DateType()),
    T.StructField("processed_at", T.TimestampType()),
])

WATERMARKS = T.StructType([
    T.StructField("app_name", T.StringType(), False),
    T.StructField("last_ts", T.TimestampNTZType()),
])

RAW_COLUMNS = [f.name for f in RAW.fields]
PROCESSED_COLUMNS = [f.name for f in PROCESSED.fields]
