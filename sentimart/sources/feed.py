"""Review feed source (S1-S3, S14): landed JSON-lines files, one folder per app.

Layout: ``<root>/app=<name>/*.json``. One scan reads every app; ``app`` comes from the folder
name (partition discovery), so a filter on the app prunes folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentimart import schemas as S

CORRUPT = "_corrupt_record"


#: Lines with the app from the folder name; always a string ("007" stays "007").
LINES = "value string, app string"


def parse_lines(lines: DataFrame) -> DataFrame:
    """JSON lines (value, app) -> feed records; a malformed line keeps its text in ``_corrupt_record``."""
    schema = T.StructType(S.FEED.fields + [T.StructField("feed_pos", T.LongType()), T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return lines.filter(F.trim("value") != "").select("app", parsed.alias("r"), F.input_file_name().alias("feed_file")).select("app", "r.*", "feed_file")


def read_feed(spark: SparkSession, root: str) -> DataFrame:
    """All landed feed records, every app in one scan, malformed lines marked (see ``split_rejects``)."""
    return parse_lines(spark.read.schema(LINES).text(root))


def stream_lines(spark: SparkSession, root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The feed's lines as a file stream (new files are picked up once); parsed inside the batch."""
    reader = spark.readStream.schema(LINES)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(root)


def split_rejects(feed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good records, rejects with reason). A bad app never stops the others."""
    bad = F.col(CORRUPT).isNotNull()
    good = feed.filter(~bad).drop(CORRUPT)
    rejects = feed.filter(bad).select(
        F.col("app"), F.col("feed_file"), F.col(CORRUPT).alias("line"),
        F.lit("malformed_record").alias("reason"),
    )
    return good, rejects


def map_feed_record(feed: DataFrame, scraped_at: str | None = None) -> DataFrame:
    """S3: feed record -> raw row. Field names change, app name and scrape time are added."""
    scraped = F.lit(scraped_at).cast("timestamp_ntz") if scraped_at else F.localtimestamp()
    # Without a position in the feed the id stays null until the batch is stored (with_raw_ids).
    pos = F.col("feed_pos") if "feed_pos" in feed.columns else F.lit(None)
    return feed.select(
        pos.cast("long").alias("raw_id"),
        F.current_timestamp().alias("ingested_at"),
        F.col("app").alias("app_name"),
        F.col("reviewId").alias("review_id"),
        F.col("userName").alias("user_name"),
        F.col("userImage").alias("user_image_url"),
        F.col("score").cast("int").alias("rating"),
        F.col("at").alias("review_ts"),
        F.col("title").alias("review_title"),
        F.col("content").alias("review_text"),
        F.col("thumbsUpCount").cast("int").alias("thumbs_up"),
        F.col("reviewCreatedVersion").alias("app_version"),
        F.col("replyContent").alias("reply_text"),
        F.col("repliedAt").alias("replied_ts"),
        scraped.alias("scraped_ts"),
    )
