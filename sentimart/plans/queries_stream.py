"""Queries that run the file-landing and streaming paths.

Each query lands files that Spark derives from the driver tables into a fresh folder under the
shared checkpoint folder, runs the job over them, and returns the resulting table.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from sentimart.operators import ingest as I
from sentimart.operators import process as P
from sentimart.plans import oracle as O
from sentimart.plans.catalog import register
from sentimart.plans.queries_marts import W
from sentimart.session import checkpoint_path
from sentimart.sources import feed as FD
from sentimart.sources import tables as ST
from sentimart.sources.warehouse import Warehouse
from sentimart.streaming import ingest as SI

SPLIT = O.ts(ST.FEED_SPLIT_TS)
KEY = "coalesce(review_id, chr(0) || 'null:' || CAST(raw_id AS VARCHAR))"


def _scratch(spark, name: str) -> str:
    return checkpoint_path(spark, f"{name}-{uuid.uuid4().hex}")


def _dedupe(rel: str) -> str:
    return f"SELECT * FROM {rel} QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY raw_id) = 1"


@register("stream_ingest", W(O.BASE + [
    ("run1", _dedupe(f"(SELECT * FROM raw_reviews WHERE review_ts < {SPLIT})")),
    ("wm", "SELECT app_name, max(review_ts) AS last_ts FROM run1 GROUP BY app_name"),
    ("inc", f"""SELECT r.* FROM raw_reviews r LEFT JOIN wm w ON w.app_name = r.app_name
WHERE r.review_ts >= {SPLIT} AND (w.last_ts IS NULL OR r.review_ts IS NULL OR r.review_ts > w.last_ts)"""),
    ("run2", _dedupe("(SELECT * FROM inc WHERE review_id NOT IN (SELECT review_id FROM run1))")),
], """SELECT raw_id, app_name, review_id, rating, review_ts FROM run1
UNION ALL SELECT raw_id, app_name, review_id, rating, review_ts FROM run2"""))
def stream_ingest(spark, sf_dir):
    """Feed files land in two rounds (history, then increment); an availableNow file
    stream ingests each round with watermark filter and insert-or-ignore; no row is capped."""
    base = _scratch(spark, "stream-ingest")
    feed, tables, ck = (os.path.join(base, x) for x in ("feed", "tables", "checkpoint"))
    raw = ST.raw_reviews(spark, sf_dir)
    for part in (ST.feed_history(raw), ST.feed_increment(raw)):
        SI.land_feed(ST.as_feed(part), feed)
        SI.run_ingest_stream(spark, feed, tables, ck, scraped_at=ST.RUN_TS)
    return SI.raw_table(spark, tables).select("raw_id", "app_name", "review_id", "rating", "review_ts")


# A feed as the source gives it: no position, some rows without a review id, some broken lines,
# app names that look like numbers. Two rounds; the rows of the first come again in the second.
_BARE = O.BASE + [
    ("fed", f"""SELECT '00' || CAST(length(app_name) AS VARCHAR) AS app, review_id, rating, review_ts, length(review_text) AS n,
  review_id IS NULL OR length(review_text) % 7 = 0 AS no_id, length(review_text) % 11 = 0 AS broken FROM raw_reviews"""),
    ("h", f"SELECT * FROM fed WHERE review_ts < {SPLIT}"), ("i", f"SELECT * FROM fed WHERE review_ts >= {SPLIT}"),
    ("w", "SELECT app, max(review_ts) AS m FROM h WHERE NOT broken GROUP BY app"),
    ("i2", "SELECT i.* FROM i LEFT JOIN w USING (app) WHERE m IS NULL OR review_ts IS NULL OR review_ts > m"),
    ("ids1", "SELECT DISTINCT review_id FROM h WHERE NOT broken AND NOT no_id"),
    ("n1", """SELECT app, count(*) FILTER (WHERE broken) AS bad, count(*) FILTER (WHERE NOT broken) AS good,
  count(*) FILTER (WHERE NOT broken AND no_id) AS bare FROM h GROUP BY app"""),
]


@register("stream_bare_feed", W(_BARE, f"""SELECT
  (SELECT count(*) FROM fed) + (SELECT count(*) FROM h) AS n_read,
  (SELECT count(*) FROM fed WHERE broken) + (SELECT count(*) FROM h WHERE broken) AS n_malformed,
  (SELECT count(*) FROM h WHERE NOT broken AND no_id) + (SELECT count(*) FROM ids1)
    + (SELECT count(*) FROM i2 WHERE NOT broken AND no_id)
    + (SELECT count(DISTINCT review_id) FROM i2 WHERE NOT broken AND NOT no_id AND review_id NOT IN (SELECT review_id FROM ids1)) AS n_inserted,
  true AS ids_unique, true AS adds_up, true AS apps_are_text"""))
def stream_bare_feed(spark, sf_dir):
    """No row is lost: stored + rejected + ignored + too old = read, over two rounds."""
    base = _scratch(spark, "bare-feed")
    feed, tables, ck = (os.path.join(base, x) for x in ("feed", "tables", "checkpoint"))
    n = F.length("review_text")
    raw = ST.raw_reviews(spark, sf_dir).withColumn("review_id", F.when(n % 7 != 0, F.col("review_id")))
    raw = raw.withColumn("app_name", F.concat(F.lit("00"), F.length("app_name").cast("string")))
    for part in (ST.feed_history(raw), raw):
        rows = ST.as_feed(part).drop("feed_pos")
        line = F.to_json(F.struct(*[c for c in rows.columns if c != "app"]))
        rows = rows.withColumn("_l", line).select("app", F.when(F.length("content") % 11 == 0, F.expr("substring(_l, 1, length(_l) - 1)")).otherwise(F.col("_l")).alias("value"))
        rows.write.mode("append").partitionBy("app").text(feed)
        SI.run_ingest_stream(spark, feed, tables, ck, scraped_at=ST.RUN_TS)
    runs = spark.read.parquet(os.path.join(tables, "runs"))
    stored = SI.raw_table(spark, tables)
    total = runs.agg(*[F.sum(c).alias(c) for c in ("n_read", "n_malformed", "n_inserted")],
                     (F.sum(F.col("n_read") - F.col("n_malformed") - F.col("n_old") - F.col("n_rejected") - F.col("n_ignored") - F.col("n_inserted")) == 0).alias("_sum"),
                     F.min(F.col("app_name").startswith("00")).alias("apps_are_text"))
    ids = stored.agg(F.count("*").alias("_n"), F.countDistinct("raw_id").alias("_ids"))
    return (total.withColumn("_k", F.lit(1)).join(ids.withColumn("_k", F.lit(1)), "_k")
            .select("n_read", "n_malformed", "n_inserted", (F.col("_n") == F.col("_ids")).alias("ids_unique"),
                    (F.col("_sum") & (F.col("_n") == F.col("n_inserted"))).alias("adds_up"), "apps_are_text"))


@register("stream_trend_monthly", W(O.PROCESSED, """SELECT app_name, year_month, sentiment, count(*) AS review_count
FROM processed WHERE year_month IS NOT NULL AND sentiment IS NOT NULL GROUP BY app_name, year_month, sentiment"""))
def stream_trend_monthly(spark, sf_dir):
    """I4: the monthly trend, kept up to date over two rounds of processed files; each round's changes are merged."""
    base = _scratch(spark, "stream-trend")
    proc, ck, trend = (os.path.join(base, x) for x in ("processed", "checkpoint", "trend"))
    done = P.process_reviews(ST.raw_reviews(spark, sf_dir)).checkpoint()
    for i, part in enumerate((ST.feed_history(done), ST.feed_increment(done))):
        part.write.mode("append").parquet(proc)
        SI.run_trend_stream(spark, proc, ck, trend)
    return SI.trend_table(spark, trend)


@register("catalog_runs", W(O.BASE + [
    ("run1", _dedupe(f"(SELECT * FROM raw_reviews WHERE review_ts < {SPLIT})")),
    ("run2", _dedupe("(SELECT * FROM raw_reviews WHERE review_id NOT IN (SELECT review_id FROM run1))")),
    ("runs", "SELECT *, 1 AS batch FROM run1 UNION ALL SELECT *, 2 AS batch FROM run2")],
    """SELECT CAST(batch AS BIGINT) AS batch, app_name, count(*) AS n_raw, count(*) AS n_processed, max(review_ts) AS newest
FROM runs GROUP BY batch, app_name"""))
def catalog_runs(spark, sf_dir):
    """Tables made in the catalog on a fresh folder, two runs, the second one replayed."""
    base = _scratch(spark, "warehouse")
    tables = Warehouse(spark, f"reviews_{uuid.uuid4().hex[:12]}", base, buckets=8).ensure()
    raw = ST.raw_reviews_full(spark, sf_dir)
    for batch, rows in ((1, ST.feed_history(raw)), (2, raw), (2, raw)):
        tables.insert_raw(rows, batch)
        tables.insert_processed(batch)
    n_raw = spark.table(tables.name("raw")).groupBy("batch", "app_name").agg(F.count(F.lit(1)).alias("n_raw"), F.max("review_ts").alias("newest"))
    n_done = spark.table(tables.name("processed")).groupBy("batch", "app_name").agg(F.count(F.lit(1)).alias("n_processed"))
    return n_raw.join(n_done, ["batch", "app_name"], "full").select("batch", "app_name", "n_raw", "n_processed", "newest")


# Feed lines broken by rule (as dirty_reviews plants its errors): a missing closing brace when
# the text length is a multiple of 11, a score written as a word when it is a multiple of 13.
BROKEN_BRACE = "length(review_text) % 11 = 0"
WORD_SCORE = "length(review_text) % 13 = 0"


@register("feed_rejects", W(O.BASE, f"""SELECT app_name AS app,
  count(*) FILTER (WHERE {BROKEN_BRACE} OR {WORD_SCORE}) AS n_rejects,
  count(*) FILTER (WHERE NOT ({BROKEN_BRACE} OR {WORD_SCORE})) AS n_good
FROM raw_reviews GROUP BY app_name"""))
def feed_rejects(spark, sf_dir):
    """Landed JSON lines read PERMISSIVE; malformed lines go to a rejects table, per app,
    and never stop the other apps."""
    base = _scratch(spark, "feed-rejects")
    raw = ST.raw_reviews(spark, sf_dir)
    feed = ST.as_feed(raw)
    line = F.to_json(F.struct(*[c for c in feed.columns if c != "app"]))
    n = F.length(F.col("content"))
    line = (F.when(n % 11 == 0, F.expr("substring(_l, 1, length(_l) - 1)"))
            .when(n % 13 == 0, F.regexp_replace("_l", r'"score":[0-9]+', '"score":"five"'))
            .otherwise(F.col("_l")))
    lines = feed.withColumn("_l", F.to_json(F.struct(*[c for c in feed.columns if c != "app"])))
    lines.select("app", line.alias("value")).write.mode("overwrite").partitionBy("app").text(base)
    good, rejects = FD.split_rejects(FD.read_feed(spark, base))
    g = good.groupBy("app").agg(F.count(F.lit(1)).alias("n_good"))
    r = rejects.groupBy("app").agg(F.count(F.lit(1)).alias("n_rejects"))
    return (g.join(r, "app", "full")
            .select("app", F.coalesce("n_rejects", F.lit(0)).alias("n_rejects"),
                    F.coalesce("n_good", F.lit(0)).alias("n_good")))
