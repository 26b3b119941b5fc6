"""Structured Streaming ingestion (I1, I2) and a live monthly trend (I4).

Feed files land under ``<feed_root>/app=<name>/*.json``. The ingest stream reads them with the
file source (each file once, progress in the checkpoint) and runs one ``foreachBatch`` per
micro-batch:

1. parse the lines; malformed ones go to ``rejects/batch=<id>`` with their text (S14);
2. feed record -> raw row (S3), stored in ``staged/batch=<id>``; rows without a feed position
   get ids above all ids in use, once (``with_raw_ids``);
3. per-app watermark from the watermark log, strict ``>`` filter (F1, I1);
4. insert-or-ignore against the raw table written so far (S7, I2: global uniqueness);
   constraint violations go to the rejects too, and each app's counts to ``runs/batch=<id>``;
5. write ``raw/batch=<id>`` and then ``watermarks/batch=<id>`` (the watermark goes last; it is
   the newest date among the rows read, ignored duplicates included).

No row is capped unless ``max_per_app`` is given; then an app's watermark stays where it is as
long as the cap skips rows of it, so that a later run fetches them.

Each batch writes only folders named by its batch id, with overwrite: a replayed batch (after a
lost executor or driver) rewrites the same folders, and it reads the tables *without* its own
folder, so a half-written attempt never hides rows from the replay. The watermark log is
append-only; the current watermark of an app is the max over the log.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentimart import schemas as S
from sentimart.operators import ingest as I
from sentimart.operators import quality as Q
from sentimart.sources import feed as FD

def land_feed(rows: DataFrame, feed_root: str) -> None:
    """Append feed records (``sources.tables.as_feed`` shape) as JSON lines, one folder per app."""
    rows.write.mode("append").partitionBy("app").json(feed_root)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of the path (local, HDFS, object store)."""
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def _read_or_empty(spark: SparkSession, path: str, schema: T.StructType, exclude_batch: int | None) -> DataFrame:
    """Table folder with ``batch=<id>`` sub-folders; empty frame before the first batch."""
    with_batch = T.StructType(schema.fields + [T.StructField("batch", T.LongType())])
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    df = spark.read.schema(with_batch).parquet(path)
    if exclude_batch is not None:
        df = df.filter(F.col("batch") != exclude_batch)
    return df.drop("batch")


def current_watermarks(spark: SparkSession, tables_root: str, exclude_batch: int | None = None) -> DataFrame:
    log = _read_or_empty(spark, os.path.join(tables_root, "watermarks"), S.WATERMARKS, exclude_batch)
    return log.groupBy("app_name").agg(F.max("last_ts").alias("last_ts"))


def raw_table(spark: SparkSession, tables_root: str, exclude_batch: int | None = None) -> DataFrame:
    return _read_or_empty(spark, os.path.join(tables_root, "raw"), S.RAW, exclude_batch)


def _batch_path(root: str, table: str, batch_id: int) -> str:
    return os.path.join(root, table, f"batch={batch_id}")


def commit_batch(rows: DataFrame, batch_id: int, tables_root: str, max_per_app: int | None = None,
                 malformed: DataFrame | None = None) -> DataFrame:
    """Store one batch of raw-shaped rows; returns the batch's run counts (one row per app).

    read = too old + rejected + ignored + capped + inserted, for every app.
    """
    spark = rows.sparkSession
    staged = _batch_path(tables_root, "staged", batch_id)
    rows.select(*S.RAW_COLUMNS).withColumn("_pos", F.monotonically_increasing_id()).write.mode("overwrite").parquet(staged)
    target = raw_table(spark, tables_root, exclude_batch=batch_id)
    read = I.with_raw_ids(spark.read.parquet(staged), target, "_pos")
    wm = current_watermarks(spark, tables_root, exclude_batch=batch_id)
    fresh = I.incremental_filter(read, wm).drop("last_ts")
    new = I.insert_or_ignore(target, fresh).select(*S.RAW_COLUMNS)
    # Duplicates go before the cap: a run never spends its cap on rows that are stored already.
    capped = new if max_per_app is None else I.cap_per_app(new, max_per_app).drop("feed_rank")
    raw_path = _batch_path(tables_root, "raw", batch_id)
    Q.write_observed(capped, Q.RAW_METRICS, raw_path, _batch_path(tables_root, "raw_metrics", batch_id))

    rejects = I.constraint_rejects(fresh).filter("reason <> 'duplicate_review_id'")
    rejects = rejects.select("app_name", F.col("raw_id").cast("string").alias("line"), "reason")
    if malformed is not None:
        rejects = rejects.unionByName(malformed.select(F.col("app").alias("app_name"), "line", "reason"))
    rejects.write.mode("overwrite").parquet(_batch_path(tables_root, "rejects", batch_id))
    counts = _run_counts(read, fresh, spark.read.schema(rejects.schema).parquet(_batch_path(tables_root, "rejects", batch_id)),
                         spark.read.schema(S.RAW).parquet(raw_path))
    counts.write.mode("overwrite").parquet(_batch_path(tables_root, "runs", batch_id))

    # The watermark is written only after the raw commit and never passes rows that were skipped.
    seen = I.watermarks_from(fresh)
    if max_per_app is not None:
        held = I.cap_report(new, max_per_app).filter("skipped_by_cap > 0").select("app_name")
        seen = seen.join(held, "app_name", "left_anti")
    seen.write.mode("overwrite").parquet(_batch_path(tables_root, "watermarks", batch_id))
    remove_folder(spark, staged)
    return spark.read.schema(counts.schema).parquet(_batch_path(tables_root, "runs", batch_id))


def _run_counts(read: DataFrame, fresh: DataFrame, rejects: DataFrame, stored: DataFrame) -> DataFrame:
    """Per app, lines read, malformed, too old, rejected by a constraint, not stored otherwise
    (duplicates, or over an asked-for cap) and inserted; one partial sum over the four tables."""
    def tag(df: DataFrame, name: str) -> DataFrame:
        return df.select("app_name", F.lit(name).alias("t"))

    bad = F.when(F.col("reason") == "malformed_record", F.lit("malformed")).otherwise(F.lit("rejected"))
    tagged = (tag(read, "read").unionByName(tag(fresh, "fresh")).unionByName(tag(stored, "stored"))
              .unionByName(rejects.select("app_name", bad.alias("t"))))
    n = {t: F.count(F.when(F.col("t") == t, 1)) for t in ("read", "fresh", "malformed", "rejected", "stored")}
    return tagged.groupBy("app_name").agg(
        (n["read"] + n["malformed"]).alias("n_read"), n["malformed"].alias("n_malformed"),
        (n["read"] - n["fresh"]).alias("n_old"), n["rejected"].alias("n_rejected"),
        (n["fresh"] - n["rejected"] - n["stored"]).alias("n_ignored"), n["stored"].alias("n_inserted"))


def ingest_batch(lines: DataFrame, batch_id: int, tables_root: str, max_per_app: int | None = None,
                 scraped_at: str | None = None) -> None:
    """One micro-batch of feed lines (value, app)."""
    good, malformed = FD.split_rejects(FD.parse_lines(lines))
    commit_batch(FD.map_feed_record(good, scraped_at), batch_id, tables_root, max_per_app, malformed)


def run_ingest_stream(spark: SparkSession, feed_root: str, tables_root: str, checkpoint: str,
                      max_per_app: int | None = None, scraped_at: str | None = None) -> None:
    """Process every feed file landed so far, then stop (``availableNow``).

    Uniqueness of review ids is exact through the insert-or-ignore of each batch, for any delay;
    the stream itself keeps no state, so late rows and rows without an id are never dropped.
    """
    q = (FD.stream_lines(spark, feed_root).writeStream
         .foreachBatch(lambda df, bid: ingest_batch(df, bid, tables_root, max_per_app, scraped_at))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()


def trend_stream(spark: SparkSession, processed_root: str) -> DataFrame:
    """I4: monthly label counts over a stream of processed rows (state: one row per app, month and label)."""
    src = spark.readStream.schema(S.PROCESSED).parquet(processed_root)
    return (src.filter(F.col("year_month").isNotNull() & F.col("sentiment").isNotNull())
            .groupBy("app_name", "year_month", "sentiment")
            .agg(F.count(F.lit(1)).alias("review_count")))


TREND = T.StructType([T.StructField("app_name", T.StringType()), T.StructField("year_month", T.DateType()),
                      T.StructField("sentiment", T.StringType()), T.StructField("review_count", T.LongType())])
TREND_KEY = ["app_name", "year_month", "sentiment"]


def _versions(spark: SparkSession, root: str) -> list[int]:
    """Versions of a keyed table that were written whole, ascending."""
    if not path_exists(spark, root):
        return []
    fs, path = _file_system(spark, root)
    names = [status.getPath().getName() for status in fs.listStatus(path)]
    return sorted(int(n[2:]) for n in names if n.startswith("v=") and path_exists(spark, os.path.join(root, n, "_SUCCESS")))


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def merge_trend(changed: DataFrame, batch_id: int, root: str) -> None:
    """The batch's changed rows take the place of those of the same key: a new version of the folder.

    Batch n writes version n from the newest version before it, so a replayed batch writes the same files.
    The two newest versions stay, for readers that have opened the older one.
    """
    spark = changed.sparkSession
    old = [v for v in _versions(spark, root) if v < batch_id]
    rows = changed.select(*TREND_KEY, "review_count")
    if old:
        before = spark.read.schema(TREND).parquet(os.path.join(root, f"v={old[-1]}"))
        rows = before.join(rows.select(*TREND_KEY), TREND_KEY, "left_anti").unionByName(rows)
    rows.write.mode("overwrite").parquet(os.path.join(root, f"v={batch_id}"))
    for v in old[:-1]:
        remove_folder(spark, os.path.join(root, f"v={v}"))


def trend_table(spark: SparkSession, root: str) -> DataFrame:
    """The newest version of the maintained trend; empty before the first batch."""
    found = _versions(spark, root)
    return spark.read.schema(TREND).parquet(os.path.join(root, f"v={found[-1]}")) if found else spark.createDataFrame([], TREND)


def run_trend_stream(spark: SparkSession, processed_root: str, checkpoint: str, trend_root: str) -> DataFrame:
    """Run the trend stream over the files present now; each micro-batch's changes are merged into ``trend_root``.

    Update mode: a batch hands on the changed rows only. Nothing of the result goes through the driver.
    """
    q = (trend_stream(spark, processed_root).writeStream
         .outputMode("update").foreachBatch(lambda df, batch_id: merge_trend(df, batch_id, trend_root))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return trend_table(spark, trend_root)
