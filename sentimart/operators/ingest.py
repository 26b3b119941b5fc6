"""Ingestion: watermarks, incremental filter, cap, constraints and insert-or-ignore
(F1, F2, S6-S9, S12, Q4, N1, I1).

One job covers all apps; nothing loops over apps on the driver. The watermark table has one row
per app and is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sentimart import resources as R


def watermarks_from(rows: DataFrame) -> DataFrame:
    """Newest review time per app (nulls skipped); apps without any time get no row."""
    return (rows.groupBy("app_name").agg(F.max("review_ts").alias("last_ts"))
            .filter(F.col("last_ts").isNotNull()))


def watermark_lookup(feed: DataFrame, watermarks: DataFrame) -> DataFrame:
    """Attach each app's last watermark (null when the app was never ingested).

    The watermarks have one row per app and are broadcast: dealt by app, a feed of few apps would lie in as few tasks,
    texts and all, and a stream's batches run without AQE.
    """
    return feed.join(F.broadcast(watermarks.select("app_name", "last_ts")), "app_name", "left")


def incremental_filter(feed: DataFrame, watermarks: DataFrame, inclusive: bool = False) -> DataFrame:
    """keep rows newer than the app's watermark; no watermark or no date -> kept.

    ``inclusive=True`` also keeps rows at the watermark (safe: insert-or-ignore dedupes them).
    """
    j = watermark_lookup(feed, watermarks)
    ts, wm = F.col("review_ts"), F.col("last_ts")
    newer = ts >= wm if inclusive else ts > wm
    return j.filter(wm.isNull() | ts.isNull() | newer)


def cap_per_app(rows: DataFrame, n: int) -> DataFrame:
    """The n newest rows per app (feed order: newest first, undated last).

    ``row_number() <= n`` becomes a partial top-n per map task, so a hot app never funnels
    its whole feed into one task.
    """
    w = Window.partitionBy("app_name").orderBy(F.col("review_ts").desc_nulls_last(), F.col("raw_id"))
    return rows.withColumn("feed_rank", F.row_number().over(w)).filter(F.col("feed_rank") <= n)


def cap_report(rows: DataFrame, n: int) -> DataFrame:
    """Per app, rows offered, rows kept by the cap and rows skipped by it.

    Jobs never cap unless asked; an asked-for cap leaves the app's watermark where it was as
    long as rows are skipped (``uncapped_watermarks``), so later runs fetch them.
    """
    c = rows.groupBy("app_name").agg(F.count(F.lit(1)).alias("n_candidates"))
    return c.select("app_name", "n_candidates",
                    F.least(F.col("n_candidates"), F.lit(n)).alias("n_kept"),
                    F.greatest(F.col("n_candidates") - n, F.lit(0)).alias("skipped_by_cap"))


def uncapped_watermarks(rows: DataFrame, n: int) -> DataFrame:
    """Watermarks of the apps whose rows all fit under a cap of n; others must not advance."""
    whole = cap_report(rows, n).filter("skipped_by_cap = 0").select("app_name")
    return watermarks_from(rows.join(whole, "app_name", "left_semi"))


def with_raw_ids(staged: DataFrame, target: DataFrame, pos_col: str) -> DataFrame:
    """Row ids for rows that have none: above every id of the table and of the batch itself.

    ``staged`` is a written table whose ``pos_col`` numbers its rows (any gaps), so ids are the
    same at every reading; arrival order is kept within and across batches.
    """
    top = target.select("raw_id").union(staged.select("raw_id")).agg(F.coalesce(F.max("raw_id"), F.lit(-1)).alias("m"))
    first = int(top.first()["m"]) + 1
    return staged.withColumn("raw_id", F.coalesce("raw_id", F.lit(first) + F.col(pos_col))).drop(pos_col)


def constraint_reason(kind: str = "raw") -> Column:
    """Q4: first violated constraint of a row, or null."""
    reason = (F.when(F.col("app_name").isNull(), F.lit("app_name_null"))
              .when(F.col("rating").isNull(), F.lit("rating_null"))
              .when(~F.col("rating").between(1, 5), F.lit("rating_out_of_range")))
    if kind == "processed":
        reason = reason.when(
            F.col("sentiment").isNotNull() & ~F.col("sentiment").isin(*R.SENTIMENT_LABELS),
            F.lit("sentiment_not_in_domain"))
    return reason


def review_key() -> Column:
    """Uniqueness key: the review id; a null id never conflicts, so it gets a per-row key."""
    return F.coalesce(F.col("review_id"), F.concat(F.lit("\u0000null:"), F.col("raw_id").cast("string")))


def first_arrivals(rows: DataFrame) -> DataFrame:
    """First row (by arrival = raw_id) per review id; null-id rows all stay."""
    w = Window.partitionBy(review_key()).orderBy("raw_id")
    return rows.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def anti_join_existing(batch: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows of ``batch`` whose non-null ``key`` is not in ``target`` (null keys are kept).

    The target (a whole table) only contributes its key column, and first meets the batch's
    distinct keys in a semi join: AQE broadcasts those keys when the batch is small, so the
    table is scanned but never shuffled. The anti join then runs between two small sides.
    """
    keys = batch.select(key).filter(F.col(key).isNotNull()).distinct()
    present = target.select(key).filter(F.col(key).isNotNull()).join(keys, key, "left_semi").distinct()
    return batch.join(present, key, "left_anti")


def insert_or_ignore(target: DataFrame | None, batch: DataFrame, kind: str = "raw") -> DataFrame:
    """Rows of ``batch`` that an INSERT OR IGNORE into ``target`` would add.

    Constraint filter first (a bad first row must not hide a good second one), then the first
    arrival per key, then ``left_anti`` against keys already in the target. Same result as
    anti join first, but a review id copied a million times is cut to one row per map task
    (partial WindowGroupLimit) before any join shuffle. The caller appends.
    """
    ok = first_arrivals(batch.filter(constraint_reason(kind).isNull()))
    if target is not None:
        ok = anti_join_existing(ok, target, "review_id")
    return ok


def constraint_rejects(batch: DataFrame, target: DataFrame | None = None, kind: str = "raw") -> DataFrame:
    """Q4: rows an insert would drop, with the reason (constraint, or duplicate id)."""
    reason = constraint_reason(kind)
    bad = batch.withColumn("reason", reason).filter(F.col("reason").isNotNull())
    ok = batch.filter(reason.isNull())
    if target is not None:
        existing = target.select("review_id").filter(F.col("review_id").isNotNull()).distinct() \
            .withColumn("_exists", F.lit(True))
        ok = ok.join(existing, "review_id", "left")
    else:
        ok = ok.withColumn("_exists", F.lit(None).cast("boolean"))
    # First arrival per key as an aggregate (partial, map-side) joined back, not a window: a
    # key copied across a third of the rows never lands whole in one task (AQE splits the
    # skewed side of the join; the aggregate side has one row per key).
    ok = ok.withColumn("_key", review_key())
    firsts = ok.groupBy("_key").agg(F.min("raw_id").alias("_first"))
    ok = ok.join(firsts, "_key")
    dup = ok.filter(F.col("_exists").isNotNull() | (F.col("raw_id") != F.col("_first"))).withColumn(
        "reason", F.lit("duplicate_review_id"))
    cols = ["raw_id", "app_name", "review_id", "rating", "reason"]
    return bad.select(*cols).unionByName(dup.select(*cols))


def run_counts(batch: DataFrame, target: DataFrame | None = None, kind: str = "raw") -> DataFrame:
    """Per app, rows read, rejected by a constraint, ignored as duplicates, inserted."""
    rejects = constraint_rejects(batch, target, kind)
    per_reason = rejects.groupBy("app_name").agg(
        F.count(F.when(F.col("reason") != "duplicate_review_id", 1)).alias("n_rejected"),
        F.count(F.when(F.col("reason") == "duplicate_review_id", 1)).alias("n_ignored"),
    )
    read = batch.groupBy("app_name").agg(F.count(F.lit(1)).alias("n_read"))
    out = read.join(per_reason, read.app_name.eqNullSafe(per_reason.app_name), "left").select(
        read.app_name, "n_read",
        F.coalesce("n_rejected", F.lit(0)).alias("n_rejected"),
        F.coalesce("n_ignored", F.lit(0)).alias("n_ignored"))
    return out.withColumn("n_inserted", F.col("n_read") - F.col("n_rejected") - F.col("n_ignored"))


def watermark_upsert(old: DataFrame | None, ingested: DataFrame) -> DataFrame:
    """One row per app, the newest review time seen; advances only from committed rows."""
    new = watermarks_from(ingested)
    if old is None:
        return new
    return (old.select("app_name", "last_ts").unionByName(new)
            .groupBy("app_name").agg(F.max("last_ts").alias("last_ts")))
