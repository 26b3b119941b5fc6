"""Queries for ingestion: watermarks, incremental filter, cap, insert-or-ignore (F1-F2, S6-S9,
S12, Q4). The feed is raw_reviews (or dirty_reviews) split by date into history and increment.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sentimart.operators import ingest as I
from sentimart.operators import process as P
from sentimart.plans import oracle as O
from sentimart.plans.catalog import register
from sentimart.sources import tables as ST

W = O.with_ctes
SPLIT = O.ts(ST.FEED_SPLIT_TS)
WM = O.BASE + [("wm", f"""SELECT app_name, max(review_ts) AS last_ts FROM raw_reviews WHERE review_ts < {SPLIT}
GROUP BY app_name HAVING max(review_ts) IS NOT NULL""")]
INC = WM + [("inc", """SELECT r.raw_id, r.app_name, r.review_ts, w.last_ts FROM raw_reviews r
LEFT JOIN wm w ON w.app_name = r.app_name
WHERE w.last_ts IS NULL OR r.review_ts IS NULL OR r.review_ts > w.last_ts""")]


def _feed(spark, sf_dir):
    return ST.raw_reviews(spark, sf_dir).select("raw_id", "app_name", "review_ts")


def _history_wm(spark, sf_dir):
    return I.watermarks_from(ST.feed_history(_feed(spark, sf_dir)))


#: A cap is only ever an explicit argument; this one cuts rows at every scale.
CAP = 7


@register("watermark_lookup", W(WM, f"""SELECT r.raw_id, r.app_name, r.review_ts, w.last_ts FROM raw_reviews r
LEFT JOIN wm w ON w.app_name = r.app_name WHERE r.review_ts >= {SPLIT}"""))
def watermark_lookup(spark, sf_dir):
    """Each increment row with its app's last watermark (from the history run)."""
    inc = ST.feed_increment(_feed(spark, sf_dir))
    return I.watermark_lookup(inc, _history_wm(spark, sf_dir))


@register("incremental_filter", W(INC, "SELECT raw_id, app_name, review_ts, last_ts FROM inc"))
def incremental_filter(spark, sf_dir):
    """Feed rows newer than the app's watermark (strict >; no watermark -> all)."""
    return I.incremental_filter(_feed(spark, sf_dir), _history_wm(spark, sf_dir))


@register("cap_per_app", W(INC, f"""SELECT raw_id, app_name, review_ts, last_ts, feed_rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY app_name ORDER BY review_ts DESC NULLS LAST, raw_id) AS INT) AS feed_rank
  FROM inc) WHERE feed_rank <= {CAP}"""))
def cap_per_app(spark, sf_dir):
    """The CAP newest rows per app of the incremental run."""
    rows = I.incremental_filter(_feed(spark, sf_dir), _history_wm(spark, sf_dir))
    return I.cap_per_app(rows, CAP).withColumn("feed_rank", F.col("feed_rank").cast("int"))


@register("cap_report", W(INC, f"""SELECT app_name, count(*) AS n_candidates,
  least(count(*), {CAP}) AS n_kept, greatest(count(*) - {CAP}, 0) AS skipped_by_cap
FROM inc GROUP BY app_name"""))
def cap_report(spark, sf_dir):
    """Rows the per-app cap keeps and skips in the incremental run."""
    rows = I.incremental_filter(_feed(spark, sf_dir), _history_wm(spark, sf_dir))
    return I.cap_report(rows, CAP)


@register("watermark_upsert", W(INC + [("new", """SELECT app_name, max(review_ts) AS last_ts FROM inc
GROUP BY app_name HAVING max(review_ts) IS NOT NULL""")], """SELECT app_name, max(last_ts) AS last_ts
FROM (SELECT app_name, last_ts FROM wm UNION ALL SELECT app_name, last_ts FROM new) GROUP BY app_name"""))
def watermark_upsert(spark, sf_dir):
    """Watermark table after the incremental run (one row per app)."""
    old = _history_wm(spark, sf_dir)
    ingested = I.incremental_filter(_feed(spark, sf_dir), old)
    return I.watermark_upsert(old, ingested)


# ------------------------------------------------------------------------------ insert-or-ignore
RAW_VALID = "app_name IS NOT NULL AND rating BETWEEN 1 AND 5"
KEY = "coalesce(review_id, chr(0) || 'null:' || CAST(raw_id AS VARCHAR))"


def _run_sql(n: int, rel: str, prior: list[str]) -> str:
    anti = ""
    if prior:
        ids = " UNION ALL ".join(f"SELECT review_id FROM {p} WHERE review_id IS NOT NULL" for p in prior)
        anti = f" AND (review_id IS NULL OR review_id NOT IN ({ids}))"
    return (f"SELECT {n} AS run, raw_id, app_name, review_id, rating FROM {rel} WHERE {RAW_VALID}{anti} "
            f"QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY raw_id) = 1")


@register("insert_or_ignore_raw", W(O.DIRTY + [
    ("h", f"SELECT * FROM dirty_reviews WHERE review_ts < {SPLIT}"),
    ("i", f"SELECT * FROM dirty_reviews WHERE review_ts >= {SPLIT}"),
    ("run1", _run_sql(1, "h", [])),
    ("run2", _run_sql(2, "i", ["run1"])),
    ("run3", _run_sql(3, "i", ["run1", "run2"])),
], "SELECT * FROM run1 UNION ALL SELECT * FROM run2 UNION ALL SELECT * FROM run3"))
def insert_or_ignore_raw(spark, sf_dir):
    """Dirty feed inserted as history, then increment, then increment again."""
    d = ST.dirty_reviews(spark, sf_dir)
    h, i = ST.feed_history(d), ST.feed_increment(d)
    cols = ["run", "raw_id", "app_name", "review_id", "rating"]
    t1 = I.insert_or_ignore(None, h).withColumn("run", F.lit(1))
    t2 = I.insert_or_ignore(t1, i).withColumn("run", F.lit(2))
    t12 = t1.select(*cols).unionByName(t2.select(*cols))
    t3 = I.insert_or_ignore(t12, i).withColumn("run", F.lit(3))
    return t12.unionByName(t3.select(*cols))


PROC_COLS = "raw_id, app_name, review_id, cleaned_text, word_count, sentiment_score, sentiment"


@register("insert_or_ignore_processed", W(
    O.BASE + [("raw_h", f"SELECT * FROM raw_reviews WHERE review_ts < {SPLIT}")]
    + O.processed_ctes("raw_h", "p1")
    + [("raw_2", """SELECT * FROM raw_reviews WHERE raw_id NOT IN (SELECT raw_id FROM p1)
AND (review_id IS NULL OR review_id NOT IN (SELECT review_id FROM p1 WHERE review_id IS NOT NULL))""")]
    + O.processed_ctes("raw_2", "p2"),
    f"SELECT 1 AS run, {PROC_COLS} FROM p1 UNION ALL SELECT 2 AS run, {PROC_COLS} FROM p2"))
def insert_or_ignore_processed(spark, sf_dir):
    """History processed first, then all raw rows again; processed keys are skipped
    before any text work (left_anti on raw_id and review_id)."""
    raw = ST.raw_reviews(spark, sf_dir)
    cols = [c.strip() for c in PROC_COLS.split(",")]
    p1 = P.process_reviews(ST.feed_history(raw))
    p2 = P.process_reviews(raw, existing=p1)
    return (p1.select(F.lit(1).alias("run"), *cols)
            .unionByName(p2.select(F.lit(2).alias("run"), *cols)))


REASON = ("CASE WHEN app_name IS NULL THEN 'app_name_null' WHEN rating IS NULL THEN 'rating_null' "
          "WHEN NOT (rating BETWEEN 1 AND 5) THEN 'rating_out_of_range' END")
REJECTS = O.DIRTY + [("rej", f"""SELECT raw_id, app_name, review_id, rating, {REASON} AS reason FROM dirty_reviews
WHERE {REASON} IS NOT NULL
UNION ALL
SELECT raw_id, app_name, review_id, rating, 'duplicate_review_id' AS reason FROM (
  SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY raw_id) AS rn FROM dirty_reviews WHERE {RAW_VALID})
WHERE rn > 1""")]


@register("constraint_rejects", W(REJECTS, "SELECT * FROM rej"))
def constraint_rejects(spark, sf_dir):
    """Q4: rows an insert into an empty raw table drops, with the first failed constraint."""
    return I.constraint_rejects(ST.dirty_reviews(spark, sf_dir))


@register("run_counts", W(REJECTS, """SELECT d.app_name, d.n_read,
  coalesce(r.n_rejected, 0) AS n_rejected, coalesce(r.n_ignored, 0) AS n_ignored,
  d.n_read - coalesce(r.n_rejected, 0) - coalesce(r.n_ignored, 0) AS n_inserted
FROM (SELECT app_name, count(*) AS n_read FROM dirty_reviews GROUP BY app_name) d
LEFT JOIN (SELECT app_name, count(*) FILTER (WHERE reason <> 'duplicate_review_id') AS n_rejected,
                  count(*) FILTER (WHERE reason = 'duplicate_review_id') AS n_ignored
           FROM rej GROUP BY app_name) r ON d.app_name IS NOT DISTINCT FROM r.app_name"""))
def run_counts(spark, sf_dir):
    """Per app, rows read / rejected / ignored / inserted in one run of the dirty feed."""
    return I.run_counts(ST.dirty_reviews(spark, sf_dir))
