"""Ingestion and data-quality jobs against the expectations in FIXTURES.md section 3."""

from pyspark.sql import functions as F

from sentimart.operators import ingest as I
from sentimart.operators import quality as Q
from sentimart.sources import tables as ST

from conftest import SF01


def _report(df):
    return {r["check"]: r["value"] for r in df.collect()}


def test_dq_report_expected_counts(spark):
    rep = _report(Q.dq_report(ST.dirty_reviews(spark, SF01), as_of=ST.DQ_AS_OF))
    assert rep == {"blank_app_name": 38, "blank_review_text": 22, "invalid_rating": 295,
                   "future_review_ts": 236, "duplicate_review_id": 2}


def test_null_rating_count(spark):
    assert ST.dirty_reviews(spark, SF01).filter(F.col("rating").isNull()).count() == 24


def test_insert_or_ignore_two_halves_and_replay(spark):
    d = ST.dirty_reviews(spark, SF01)
    h1, h2 = d.filter(F.col("raw_id") < 500), d.filter(F.col("raw_id") >= 500)
    t1 = I.insert_or_ignore(None, h1)
    t2 = I.insert_or_ignore(t1, h2)
    t12 = t1.unionByName(t2)
    t3 = I.insert_or_ignore(t12, h2)
    assert t12.count() + t3.count() == 629
    # Only null-id rows come back on a replay.
    assert t3.filter(F.col("review_id").isNotNull()).count() == 0


def test_insert_or_ignore_constraint_before_dedupe(spark):
    rows = [(1, "a", "k", 9), (2, "a", "k", 3), (3, None, "m", 3), (4, "a", None, 2), (5, "a", None, 2)]
    b = spark.createDataFrame(rows, "raw_id long, app_name string, review_id string, rating int")
    got = sorted(r.raw_id for r in I.insert_or_ignore(None, b).collect())
    # Row 1 breaks the rating check, so row 2 wins key k; null ids never conflict.
    assert got == [2, 4, 5]
    rej = {r.raw_id: r.reason for r in I.constraint_rejects(b).collect()}
    assert rej == {1: "rating_out_of_range", 3: "app_name_null"}


def test_incremental_runs_equal_one_run(spark):
    """Watermark runs over date-ordered chunks ingest the same keys as one run (strict >)."""
    raw = ST.raw_reviews(spark, SF01).select("raw_id", "app_name", "review_id", "rating", "review_ts")
    one = I.insert_or_ignore(None, raw)
    h, inc = ST.feed_history(raw), ST.feed_increment(raw)
    t1 = I.insert_or_ignore(None, h)
    wm = I.watermark_upsert(None, t1)
    new = I.insert_or_ignore(t1, I.incremental_filter(inc, wm).drop("last_ts"))
    two = t1.unionByName(new)
    assert sorted(r.review_id for r in one.collect()) == sorted(r.review_id for r in two.collect())


def test_cap_per_app_keeps_newest(spark):
    raw = ST.raw_reviews(spark, SF01)
    capped = I.cap_per_app(raw, n=3)
    per_app = {r.app_name: r.n for r in capped.groupBy("app_name").agg(F.count("*").alias("n")).collect()}
    assert set(per_app.values()) == {3}
    newest = raw.groupBy("app_name").agg(F.max("review_ts").alias("m"))
    top = capped.filter("feed_rank = 1").join(newest, "app_name")
    assert top.filter(F.col("review_ts") != F.col("m")).count() == 0


def test_gate_raises_on_failure(spark):
    import pytest
    rep = Q.dq_gate_raw(ST.dirty_reviews(spark, SF01))
    with pytest.raises(Q.GateFailed):
        Q.enforce(rep)
    # raw_reviews holds exact copies inside one app; the inserted table does not.
    ok = Q.dq_gate_raw(I.insert_or_ignore(None, ST.raw_reviews(spark, SF01)))
    Q.enforce(ok)


def test_k_date_ordered_chunks_equal_one_run(spark):
    """Three watermark runs over date-ordered chunks insert exactly what one run inserts."""
    raw = ST.dirty_reviews(spark, SF01)
    one = I.insert_or_ignore(None, raw).filter(F.col("review_id").isNotNull())
    cuts = ["2024-05-01 00:00:00", "2024-09-01 00:00:00"]
    ts = F.col("review_ts")
    chunks = [raw.filter(ts < F.lit(cuts[0]).cast("timestamp_ntz")),
              raw.filter((ts >= F.lit(cuts[0]).cast("timestamp_ntz")) & (ts < F.lit(cuts[1]).cast("timestamp_ntz"))),
              raw.filter(ts >= F.lit(cuts[1]).cast("timestamp_ntz"))]
    table, wm = None, None
    for c in chunks:
        fresh = c if wm is None else I.incremental_filter(c, wm).drop("last_ts")
        new = I.insert_or_ignore(table, fresh)
        table = new if table is None else table.unionByName(new)
        wm = I.watermark_upsert(wm, fresh)
    many = table.filter(F.col("review_id").isNotNull())
    assert sorted(r.review_id for r in many.collect()) == sorted(r.review_id for r in one.collect())


def test_insert_or_ignore_is_idempotent(spark):
    raw = ST.dirty_reviews(spark, SF01)
    t = I.insert_or_ignore(None, raw)
    again = I.insert_or_ignore(t, raw)
    # Only rows without an id come back (they never conflict, as in the reference).
    assert again.filter(F.col("review_id").isNotNull()).count() == 0
    assert again.count() == t.filter(F.col("review_id").isNull()).count()


def test_feed_is_not_dealt_by_app(spark):
    """Watermarks (one row per app) go to the rows, also where AQE is off, as in a stream's batch."""
    feed = spark.createDataFrame([(i, "a", "2024-01-0%d" % (i % 9 + 1)) for i in range(20)], "raw_id long, app_name string, d string").withColumn("review_ts", F.col("d").cast("timestamp_ntz"))
    before = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = I.incremental_filter(feed, I.watermarks_from(feed.filter("raw_id < 5")))
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert fresh.count() == sum(i % 9 + 1 > 5 for i in range(20))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before[0])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before[1])
