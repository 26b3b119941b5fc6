"""Batch pipeline and streaming ingest: incremental runs, replays, gates."""

import os
import tempfile

from pyspark.sql import functions as F

from sentimart.plans.pipeline import processed_table, run_pipeline
from sentimart.session import checkpoint_path
from sentimart.sources import tables as ST
from sentimart.streaming import ingest as SI

from conftest import SF01


def test_pipeline_two_runs_and_replay(spark):
    root = checkpoint_path(spark, next(tempfile._get_candidate_names()))
    raw = ST.raw_reviews_full(spark, SF01)
    r1 = run_pipeline(spark, ST.feed_history(raw), root, 1)
    r2 = run_pipeline(spark, ST.feed_increment(raw), root, 2)
    assert r1.raw_inserted + r2.raw_inserted == 927
    assert r1.processed_inserted + r2.processed_inserted == 927
    assert all(p for _, _, p in r1.raw_gate + r2.raw_gate + r1.processed_gate + r2.processed_gate)
    # Replaying run 2 (e.g. after a failure) rewrites its own folders: same tables.
    r2b = run_pipeline(spark, ST.feed_increment(raw), root, 2)
    assert (r2b.raw_inserted, r2b.processed_inserted) == (r2.raw_inserted, r2.processed_inserted)
    p = processed_table(spark, root)
    assert p.count() == 927 and p.select("review_id").distinct().count() == 927


def test_stream_restart_from_checkpoint(spark):
    base = checkpoint_path(spark, next(tempfile._get_candidate_names()))
    feed, tables, ck = (os.path.join(base, x) for x in ("feed", "tables", "ck"))
    raw = ST.raw_reviews(spark, SF01)
    SI.land_feed(ST.as_feed(ST.feed_history(raw)), feed)
    SI.run_ingest_stream(spark, feed, tables, ck)
    n1 = SI.raw_table(spark, tables).count()
    # Restart with nothing new: the checkpoint knows every file, nothing is ingested twice.
    SI.run_ingest_stream(spark, feed, tables, ck)
    assert SI.raw_table(spark, tables).count() == n1
    SI.land_feed(ST.as_feed(ST.feed_increment(raw)), feed)
    SI.run_ingest_stream(spark, feed, tables, ck)
    t = SI.raw_table(spark, tables)
    assert t.count() == t.select("review_id").distinct().count() == 927
    # The watermark lies between the newest stored row and the newest fed row of each app.
    wm = {r.app_name: r.last_ts for r in SI.current_watermarks(spark, tables).collect()}
    mx = {r.app_name: r.m for r in raw.groupBy("app_name").agg(F.max("review_ts").alias("m")).collect()}
    st = {r.app_name: r.m for r in t.groupBy("app_name").agg(F.max("review_ts").alias("m")).collect()}
    assert set(wm) == set(mx) and all(st[a] <= wm[a] <= mx[a] for a in wm)


def test_gate_reads_the_new_run_and_stored_figures(spark):
    """Q2: the gate over all runs scans one batch folder and the small table of figures, and equals the whole-table gate."""
    from sentimart.operators import quality as Q

    root = checkpoint_path(spark, next(tempfile._get_candidate_names()))
    raw = ST.raw_reviews_full(spark, SF01)
    SI.commit_batch(ST.feed_history(raw), 1, root)
    SI.commit_batch(ST.feed_increment(raw), 2, root)
    new = spark.read.parquet(os.path.join(root, "raw", "batch=2"))
    gate = Q.gate_of_runs(spark, Q.RAW_METRICS, os.path.join(root, "raw_metrics"), new)
    scanned = {f.split(root)[1].split("/part-")[0] for f in gate.inputFiles()}
    assert {s for s in scanned if s.startswith("/raw/")} == {"/raw/batch=2"}
    assert sorted(map(tuple, gate.collect())) == sorted(map(tuple, Q.dq_gate_raw(SI.raw_table(spark, root)).collect()))
    assert not SI.path_exists(spark, os.path.join(root, "staged", "batch=1"))


def test_id_tables_are_read_without_an_exchange(spark):
    """The stored side of the check is a bucketed scan with no Exchange above it; a replay changes nothing."""
    from sentimart.operators import ingest as I
    from sentimart.sources.warehouse import Warehouse

    name = next(tempfile._get_candidate_names())
    w = Warehouse(spark, f"w{name}", checkpoint_path(spark, name), buckets=4).ensure().ensure()
    raw = ST.raw_reviews_full(spark, SF01)
    w.insert_raw(ST.feed_history(raw), 1)
    w.insert_raw(raw, 2)
    before = sorted(map(tuple, w.read("raw").select("raw_id", "review_id").collect()))
    w.insert_raw(raw, 2)
    assert sorted(map(tuple, w.read("raw").select("raw_id", "review_id").collect())) == before and len(before) == 927
    check = w.unseen(I.insert_or_ignore(None, raw), "raw_ids", "review_id", 3)
    plan = check._jdf.queryExecution().executedPlan().toString()
    stored = plan[plan.index("LeftAnti"):]
    scan = next(i for i, line in enumerate(stored.splitlines()) if "raw_ids" in line)
    lines = stored.splitlines()
    depth = len(lines[scan]) - len(lines[scan].lstrip(" :+-"))
    above = []
    for line in reversed(lines[:scan]):
        own = len(line) - len(line.lstrip(" :+-"))
        if own < depth:
            above.append(line.strip(" :+-"))
            depth = own
    assert not any(x.startswith("Exchange") for x in above), above
    assert check.count() == 0
    # The tables of another session are found again in the folder.
    again = Warehouse(spark, f"again{name}", checkpoint_path(spark, name), buckets=4).ensure()
    assert again.read("raw").count() == 927


def test_trend_is_maintained_by_key(spark):
    """I4: changed rows replace those of their key, a replayed batch writes the same, two versions stay."""
    root = checkpoint_path(spark, next(tempfile._get_candidate_names()))

    def rows(*n):
        return spark.createDataFrame([("a", k, "Neutral", v) for k, v in n], "app_name string, year_month string, sentiment string, review_count long") \
            .withColumn("year_month", F.to_date("year_month"))

    assert SI.trend_table(spark, root).count() == 0
    SI.merge_trend(rows(("2024-01-01", 1), ("2024-02-01", 5)), 0, root)
    for _ in range(2):
        SI.merge_trend(rows(("2024-02-01", 7), ("2024-03-01", 2)), 1, root)
    SI.merge_trend(rows(("2024-01-01", 3)), 2, root)
    got = {str(r.year_month): r.review_count for r in SI.trend_table(spark, root).collect()}
    assert got == {"2024-01-01": 3, "2024-02-01": 7, "2024-03-01": 2}
    assert SI._versions(spark, root) == [1, 2]
