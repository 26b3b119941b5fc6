"""Physical plans: no Python on the default path, partial top-k, broadcasts, pushdown, pruning."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from sentimart.operators import marts as M
from sentimart.sources import tables as ST

from conftest import SF001, SF01


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["scan_processed", "top_unigrams", "top_bigrams_corpus", "kpi_overview",
                                  "examples_neutral", "insert_or_ignore_raw", "dq_report"])
def test_no_python_udf(spark, name):
    p = plan(E.queries()[name](spark, SF001))
    for op in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas"):
        assert op not in p


@pytest.mark.parametrize("name", ["top_unigrams", "examples_positive", "cap_per_app"])
def test_top_k_is_partial_before_shuffle(spark, name):
    p = optimized(E.queries()[name](spark, SF001))
    assert "WindowGroupLimit" in p


def test_lexicon_is_broadcast(spark):
    df = E.queries()["scan_processed"](spark, SF001)
    df._jdf.queryExecution().executedPlan()
    assert "BroadcastExchange" in df._jdf.queryExecution().toString() or "broadcast" in optimized(df).lower()


def test_app_filter_pushed_to_scan_and_columns_pruned(spark):
    raw = ST.raw_reviews(spark, SF001)
    df = M.rating_distribution(raw).filter(F.col("app_name") == "src1")
    p = plan(df)
    pushed = p.split("PushedFilters: [")[1].split("]")[0]
    assert "EqualTo(source,src1)" in pushed
    read_schema = p.split("ReadSchema: ")[1].split("\n")[0]
    assert "text" not in read_schema and "source" in read_schema


def test_no_cross_join(spark):
    for name in ("sentiment_distribution", "kpi_overview", "filter_app", "dq_report", "dq_gate_raw"):
        p = plan(E.queries()[name](spark, SF001))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_batch_vs_table_check_does_not_shuffle_the_table(spark):
    """After execution, AQE's final plan joins the table's ids to the broadcast batch keys."""
    from sentimart.operators import ingest as I
    from conftest import SF01
    raw = ST.raw_reviews(spark, SF01)
    cut = F.lit("2024-12-01").cast("timestamp_ntz")
    df = I.insert_or_ignore(raw.filter(F.col("review_ts") < cut), raw.filter(F.col("review_ts") >= cut))
    df.write.format("noop").mode("overwrite").save()
    p = plan(df)
    assert "BroadcastHashJoin" in p and "LeftSemi" in p and "SortMergeJoin" not in p


@pytest.mark.parametrize("name", ["scan_processed", "sentiment_trend_monthly", "top_bigrams_corpus", "examples_formatted"])
def test_no_exchange_between_the_steps_of_a_document(spark, name):
    """Texts are dealt by document once; scores, lemmas and attributes then meet without a further exchange by raw_id."""
    p = plan(E.queries()[name](spark, SF001))
    by_id = [line for line in p.splitlines() if "Exchange hashpartitioning(raw_id" in line]
    assert by_id and all("ENSURE_REQUIREMENTS" in line for line in by_id)
    assert not [line for line in p.splitlines() if "Exchange hashpartitioning(raw_id" in line and ", pos" in line]


def test_unused_results_are_not_computed(spark):
    """The trend needs scores only: no lemmas are gathered; the global count needs neither."""
    assert "collect_list(struct(pos" not in plan(E.queries()["sentiment_trend_monthly"](spark, SF001))
    assert "posexplode" not in plan(E.queries()["processed_total"](spark, SF001))


def test_corpus_bigrams_make_the_tokens_once(spark):
    """Pairs and edges read one shuffle; a map inside a literal of the text chain made Spark run it all for each."""
    df = E.queries()["top_bigrams_corpus"](spark, SF001)
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    assert final.count("posexplode(_toks") == 1 and "ReusedExchange" in final


def test_no_job_while_a_plan_is_built(spark):
    from sentimart.operators import ngrams as N
    from sentimart.operators import process as P
    raw = ST.raw_reviews(spark, SF001)  # reads the file's schema
    spark.sparkContext.setJobGroup("building", "plans only")
    try:
        processed = P.process_reviews(raw, existing=P.process_reviews(raw).filter("rating > 3"))
        M.sentiment_trend_monthly(processed), M.kpi_formatted(raw, processed), N.top_bigrams_corpus(processed), M.examples_formatted(M.join_examples(raw, processed))
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) == []
    finally:
        spark.sparkContext._jsc.sc().clearJobGroup()


def test_score_plan_does_not_grow_with_the_tables(spark):
    """Word lists are joined: ten times the boosters and phrases give the same plan."""
    from sentimart.operators import process as P
    df = spark.createDataFrame([(1, "x")], "raw_id long, review_text string")

    def size(n):
        boosters = spark.range(n).selectExpr("concat('b', id) as token", "0.1D as scalar")
        phrases = spark.range(n).selectExpr("concat('p', id, ' q') as phrase", "1.0D as valence")
        return len(P.clean_text_only(df, P.TextResources(boosters=boosters, phrases=phrases)).select("sentiment_score")._jdf.queryExecution().analyzed().toString())

    assert abs(size(1000) - size(10)) < 20


def test_counts_and_scores_read_the_tokens_once(spark):
    """a document's number of words comes with its score, so the texts are cleaned once for both."""
    for name in ("length_correlation", "word_count"):
        # SF01: another test keeps the processed table of SF001 cached.
        assert plan(E.queries()[name](spark, SF01)).count("Generate posexplode(") == 1


def test_no_pattern_is_compiled_for_each_text(spark):
    """tokens are cut at a plain blank, not at a pattern."""
    from sentimart.functions import text as TF
    p = optimized(E.queries()["sentiment_score_lexicon"](spark, SF001))
    assert "split(" in p and f"{TF.BLANK_RUN}, -1)" not in p
