"""Marts: sentiment expectations, corpus-bigram exactness, entry contract."""

from pyspark.sql import functions as F

from sentimart import resources as R
from sentimart.operators import ngrams as N
from sentimart.operators import process as P
from sentimart.sources import tables as ST

from conftest import SF001, SF01


def test_five_word_lexicon_label_counts(spark):
    lex = spark.createDataFrame(
        [("idiot", -2.3), ("worthless", -1.9), ("pathetic", -2.7), ("stupid", -2.4), ("best", 3.2)],
        "token string, valence double")
    raw = ST.raw_reviews(spark, SF01)
    scored = P.clean_text_only(raw, P.TextResources(lexicon=lex))
    from sentimart.functions.sentiment import sentiment_label
    counts = {r.s: r.n for r in scored.groupBy(sentiment_label(F.col("sentiment_score")).alias("s"))
              .agg(F.count("*").alias("n")).collect()}
    assert sum(counts.values()) == 1000
    assert counts == {"Neutral": 906, "Negative": 65, "Positive": 29}


def test_corpus_bigrams_independent_of_bucket_size(spark):
    """The two-level lead gives the same pairs with tiny buckets as with one bucket per app."""
    processed = P.process_reviews(ST.raw_reviews(spark, SF001))
    docs = N.ngram_docs(processed)
    a = N.bridge_bigrams(docs, bucket_size=1 << 30)
    b = N.bridge_bigrams(docs, bucket_size=7)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert a.count() == docs.filter(F.size("toks") > 0).count() - docs.select("app_name").distinct().count()


def test_theme_counts_on_golden_text(spark):
    df = spark.createDataFrame([(1, "a", "Cheap price, slow shipping"), (2, "a", "great app and service"),
                                (3, "b", "prices prices prices")],
                               "raw_id long, app_name string, review_text string")
    p = df.withColumn("rating", F.lit(3)).withColumn("review_id", F.col("raw_id").cast("string")) \
        .withColumn("review_ts", F.lit(None).cast("timestamp_ntz"))
    processed = P.process_reviews(p)
    got = {(r.app_name, r.theme): r.review_count
           for r in N.theme_counts(processed, R.themes_df(spark)).collect()}
    assert got == {("a", "price"): 1, ("a", "shipping"): 1, ("a", "app"): 1, ("a", "service"): 1,
                   ("b", "price"): 1}


def test_entry_and_registry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"app_name", "year_month", "sentiment", "review_count"}
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 50


def test_unknown_label_only_for_apps_without_processed_rows(spark):
    from sentimart.operators import marts as M
    raw = spark.createDataFrame(
        [(1, "a", "r1", 5), (2, "a", "r2", 4), (3, "b", "r3", 1)],
        "raw_id long, app_name string, review_id string, rating int"
    ).withColumn("review_ts", F.lit(None).cast("timestamp_ntz")).withColumn("review_text", F.lit("good"))
    proc = spark.createDataFrame([(1, "a", "r1", "Positive", 0.44)],
                                 "raw_id long, app_name string, review_id string, sentiment string, sentiment_score double")
    got = {r.raw_id: (r.sentiment, r.sentiment_score) for r in M.join_examples(raw, proc).collect()}
    # App a has processed rows: an unmatched row keeps null; app b has none: 'Unknown'.
    assert got == {1: ("Positive", 0.44), 2: (None, None), 3: ("Unknown", None)}


def test_dictionary_vocabulary(spark):
    df = spark.createDataFrame([(1, "cats dogs glasses")], "raw_id long, review_text string")
    dictionary = spark.createDataFrame([("cat",), ("glass",)], "token string")
    out = P.clean_text_only(df, P.TextResources(dictionary=dictionary)).first()
    # cats->cat and glasses->glass (ses rule) are in the dictionary; dog is not, dogs stays.
    assert out.cleaned_text == "cat dogs glass"


def test_top_k_is_subset_of_counts(spark):
    processed = P.process_reviews(ST.raw_reviews(spark, SF001))
    counts = N.count_items(N.unigram_items(N.ngram_docs(processed)))
    top = N.top_k(counts, 5)
    c = counts.select("app_name", "ngram", F.col("ngram_count").alias("c"))
    joined = top.join(c, ["app_name", "ngram"])
    assert joined.count() == top.count()
    assert joined.filter(F.col("ngram_count") != F.col("c")).count() == 0
    # Nothing outside the top k has a higher count than the k-th entry of its app.
    kth = top.groupBy("app_name").agg(F.min("ngram_count").alias("m"))
    outside = c.join(top.select("app_name", "ngram"), ["app_name", "ngram"], "left_anti").join(kth, "app_name")
    assert outside.filter(F.col("c") > F.col("m")).count() == 0


def test_null_ids_pair_only_when_asked(spark):
    from sentimart.operators import marts as M
    raw = spark.createDataFrame([(1, "a", None, 5), (2, "a", None, 4)],
                                "raw_id long, app_name string, review_id string, rating int") \
        .withColumn("review_ts", F.lit(None).cast("timestamp_ntz")).withColumn("review_text", F.lit("x"))
    proc = spark.createDataFrame([(7, "a", None, "Neutral", 0.0), (8, "a", None, "Neutral", 0.0)],
                                 "raw_id long, app_name string, review_id string, sentiment string, sentiment_score double")
    assert M.join_examples(raw, proc, pair_null_ids=True).count() == 4  # 2 x 2, as a null-safe merge
    got = M.join_examples(raw, proc)
    assert got.count() == 2 and got.filter("sentiment is not null").count() == 0  # 7 and 8 are other rows


def test_dominant_sentiment_tie_goes_to_first_label(spark):
    from sentimart.operators import marts as M
    raw = spark.createDataFrame([(1, "a", 5)], "raw_id long, app_name string, rating int")
    proc = spark.createDataFrame([("a", "Positive"), ("a", "Negative"), ("a", "Neutral"), ("a", "Negative"),
                                  ("a", "Positive")], "app_name string, sentiment string")
    r = M.kpi_overview(raw, proc).first()
    assert r.dominant_sentiment == "Negative"          # Negative and Positive tie at 2
    assert r.positive_pct == 40.0 and r.total_reviews == 1 and r.avg_rating == 5.0


def test_empty_input_flows_through(spark):
    """Tables without rows give reports without rows (or the figures of nothing), never an error."""
    from sentimart.operators import marts as M
    from sentimart.operators import quality as Q
    raw = ST.raw_reviews(spark, SF001).limit(0)
    processed = P.process_reviews(raw)
    for df in (processed, M.kpi_formatted(raw, processed), M.sentiment_trend_monthly(processed), M.volume_trend_monthly(raw),
               N.top_bigrams_corpus(processed), M.examples_formatted(M.join_examples(raw, processed)), M.app_list(raw, processed)):
        assert df.count() == 0
    assert M.processed_total(processed).first()[0] == 0
    assert {r["check"]: r.value for r in Q.dq_gate_raw(raw).collect()}["row_count"] == 0


def test_example_titles_and_unscored_neutrals(spark):
    """A neutral example without a score has a title without one, and only appears if its app has no scored one."""
    from sentimart.operators import marts as M
    rows = [(1, "a", 5, "Neutral", None), (2, "a", None, "Neutral", None), (3, "b", 4, "Neutral", 0.01), (4, "b", 2, "Neutral", None),
            (5, "a", 1, "Negative", -0.5), (6, "a", 1, "Negative", -0.9), (7, "a", 1, "Negative", None), (8, "b", 5, "Positive", 0.25), (9, "b", 3, None, 0.3)]
    ex = spark.createDataFrame(rows, "raw_id long, app_name string, rating int, sentiment string, sentiment_score double") \
        .withColumn("review_ts", F.when(F.col("raw_id") != 2, F.lit("2024-03-05 10:00:00").cast("timestamp_ntz")))
    got = {(r.app_name, r.tab, r.title) for r in M.examples_formatted(ex).collect()}
    assert got == {
        ("a", "Neutral", "Rating: 5 \u2b50 | Date: 2024-03-05"), ("a", "Neutral", "Rating: N/A \u2b50 | Date: N/A"),
        ("b", "Neutral", "Rating: 4 \u2b50 | VADER Score: 0.010 | Date: 2024-03-05"),
        ("a", "Negative", "Rating: 1 \u2b50 | VADER Score: -0.900 | Date: 2024-03-05"),
        ("a", "Negative", "Rating: 1 \u2b50 | VADER Score: -0.500 | Date: 2024-03-05"),
        ("b", "Positive", "Rating: 5 \u2b50 | VADER Score: 0.250 | Date: 2024-03-05")}
    assert [r.raw_id for r in M.examples_negative(ex).orderBy("rank").collect()] == [6, 5]


def test_kpi_forms(spark):
    from sentimart.operators import marts as M
    raw = spark.createDataFrame([(1, "a", 5), (2, "a", 4), (3, "b", None)], "raw_id long, app_name string, rating int")
    proc = spark.createDataFrame([("a", "Positive"), ("a", "Neutral"), ("a", "Neutral"), ("c", None)], "app_name string, sentiment string")
    got = {tuple(r) for r in M.kpi_formatted(raw, proc).collect()}
    assert got == {("a", "2", "4.50", "33.3%", "Neutral"), ("b", "1", "N/A", "N/A", "N/A"), ("c", "N/A", "N/A", "0.0%", "N/A")}


def test_months_without_reviews(spark):
    from sentimart.operators import marts as M
    raw = spark.createDataFrame([(1, "a", "2024-01-05"), (2, "a", "2024-01-09"), (3, "a", "2024-04-01"), (4, None, "2024-02-01"), (5, "a", None)],
                                "raw_id long, app_name string, d string").withColumn("review_ts", F.col("d").cast("timestamp_ntz"))
    got = [(r.app_name, str(r.year_month)[:7], r.review_count, r.prev_count, r.change) for r in M.volume_trend_monthly(raw).orderBy("app_name", "year_month").collect()]
    assert got == [(None, "2024-02", 1, None, None), ("a", "2024-01", 2, None, None), ("a", "2024-02", 0, 2, -2), ("a", "2024-03", 0, 0, 0), ("a", "2024-04", 1, 0, 1)]


def test_one_scan_corpus_bigrams(spark):
    """Counts and first places equal those of pairs and bridges counted apart, for buckets of any size; ranges fall back to words."""
    processed = P.process_reviews(ST.raw_reviews(spark, SF001)).cache()
    docs = N.ngram_docs(processed)
    want = sorted(map(str, N.count_items(N.bigram_items(docs).unionByName(N.bridge_bigrams(docs))).collect()))
    for size in (1, 7, 1 << 20):
        got = N.corpus_bigram_counts(docs, size).select("app_name", "ngram", "ngram_count", "first")
        assert sorted(map(str, got.collect())) == want
    assert N.top_ngrams(processed, (3, 3)).exceptAll(N.top_unigrams(processed)).count() == 0
    assert N.top_ngrams(processed, (2, 2)).exceptAll(N.top_bigrams_corpus(processed)).count() == 0


def test_counts_need_no_sorted_occurrences(spark):
    """Occurrences are counted by hash, also with their first places and, over the corpus, from one shuffle of one scan."""
    rows = [(5, "a", "x y x"), (1, "a", "y x"), (None, "a", "y x"), (-3, "b", "z"), (2, "b", "z z"), (2, "b", "z z")]
    docs = spark.createDataFrame(rows, "raw_id long, app_name string, cleaned_text string").selectExpr("app_name", "raw_id", "split(cleaned_text, ' ') as toks")
    counts = N.count_items(N.unigram_items(docs))
    first = {(r.app_name, r.ngram): (r.ngram_count, *r["first"]) for r in counts.collect()}
    assert first == {("a", "x"): (4, None, 1), ("a", "y"): (3, None, 0), ("b", "z"): (5, -3, 0)}
    for df in (N.top_k(counts, 3), N.top_k(N.corpus_bigram_counts(docs), 3)):
        df.collect()
        assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    pairs = {(r.app_name, r.ngram): r.ngram_count for r in N.corpus_bigram_counts(docs, 2).collect()}
    assert pairs == {("a", "y x"): 3, ("a", "x y"): 2, ("a", "x x"): 1, ("b", "z z"): 4}
