"""N-gram counts, top-k per app, corpus bigrams, word weights and themes (X18, T4, N4, A13,
A16, R4).

Counting is ``explode`` + ``groupBy(app, ngram)``: the key holds the n-gram, so one app with a
third of all reviews still spreads over many reducers, and the partial aggregate combines on
the map side. Ranking happens after counting, behind ``row_number() <= k``, which Spark plans as
a partial top-k before the shuffle by app.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sentimart import resources as R
from sentimart.functions import text as TF

# Rows per bucket for the two-level ``lead`` of corpus bigrams (no window ever holds an app).
BRIDGE_BUCKET = 1 << 20


def ngram_docs(processed: DataFrame, stopwords=R.STOPWORDS) -> DataFrame:
    """(app_name, raw_id, toks) from the cleaned text, as the dashboard re-tokenizes it."""
    return (processed.filter(F.col("cleaned_text").isNotNull())
            .select("app_name", "raw_id", TF.ngram_tokens(F.col("cleaned_text"), stopwords).alias("toks")))


def _items(docs: DataFrame, arr) -> DataFrame:
    # posexplode_outer + filter: the inner form would push an inferred size() filter below the
    # projection that tokenizes, tokenizing twice.
    return (docs.select("app_name", "raw_id", F.posexplode_outer(arr).alias("pos", "ngram"))
            .filter(F.col("ngram").isNotNull()))


def unigram_items(docs: DataFrame) -> DataFrame:
    return _items(docs, F.col("toks"))


def bigram_items(docs: DataFrame) -> DataFrame:
    return _items(docs, TF.bigrams(F.col("toks")))


def bridge_bigrams(docs: DataFrame, bucket_size: int = BRIDGE_BUCKET) -> DataFrame:
    """Pairs (last token of a review, first token of the app's next review with tokens).

    Exact, and without a window over a whole app: a ``lead`` inside (app, raw_id bucket)
    covers all but the last review of each bucket; those are paired through a second ``lead``
    over one summary row per bucket.
    """
    d = docs.filter(F.size("toks") > 0).select(
        "app_name", "raw_id",
        F.element_at("toks", 1).alias("first"),
        F.element_at("toks", -1).alias("last"),
        (F.size("toks") - 1).alias("last_pos"),
        F.floor(F.col("raw_id") / F.lit(bucket_size)).alias("bucket"),
    )
    w = Window.partitionBy("app_name", "bucket").orderBy("raw_id")
    inner = (d.select("app_name", "raw_id", "last", "last_pos", F.lead("first").over(w).alias("next_first"))
             .filter(F.col("next_first").isNotNull()))
    summary = d.groupBy("app_name", "bucket").agg(
        F.min(F.struct("raw_id", "first")).alias("head"),
        F.max(F.struct("raw_id", "last", "last_pos")).alias("tail"),
    )
    w2 = Window.partitionBy("app_name").orderBy("bucket")
    across = (summary.select("app_name", "tail", F.lead("head.first").over(w2).alias("next_first"))
              .filter(F.col("next_first").isNotNull())
              .select("app_name", F.col("tail.raw_id").alias("raw_id"), F.col("tail.last").alias("last"),
                      F.col("tail.last_pos").alias("last_pos"), "next_first"))
    return inner.unionByName(across).select(
        "app_name", "raw_id", F.col("last_pos").alias("pos"),
        F.concat_ws(" ", "last", "next_first").alias("ngram"))


#: Places in one review; a place in the corpus is raw_id * PLACES + pos.
PLACES = 1 << 31
#: The place of rows without an id, which come first.
_NO_ID = f"cast('{-(1 << 64)}' as decimal(20,0))"


def _place(raw_id: Column, pos: Column) -> Column:
    """(raw_id, pos) as one number of the same order: its minimum fits a hash aggregate, that of a struct needs sorted rows."""
    rid = F.coalesce(raw_id.cast("decimal(20,0)"), F.expr(_NO_ID))
    return rid * F.lit(PLACES).cast("decimal(10,0)") + pos.cast("decimal(10,0)")


def _first(place: Column) -> Column:
    """(raw_id, pos) of a place."""
    pos = F.pmod(place, F.lit(PLACES).cast("decimal(10,0)"))
    rid = ((place - pos) / F.lit(PLACES).cast("decimal(10,0)")).cast("decimal(20,0)")
    return F.struct(F.when(rid != F.expr(_NO_ID), rid).cast("long").alias("raw_id"), pos.cast("int").alias("pos"))


def _placed_counts(items: DataFrame) -> DataFrame:
    """(app_name, ngram, ngram_count, first) with the place of the first occurrence as ``first``."""
    return items.groupBy("app_name", "ngram").agg(F.count(F.lit(1)).alias("ngram_count"), F.min(_place(F.col("raw_id"), F.col("pos"))).alias("first"))


def count_items(items: DataFrame) -> DataFrame:
    """(app_name, ngram, ngram_count, first) with first = (raw_id, pos) of the first occurrence."""
    return _placed_counts(items).withColumn("first", _first(F.col("first")))


def top_k(counts: DataFrame, k: int = 20) -> DataFrame:
    """T4: most frequent first; ties in order of first occurrence (``Counter.most_common``)."""
    w = Window.partitionBy("app_name").orderBy(F.col("ngram_count").desc(), F.col("first"))
    return (counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("app_name", F.col("rank").cast("int").alias("rank"), "ngram", "ngram_count"))


def top_unigrams(processed: DataFrame, k: int = 20) -> DataFrame:
    return top_k(_placed_counts(unigram_items(ngram_docs(processed))), k)


def top_bigrams(processed: DataFrame, k: int = 20) -> DataFrame:
    """Bigrams inside each review."""
    return top_k(_placed_counts(bigram_items(ngram_docs(processed))), k)


#: Reviews per bucket of the one-pass summary: the most edges that one row of it collects.
SUMMARY_BUCKET = 4096


def _placed_corpus_counts(docs: DataFrame, bucket_size: int) -> DataFrame:
    """(app_name, ngram, ngram_count, first), with places as ``first``, over each app's concatenated corpus, from one scan of docs.

    The tokens are made once and dealt by review; pairs and edges (first and last token of a review) read that one shuffle.
    The edges, one row per review, are gathered by (app, raw_id bucket); each bucket's row has the pairs across its own
    neighbouring reviews, its first token and its last one, which meets the first token of the app's next bucket. All
    pairs are counted by one aggregate, so an occurrence is shuffled once.
    """
    size = F.size("toks")
    dealt = docs.select("app_name", "raw_id", "toks").repartition("app_name", "raw_id")
    pairs = bigram_items(dealt)
    # An outer generator: a filter on the tokens would go below the shuffle, which then differs from that of the pairs.
    edge = F.array(F.struct("raw_id", (size - 1).alias("pos"), F.element_at("toks", 1).alias("head"), F.element_at("toks", -1).alias("tail")))
    edges = dealt.select(
        "app_name", F.floor(F.col("raw_id") / F.lit(bucket_size)).alias("bucket"),
        F.explode_outer(F.when(size > 0, edge)).alias("e")).filter(F.col("e").isNotNull())
    summary = edges.groupBy("app_name", "bucket").agg(F.sort_array(F.collect_list("e")).alias("edges"))
    # Buckets of an app follow each other in one window of one row per bucket.
    w = Window.partitionBy("app_name").orderBy("bucket")
    linked = summary.select("app_name", "edges", F.lead(F.get("edges", F.lit(0))["head"]).over(w).alias("next"))
    following = F.transform("edges", lambda e, i: F.struct(
        e["raw_id"].alias("raw_id"), e["pos"].alias("pos"), e["tail"].alias("tail"), F.coalesce(F.get("edges", i + 1)["head"], F.col("next")).alias("head")))
    across = linked.select("app_name", F.explode(following).alias("f")).filter(F.col("f.head").isNotNull()).select(
        "app_name", F.col("f.raw_id").alias("raw_id"), F.col("f.pos").alias("pos"), F.concat_ws(" ", "f.tail", "f.head").alias("ngram"))
    return _placed_counts(pairs.unionByName(across))


def corpus_bigram_counts(docs: DataFrame, bucket_size: int = SUMMARY_BUCKET) -> DataFrame:
    """(app_name, ngram, ngram_count, first) of the pairs of each app's concatenated corpus; first as in ``count_items``."""
    return _placed_corpus_counts(docs, bucket_size).withColumn("first", _first(F.col("first")))


def top_bigrams_corpus(processed: DataFrame, k: int = 20, bucket_size: int = SUMMARY_BUCKET) -> DataFrame:
    """Bigrams over the app's concatenated corpus, as the reference counts them."""
    return top_k(_placed_corpus_counts(ngram_docs(processed), bucket_size), k)


def top_ngrams(processed: DataFrame, ngram_range: tuple[int, int], k: int = 20) -> DataFrame:
    """The k most frequent n-grams: (1, 1) words, (2, 2) pairs over the corpus, any other range falls back to words."""
    return top_bigrams_corpus(processed, k) if tuple(ngram_range) == (2, 2) else top_unigrams(processed, k)


def term_weights(processed: DataFrame, k: int = 100) -> DataFrame:
    """A16 re-aimed: the word cloud's top k words per app with weight = count / top count."""
    top = top_k(_placed_counts(unigram_items(ngram_docs(processed))), k)
    # Runs on at most k rows per app.
    top_count = F.max("ngram_count").over(Window.partitionBy("app_name"))
    return top.withColumn("weight", F.col("ngram_count") / top_count)


def theme_counts(processed: DataFrame, themes: DataFrame) -> DataFrame:
    """Reviews per app that mention each theme (any of its tokens; a review counts once)."""
    docs = ngram_docs(processed)
    toks = (docs.select("app_name", "raw_id", F.explode_outer(F.array_distinct("toks")).alias("token"))
            .filter(F.col("token").isNotNull()))
    hits = toks.join(themes.select("theme", "token"), "token")
    return (hits.select("app_name", "theme", "raw_id").distinct()
            .groupBy("app_name", "theme").agg(F.count(F.lit(1)).alias("review_count")))
