"""Transform stage: raw reviews -> processed reviews.

Plan, per batch of raw rows:

* constraint filter, first row per key and anti joins against what is already processed, on ids only;
* the rows left, met with their text by a shuffled semi join on ``raw_id``: from here on every row of a
  document lies in the task of its id, and no later step of a document shuffles again;
* native column chain -> tokens -> occurrences (posexplode);
* the token table (lemma, valence, booster, negator, phrase word) is made from the resource tables
  alone (``lemmas.noun_forms``, ``score.word_table``), so neither the corpus nor its vocabulary is read
  for it. It is broadcast only if its size is known to be bounded, else AQE picks the join;
* score: the marked occurrences only, joined by (document, position) (``operators.score``). A head per
  document brings its number of words along, so scores and counts need one pass over the texts;
* text: every occurrence carries its lemma and a document's are gathered by position;
* both per-document results are joined to the document's attributes by ``raw_id``. A query that does
  not use one of them does not compute it (the join is dropped by Catalyst).

No Python UDF, no collect, no job while the plan is built.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentimart import resources as R
from sentimart.functions import sentiment as SF
from sentimart.functions import text as TF
from sentimart.functions.formats import year_month
from sentimart.operators import score as SC
from sentimart.operators.lemmas import noun_forms


#: Rows of a token table that may be broadcast.
BROADCAST_WORDS = 200_000


@dataclass
class TextResources:
    """Resource tables used by the transform. ``None`` -> built-in seed.

    ``bounded``: whether the token table made of them may be broadcast; known for the seeds, found by
    :meth:`prepared` for other tables, else left to AQE.
    """

    stopwords: tuple[str, ...] = R.STOPWORDS
    lexicon: DataFrame | None = None       # token string, valence double
    lemmas: DataFrame | None = None        # token string, lemma string: irregular forms
    dictionary: DataFrame | None = None    # token string: words the suffix rules may reduce to
    # "vader": valences with booster, negation, phrase and 'least' rules; "lexicon": their plain sum.
    mode: str = "vader"
    boosters: DataFrame | None = None      # token string, scalar double
    negators: DataFrame | None = None      # token string
    phrases: DataFrame | None = None       # phrase string (two or three words), valence double
    bounded: bool | None = None
    words: DataFrame | None = None         # the token table, if already made

    def resolve(self, spark: SparkSession) -> "TextResources":
        if self.mode not in ("lexicon", "vader"):
            raise ValueError(f"unknown sentiment mode {self.mode}")
        given = (self.lexicon, self.lemmas, self.dictionary, self.boosters, self.negators, self.phrases)
        seeds = (R.lexicon_df, R.lemmas_df, R.dictionary_df, R.boosters_df, R.negators_df, R.phrases_df)
        tables = [g if g is not None else make(spark) for g, make in zip(given, seeds)]
        bounded = self.bounded if self.bounded is not None else all(g is None for g in given)
        words = self.words
        if words is None:
            lexicon, lemmas, dictionary, boosters, negators, phrases = tables
            words = SC.word_table(noun_forms(dictionary, lemmas), SC.role_words(lexicon, boosters, negators, phrases))
        return TextResources(self.stopwords, *tables[:3], self.mode, *tables[3:], bounded, words)

    def prepared(self, spark: SparkSession) -> "TextResources":
        """Make and measure the token table once (two small jobs); for full-size tables used by many queries."""
        from sentimart.session import ensure_checkpoint_dir
        res = self.resolve(spark)
        ensure_checkpoint_dir(spark)
        words = res.words.checkpoint(eager=True)
        bounded = words.limit(BROADCAST_WORDS + 1).count() <= BROADCAST_WORDS
        return replace(res, words=words, bounded=bounded)

    def token_side(self, words: DataFrame) -> DataFrame:
        return F.broadcast(words) if self.bounded else words


def valid_for_processed(raw: DataFrame) -> DataFrame:
    """Rows the processed table's NOT NULL / CHECK constraints accept."""
    return raw.filter(F.col("app_name").isNotNull() & F.col("rating").between(1, 5))


def tokenized(raw: DataFrame, stopwords=R.STOPWORDS, text_col: str = "review_text") -> DataFrame:
    return TF.add_clean_tokens(raw, text_col, "_toks", stopwords)


def token_occurrences(docs: DataFrame, tokens_col: str = "_toks") -> DataFrame:
    """(raw_id, pos, token) per token.

    ``posexplode_outer`` + a null filter above it, not ``posexplode``: for the inner form Spark
    infers ``size(tokens) > 0`` and pushes it below the projections that build the tokens,
    which re-runs the whole regex chain inside the filter.
    """
    return (docs.select("raw_id", F.posexplode_outer(tokens_col).alias("pos", "token"))
            .filter(F.col("token").isNotNull()))


def headed_occurrences(docs: DataFrame, tokens_col: str = "_toks") -> DataFrame:
    """(raw_id, pos, token, n_words) per token, and a head per row of ``docs``: only it has the row's number of tokens."""
    # Counted and headed below the generator, so that no row carries the whole list on.
    listed = F.concat(F.array(F.lit(SC.HEAD)), F.col(tokens_col)).alias("listed")
    return (docs.select("raw_id", F.size(tokens_col).alias("n_words"), listed)
            .select("raw_id", "n_words", F.posexplode_outer("listed").alias("place", "token"))
            .selectExpr("raw_id", "place - 1 as pos", "token", "if(place = 0, n_words, null) as n_words"))


def scores(headed: DataFrame, res: TextResources) -> DataFrame:
    """(raw_id, _vsum, n_words) of the documents; the sum is null without a scored word."""
    roles = res.words.filter("valence is not null or scalar is not null or negates or in_phrase or word in "
                             f"({', '.join(repr(w) for w in SC.NAMED_WORDS)})")
    marks = headed.join(res.token_side(SC.with_head(roles)), "token")
    if res.mode == "lexicon":
        return marks.groupBy("raw_id").agg(F.sum("valence").alias("_vsum"), F.sum("n_words").alias("n_words"))
    return SC.valence_sums(marks, F.broadcast(res.phrases) if res.bounded else res.phrases)


def cleaned(occ: DataFrame, res: TextResources) -> DataFrame:
    """(raw_id, lemmas): every occurrence with its lemma, gathered by position."""
    changed = res.token_side(res.words.filter("changed").select("token", "word"))
    by_pos = F.sort_array(F.collect_list(F.struct("pos", F.coalesce("word", "token").alias("word"))))
    return occ.join(changed, "token", "left").groupBy("raw_id").agg(by_pos["word"].alias("lemmas"))


def lemmatized(docs: DataFrame, res: TextResources, keep: list[str]) -> DataFrame:
    """``docs`` (raw_id unique, review_text, ...) -> ``keep`` columns + lemmas, word_count, _vsum."""
    tokens = tokenized(docs.select("raw_id", "review_text"), res.stopwords).select("raw_id", "_toks")
    out = (docs.select(*keep).join(cleaned(token_occurrences(tokens), res), "raw_id", "left")
           .join(scores(headed_occurrences(tokens), res), "raw_id", "left"))
    return out.select(*keep, F.coalesce("lemmas", F.array().cast("array<string>")).alias("lemmas"),
                      F.coalesce(F.col("n_words").cast("int"), F.lit(0)).alias("word_count"), "_vsum")


def process_reviews(raw: DataFrame, res: TextResources | None = None,
                    existing: DataFrame | None = None, processed_at: str | None = None,
                    apps: DataFrame | None = None) -> DataFrame:
    """Raw rows -> processed rows not yet in ``existing`` (schema: ``schemas.PROCESSED``).

    ``apps`` (app_name): only the rows of these apps, chosen before any text work but after the first arrivals of
    all apps are known, so the result is that of filtering afterwards.
    """
    spark = raw.sparkSession
    res = (res or TextResources()).resolve(spark)
    # Ids only: first rows per review id and pending ids are found on two key columns; the rows
    # with their text are read once, through a semi join on the ids that are left.
    from sentimart.operators.ingest import anti_join_existing, first_arrivals
    valid = valid_for_processed(raw)
    ids = first_arrivals(valid.select("raw_id", "review_id"))
    if existing is not None:
        ids = anti_join_existing(anti_join_existing(ids, existing, "raw_id"), existing, "review_id")
    # A shuffled semi join, also where the ids are few: it deals the texts by document.
    if apps is not None:
        valid = valid.join(apps, "app_name", "left_semi")
    todo = valid.join(ids.select("raw_id").hint("merge"), "raw_id", "left_semi")
    keep = ["raw_id", "app_name", "review_id", "rating", "review_ts", "review_text"]
    scored = lemmatized(todo, res, keep)
    score = SF.compound(F.col("_vsum"))
    stamp = F.lit(processed_at).cast("timestamp") if processed_at else F.current_timestamp()
    return scored.select(
        F.col("raw_id"),
        F.col("app_name"),
        F.col("review_id"),
        F.col("rating"),
        F.col("review_ts"),
        F.col("review_text"),
        TF.join_tokens(F.col("lemmas")).alias("cleaned_text"),
        F.col("word_count"),
        score.alias("sentiment_score"),
        SF.sentiment_label(score).alias("sentiment"),
        year_month(F.col("review_ts")).alias("year_month"),
        stamp.alias("processed_at"),
    )


def clean_text_only(df: DataFrame, res: TextResources | None = None, text_col: str = "review_text") -> DataFrame:
    """(raw_id, cleaned_text, word_count, sentiment_score) for any (raw_id, text) frame."""
    spark = df.sparkSession
    res = (res or TextResources()).resolve(spark)
    docs = df.select("raw_id", F.col(text_col).alias("review_text")).repartition("raw_id")
    scored = lemmatized(docs, res, ["raw_id"])
    return scored.select(
        "raw_id",
        TF.join_tokens(F.col("lemmas")).alias("cleaned_text"),
        F.col("word_count"),
        SF.compound(F.col("_vsum")).alias("sentiment_score"),
    )
