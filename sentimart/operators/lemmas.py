"""Lemmatisation as a table job (X9, SURVEY N3).

A noun's lemma is the shortest dictionary word that one of the suffix rules makes of it, or the word
itself. The rules are turned round: each dictionary word and rule give the one form that the rule
reduces to it. So the table of forms comes from the resources alone, once, whatever the corpus is;
no pass over a batch's vocabulary is needed and a text has one result in every batch.

1. forms = the dictionary words themselves, and for each rule the word with the rule undone;
2. per form the shortest word wins, ties going to the word itself, then to rule order;
3. the irregular-form table overrides the rules.

The result holds only forms whose lemma differs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentimart import resources as R


def _undone(suffix: str, repl: str) -> str:
    """The form that the rule suffix -> repl reduces to the word; null where the word does not end so."""
    form = f"concat(substring(word, 1, length(word) - {len(repl)}), '{suffix}')"
    return f"if(endswith(word, '{repl}'), {form}, null)" if repl else form


def noun_forms(dictionary: DataFrame, lemmas: DataFrame | None = None, rules=R.NOUN_SUFFIX_RULES) -> DataFrame:
    """(token, lemma) of every form whose lemma differs from it, from the resource tables alone."""
    made = ["named_struct('token', word, 'ord', 0, 'word', word)"]
    made += [f"named_struct('token', {_undone(suffix, repl)}, 'ord', {i}, 'word', word)" for i, (suffix, repl) in enumerate(rules, start=1)]
    words = dictionary.select(F.col("token").alias("word")).filter("word <> ''")
    best = (words.selectExpr(f"inline(array({', '.join(made)}))").filter(F.col("token").isNotNull())
            .groupBy("token").agg(F.expr("min(named_struct('len', length(word), 'ord', ord, 'word', word)) as b")))
    by_rule = best.select("token", F.col("b.word").alias("lemma")).filter("lemma <> token")
    if lemmas is None:
        return by_rule
    irregular = lemmas.groupBy("token").agg(F.min("lemma").alias("lemma"))
    return by_rule.join(irregular.select("token"), "token", "left_anti").unionByName(irregular)


def lemma_map(vocab: DataFrame, lemmas: DataFrame | None = None,
              dictionary: DataFrame | None = None, rules=R.NOUN_SUFFIX_RULES) -> DataFrame:
    """(token, lemma) for every vocabulary token whose lemma differs from it.

    ``vocab``: distinct tokens to lemmatise. ``dictionary``: known words (default: the seed).
    ``lemmas``: irregular forms (token, lemma), applied before the rules.
    """
    spark: SparkSession = vocab.sparkSession
    known = dictionary if dictionary is not None else R.dictionary_df(spark)
    return vocab.select("token").join(noun_forms(known, lemmas, rules), "token")
