"""Valence sums with neighbour and phrase rules as joins on (document, position).

All word lists are tables. The words that bear on a score (lexicon words, boosters, negators, the few
words the rules name, words of phrases) are found among the occurrences by one join on the token; only
these marked occurrences go on. A marked word at position p is sent to the positions it bears on,

* its own, if it has a valence;
* p + 1 to p + 3: boosters, negators and lexicon words are read by the three words after them;
* p - 1 and p - 2, if it occurs in a phrase: windows may go on after the scored word,

and meets the scored word there by (document, position): an equi-join written as one grouping, so the
tokens are read once. A scored word then has its neighbours' scalars and flags as columns, whatever the
size of the tables. Windows of two and three words around it are joined to the phrase table.

Each document also has a head, the token '' before its first one, that holds its number of words and scores
nothing, so that counts and sums come from one reading of the tokens.

Rules, in order, for the word at i with valence v (public VADER rules, as far as they can fire on
cleaned text): for k = 1, 2, 3, unless word i - k is in the lexicon: its booster scalar times 1, 0.95,
0.9 is added (subtracted while v < 0); a negator there multiplies v by -0.74 ("without doubt" does not
negate). From the fourth word on, unless word i - 3 is in the lexicon, a phrase around i replaces v.
"least" before it multiplies v by -0.74 unless "at" or "very" stands before that. A booster that is
also in the lexicon scores nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentimart import resources as R

#: FIXED VALUES (VADER): booster damping at distance 1, 2, 3.
DAMPING = (1.0, 0.95, 0.9)
#: FIXED VALUES (VADER): words the rules name.
NAMED_WORDS = ("without", "doubt", "least", "at", "very")
#: The token that stands for a document's head; no text has it.
HEAD = ""
#: Windows (offsets from the scored word) in order of precedence.
WINDOWS = ((0, 1, 2), (0, 1), (-1, 0), (-2, -1, 0), (-2, -1), (-3, -2, -1), (-3, -2))


def role_words(lexicon: DataFrame, boosters: DataFrame, negators: DataFrame, phrases: DataFrame) -> DataFrame:
    """(word, valence, scalar, negates, in_phrase): one row for each word that bears on a score."""
    named = R.seed_df(lexicon.sparkSession, [(w,) for w in NAMED_WORDS], "word string")
    no_valence, no_scalar = "cast(null as double) as valence", "cast(null as double) as scalar"
    parts = [
        lexicon.selectExpr("token as word", "cast(valence as double) as valence", no_scalar, "false as negates", "false as in_phrase"),
        boosters.selectExpr("token as word", no_valence, "cast(scalar as double) as scalar", "false as negates", "false as in_phrase"),
        negators.selectExpr("token as word", no_valence, no_scalar, "true as negates", "false as in_phrase"),
        phrases.selectExpr("explode(split(phrase, ' ')) as word", no_valence, no_scalar, "false as negates", "true as in_phrase"),
        named.selectExpr("word", no_valence, no_scalar, "false as negates", "false as in_phrase"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("word").agg(F.max("valence").alias("valence"), F.max("scalar").alias("scalar"),
                                   F.max("negates").alias("negates"), F.max("in_phrase").alias("in_phrase"))


def word_table(forms: DataFrame, roles: DataFrame) -> DataFrame:
    """(token, word, changed, valence, scalar, negates, in_phrase): each token that changes or bears on a score."""
    by_form = forms.select("token", F.col("lemma").alias("word"), F.lit(True).alias("changed")).join(roles, "word", "left")
    same = roles.join(forms.select(F.col("token").alias("word")), "word", "left_anti").withColumn("token", F.col("word")).withColumn("changed", F.lit(False))
    return by_form.unionByName(same)


def with_head(words: DataFrame) -> DataFrame:
    """``words`` (see :func:`word_table`) with a row for the heads, which bear on nothing."""
    return words.unionByName(R.seed_df(words.sparkSession, [(HEAD,)], "token string"), allowMissingColumns=True)


def neighbourhoods(marks: DataFrame) -> DataFrame:
    """(raw_id, pos, n_words, valence, near): scored words with the marked words from pos - 3 to pos + 2 by their distance,
    and heads."""
    shifts = ("if(n_words is not null, array(0), concat(if(valence is not null, array(0), array()), array(1, 2, 3), "
              "if(in_phrase, array(-1, -2), array())))")
    sent = marks.selectExpr("raw_id", "pos", "n_words", f"explode({shifts}) as shift", "word", "valence", "scalar", "negates", "in_phrase")
    mark = "named_struct('off', -shift, 'word', word, 'known', valence is not null, 'scalar', scalar, 'negates', negates, 'in_phrase', in_phrase)"
    sent = sent.selectExpr("raw_id", "pos + shift as pos", "n_words", "if(shift = 0, valence, null) as own", f"if(n_words is null, {mark}, null) as mark")
    met = sent.groupBy("raw_id", "pos").agg(F.sum("n_words").alias("n_words"), F.max("own").alias("valence"), F.collect_list("mark").alias("near"))
    return met.filter("valence is not null or n_words is not null")


def _mark(off: int) -> str:
    """Column of the marked word at this distance."""
    return f"m{off + 3}"


def _step(k: int) -> str:
    """What the word k places before does: its scalar, whether it negates, and whether it counts at all."""
    w = _mark(-k)
    doubt = {1: "false", 2: f"{w}.word = 'without' and {_mark(-1)}.word = 'doubt'",
             3: f"{w}.word = 'without' and ({_mark(-1)}.word = 'doubt' or coalesce({_mark(-2)}.word = 'doubt', false))"}[k]
    return (f"named_struct('add', coalesce({w}.scalar, 0D) * {DAMPING[k - 1]}D, 'negated', coalesce({w}.negates, false) and not coalesce({doubt}, false), "
            f"'open', pos >= {k} and not coalesce({w}.known, false))")


def valence_sums(marks: DataFrame, phrases: DataFrame) -> DataFrame:
    """(raw_id, _vsum, n_words): the documents' sums over their scored words and their numbers of words.

    ``marks``: (raw_id, pos, n_words, word, valence, scalar, negates, in_phrase) of the marked occurrences and the heads;
    only these have ``n_words``.
    """
    hits = neighbourhoods(marks).selectExpr("raw_id", "pos", "n_words", "valence", *[f"get(filter(near, m -> m.off = {k}), 0) as {_mark(k)}" for k in range(-3, 3)])
    negation = f"{R.NEGATION_SCALAR}D"
    moved = "v + if(v < 0, -s.add, s.add)"
    boosted = (f"aggregate(array({', '.join(map(_step, (1, 2, 3)))}), valence, "
               f"(v, s) -> if(s.open, if(s.negated, ({moved}) * {negation}, {moved}), v))")
    one, two = _mark(-1), _mark(-2)
    least = f"coalesce({one}.word = 'least' and not {one}.known and not coalesce({two}.word in ('at', 'very'), false), false)"
    windows = ", ".join(
        f"named_struct('rank', {i}, 'phrase', if({' and '.join(f'coalesce({_mark(o)}.in_phrase, false)' for o in w)}, "
        f"concat_ws(' ', {', '.join(f'{_mark(o)}.word' for o in w)}), null))" for i, w in enumerate(WINDOWS))
    idioms = f"pos >= 3 and not coalesce({_mark(-3)}.known, false)"
    scored = hits.filter(f"{_mark(0)}.scalar is null").selectExpr(
        "raw_id", "pos", "n_words", f"{boosted} as v", f"{least} as least",
        f"explode_outer(filter(if({idioms}, array({windows}), null), w -> w.phrase is not null)) as w")
    table = phrases.groupBy("phrase").agg(F.max(F.col("valence").cast("double")).alias("p"))
    found = scored.selectExpr("raw_id", "pos", "n_words", "v", "least", "w.rank", "w.phrase").join(table, "phrase", "left")
    per_word = found.groupBy("raw_id", "pos").agg(
        F.max("n_words").alias("n_words"), F.max("v").alias("v"), F.max("least").alias("least"), F.expr("min_by(p, if(p is not null, rank, null)) as p"))
    return per_word.groupBy("raw_id").agg(F.expr(f"sum(coalesce(p, v) * if(least, {negation}, 1D)) as _vsum"), F.sum("n_words").alias("n_words"))
