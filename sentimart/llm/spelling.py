"""Spelling variant groups over a variable-length gram index.

Words are counted over all texts; each word is then grouped under its likely form: the most frequent word at one
inserted, deleted or replaced character, if that is frequent enough. Near words are found by an index of grams of
variable length:

1. Gram dictionary: a gram of SHORTEST characters always belongs to it, a longer one only if the gram without its last
   character occurs more than FREQUENT times in the words (put between a begin and an end mark). So frequent grams are
   replaced by longer, rarer ones and no others are kept. It is a table, pruned level by level.
2. Decomposition: from each position the word takes the longest gram of the dictionary. A gram depends on its own
   characters alone, so an edit of character e changes at most the grams that cover e: `affected` is the
   largest number of grams over one character of the word.
3. List merging: two words at distance one share all grams that the edit leaves alone, at least grams - affected of
   either word. So some gram is among the affected + 1 rarest of both: only these are listed, and words of one
   list whose lengths differ by one at most are merged. Repeated grams of a word are told apart by their number.
4. Verification: the edit distance, inside the join; only near pairs leave it.

A word of n characters has n + 1 grams and at most LONGEST of them are affected, so from LONGEST characters on no pair can be missed;
shorter words than that are refused by a parameter check.

Cases: null texts and texts without letters give nothing; a null id is written as an empty string before the colon;
repeated rows count each; very long texts are whole; an empty table gives no rows; ties among forms go to the
smallest word in code-point order. Only the named columns are read, so further columns may have any name.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sentimart.llm.scratch import stored

#: Gram lengths, and the number of occurrences in words up to which a gram is rare enough to be kept as it is.
SHORTEST, LONGEST, FREQUENT = 2, 5, 48
#: Words counted in a task before they leave it.
COUNT_WORDS = 400_000
#: Texts' characters read at once.
_RUN = re.compile("[a-zÀ-ÿ]+")


def _word_counts(df: DataFrame, shortest: int, every: int) -> DataFrame:
    """(word, n) of all runs of letters with at least `shortest` characters after the planted deletion."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        for b in batches:
            for key, text in zip(b.column("key"), b.column("text")):
                if not text.is_valid:
                    continue
                prefix = zlib.crc32(b"%s:" % (key.as_py() or "").encode())
                # Only A-Z: bytes.lower leaves every other character as it is.
                for word, n in Counter(_RUN.findall(text.as_buffer().to_pybytes().lower().decode())).items():
                    if len(word) < shortest:
                        continue
                    h = zlib.crc32(word.encode(), prefix)
                    if not h % every:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < shortest:
                            continue
                    counts[word] += n
                if len(counts) >= COUNT_WORDS:
                    yield out()
                    counts.clear()
        yield out()

    return df.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _decomposed(words: DataFrame, frequent: int) -> DataFrame:
    """(word, at, gram) of each word: the longest gram of the dictionary from each position."""
    marked = F.concat(F.lit("^"), "word", F.lit("$"))
    grams = words.select("word", marked.alias("m"), F.explode(F.sequence(F.lit(1), F.length("word") + 1)).alias("at"))
    grams = grams.withColumn("gram", F.substring("m", F.col("at"), F.lit(SHORTEST)))
    for size in range(SHORTEST, LONGEST):
        # Grams of this size that occur too often are replaced by their extensions, where the word goes on.
        often = grams.filter(F.length("gram") == size).groupBy("gram").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > frequent).select("gram", F.lit(True).alias("often"))
        longer = F.substring("m", F.col("at"), F.lit(size + 1))
        grams = stored(grams.join(often, "gram", "left").select("word", "m", "at", F.when(F.col("often"), longer).otherwise(F.col("gram")).alias("gram")), "grams")
    return grams.select("word", "at", "gram")


def _affected() -> Column:
    """The largest number of a word's grams (spans) over one of its characters."""
    over = F.transform(F.sequence(F.lit(2), F.length("word") + 1), lambda e: F.size(F.filter("spans", lambda s: (s["at"] <= e) & (e < s["at"] + s["size"]))))
    return F.array_max(over)


def gram_lists(words: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """(gram, number, word): each word under its affected + 1 rarest grams; number tells a word's equal grams apart."""
    grams = _decomposed(words, frequent)
    numbered = grams.withColumn("number", F.row_number().over(Window.partitionBy("word", "gram").orderBy("at")))
    lists = numbered.groupBy("gram", "number").agg(F.count(F.lit(1)).alias("listed"))
    sized = numbered.join(lists, ["gram", "number"])
    per_word = sized.groupBy("word").agg(
        F.sort_array(F.collect_list(F.struct("listed", "gram", "number"))).alias("rarest"),
        F.collect_list(F.struct("at", F.length("gram").alias("size"))).alias("spans"))
    kept = per_word.select("word", F.explode(F.slice("rarest", F.lit(1), _affected() + 1)).alias("g"))
    return kept.select("g.gram", "g.number", "word")


def near_words(words: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """(word, near): all pairs at an edit distance of exactly one, in both directions. Words need LONGEST characters."""
    lists = stored(gram_lists(words, frequent), "lists").withColumn("size", F.length("word"))
    one = lists.select("gram", "number", "size", F.col("word").alias("a"))
    # A word meets words of its own length and of the next one.
    two = lists.select("gram", "number", F.explode(F.array(F.col("size"), F.col("size") - 1)).alias("size"), F.length("word").alias("own"), F.col("word").alias("b"))
    met = one.join(two, ["gram", "number", "size"]).filter("(own > size or a < b) and levenshtein(a, b, 1) = 1").select("a", "b").distinct()
    pairs = stored(met, "near")
    return pairs.select(F.col("a").alias("word"), F.col("b").alias("near")).unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near")))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: the last word when forms are followed. Each round doubles the steps."""
    now = stored(forms.filter("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = stored(now.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        now = new.select("word", "root")
        if not new.filter("moved").limit(1).count():
            return now


def spelling_groups(df: DataFrame, shortest: int = 6, least: int = 5, ratio: int = 5, every: int = 199, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of at least `shortest` characters and `least` occurrences.

    form: the near word of largest n, if that is at least `ratio` times the word's. Where `every` divides the checksum of
    id and word, the word is read with one character less (a planted misspelling).
    """
    if shortest < LONGEST:
        raise ValueError(f"words need at least {LONGEST} characters for the gram bound")
    rows = df.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    words = stored(_word_counts(rows, shortest, every).filter(F.col("n") >= least), "words")
    near = near_words(words.select("word"))
    counted = near.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    per_word = counted.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("top"))
    found = words.join(per_word, "word", "left").withColumn("top_n", -F.col("top.less"))
    chosen = F.col("top_n") >= F.col("n") * ratio
    forms = stored(found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                F.when(chosen, F.col("top.near")).alias("form"), F.when(chosen, F.col("top_n")).alias("form_n")), "forms")
    return forms.join(_roots(forms), "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
