"""Phrase collocations by stripes.

A stripe is one prefix (no word to three words) with an associative counter of its next words. Each task makes the
stripes of its texts, stripes of one prefix meet and are added elementwise; an entry of a merged stripe is the count of
prefix + next word. So the entries give the extensions, the entry that a prefix has in its own prefix's stripe is its
total, and the largest entry above a phrase (or of a stripe that holds it further back) tells whether it is subsumed.

1. The empty prefix: all words, by their texts. Words travel on as 64-bit hashes; two texts of one hash, of which one is
   frequent, make the job start again with another base, so counts are exact.
2. One-word prefixes, then two- and three-word prefixes. A phrase is counted only if the shorter phrases in it
   that are known are frequent. That is asked of a bitmap of at most MAX_BITS bits, whatever the corpus is; a full bitmap
   lets rare phrases through, which are counted and then dropped, and never loses a frequent one.
3. A prefix with at least one in HEAVY of all words has its stripe cut into SLICES by the next word, so that no
   task holds one prefix's rows alone. There are at most HEAVY such prefixes.
4. Candidates (few) are scored by joins: each cut's two parts, the longer candidates around each, the words' texts.

Cases: a null text is empty; a null language is `und`; texts without words give nothing; repeated rows
count each; long texts are whole; an empty table gives no rows. Only the named columns are read, so further columns may have any name.
Ties are cut by score, count and the phrase in byte order. Sums and products are decimals, so they do not overflow.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sentimart.llm.scratch import stored
from sentimart.llm.textblocks import U64, TextHash, blocks, mix, runs, starts_of_rows, text_column

#: Bases of the word hash, tried in turn.
BASES = (0x0F3B9E4A5C7D86D7, 0x1A2F6D0B94E3C581, 0x07D4C1E85BA3926F, 0x1391A5F7E06B2C4D)
MAX_BITS = 1 << 27
HEAVY, SLICES = 1000, 64
#: Text bytes whose stripes are combined before they leave a task.
COMBINE_BYTES = 12 << 20
#: Stripe entries merged at once.
MERGE_ENTRIES = 1 << 20
LONGEST = 4
_MIX = (U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9), U64(0x27D4EB2F165667C5))


class _Words:
    """The words of some texts: hash, language code and whether the next word follows in the same piece."""

    def __init__(self, base: int):
        self.base, self.langs, self.hashes, self.codes, self.follows, self.bytes = base, {}, [], [], [], 0

    def add(self, batch: pa.RecordBatch, texts: dict[int, bytes] | None) -> None:
        raw, offsets = text_column(batch.column("text"))
        self.bytes += len(raw)
        if not len(raw):
            return
        low = raw + (((raw >= 65) & (raw <= 90)) * np.uint8(32))
        cut = (low == 46) | (low == 44) | (low == 59) | (low == 58) | (low == 33) | (low == 63) | ((low >= 10) & (low <= 13))
        starts, ends = runs(~(cut | (low == 32) | (low == 9)), starts_of_rows(offsets, len(raw)))
        if not len(starts):
            return
        hashes = TextHash(low, self.base)(starts, ends)
        row = np.searchsorted(offsets, starts, side="right") - 1
        seen = np.concatenate([[0], np.cumsum(cut)])
        follows = np.zeros(len(starts), bool)
        follows[:-1] = (row[1:] == row[:-1]) & (seen[starts[1:]] == seen[ends[:-1]])
        names = [self.langs.setdefault("und" if x is None else x, len(self.langs)) for x in batch.column("lang").to_pylist()]
        self.hashes.append(hashes), self.follows.append(follows), self.codes.append(np.array(names, np.int64)[row])
        if texts is not None:
            data = low.tobytes()
            kinds, where = np.unique(hashes, return_index=True)
            for h, i in zip(kinds.tolist(), where.tolist()):
                word = data[starts[i] : ends[i]]
                if texts.setdefault(h, word) != word:
                    texts.setdefault(-1, word)  # two words of one hash in one task

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """(hashes, language codes, follows, language keys by code, language names by code)."""
        names = list(self.langs)
        keys = np.array([zlib.crc32(x.encode()) for x in names], np.uint64)
        if not self.hashes:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool), keys, names
        return np.concatenate(self.hashes), np.concatenate(self.codes), np.concatenate(self.follows), keys, names


def _portions(batches: Iterator[pa.RecordBatch], base: int, texts: bool) -> Iterator[tuple[_Words, dict[int, bytes] | None]]:
    words, found = _Words(base), {} if texts else None
    for b in blocks(batches, "text"):
        words.add(b, found)
        if words.bytes >= COMBINE_BYTES:
            yield words, found
            words, found = _Words(base), {} if texts else None
    yield words, found


def _key(columns: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(columns[0]), np.uint64)
    for i, c in enumerate(columns):
        out = mix(out * _MIX[i % 4] + c.astype(np.uint64))
    return out


def _ordered(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal rows together, and where each run of equal rows begins in it."""
    order = np.argsort(_key(columns))
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([c[order][1:] != c[order][:-1] for c in columns])
    return order, np.flatnonzero(new)


def _count_words(df: DataFrame, base: int) -> DataFrame:
    """(lang, word, h, n): the stripe of the empty prefix, by language; a word null marks a hash with two words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, texts in _portions(batches, base, True):
            hashes, codes, _, _, names = words.arrays()
            if not len(hashes):
                continue
            order, begin = _ordered([hashes, codes])
            n = np.diff(np.append(begin, len(order)))
            h, code = hashes[order][begin], codes[order][begin]
            clash = -1 in texts
            yield pa.RecordBatch.from_arrays([
                pa.array([names[c] for c in code.tolist()]), pa.array([None if clash else texts[x] for x in h.tolist()], pa.binary()),
                pa.array(h.view(np.int64)), pa.array(n, pa.int64())], names=["lang", "word", "h", "n"])

    made = df.mapInArrow(run, "lang string, word binary, h long, n long")
    return made.groupBy("lang", "word", "h").agg(F.sum("n").alias("n"))


def _bitmap(keys: DataFrame) -> np.ndarray:
    """A bitmap of key (long): 16 bits a key, MAX_BITS at most. The driver sees its words only."""
    count = keys.count()
    bits = 1 << 16
    while bits < min(16 * count, MAX_BITS):
        bits *= 2
    place = F.pmod("key", F.lit(bits))
    words = keys.select((place / 64).cast("long").alias("at"), F.expr(f"shiftleft(1L, int(pmod(pmod(key, {bits}), 64)))").alias("bit"))
    table = words.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[table.column("at").to_numpy()] = table.column("bits").to_numpy()
    return out.view(np.uint64)


def _holds(bitmap: np.ndarray, key: np.ndarray) -> np.ndarray:
    bits = U64(len(bitmap) * 64)
    place = key.view(np.int64) % np.int64(bits)
    return (bitmap[place >> 6] >> (place & 63).astype(np.uint64)) & U64(1) == 1


def _keyed(frequent: DataFrame, n_words: int) -> DataFrame:
    """(key): the hash of language and words, as the tasks compute it, of rows (lang, ws)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang = np.array([zlib.crc32(x.encode()) for x in b.column("lang").to_pylist()], np.uint64)
            ws = np.array(b.column("ws").to_pylist(), np.int64).reshape(-1, n_words).view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(_key([lang, *ws.T]).view(np.int64))], names=["key"])

    return frequent.select("lang", "ws").mapInArrow(run, "key long")


_STRIPE = "lang string, plen int, w1 long, w2 long, w3 long, slice int, next array<long>, n array<long>"


def _stripe_batch(names: list[str], codes: np.ndarray, prefix: list[np.ndarray], following: np.ndarray, heavy: np.ndarray, lang_key: np.ndarray) -> pa.RecordBatch:
    """One row for each prefix (and slice) of the phrases prefix + following, with its counter."""
    order, begin = _ordered([codes, *prefix, following])
    n = np.diff(np.append(begin, len(order)))
    at = order[begin]
    codes, prefix, following = codes[at], [p[at] for p in prefix], following[at]
    cut = np.isin(_key([lang_key[codes], *prefix]), heavy)
    piece = np.where(cut, (following % U64(SLICES)).astype(np.int64), 0)
    order, begin = _ordered([codes, *prefix, piece])
    first = order[begin]
    offsets = pa.array(np.append(begin, len(order)), pa.int32())
    ws = [prefix[i][first].view(np.int64) if i < len(prefix) else np.zeros(len(first), np.int64) for i in range(3)]
    return pa.RecordBatch.from_arrays([
        pa.array([names[c] for c in codes[first].tolist()], pa.string()), pa.array(np.full(len(first), len(prefix), np.int32)), *map(pa.array, ws),
        pa.array(piece[first].astype(np.int32)), pa.ListArray.from_arrays(offsets, pa.array(following[order].view(np.int64))),
        pa.ListArray.from_arrays(offsets, pa.array(n[order], pa.int64()))], names=["lang", "plen", "w1", "w2", "w3", "slice", "next", "n"])


def _stripes(df: DataFrame, base: int, lengths: tuple[int, ...], bitmap, heavy: np.ndarray) -> DataFrame:
    """Stripes of the prefixes of these lengths. bitmap: a broadcast of the frequent words (length 1) or word pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = bitmap.value
        for words, _ in _portions(batches, base, False):
            hashes, codes, follows, lang_key, names = words.arrays()
            if len(hashes) < 2:
                continue
            lang = lang_key[codes]
            if lengths == (1,):
                good = _holds(known, _key([lang, hashes]))
                step = follows[:-1] & good[:-1] & good[1:]
            else:
                step = follows[:-1].copy()
                step[step] = _holds(known, _key([lang[:-1][step], hashes[:-1][step], hashes[1:][step]]))
            for length in lengths:
                whole = step[: len(step) - length + 1].copy()
                for j in range(1, length):
                    whole &= step[j : len(step) - length + 1 + j]
                first = np.flatnonzero(whole)
                if len(first):
                    yield _stripe_batch(names, codes[first], [hashes[first + j] for j in range(length)], hashes[first + length], heavy, lang_key)

    return df.mapInArrow(run, _STRIPE)


def _merged(stripes: DataFrame, least: int) -> DataFrame:
    """(lang, ws, f): the entries of at least `least` of the stripes merged by prefix."""
    by = ["lang", "plen", "w1", "w2", "w3", "slice"]
    dealt = stripes.repartition(*by).sortWithinPartitions(*by)

    def entries(names: list, counts: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.RecordBatch:
        row, following, n = counts
        keep = np.flatnonzero(n >= least)
        chosen = [names[i] for i in row[keep].tolist()]
        ws = [[*x[2 : 2 + x[1]], w] for x, w in zip(chosen, following[keep].tolist())]
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in chosen], pa.string()), pa.array(ws, pa.list_(pa.int64())), pa.array(n[keep], pa.int64())], names=["lang", "ws", "f"])

    def add(row: np.ndarray, following: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Elementwise sums of (row, next) counters, by row."""
        order = np.lexsort((following, row))
        row, following, n = row[order], following[order], n[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (following[1:] != following[:-1])
        begin = np.flatnonzero(new)
        return row[begin], following[begin], np.add.reduceat(n, begin)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counter = None, (np.zeros(0, np.int64),) * 2  # the last prefix so far and its merged counter
        for whole in batches:
            sizes = np.diff(whole.column("next").offsets.to_numpy())
            share = np.cumsum(sizes) // MERGE_ENTRIES
            for k in np.unique(share).tolist():
                at = np.flatnonzero(share == k)
                b = whole.slice(int(at[0]), len(at))
                keys = list(zip(*(b.column(c).to_pylist() for c in by)))
                names, rows = [], []
                for key in ([held] if held else []) + keys:
                    if not names or names[-1] != key:
                        names.append(key)
                    rows.append(len(names) - 1)
                if held:
                    rows = rows[1:]
                lists, amounts = b.column("next"), b.column("n")
                row = np.repeat(np.array(rows, np.int64), sizes[at])
                old = np.zeros(len(counter[0]), np.int64)
                merged = add(np.concatenate([old, row]), np.concatenate([counter[0], lists.flatten().to_numpy()]), np.concatenate([counter[1], amounts.flatten().to_numpy()]))
                last = np.searchsorted(merged[0], len(names) - 1)
                yield entries(names, tuple(x[:last] for x in merged))
                held, counter = names[-1], (merged[1][last:], merged[2][last:])
        if held:
            yield entries([held], (np.zeros(len(counter[0]), np.int64), *counter))

    return dealt.mapInArrow(run, "lang string, ws array<long>, f long")


def _heavy(frequent: DataFrame, n_words: int, total: int) -> np.ndarray:
    """Keys of the prefixes with at least one in HEAVY of all words; at most HEAVY for each length."""
    table = _keyed(frequent.filter(F.col("f") * HEAVY >= max(total, 1)), n_words).toArrow()
    return table.column("key").to_numpy().view(np.uint64)


def _counts(df: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(lang, ws, f) of the phrases with at least `least` occurrences, and (lang, word, h, n) of all words."""
    spark = df.sparkSession
    for base in BASES:
        words = stored(_count_words(df, base), "words")
        often = words.groupBy("h").agg(F.max("n").alias("top"), F.count_distinct("word").alias("kinds"), F.max(F.col("word").isNull()).alias("clash"))
        if not often.filter(f"clash or kinds > 1 and top >= {least}").limit(1).count():
            break
    else:
        raise ValueError("every base gives a frequent word the hash of another one")
    total = words.agg(F.sum("n")).first()[0] or 0
    levels = [words.filter(F.col("n") >= least).select("lang", F.array("h").alias("ws"), F.col("n").alias("f"))]
    for n_words, lengths in ((1, (1,)), (2, (2, 3))):
        bitmap = spark.sparkContext.broadcast(_bitmap(_keyed(levels[-1], n_words)))
        heavy = _heavy(levels[-1], n_words, total)
        levels.append(stored(_merged(_stripes(df, base, lengths, bitmap, heavy), least), f"phrases{n_words}"))
    return levels[0].unionByName(levels[1]).unionByName(levels[2]), words


def collocations(df: DataFrame, least: int = 30, share: int = 80, top: int = 2000, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first phrases of 2 to 4 words."""
    rows = df.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    counts, words = _counts(rows, least)
    found = counts.filter(F.size("ws") > 1).select("lang", "ws", F.col("f").alias("a"))
    # Subsumption: the largest longer candidate around each phrase.
    longer = found.filter(F.size("ws") > 2)
    inner = longer.select("lang", "a", F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), F.size("ws") - 1), lambda size: F.transform(F.sequence(F.lit(1), F.size("ws") - size + 1), lambda at: F.slice("ws", at, size))))).alias("ws"))
    around = inner.groupBy("lang", "ws").agg(F.max("a").alias("around"))
    alone = found.join(around, ["lang", "ws"], "left").filter(
        F.col("around").isNull() | (F.col("around").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * share))
    # Cuts: both parts' counts; the lowest score counts, then the first cut.
    cuts = alone.select("lang", "ws", "a", F.explode(F.sequence(F.lit(1), F.size("ws") - 1)).alias("k"))
    cuts = cuts.select("lang", "ws", "a", "k", F.slice("ws", F.lit(1), F.col("k")).alias("left"), F.slice("ws", F.col("k") + 1, F.size("ws") - F.col("k")).alias("right"))
    parts = counts.filter(F.size("ws") < LONGEST)
    cuts = cuts.join(parts.select("lang", F.col("ws").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(parts.select("lang", F.col("ws").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    cuts = cuts.withColumn("score", F.expr("(CAST(2000000 AS DECIMAL(10,0)) * CAST(a AS DECIMAL(20,0))) div (l + r)"))
    scored = cuts.groupBy("lang", "ws", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    names = words.filter(F.col("n") >= least).select("lang", F.col("h").alias("w"), F.col("word").cast("string").alias("word"))
    spelled = scored.select("lang", "ws", F.posexplode("ws").alias("at", "w")).join(names, ["lang", "w"]).groupBy("lang", "ws").agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("at", "word")))["word"], " ").alias("phrase"))
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    out = scored.join(spelled, ["lang", "ws"]).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    first = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = out.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= top).join(total, "lang")
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
