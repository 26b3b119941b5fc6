"""Toxicity scores of texts restored through a noisy channel.

1. A character trigram model counts every document (28 symbols, so its size is fixed while its counts grow).
2. Suspicious stretches (letters mixed with digits or signs, letters set apart, letters repeated) become lattices:
   each sign may stand for the letters it imitates, separators and repetitions for nothing. Viterbi decoding under
   the character model finds the likeliest reading of the whole stretch, however long, which replaces it. A separator
   may also be a gap between words: of letters set apart, each further place where a word may begin is read as well.
3. Words and their 4-, 5- and 6-byte beginnings are features. From labelled texts a feature's weight is the lower
   confidence bound of its log-odds in toxic texts; a feature needs MIN_TEXTS toxic texts, at every size of the table.
   A logistic curve over a text's strongest weight and the sum of its weights, fitted on the same labelled texts, gives
   the score. All features that are looked at come from the bounded sample.

Learning takes at most `sample` labelled rows, chosen by a hash of the key; every row is scored. Cases: null and
empty texts get the score of a text without features; keys that are null or without a label are scored alike but
never learned from; a key with several labels counts as toxic if one says so, and its repeated rows count each;
without any toxic or any clean labelled text all scores are the share of toxic ones (0.0 without labels); an empty
table gives an empty table. Only the named columns are read, so further columns may have any name.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentimart.llm.scratch import stored
from sentimart.llm.textblocks import U64, TextHash, blocks, mix, runs, starts_of_rows, text_column

MIN_TEXTS = 3
#: Standard errors by which a weight is lowered, and the least weight kept.
CAUTION, LEAST_WEIGHT = 2.0, 1.0
BEGINNINGS = (4, 5, 6)
_WHOLE = U64(0x5851F42D4C957F2D)

# Letters that digits and signs imitate.
IMITATED = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "*": "aeiou"}
#: Costs (negative logs) in the channel: a letter as itself, as one of its imitations, dropped as a repetition.
SELF, IMITATION, WILD, REPEAT = 0.0, 1.0, 2.0, 0.5
#: Letters of a word that may begin inside a stretch of letters set apart: as many as features and their ends take.
INSIDE = 7
#: Longest stretch whose reading is remembered.
KNOWN = 64

_SIGN = r"0-9@$!|+*€("
_LETTER = "a-zA-Zİ\u212a"  # all whose lower case has an ASCII letter
_EDGE = "[^a-zA-Z0-9\u212a]"
# RE2, over whole columns: which texts hold something suspicious; every text in which _STRETCH finds one is among them.
_SUSPICIOUS = (
    rf"(^|{_EDGE})[{_LETTER}{_SIGN}][ ._*-]{{1,2}}[{_LETTER}{_SIGN}][ ._*-]{{1,2}}(İ|[{_LETTER}{_SIGN}]({_EDGE}|$))"
    rf"|[{_LETTER}][{_SIGN}][{_LETTER}{_SIGN}]|[{_SIGN}][{_LETTER}][{_LETTER}{_SIGN}]|[{_LETTER}{_SIGN}][{_LETTER}][{_SIGN}]|[{_LETTER}{_SIGN}][{_SIGN}][{_LETTER}]"
    "|(?i:" + "|".join(c * 3 for c in "abcdefghijklmnopqrstuvwxyz") + ")"
)
_STRETCH = re.compile(
    rf"(?P<apart>(?<![a-z0-9])[a-z{_SIGN}](?:[ ._*-]{{1,2}}[a-z{_SIGN}](?![a-z0-9])){{2,}})"
    rf"|(?P<mixed>(?<![a-z{_SIGN}])(?=[a-z{_SIGN}]*[a-z])(?=[a-z]*[{_SIGN}])[a-z{_SIGN}]{{3,}}(?![a-z{_SIGN}]))"
    rf"|(?P<drawn>(?<![a-z])(?=[a-z]*([a-z])\4\4)[a-z]{{3,}}(?![a-z]))"
)


def _symbols() -> np.ndarray:
    """Model symbol of each byte: 0 a gap, 1 to 26 letters without case, 27 any other letter's byte."""
    table = np.zeros(256, np.int32)
    for i in range(26):
        table[[97 + i, 65 + i]] = i + 1
    table[128:] = 27
    return table


_SYMBOL = _symbols()


class CharModel:
    """Smoothed trigram log-probabilities over 28 symbols."""

    def __init__(self, counts: np.ndarray):
        tri = counts.reshape(28, 28, 28).astype(np.float64)
        one = (tri.sum((0, 1)) + 1) / (tri.sum() + 28)
        two = (tri.sum(0) + 5 * one) / (tri.sum((0, 2))[:, None] + 5)
        three = (tri + 5 * two[None]) / (tri.sum(2, keepdims=True) + 5)
        self.cost = (-np.log(three)).tolist()
        self.known: dict[str, str] = {}

    def decode(self, stretch: str) -> str:
        """The likeliest letters behind a stretch of signs and letters (lower case, separators removed)."""
        if len(stretch) > KNOWN:
            return self._viterbi(stretch)
        if stretch not in self.known:
            if len(self.known) > 50_000:
                self.known = {}
            self.known[stretch] = self._viterbi(stretch)
        return self.known[stretch]

    def _viterbi(self, stretch: str) -> str:
        cost = self.cost
        # The two last symbols: cost so far, letters so far as (letters before, letter), so that paths share them.
        paths: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        previous = ""
        first, last = len(stretch) - len(stretch.lstrip("(")), len(stretch.rstrip("!"))  # outside, both may be punctuation
        for i, sign in enumerate(stretch):
            letters = [(sign, SELF)] if "a" <= sign <= "z" else [(c, WILD if sign == "*" else IMITATION) for c in IMITATED.get(sign, "")]
            ways = [(ord(c) - 96, c, w) for c, w in letters]
            if i < first or i >= last:
                ways.append((0, sign, SELF))
            new: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (so_far, text) in paths.items():
                if sign == previous and (a, b) != (0, 0) or not ways:
                    here = so_far + REPEAT
                    if here < new.get((a, b), (math.inf,))[0]:
                        new[a, b] = (here, text)
                for s, c, w in ways:
                    here = so_far + w + cost[a][b][s]
                    if here < new.get((b, s), (math.inf,))[0]:
                        new[b, s] = (here, (text, c))
            paths, previous = new, sign
        ends = [(so_far + cost[a][b][0], text) for (a, b), (so_far, text) in paths.items()]
        least = min(e[0] for e in ends)
        return min(_letters(text) for here, text in ends if here == least)

    def restore(self, text: str) -> str:
        """The text in lower case with its suspicious stretches decoded."""

        def read(m: re.Match) -> str:
            if not m["apart"]:
                return self.decode(m[0])
            word = self.decode(re.sub(r"[ ._-]|(?<=\*)\*", "", m[0]))
            # Every separator may be a gap: the words that may begin behind one, beside the reading as one word.
            return " ".join([word, *(word[i : i + INSIDE] for i in range(1, len(word) - BEGINNINGS[0] + 1))])

        return _STRETCH.sub(read, text.lower())


def _letters(path: tuple | None) -> str:
    out = []
    while path is not None:
        path, letter = path
        out.append(letter)
    return "".join(reversed(out))


def _restored(col: pa.Array, model: CharModel) -> pa.Array:
    """The column with suspicious texts restored."""
    col = col.fill_null("")
    at = pc.indices_nonzero(pc.match_substring_regex(col, _SUSPICIOUS)).to_pylist()
    if not at:
        return col
    mask = np.zeros(len(col), bool)
    mask[at] = True
    return pc.replace_with_mask(col, pa.array(mask), pa.array([model.restore(col[i].as_py()) for i in at], col.type))


def features(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every word and beginning of a word, row by row."""
    raw, offsets = text_column(col)
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    low = raw + (((raw >= 65) & (raw <= 90)) * np.uint8(32))
    inside = ((low >= 97) & (low <= 122)) | (low >= 128)
    starts, ends = runs(inside, starts_of_rows(offsets, len(raw)))
    row = np.searchsorted(offsets, starts, side="right") - 1
    hashed, size = TextHash(low), ends - starts
    rows, values = [row], [mix(hashed(starts, ends) + _WHOLE)]
    for n in BEGINNINGS:
        own = size >= n
        rows.append(row[own])
        values.append(hashed(starts[own], starts[own] + n))
    return np.concatenate(rows), np.concatenate(values)


@dataclass
class ToxicityModel:
    chars: CharModel
    hashes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))  # sorted
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    curve: tuple[float, float, float] = (-50.0, 0.0, 0.0)

    def __post_init__(self):
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[self.hashes & U64(0xFFFF)] = True

    def strengths(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Strongest weight and log of the sum of weights of each text."""
        row, value = features(_restored(col, self.chars))
        some = self.maybe[value & U64(0xFFFF)]
        row, value = row[some], value[some]
        at = np.minimum(np.searchsorted(self.hashes, value), max(len(self.hashes) - 1, 0))
        hit = self.hashes[at] == value if len(self.hashes) else np.zeros(0, bool)
        row, weight = row[hit], self.weights[at[hit]]
        top, total = np.zeros(len(col)), np.bincount(row, weight, len(col))
        np.maximum.at(top, row, weight)
        return top, np.log1p(total)

    def score(self, col: pa.Array) -> np.ndarray:
        top, total = self.strengths(col)
        base, a, b = self.curve
        return 1 / (1 + np.exp(-np.clip(base + a * top + b * total, -50, 50)))


def char_model(docs: DataFrame, text: str = "text") -> CharModel:
    """Trigram counts over all documents; each task sends at most 28 ** 3 sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(28**3, np.int64)
        for b in blocks(batches, "text"):
            raw, offsets = text_column(b.column("text"))
            s = _SYMBOL[np.insert(raw, offsets[:-1], 32)] if len(raw) else np.zeros(0, np.int32)  # a gap before each text
            s = np.concatenate([[0], s, [0]]).astype(np.int32)
            counts += np.bincount(s[:-2] * 784 + s[1:-1] * 28 + s[2:], minlength=28**3)
        own = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(counts[own], pa.int64())], names=["code", "n"])

    sums = docs.select(F.col(text).alias("text")).mapInArrow(run, "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(28**3)
    counts[[r["code"] for r in sums]] = [r["n"] for r in sums]
    return CharModel(counts)


def held_out(key: Column) -> Column:
    """Whether a row's label is kept from learning; rows without a key are."""
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(True))


def _counts(texts: DataFrame, chars: CharModel, among: np.ndarray | None) -> DataFrame:
    """(feature, n): texts that have each feature, summed in each task before it leaves it; among: only these, sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text"):
            row, value = features(_restored(b.column("text"), chars))
            if among is not None:
                at = np.minimum(np.searchsorted(among, value), len(among) - 1)
                hit = among[at] == value
                row, value = row[hit], value[hit]
            order = np.lexsort((row, value))
            row, value = row[order], value[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
            found, n = np.unique(value[new], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64), pa.int64()), pa.array(n, pa.int64())], names=["feature", "n"])

    return texts.select("text").mapInArrow(run, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))


def _fit_curve(top: np.ndarray, total: np.ndarray, toxic: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression on two inputs by Newton steps, with a small ridge on the slopes."""
    x = np.column_stack([np.ones(len(top)), top, total])
    beta, ridge = np.zeros(3), np.diag([1e-6, 1e-3, 1e-3]) * len(top) + np.diag([1e-6] * 3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -50, 50)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (toxic - p) - ridge @ beta)
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in beta)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label_key: str = "doc_id", label: str = "toxic", sample: int = 200_000) -> ToxicityModel:
    """Learn from the labelled rows that are not held out, at most about `sample` of them."""
    chars = char_model(docs, text)
    marks = labels.filter(F.col(label).isNotNull()).groupBy(F.col(label_key).alias("key")).agg(F.max(label).alias("toxic"))
    marks = marks.filter("key is not null").filter(~held_out(F.col("key")))
    rows = marks.count()
    if rows > sample:
        marks = marks.filter(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < int(sample / rows * (1 << 20)))
    # At most about `sample` keys and marks are broadcast, so the texts of all other rows stay where they are.
    known = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(marks), "key")
    known = stored(known, "labelled")
    sizes = {int(r["toxic"]): r["count"] for r in known.groupBy("toxic").count().collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        share = bad / max(bad + good, 1)
        return ToxicityModel(chars, curve=(math.log((share + 1e-9) / (1 - share + 1e-9)), 0.0, 0.0))
    seen = _counts(known.filter("toxic = 1"), chars, None).filter(F.col("n") >= MIN_TEXTS).toArrow()
    among, t = seen.column("feature").to_numpy().view(np.uint64), seen.column("n").to_numpy().astype(np.float64)
    order = np.argsort(among)
    among, t = among[order], t[order]
    c = np.zeros(len(among))
    if len(among):
        clean = _counts(known.filter("toxic = 0"), chars, among).toArrow()
        c[np.searchsorted(among, clean.column("feature").to_numpy().view(np.uint64))] = clean.column("n").to_numpy()
    weight = np.log((t + 0.5) / (bad + 1)) - np.log((c + 0.5) / (good + 1)) - CAUTION * np.sqrt(1 / (t + 0.5) + 1 / (c + 0.5))
    kept = weight >= LEAST_WEIGHT
    model = ToxicityModel(chars, among[kept], weight[kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text"):
            top, total = model.strengths(b.column("text"))
            yield pa.RecordBatch.from_arrays([pa.array(top), pa.array(total), b.column("toxic").cast(pa.int32())], names=["top", "total", "toxic"])

    points = known.mapInArrow(run, "top double, total double, toxic int").groupBy("top", "total", "toxic").count().toPandas()  # at most `sample` rows
    n = points["count"].to_numpy()
    model.curve = _fit_curve(*(np.repeat(points[x].to_numpy(np.float64), n) for x in ("top", "total", "toxic")))
    return model


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, score, predicted) for each row."""
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "__text"):
            found = model.score(b.column("__text"))
            yield pa.RecordBatch.from_arrays([b.column("__key"), pa.array(found), pa.array((found >= 0.5).astype(np.int32))], names=schema.names)

    return docs.select(F.col(key).alias("__key"), F.col(text).alias("__text")).mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """The rows of docs, all columns, that are not predicted toxic."""
    @F.pandas_udf("double")
    def toxicity(col: pd.Series) -> pd.Series:
        array = pa.array(col, pa.string(), from_pandas=True)
        parts = [model.score(b.column("t")) for b in blocks(iter([pa.RecordBatch.from_arrays([array], names=["t"])]), "t")]
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return docs.filter(toxicity(F.col(text)) < 0.5)
