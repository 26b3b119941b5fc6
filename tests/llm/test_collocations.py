"""op12 against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from sentimart.llm import collocations

from odd_rows import ODD_ROWS, llm_spark  # noqa: F401  fixtures

SCHEMA = T.StructType([T.StructField("lang", T.StringType()), T.StructField("text", T.StringType()), T.StructField("ws", T.StringType()), T.StructField("n", T.StringType()), T.StructField("score", T.StringType())])


def brute(rows, least, top):
    out = []
    for lang in {x or "und" for x, _ in rows}:
        f, n = Counter(), 0
        for own, text in rows:
            if (own or "und") != lang:
                continue
            for piece in re.split("[.,;:!?\n\x0b\x0c\r]", "".join(c.lower() if c.isascii() else c for c in text or "")):
                ws = [w for w in re.split("[ \t]+", piece) if w]
                n += len(ws)
                for size in range(1, 5):
                    f.update(tuple(ws[i : i + size]) for i in range(len(ws) - size + 1))
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in found.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in found.items()):
                continue
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -s))
    return sorted(out)


def sample():
    rng = random.Random(11)
    words = ["the", "of", "New", "York", "city", "é", "a%b", "ion", "x"]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(30):
            parts.append(rng.choice(["new york city council", "of the", rng.choice(words), rng.choice(words) + "\t" + rng.choice(words), "kind of a thing", "one two"]))
            parts.append(rng.choice([" ", " ", " ", ", ", ".\n", "\r", "  "]))
        rows.append((rng.choice(["en", "fr", None]), "".join(parts)))
    return rows + [("en", t) for _, t in ODD_ROWS] + [("de", "nur wenige worte")]


@pytest.mark.parametrize("small", [False, True])
def test_collocations(llm_spark, monkeypatch, small):
    if small:  # many portions and merges, every stripe cut, a full bitmap
        monkeypatch.setattr(collocations, "COMBINE_BYTES", 300)
        monkeypatch.setattr(collocations, "MERGE_ENTRIES", 7)
        monkeypatch.setattr(collocations, "HEAVY", 1 << 40)
        monkeypatch.setattr(collocations, "_bitmap", lambda keys: np.full(1024, (1 << 64) - 1, np.uint64))
    rows = sample()
    df = llm_spark.createDataFrame([(a, t, "x", "y", "z") for a, t in rows], SCHEMA).repartition(3)
    got = collocations.collocations(df, top=40).collect()
    assert sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got) == brute(rows, 30, 40)


def test_colliding_words_take_another_base(llm_spark, monkeypatch):
    rows = [("en", "good day " * 40 + "bad night " * 40)]
    df = llm_spark.createDataFrame([(a, t, "x", "y", "z") for a, t in rows], SCHEMA)
    monkeypatch.setattr(collocations, "BASES", (1, collocations.BASES[0]))  # base 1: every anagram collides
    df2 = df.unionByName(df.withColumn("text", df.text.substr(1, 0)))
    more = llm_spark.createDataFrame([("en", "yad doog thgin dab " * 40, "x", "y", "z")], SCHEMA)
    got = collocations.collocations(df2.unionByName(more)).collect()
    assert sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got) == brute([*rows, ("en", "yad doog thgin dab " * 40)], 30, 2000)
    assert collocations.collocations(df.filter("lang = 'none'")).count() == 0
