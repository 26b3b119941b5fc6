"""op4, op5, op6 and op7 against plain Python."""

import math
import random
import re
from pathlib import Path

import duckdb
import numpy as np
import pytest

from odd_rows import ODD_ROWS, docs_of, llm_spark  # noqa: F401  fixtures
from sentimart.llm import decontaminate, licenses, topk, url_filter
from sentimart.llm.queries import ORACLE_SQL, QUERIES, URL_RULES

ITEM = "Anna bought 12 apples and 7 pears for 40 dollars at the old market near the river last week"


@pytest.fixture(scope="module")
def benchmark(llm_spark):
    rows = [(1, ITEM), (2, "short five word item here"), (3, None), (4, ""), (1, ITEM), (5, "Paris London Berlin Madrid Rome Vienna Prague Oslo Bern Kiev")]
    return llm_spark.createDataFrame(rows, "item_id long, text string")


def leaks(docs_of, benchmark, texts):
    rows = list(enumerate(texts))
    found = decontaminate.find_leaks(docs_of(rows), benchmark).collect()
    assert sorted(r.doc_id for r in found) == list(range(len(texts)))
    return {r.doc_id: (r.contaminated, r.item) for r in found}


def test_leaks(docs_of, benchmark):
    texts = [
        f"some words before. {ITEM} and after",  # as it is
        ITEM.lower(),
        ITEM.replace("12", "15").replace("40", "90"),  # other numbers
        "so Anna bought 12 apples and 7 pears for 40",  # one window
        "he said that Anna bought twelve apples and seven pears for forty dollars",  # no window alike
        "short five word item here",  # a short item as the whole text
        "the short five word item here is only quoted",
        "Oslo Rome Paris Vienna Bern Prague Madrid London Kiev Berlin",  # names only say nothing
        None,
        "",
        "bought 12 apples and 12 pears for 40 dollars at the old market",  # equal where the item differs
        "Short FIVE, word: item (here)!",
        "short five word item there",
        "it said so. Pears for 40 dollars at the old market, then",  # a window that begins a sentence here only
    ]
    got = leaks(docs_of, benchmark, texts)
    assert [got[i][0] for i in range(len(texts))] == [True, True, True, True, False, True, True, False, False, False, True, True, False, True]
    assert got[2] == (True, 1) and got[5] == got[6] == got[11] == (True, 2)


def test_windows_that_name_one_word_or_none(docs_of, llm_spark):
    """Items without two neighbouring simple words are met all the same; the cheap test then asks for less."""
    texts = ["a 1.5 of-x b 2.5 c-d 3.5 e-f 4.5 g", "1.5 of-x B 2.5 c-d 3.5 e-f 4.5", "1.5 2.5 3.5 4.5 5.5 6.5 7.5 8.5 9.5", "x 2.5 3.5 4.5 5.5 6.5 7.5 8.5 9.5 y", "nothing"]
    for items, want in (([texts[1]], [True, True, False, False, False]), ([texts[2]], [False, False, True, True, False]), (["nothing"], [False] * 4 + [True])):
        frame = llm_spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
        got = leaks(docs_of, frame, texts)
        assert [got[i][0] for i in range(len(texts))] == want


def test_slots_must_agree(docs_of, benchmark):
    """Windows that only differ in slot structure do not meet; the rest of the passage may."""
    assert leaks(docs_of, benchmark, ["bought 12 apples and 12 pears for 40"])[0][0] is False
    assert leaks(docs_of, benchmark, ["bought 13 apples and 8 pears for 40"])[0][0] is True


def test_every_case_and_slot_heavy_items(docs_of, llm_spark):
    """Copies whose template says little: their words are compared, in whatever case; amounts are numbers."""
    sums, table = "12 + 30 = 42 and 9 * 8 = 72 or 5", "Name Alice Bob Carol Dave Erin Frank Grace Heidi"
    paid = "they paid $20 for the old lamp in town today"
    items = llm_spark.createDataFrame([(1, ITEM), (2, sums), (3, table), (4, paid)], "item_id long, text string")
    plain = llm_spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    lists = [
        (f"see {sums} there", 2),
        (f"see {sums} there".replace("42", "43").replace("72", "73").replace("30", "31"), None),
        (f"see {table.lower()} there", 3),
        (f"see {' '.join(reversed(table.split()))} there", None),
        (f"see {ITEM.upper()} THERE", 1),
        (f"see {ITEM.title()} There", 1),
        (paid.replace("$20", "€35"), 4),
        (paid.replace("$20", "35"), 4),
        ("SHORT", None),
    ]
    got = leaks(docs_of, items, [t for t, _ in lists])
    assert [got[i][1] for i in range(len(lists))] == [item for _, item in lists]
    assert [v for _, v in sorted(leaks(docs_of, plain, [ITEM.upper(), ITEM.title(), "A B C D E F G H I"]).items())] == [(True, 1), (True, 1), (False, None)]


def test_drop_leaks(docs_of, benchmark):
    rows = [(1, ITEM), (1, "clean"), (2, ITEM + " more"), (2, ITEM + " more"), (None, ITEM), *ODD_ROWS]
    kept = decontaminate.drop_leaks(docs_of(rows), benchmark)
    assert kept.columns == docs_of(rows).columns
    assert sorted(str((r.doc_id, r.text)) for r in kept.collect()) == sorted(str(r) for r in [(1, "clean"), *ODD_ROWS])
    assert decontaminate.find_leaks(docs_of([]), benchmark).count() == 0
    assert decontaminate.find_leaks(docs_of(rows), benchmark.limit(0)).filter("contaminated").count() == 0


def test_leaks_without_broadcast(docs_of, benchmark, monkeypatch):
    texts = [f"x {ITEM}", "nothing of it"]
    want = leaks(docs_of, benchmark, texts)
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert leaks(docs_of, benchmark, texts) == want


def test_licenses(docs_of, llm_spark):
    known = llm_spark.createDataFrame([("B", "You MAY use this Licence, freely!\n(c) 2001 Someone"), ("A", "you may use this license freely"), ("C", "Other terms apply."), ("D", None), ("E", "...")], "license_id string, text string")
    rows = [
        (1, "Copyright (c) 2020 Me\n\n  You may use THIS license -- freely."),
        (2, "prose\nOther terms apply\nmore prose"),
        (3, "you may use this license freely and more"),
        (4, "Other terms apply.\nyou may use this licence freely"),
        *ODD_ROWS,
    ]
    got = licenses.scan_licenses(docs_of(rows), known).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.text_license, tuple(r.line_licenses)) for r in got if r.text_license or r.line_licenses} == {(1, "A", ("A",)), (2, None, ("C",)), (4, None, ("A", "C"))}
    assert licenses.scan_licenses(docs_of([]), known).count() == 0


def test_license_lines_of_documents(llm_spark):
    """Every line that speaks of a licence, found without the known table, gets one."""
    folder = "/root/testdata/sf0.01"
    lines = {r.doc_id: [x for x in (r.text or "").split("\n") if re.search("licen[cs]e|CC[ -]BY", x, re.I)] for r in llm_spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    got = {r.doc_id: [x for x in r.line_licenses.split(",") if x] for r in QUERIES["op5_license_scans"](llm_spark, folder).collect()}
    assert sum(map(bool, lines.values())) > 10
    for key, own in lines.items():
        assert len(got[key]) == len({x.split(" under ")[-1] for x in own}), own
        assert ("MIT" in got[key]) == any("MIT License" in x for x in own)


MIT_TEXT = """The MIT License (MIT)

Copyright (c) 2019 Jane Doe

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \u201cSoftware\u201d), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED \u201cAS IS\u201d, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""


def test_full_license_texts(docs_of, llm_spark):
    folder = Path(licenses.__file__).parent / "license_texts"
    texts = {f.stem: f.read_text() for f in folder.iterdir()}
    apache = texts["Apache-2.0"]
    rows = [
        (1, MIT_TEXT),
        (2, "Copyright 2001 A. Body. All rights reserved.\n\n" + texts["BSD-3-Clause"].upper()),
        (3, apache.replace("http:", "https:")),
        (4, apache.replace("[yyyy] [name of copyright owner]", "2020 Jane Doe")),
        (5, apache.split("APPENDIX")[0]),
        (6, texts["GPL-2.0"].split("How to Apply")[0]),
        (7, MIT_TEXT.replace("free of charge", "for a fee")),
        *[(100 + i, t) for i, t in enumerate(texts.values())],
    ]
    got = {r.doc_id: r.text_license for r in licenses.scan_licenses(docs_of(rows), licenses.known_notices(llm_spark)).collect()}
    assert [got[i] for i in range(1, 8)] == ["MIT", "BSD-3-Clause", "Apache-2.0", "Apache-2.0", "Apache-2.0", "GPL-2.0", None]
    assert {i: got[100 + i] for i in range(len(texts))} == {i: name.split("@")[0] for i, name in enumerate(texts)}


def rule_by_hand(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = rest
    for c in "/?#":
        host = host.split(c, 1)[0]
    path = rest[len(host) :].split("?", 1)[0].split("#", 1)[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for what, h, p in URL_RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, what)
    return host, path, *(best or (None, None))


URLS = [None, "", "nothing", "://", "http://", "http://A.COM", "http://A.com/", "http://com/x?y=/en/", "https://www.Example.com/en/1", "https://m.www.example.com/en/1#a", "https://example.com/en/", "https://notexample.com/en/", "https://x.net/es/1", "https://x.net/esx", "https://net/fr/?", "ftp://a?b/c", "ftp://a#b?c", "http://b.org:80/p/q?r#s", "a://b://c/d", "http://bad.org/en/1\nx", "http://É.COM/é"]


def test_rules_and_reputation(llm_spark):
    rows = [(i, u, None) for i, u in enumerate(URLS)]
    rows += [(1000 + i, f"http://bad.example.org/{i}", 0) for i in range(60)] + [(2000 + i, f"http://s{i % 9}.good.org/{i}", 1) for i in range(90)] + [(None, "http://new.good.org/", None)]
    pages = llm_spark.createDataFrame(rows, "page_id long, url string, good int")
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages, URL_RULES, "good").collect()}
    want = set()
    for key, url, _ in rows:
        host, path, rule, verdict = rule_by_hand(url)
        want.add((key, host, path, rule, verdict or ("block" if host == "bad.example.org" else "allow")))
    assert got == want
    assert url_filter.judge_urls(pages.limit(0), URL_RULES, "good").count() == 0
    assert url_filter.judge_urls(pages.withColumn("good", pages["good"] * None), URL_RULES, "good").filter("rule is null and verdict = 'block'").count() == 0


def test_top_k(llm_spark):
    rng = np.random.default_rng(7)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 1 + i % 5, 8)], "x") for i in range(300)]
    rows += [(i + 300, rows[i % 7][1], "x") for i in range(60)]  # ties
    rows += [(400, None, "x"), (401, [], "x"), (402, [1.0] * 7, "x"), (403, [math.nan] + [1.0] * 7, "x"), (404, [None] + [1.0] * 7, "x"), (None, [1.0] * 8, "x"), (405, [math.inf] * 8, "x"), (406, [0.0] * 8, "x"), (7, rows[7][1], "x")]
    frame = llm_spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    rows += [(11, [3.0] * 8, "x"), (40, [-2.0] * 8, "x")]  # repeated ids with other vectors, one of a query
    frame = llm_spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    vectors = [(k, [math.floor(64 * x) for x in v]) for k, v, _ in rows if k is not None and v and len(v) == 8 and all(x is not None and math.isfinite(x) for x in v)]
    want = set()
    for q in {k for k, _ in vectors if k % 20 == 0}:
        near = sorted((-sum(a * b for a, b in zip(v, w)), k) for own, v in vectors if own == q for k, w in vectors if k != q)[:20]
        want |= {(q, r + 1, k, -s) for r, (s, k) in enumerate(near)}
    for size, head in ((4096, 16), (16, 2), (4, 2)):  # one, some and many rounds
        topk.BLOCK, topk.QUERIES, topk.HEAD = size, max(size // 2, 3), head
        got = {tuple(r) for r in topk.top_k(frame, frame["vec_id"] % 20 == 0).collect()}
        topk.BLOCK, topk.QUERIES, topk.HEAD = 4096, 256, 16
        assert got == want
    assert topk.top_k(frame.limit(0), frame["vec_id"] % 20 == 0).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_equal_sql(llm_spark, name):
    folder = "/root/testdata/sf0.001"
    frame = QUERIES[name](llm_spark, folder)
    columns = sorted(frame.columns)
    db = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    result = db.execute(ORACLE_SQL[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    want = [tuple(r[names.index(c)] for c in columns) for r in result.fetchall()]
    got = [tuple(r[c] for c in columns) for r in frame.collect()]
    random.shuffle(got)
    assert sorted(map(str, got)) == sorted(map(str, want))
