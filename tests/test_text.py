"""Golden rows for every text step (FIXTURES.md section 4) and text properties."""

from dataclasses import replace

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from sentimart import resources as R
from sentimart.functions import text as TF
from sentimart.operators import process as P

# Input -> tokens joined by a blank, before stopwords and lemmas.
GOLDEN = [
    (None, ""),
    ("", ""),
    ("   ", ""),
    ("Great APP!!!", "great app"),
    ("good/bad", "goodbad"),
    ("café 5stars", "caf stars"),
    ("see https://x.y/z now", "see now"),
    ("awwww ok", "a ok"),
    ("<b>Love</b> it &amp; more", "love it more"),
    ("a<br>b", "ab"),
    ("don't can't won't", "do not can not will not"),
    ("cannot pay", "can not pay"),
    ("fast\u00a0ship", "fast ship"),
    ("x\u3000y", "xy"),
    ("ok\U0001F600\u2764\ufe0f", "ok"),
    ("wow...great", "wowgreat"),
    ("<script>var a=1;</script>hi", "hi"),
    ("<!-- c -->hi", "hi"),
    ("2 < 3 fine", "fine"),
]


def _frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "raw_id long, review_text string")


def test_golden_column_chain(spark):
    df = _frame(spark, [g[0] for g in GOLDEN])
    out = df.select("raw_id", F.array_join(TF.tokenize(TF.pre_clean(F.col("review_text"))), " ").alias("o"))
    got = {r.raw_id: r.o for r in out.collect()}
    assert [got[i] for i in range(len(GOLDEN))] == [g[1] for g in GOLDEN]


def test_staged_chain_equals_column_chain(spark):
    """The guarded, staged DataFrame chain gives the same tokens as the plain column chain."""
    df = _frame(spark, [g[0] for g in GOLDEN] + ["It's https://a.b/c gonna be <i>ok</i> &lt;3"])
    a = df.select("raw_id", TF.clean_tokens(F.col("review_text")).alias("t"))
    b = TF.add_clean_tokens(df, "review_text", "t").select("raw_id", "t")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_stopwords_keep_order_and_repeats(spark):
    df = _frame(spark, ["the app the app is great great"])
    out = df.select(F.array_join(TF.clean_tokens(F.col("review_text")), " ").alias("o")).first().o
    assert out == "app app great great"


def test_no_stopword_list_means_no_removal(spark):
    df = _frame(spark, ["the app"])
    out = df.select(F.array_join(TF.clean_tokens(F.col("review_text"), stopwords=()), " ").alias("o")).first().o
    assert out == "the app"


def test_lemmas_use_vocabulary_and_irregular_table(spark):
    df = _frame(spark, ["boxes box watches watch children ponies pony glass"])
    out = P.clean_text_only(df).first()
    # boxes->box (xes rule, 'box' known), watches->watch (ches rule), children->child (table),
    # ponies->pony (ies rule), glass stays (no 'glas' in the vocabulary).
    assert out.cleaned_text == "box box watch watch child pony pony glass"
    assert out.word_count == 8


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=1, max_size=6))
def test_cleaned_text_shape_and_score_range(spark, texts):
    out = P.clean_text_only(_frame(spark, texts)).collect()
    assert len(out) == len(texts)
    for r in out:
        assert r.cleaned_text == "" or all(t.isascii() and t.isalpha() and t.islower() for t in r.cleaned_text.split(" "))
        assert not any(ch.isdigit() for ch in r.cleaned_text)
        assert -1.0 <= r.sentiment_score <= 1.0
        assert r.word_count == (len(r.cleaned_text.split(" ")) if r.cleaned_text else 0)


def test_golden_sentiment(spark):
    df = _frame(spark, ["terrible products, bad shipping but great prices", "I love it, the best", "ok"])
    got = {r.raw_id: r.sentiment_score for r in P.clean_text_only(df).collect()}
    s = -2.1 - 2.5 + 3.1
    assert got[0] == pytest.approx(round(s / (s * s + 15) ** 0.5, 4))
    s = 3.2 + 3.2
    assert got[1] == pytest.approx(round(s / (s * s + 15) ** 0.5, 4))
    assert got[2] == 0.0


def test_vader_heuristics_by_hand(spark):
    """'app really good never great': booster before 'good', negator before 'great', and
    the damped booster three tokens back (its sign follows the now negative valence)."""
    df = _frame(spark, ["This app is really good but never great", "least good", "good"])
    got = {r.raw_id: r.sentiment_score
           for r in P.clean_text_only(df, P.TextResources(mode="vader")).collect()}
    good = 1.9 + 0.293
    great = 3.1 * -0.74 - 0.293 * 0.9
    s = good + great
    assert got[0] == pytest.approx(round(s / (s * s + 15) ** 0.5, 4))
    s = 1.9 * -0.74
    assert got[1] == pytest.approx(round(s / (s * s + 15) ** 0.5, 4))
    s = 1.9
    assert got[2] == pytest.approx(round(s / (s * s + 15) ** 0.5, 4))


def test_html_fixed_values(spark):
    rows = {"<b>love</b> it &amp; more": "love it & more", "a<br>b": "ab", "<script>var a=1;</script>hi": "hi", "<!-- c -->hi": "hi",
            "<p title='a>b'>x</p>": "x", '<a href="x>y" >z</a>': "z", "2 &lt; 3 &#233;t&eacute; &#x1f600;": "2 < 3 \u00e9t\u00e9 \U0001f600",
            "&middot;&copy;don&rsquo;t": "\u00b7\u00a9don\u2019t", "&amp;lt; &nosuch; & &#0; a&b": "&lt; &nosuch; & \ufffd a&b",
            "&copy 2024 &notit; &notin; &amp &ltb&gt": "\u00a9 2024 \u00acit; \u2209 & <b>", "&#65&#x42;&#x110000;&#128;&#99999999999;": "AB\ufffd\u20ac\ufffd",
            "&am<b></b>p; &#<i>65;": "&amp; &#65;", "&ngt; &nvlt; &fjlig;": "\u226f <\u20d2 fj", "&#1;x&#xb;&#13;": "x\r"}
    got = _frame(spark, list(rows)).select("raw_id", TF.strip_html(F.col("review_text")).alias("t")).collect()
    assert [r.t for r in sorted(got, key=lambda r: r.raw_id)] == list(rows.values())


def test_html_agrees_with_the_parser_on_all_pages(spark):
    """Same words as the standard library's parser on every page."""
    from html_exact import html_to_text

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = pages.select(F.lower("html").alias("h"), TF.strip_html(F.lower("html")).alias("t")).collect()
    differ = [r for r in got if html_to_text(r.h).split() != r.t.split()]
    assert not differ, (len(differ), differ[0].t[:300], html_to_text(differ[0].h)[:300])


def test_contractions(spark):
    got = _frame(spark, ["that's great, let's go, I'd buy", "ain't bad", "y'all gonna love it", "don't you'll dog's"]) \
        .select("raw_id", TF.expand_contractions(F.lower("review_text")).alias("t")).collect()
    assert [r.t for r in sorted(got, key=lambda r: r.raw_id)] == [
        "that is great, let us go, i would buy", "are not bad", "you all going to love it", "do not you will dog's"]


def test_lemmas_do_not_depend_on_the_batch(spark):
    texts = ["broken boxes", "broken boxes and one box", "sad news", "sad news of a new app"]
    together = {r.raw_id: r.cleaned_text for r in P.clean_text_only(_frame(spark, texts)).collect()}
    alone = {i: P.clean_text_only(_frame(spark, [t])).collect()[0].cleaned_text for i, t in enumerate(texts)}
    assert together == alone and together[0] == "broken box" and together[2] == "sad news"


def test_negation_is_the_default(spark):
    row = P.clean_text_only(_frame(spark, ["never great"])).collect()[0]
    assert row.sentiment_score == pytest.approx(-0.5096)


def test_html_agrees_with_the_parser_on_generated_pages(spark):
    """Character for character, on 2,000 pages of tags, comments, scripts and references of every kind."""
    import random
    from html.entities import html5

    from html_exact import html_to_text

    rng = random.Random(9)
    names = sorted({n.lower() for n in html5})
    legacy = sorted(n for n in html5 if not n.endswith(";") and n == n.lower())

    def piece():
        kind = rng.randrange(14)
        if kind == 0:
            return "&" + rng.choice(names)
        if kind == 1:
            return "&" + rng.choice(legacy) + rng.choice(["", ";", "x", "=1", " ", "it;", "9"])
        if kind == 2:
            return f"&#{rng.choice([0, 9, 13, 38, 60, 65, 128, 129, 150, 159, 160, 233, 8217, 55296, 65535, 128512, 1114111, 1114112, 10 ** 12])}" + rng.choice(["", ";", "x", " "])
        if kind == 3:
            return f"&#x{rng.choice([0, 11, 26, 60, 130, 160, 233, 0xD800, 0xFDD0, 0x1F600, 0x10FFFF, 0x110000]):x}" + rng.choice(["", ";", "g", " "])
        if kind == 4:
            return rng.choice(["<b>", "</b>", "<br/>", "<p class='a>b'>", '<a href="x&amp;y">', "</p >", "<!-- c &amp; -->"])
        if kind == 5:
            return "<script>var a = 1;</script>"
        if kind == 6:
            return rng.choice(["&", "& ", "&;", "&&", "&#;", "&#x;", "& amp;", "a&b", "&am<i></i>p;"])
        return rng.choice(["word", " ", "2 > 1", "x;", "\u00e9t\u00e9", "; ", "100%"])

    pages = ["".join(piece() for _ in range(rng.randint(1, 25))) + " end" for _ in range(2000)]
    got = _frame(spark, pages).select("raw_id", TF.strip_html(F.col("review_text")).alias("t")).collect()
    differ = [(pages[r.raw_id], r.t, html_to_text(pages[r.raw_id])) for r in got if r.t != html_to_text(pages[r.raw_id])]
    assert not differ, (len(differ), differ[:3])


def test_words_in_one_pass(spark):
    """Every rule, alone and as a run of suffixes, gives the tokens of the rule-by-rule chain; so do words in quotes and beside signs."""
    rules = [p.removeprefix("=") for _, p, _ in R.CONTRACTIONS]
    texts = [f"x {w} y" for w in rules if w[0] != "n"] + [f"they{w}, dog{w}." for w in rules if w[0] == "'" and w != "'cause"]
    texts += ["don't you'll dog's", "he'd've", "shouldn't've", "y'all're", "(don't) won't/can't", "she's 'tis", "we’re isn’t", "wanna! gonnax"]
    df = _frame(spark, texts)
    rows = df.select("review_text", TF.tokenize(TF.keep_letters(TF.expand_contractions(F.col("review_text")))).alias("a"),
                     TF.tokenize(TF.keep_letters(TF.expand_words(F.col("review_text")))).alias("b")).collect()
    assert [r.review_text for r in rows if r.a != r.b] == []


def _compound(s):
    return pytest.approx(round(s / (s * s + 15) ** 0.5, 4))


def test_phrases_by_hand(spark):
    """Phrases take the place of a word's valence from the fourth word on, before 'least' and after boosters."""
    texts = ["phone truly looks bad ass", "bad ass phone", "screen yeah right great", "aaa bbb ccc really great", "good bbb ccc bad ass",
             "aaa bbb kiss of death great", "aaa bbb ccc least good"]
    phrases = spark.createDataFrame([("bad ass", 1.5), ("yeah right", -2.0), ("kiss death great", 0.5)], "phrase string, valence double")
    got = {r.raw_id: r.sentiment_score for r in P.clean_text_only(_frame(spark, texts), P.TextResources(phrases=phrases)).collect()}
    assert got[0] == _compound(1.5)                       # the phrase begins with the scored word
    assert got[1] == _compound(-2.5)                      # too early in the text
    assert got[2] == _compound(-2.0)                      # the phrase stands before the scored word
    assert got[3] == _compound(3.1 + 0.293)               # no phrase
    assert got[4] == _compound(1.9 - 2.5)                 # word i - 3 is in the lexicon: phrases are not looked up
    assert got[5] == _compound(0.5)                       # three words
    assert got[6] == _compound(1.9 * -0.74)


def test_full_size_tables(spark, tmp_path):
    """Loaders read the public files' formats; a lexicon and dictionary of their size give the right rows and small plans."""
    from sentimart.sources import lexicons as L

    def name(i):
        return "q" + "".join(chr(97 + (i // 26 ** k) % 26) for k in range(4))

    (tmp_path / "lex.txt").write_text("".join(f"{name(i)}\t{(i % 9) - 4.0}\t0.5\t[1, 2]\n" for i in range(7500)) + "great\t3.1\t0.7\t[3]\n")
    (tmp_path / "noun.exc").write_text("".join(f"irr{name(i)} {name(i)}\n" for i in range(2000)) + "children child\n")
    (tmp_path / "index.noun").write_text("  1 licence line\n" + "".join(f"{name(i)} n 1 0 1 0 00001740\n" for i in range(90_000)) + "two_words n 1 0\n")
    (tmp_path / "phrases.tsv").write_text("bad ass\t1.5\nkiss of death\t-1.5\n")
    res = P.TextResources(lexicon=L.vader_lexicon(spark, str(tmp_path / "lex.txt")), lemmas=L.exceptions(spark, str(tmp_path / "noun.exc")),
                          dictionary=L.dictionary(spark, str(tmp_path / "index.noun")), phrases=L.phrases(spark, str(tmp_path / "phrases.tsv"))).prepared(spark)
    assert res.bounded and res.words.count() > 90_000
    df = _frame(spark, [f"great {name(7)}s irr{name(8)}", "children"])
    s = 3.1 + 3.0 + 4.0
    for own in (res, replace(res, bounded=False)):  # broadcast, and left to the optimizer
        got = {r.raw_id: (r.cleaned_text, r.sentiment_score) for r in P.clean_text_only(df, own).collect()}
        assert got == {0: (f"great {name(7)} {name(8)}", _compound(s)), 1: ("child", 0.0)}
    seeds = P.clean_text_only(df)._jdf.queryExecution().analyzed().toString()
    loaded = P.clean_text_only(df, res)._jdf.queryExecution().analyzed().toString()
    assert len(loaded) <= len(seeds)


def test_lemmas_of_a_million_tokens(spark):
    """One text of a million tokens, half of them changed: every occurrence carries its lemma, in order."""
    words = ["boxes", "glass", "children", "qqq"]
    row = P.clean_text_only(_frame(spark, [" ".join(words * 250_000)])).select(
        "word_count", F.md5("cleaned_text").alias("m")).first()
    import hashlib
    assert (row.word_count, row.m) == (1_000_000, hashlib.md5(" ".join(["box", "glass", "child", "qqq"] * 250_000).encode()).hexdigest())


def test_character_classes_are_looked_up(spark):
    """No class on the way of every character is a chain of ranges; what the classes match stays that of the SQL's patterns."""
    import re
    for pattern in (TF.DROPPED, TF.EMOJI_RUN, TF.BLANK_RUN):
        assert len(re.findall(r"\\x\{?[0-9A-F]+\}?-\\x", pattern.split("&&")[0])) <= 1
    every = "".join("a" + chr(i) for i in [*range(0xD800), *range(0xE000, 0xFFFF), *range(0x1F300, 0x1F700)])
    df = spark.createDataFrame([(every,)], "t string")
    for old, new, put in ((TF.NON_LETTER, TF.DROPPED, ""), (TF.EMOJI, TF.EMOJI_RUN, ""), (TF.BLANKS, TF.BLANK_RUN, "|")):
        row = df.select(F.regexp_replace("t", old, put).alias("a"), F.regexp_replace("t", new, put).alias("b")).first()
        assert row.a == row.b


def test_contraction_rules_go_over_few_pieces(spark):
    """The rules stand under a test for an apostrophe or a whole word, and give what they give over the whole text."""
    rows = [("it's  gonna rain ,won’t it\tshe'd've gone ",), ("xgonna gonnax 'cause y'all's o'clock",), ("no rule applies",), ("",), (None,)]
    df = spark.createDataFrame(rows, "t string")
    whole = F.col("t")
    for _, pattern, replacement in sorted(R.CONTRACTIONS):
        whole = F.regexp_replace(whole, TF.contraction_regex(pattern), replacement)
    got = df.select(whole.alias("a"), TF.expand_contractions(F.col("t")).alias("b"))
    assert [r.a for r in got.collect()] == [r.b for r in got.collect()]
    assert "contains" in got.select("b")._jdf.queryExecution().optimizedPlan().toString().lower()


def test_word_counts_of_odd_documents(spark):
    """Documents without a word, without a scored word, with scored words only, and two rows of one id."""
    texts = [None, "", "the", "qqq box", "great", "very great least good", "bad ass qqq"]
    rows = list(enumerate(texts)) + [(9, "great qqq"), (9, "box"), (None, "good box")]
    df = spark.createDataFrame(rows, "raw_id long, review_text string")
    for mode in ("vader", "lexicon"):
        out = P.clean_text_only(df, P.TextResources(mode=mode)).collect()
        assert sorted((-1 if r.raw_id is None else r.raw_id, r.word_count) for r in out) == [
            (-1, 0), (0, 0), (1, 0), (2, 0), (3, 2), (4, 1), (5, 3), (6, 3), (9, 3), (9, 3)]
        for r in out:
            assert (r.sentiment_score == 0.0) == (r.raw_id in (None, 0, 1, 2, 3))
            assert r.raw_id == 9 or r.word_count == len(r.cleaned_text.split())


def test_tokens_are_cut_at_every_blank(spark):
    """Every blank of Python's ``str.split``, alone, in runs, at the edges and mixed; U+3000 goes with the emoji."""
    blanks = [c for c in map(chr, range(0x3000)) if c.isspace()]
    texts = [f"{c}aa{c}{c}bb {c}\n{c}cc{c}" for c in blanks] + ["".join(f"w{c}" for c in blanks), "aa\n\nbb  cc\n", "\n", " ", "aa　bb"]
    df = _frame(spark, texts)
    got = {r.raw_id: r.t for r in TF.add_clean_tokens(df, "review_text", "t", ()).collect()}
    assert [got[i] for i in range(len(texts))] == [t.replace("　", "").split() for t in texts]


def test_ampersands_that_begin_no_reference(spark):
    texts = ["a&&&amp;b", "&", "&&", "x& y&.&amp", "&é&#;&#x;&;", "&AMP;&Lt;&#65;&#x42;&copyx", "tion&&&\nof&%"]
    want = ["a&&&b", "&", "&&", "x& y&.&", "&é&#;&#x;&;", "&<AB©x", "tion&&&\nof&%"]
    df = _frame(spark, texts)
    got = {r.raw_id: r.t for r in df.select("raw_id", TF.strip_html(TF.lower_text(F.col("review_text"))).alias("t")).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_ngram_tokens_of_any_text(spark):
    """Plain texts take a shorter way with the tokens that every text gets."""
    from sentimart.functions import text as TF

    texts = [None, "", " ", "The cat  sat", "cannot gimme x", "i cannot, gimme 2 apples", "tab\tand\u00a0blank", "The CANNOT of it", "caf\u00e9 is open", "line\nbreak", "wanna" * 3]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    words = list(R.STOPWORDS)
    slow = F.filter(TF.tokenize(F.lower("t")), lambda t: t.rlike("^[A-Za-z]+$") & ~t.isin(words))
    got = df.select("i", TF.ngram_tokens(F.col("t")).alias("a"), slow.alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got]
