"""op3 on held-out labels and disguised words; the pipeline against brute force, stage by stage."""

import hashlib
import math
import random
import zlib

import duckdb
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import sentencepiece

import corpus_pipeline
from odd_rows import ODD_ROWS, docs_of, llm_spark  # noqa: F401  fixtures
from sentimart.llm import pii, toxicity
from sentimart.llm.queries import OP4_SQL, QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(llm_spark):
    return toxicity.fit(llm_spark.read.parquet(f"{FOLDER}/documents.parquet"), llm_spark.read.parquet(f"{FOLDER}/labels.parquet"))


def test_held_out_labels(llm_spark):
    """Labels of the held-out rows, which the model never saw."""
    found = QUERIES["op3_toxicity"](llm_spark, "/root/testdata/sf0.1").toPandas()
    labels = pd.read_parquet("/root/testdata/sf0.1/labels.parquet")
    assert len(found) == 10_000 and found.score.between(0, 1).all() and ((found.score >= 0.5) == (found.predicted == 1)).all()
    assert (found.held_out == [zlib.crc32(str(d).encode()) % 5 == 0 for d in found.doc_id]).all()
    test = found[found.held_out].merge(labels, on="doc_id")
    assert test[test.toxic == 1].predicted.mean() > 0.85 and test[test.toxic == 0].predicted.mean() < 0.01


@pytest.mark.parametrize("hidden, word", [("1d10t", "idiot"), ("m o r o n", "moron"), ("m.o.r.0.n", "moron"), ("stuuuupid", "stupid"), ("p4th3t1c", "pathetic"), ("$cum", "scum"), ("tr@sh", "trash"), ("l0s3r", "loser"), ("d1sgust1ng", "disgusting")])
def test_restoring(model, hidden, word):
    assert word in model.chars.restore(f"and the {hidden} of it")
    plain, disguised = model.score(pa.array([f"an {w} of the on" for w in (word, hidden)]))
    assert disguised == pytest.approx(plain)


@pytest.mark.parametrize("text, word", [("y o u i d i o t", "idiot"), ("what a i d i o t", "idiot"), ("stu" + "u" * 45 + "pid", "stupid"), ("x " + "q w " * 60 + "m o r o n", "moron"), ("1d" + "1" * 60 + "0t", "idiot")])
def test_gaps_and_long_stretches(model, text, word):
    """Letters set apart hold a gap or none at each separator; stretches of any length are decoded whole."""
    found = model.strengths(pa.array([f"an {t} of it" for t in (word, text)]))[0]
    assert found[1] == pytest.approx(found[0]) and found[0] > 0


def test_letters_set_apart_of_plain_words_stay_clean(model):
    assert (model.score(pa.array(["t h e o n t h e i n w a s w i t h", "a b c d e f g", "s p a c e d t i t l e o f t h e b o o k"])) < 0.5).all()


def viterbi(model, stretch):
    """The least cost over all readings, by plain recursion over the channel's choices."""
    best = None

    def go(i, previous, a, b, cost, out):
        nonlocal best
        if best is not None and cost > best[0] + 1e-9:
            return
        if i == len(stretch):
            best = min(best or (math.inf, ""), (cost + model.cost[a][b][0], out))
            return
        sign = stretch[i]
        ways = [(sign, toxicity.SELF)] if "a" <= sign <= "z" else [(c, toxicity.WILD if sign == "*" else toxicity.IMITATION) for c in toxicity.IMITATED.get(sign, "")]
        for c, w in ways:
            go(i + 1, sign, b, ord(c) - 96, cost + w + model.cost[a][b][ord(c) - 96], out + c)
        if sign == previous and (a, b) != (0, 0) or not ways:
            go(i + 1, sign, a, b, cost + toxicity.REPEAT, out)

    go(0, "", 0, 0, 0.0, "")
    return best[1]


def test_decoding_against_all_readings(model):
    rng = random.Random(8)
    for _ in range(300):
        stretch = "x" + "".join(rng.choice("abeo01358@$+*lst") for _ in range(rng.randint(1, 8))) + "y"
        assert model.chars.decode(stretch) == viterbi(model.chars, stretch), stretch


@pytest.mark.parametrize("hidden, word", [("idio7", "idiot"), ("1di0+", "idiot"), ("id!0+", "idiot"), ("m0r0n", "moron"), ("s(um", "scum"), ("idiot!", "idiot"), ("(idiot", "idiot")])
def test_gate_lets_disguises_through(model, hidden, word):
    plain, disguised = toxicity._restored(pa.array([f"an {word} of it", f"an {hidden} of it"]), model.chars).to_pylist()
    assert plain.split() == [x.strip("!(") for x in disguised.split()]


def test_gate_is_no_narrower_than_the_decoder():
    rng = random.Random(3)
    for letters in ("ab3$! .", "aA(*- x0", "İ\u212aſk. 1", "aaAbé+ _"):
        texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 12))) for _ in range(20_000)]
        gate = pc.match_substring_regex(pa.array(texts), toxicity._SUSPICIOUS).to_pylist()
        assert not [t for t, open_ in zip(texts, gate) if not open_ and toxicity._STRETCH.search(t.lower())]


def test_ordinary_text_is_left_alone(model):
    for text in ("the onthe in was with that erstion", "a as i in on", "call 555 now"):
        assert model.chars.restore(text) == text


def test_odd_rows(docs_of, llm_spark, model):
    found = toxicity.score(docs_of(ODD_ROWS), model).collect()
    assert len(found) == len(ODD_ROWS) and len({r.score for r in found if r.doc_id in (1, 2, 4)}) == 1
    assert toxicity.score(docs_of([]), model).count() == 0
    kept = toxicity.drop_toxic(docs_of(ODD_ROWS), model)
    assert kept.columns == docs_of([]).columns and kept.count() == len(ODD_ROWS)
    none = llm_spark.createDataFrame([], "doc_id long, toxic int")
    blank = toxicity.fit(docs_of(ODD_ROWS), none)
    assert {round(r.score, 6) for r in toxicity.score(docs_of(ODD_ROWS), blank).collect()} == {0.0}


def near_copies(rows):
    """Ids of all but the smallest id of each class of texts of Jaccard 0.8 over 5 words."""
    sets = []
    for _, text in rows:
        words = (text or "").lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set())
    holders: dict = {}
    for i, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(i)
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for own in holders.values():
        for i, j in zip(own, own[1:]):
            for k in own[: own.index(j)]:
                if find(k) != find(j) and 100 * len(sets[k] & sets[j]) >= 80 * len(sets[k] | sets[j]):
                    parent[find(j)] = find(k)
    least: dict = {}
    for (key, _), i in zip(rows, range(len(rows))):
        least[find(i)] = min(key, least.get(find(i), key))
    return {key for (key, _), i in zip(rows, range(len(rows))) if sets[i] and key != least[find(i)]}


def test_pipeline(llm_spark, model):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(llm_spark, FOLDER).collect()}
    documents = pd.read_parquet(f"{FOLDER}/documents.parquet")
    scores = model.score(pa.array(documents.text, pa.string()))
    rows = [(k, t) for k, t, s in zip(documents.doc_id, documents.text, scores) if s < 0.5]
    copies = near_copies(rows)
    rows = [(k, t) for k, t in rows if k not in copies]
    db = duckdb.connect()
    db.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    db.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{FOLDER}/benchmark.parquet'")
    leaked = {r[0] for r in db.execute(f"SELECT doc_id FROM ({OP4_SQL}) WHERE contaminated").fetchall()}
    rows = [(k, t) for k, t in rows if k not in leaked]
    encoder = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {}
    for key, text in rows:
        ids = encoder.encode(pii.masked(text, pii.spans_of(text))) + [encoder.eos_id()]
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want[key] = (len(ids), sha(" ".join(map(str, ids))), sha(encoder.decode(ids)))
    assert got == want and len(copies) > 20 and len(leaked) > 5


def test_stages_keep_columns(docs_of, llm_spark):
    rows = docs_of([*ODD_ROWS, (8, "a@b.co"), (9, "word")]).selectExpr("doc_id", "text", "key as lang", "n as source", "cast(length(text) as bigint) as n_chars")
    for frame in (rows, rows.limit(0)):
        docs = frame
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(llm_spark, docs, "/root/testdata/sf0.001")
            assert docs.columns == frame.columns, name
        assert (docs.count() == 0) == (frame is not rows)
        assert corpus_pipeline.STAGES[-1][1](llm_spark, docs, FOLDER).count() == docs.count()
