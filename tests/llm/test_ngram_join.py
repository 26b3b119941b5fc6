"""op1 against pairwise comparison."""

import random

import numpy as np
import pytest

from sentimart.llm import ngram_join

from odd_rows import ODD_ROWS, docs_of, llm_spark  # noqa: F401  fixtures


def classes(sets, percent):
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(sets))]


def test_trie_finds_the_classes():
    rng = random.Random(2)
    for _ in range(500):
        sets = []
        for _ in range(rng.randint(1, 4)):
            base = rng.sample(range(60), rng.randint(1, 40))
            for _ in range(rng.randint(1, 6)):
                own = (set(base) - set(rng.choices(base, k=rng.randint(0, 4)))) | set(rng.choices(range(90), k=rng.randint(0, 3)))
                sets.append(own or {1})
        percent = rng.choice([60, 80, 90])
        got = ngram_join.link_sets([np.array(sorted(s), np.uint64) for s in sets], list(range(len(sets))), percent)
        want = classes(sets, percent)
        assert [got.index(x) for x in got] == [want.index(x) for x in want]


def brute(rows, width, percent):
    sets = []
    for _, text in rows:
        words = (text or "").lower().split()
        sets.append({tuple(words[i : i + width]) for i in range(max(len(words) - width + 1, 1))} if words else set())
    found = classes(sets, percent)
    out = []
    for (key, _), own, c in zip(rows, sets, found):
        keys = [k for (k, _), d in zip(rows, found) if d == c and k is not None]
        out.append((key, len(own), min(keys) if keys else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes, width, percent", [(8 << 20, 3, 90), (1500, 5, 80)])
def test_classes(docs_of, monkeypatch, block_bytes, width, percent):
    monkeypatch.setattr(ngram_join, "BLOCK_BYTES", block_bytes)
    rng, rows = random.Random(4), []
    for _ in range(4):
        base = [rng.choice("abcdefghij") + str(rng.randrange(50)) for _ in range(rng.choice([3, 8, 40, 80]))]
        for _ in range(20):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                own[rng.randrange(len(own))] = rng.choice("xyz") + str(rng.randrange(9))
            rows.append((len(rows) + 100, " ".join(own)))
    rows += [*ODD_ROWS[:8], (30, "two  words"), (31, "TWO\nwords"), (None, "one of a kind of text"), (None, "one of a kind of text")]
    got = ngram_join.jaccard_classes(docs_of(rows), width, percent).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, width, percent)


def test_keep_one(docs_of):
    rows = [(3, "a b c d e f"), (2, "A b c d e f"), (2, "A b c d e f"), (None, "a b c d e f"), (5, ""), (5, None), (9, "quite another text than those")]
    kept = ngram_join.keep_one(docs_of(rows), 5, 80)
    assert kept.columns == docs_of(rows).columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(2, "A b c d e f"), (5, ""), (5, None), (9, "quite another text than those")], key=str)
    assert ngram_join.jaccard_classes(docs_of([])).count() == 0


def near_copies(rng, n, words=120):
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(2):
            own[rng.randrange(words)] = f"x{rng.randrange(900)}"
        out.append(" ".join(own))
    return out


def test_a_group_of_near_copies_has_about_one_edge_a_set(docs_of):
    rng = random.Random(5)
    texts = [*near_copies(rng, 150), *near_copies(rng, 150)]
    rows = docs_of(list(enumerate(texts))).selectExpr("doc_id as row", "doc_id as key", "text")
    signed = ngram_join._signed(rows, 3, 90, 0)
    edges = [tuple(r) for r in ngram_join.star_edges(signed).collect()]
    assert len(edges) < 1.5 * len(texts)
    by_value = {}
    for r in signed.distinct().collect():
        by_value.setdefault(r.value, []).append(r.set_id)
    every = [(s[0], x) for s in by_value.values() for x in s[1:]]
    ids = sorted({x for e in every for x in e})

    def parts(pairs):
        root = {x: x for x in ids}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
        return [find(x) for x in ids]

    assert parts(edges) == parts(every)


def test_one_text_of_each_set_travels(docs_of, monkeypatch):
    """Sets are larger than their texts and do not compress, so none is stored; repeated keys and rows bring no further text."""
    tables, stored = {}, ngram_join.stored
    monkeypatch.setattr(ngram_join, "stored", lambda df, name: tables.setdefault(name, stored(df, name)) if name == "texts" else stored(df, name))
    texts = near_copies(random.Random(6), 20)
    rows = [*enumerate(texts), *enumerate(texts), (None, texts[0]), (3, texts[4]), (99, "all alone")]
    got = ngram_join.jaccard_classes(docs_of(rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, 3, 90)
    assert sorted(bytes(r.text).decode() for r in tables["texts"].collect()) == sorted(set(texts))


def test_stored_tables_leave_no_setting(llm_spark):
    from sentimart.llm import scratch

    before = llm_spark.conf.get(scratch.CLEAN_UP, "false")
    table = scratch.stored(llm_spark.range(100).repartition(4, "id"), "plain")
    assert table.count() == 100 and llm_spark.conf.get(scratch.CLEAN_UP, "false") == before


def test_strong_parts_of_linked_sets_meet():
    """Whatever shingles count as common, sets that link share a signature."""
    rng = random.Random(8)
    for _ in range(300):
        base = rng.sample(range(1, 5000), rng.randint(1, 120))
        percent = rng.choice([60, 80, 90])
        own = [set(base), set(base)]
        while 100 * len(own[0] & own[1]) >= percent * len(own[0] | own[1]):
            last = [set(own[0]), set(own[1])]
            if rng.random() < 0.5 and len(own[1]) > 1:
                own[1].discard(rng.choice(sorted(own[1])))
            else:
                own[rng.randrange(2)].add(rng.randrange(5000, 1 << 40))
        arrays = [ngram_join.mix(np.array(sorted(x), np.uint64)) for x in last]
        common = np.sort(np.array(rng.sample(arrays[0].tolist(), rng.randint(0, len(arrays[0]))), np.uint64))
        owner, sign = ngram_join.signatures(np.concatenate(arrays), np.cumsum([0, *map(len, arrays)]), percent, common)
        assert set(sign[owner == 0].tolist()) & set(sign[owner == 1].tolist())


def test_a_common_line_connects_few_unlike_texts(docs_of):
    rng = random.Random(9)
    line = [f"line{i}" for i in range(40)]
    texts = [" ".join([*(f"t{i}w{j}" for j in range(90 + rng.randrange(4))), *line]) for i in range(400)]
    rows = docs_of(list(enumerate(texts))).selectExpr("doc_id as row", "doc_id as key", "text")
    common = ngram_join.common_shingles(rows, 5, len(texts))
    assert len(common) == 36
    plain, tied = (ngram_join.star_edges(ngram_join._signed(rows, 5, 80, 0, c)).count() for c in (common[:0], common))
    assert tied < plain / 2


def test_parities_part_only_sets_that_are_not_linked():
    rng = random.Random(10)
    for _ in range(300):
        base = rng.sample(range(1 << 40), rng.randint(1, 700))
        percent = rng.choice([60, 80, 90])
        sets = [base]
        while len(sets) < 6:  # each differs from the one before as far as linked sets may, or is another set altogether
            last = list(sets[-1])
            for _ in range(rng.choice([0, 1, (100 - percent) * len(last) // 200, len(last)])):
                last[rng.randrange(len(last))] = rng.randrange(1 << 40)
            sets.append(last)
        arrays = [np.sort(ngram_join.mix(np.array(sorted(set(x)), np.uint64))) for x in sets]
        sizes = np.array([len(x) for x in arrays])
        bits = ngram_join.parities(np.concatenate(arrays), np.cumsum([0, *sizes]))
        groups = [ngram_join.star_groups(bits, sizes, percent), ngram_join.star_groups(bits, sizes, percent, 3)]
        for i in range(6):
            for j in range(i):
                overlap = len(set(arrays[i].tolist()) & set(arrays[j].tolist()))
                if 100 * overlap >= percent * (sizes[i] + sizes[j] - overlap):
                    assert not ngram_join.unlike_pair(bits[i], sizes[i], bits[j], sizes[j], percent)
                    assert all(g[i] == g[j] for g in groups)


@pytest.mark.parametrize("star,compared", [(20_000, 4_000_000), (20_000, 3), (4, 4_000_000)])
def test_passages_shared_by_unlike_texts_tie_no_group(docs_of, monkeypatch, star, compared):
    """Each text shares a third of its words with the next one; near copies of some must be found whatever is compared."""
    rng = random.Random(11)
    passages = [" ".join(f"p{i}w{j}" for j in range(60)) for i in range(61)]
    texts = [f"{passages[i]} {' '.join(f't{i}w{j}' for j in range(60))} {passages[i + 1]}" for i in range(60)]
    copies = [t.replace(f"t{i}w{rng.randrange(60)} ", "other ") for i, t in enumerate(texts[:10])]
    rows = list(enumerate([*texts, *copies]))
    want = brute(rows, 5, 80)
    monkeypatch.setattr(ngram_join, "STAR", star)
    monkeypatch.setattr(ngram_join, "COMPARED", compared)
    placed, stored = {}, ngram_join.stored
    monkeypatch.setattr(ngram_join, "stored", lambda df, name: placed.setdefault(name, stored(df, name)) if name == "placed" else stored(df, name))
    got = ngram_join.jaccard_classes(docs_of(rows), 5, 80).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == want
    if star == 20_000 and compared > 3:
        assert placed["placed"].count() == 20
