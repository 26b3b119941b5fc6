"""op13 against pairwise comparison, its star components and the hash of byte ranges."""

import random

import numpy as np
import pytest

from sentimart.llm import hotkeys, minhash_dedup, stars, textblocks

from odd_rows import ODD_ROWS, docs_of, llm_spark  # noqa: F401  fixtures
from test_ngram_join import brute


def near_rows(seed):
    rng, rows = random.Random(seed), []
    for size in (3, 9, 40, 80, 120):
        base = [rng.choice("abcdefghij") + str(rng.randrange(50)) for _ in range(size)]
        for _ in range(25):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 4])):
                own[rng.randrange(len(own))] = rng.choice("xyz") + str(rng.randrange(9))
            rows.append((len(rows) + 100, " ".join(own)))
    # A chain: each text is near the next one only, so the class is found link by link.
    words = [f"w{i}" for i in range(100)]
    for i in range(30):
        rows.append((1000 - i, " ".join(words)))
        words = words[5:] + [f"v{i}-{j}" for j in range(5)]
    return rows


@pytest.mark.parametrize("block_bytes, width", [(8 << 20, 4), (6000, 5)])
def test_classes(docs_of, monkeypatch, block_bytes, width):
    monkeypatch.setattr(minhash_dedup, "BLOCK_BYTES", block_bytes)
    rows = [*near_rows(7), *ODD_ROWS[:8], (30, "two  words"), (31, "TWO\nwords"), (None, "one of a kind of text"), (None, "one of a kind of text")]
    got = minhash_dedup.near_duplicates(docs_of(rows), width, 80).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, width, 80)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_empty_table_and_names(docs_of):
    assert minhash_dedup.near_duplicates(docs_of([])).count() == 0
    assert minhash_dedup.near_duplicates(docs_of(ODD_ROWS)).columns == ["doc_id", "n_shingles", "component_id", "kept"]


def test_open_values_need_no_hub(llm_spark, monkeypatch):
    """Nodes that link with each other but not with the smallest node of their band value are found by the blocks."""
    rng = np.random.default_rng(3)
    shared = rng.integers(0, 1 << 62, 60, dtype=np.uint64)
    hub = np.sort(np.concatenate([shared, rng.integers(0, 1 << 62, 60, dtype=np.uint64)]))
    twin = np.concatenate([shared, rng.integers(0, 1 << 62, 60, dtype=np.uint64)])
    sets = [hub, np.sort(twin), np.sort(np.append(twin[:-1], np.uint64(5)))]
    signs = minhash_dedup.signatures(np.concatenate(sets), np.array([0, 120, 240, 360]))
    values = minhash_dedup.band_values(signs)
    spark = llm_spark
    nodes = spark.createDataFrame([(i, len(s), signs[i].tobytes()) for i, s in enumerate(sets)], "node long, n long, sign binary")
    shared_rows = [(int(values[i, b].view(np.int64)), b, i, 0) for i in range(3) for b in range(minhash_dedup.BANDS)]
    none = spark.createDataFrame([], "node long, root long")
    opened = minhash_dedup._open_groups(spark.createDataFrame(shared_rows, "value long, band int, node long, hub long"), nodes, none)
    marked = minhash_dedup._plausible(opened.join(nodes.select("node", "sign"), "node")).cache()
    assert {r.node for r in marked.collect()} == {1, 2}
    members = spark.createDataFrame([(i, s.tobytes()) for i, s in enumerate(sets)], "node long, members binary")
    found = minhash_dedup._confirm_groups(marked.join(members, "node"), 80).collect()
    assert {(min(r), max(r)) for r in found} == {(1, 2)}


def test_stars(llm_spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 130)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.root for r in stars.components(llm_spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert stars.components(llm_spark.createDataFrame([], "a long, b long")).count() == 0


def test_join_heavy(llm_spark):
    rows = llm_spark.createDataFrame([(k, i) for i, k in enumerate([1] * 50 + [2, 3, None])], "k long, i long")
    table = llm_spark.createDataFrame([(1, 50, "a"), (2, 1, "b"), (3, 1, "c")], "k long, n long, v string")
    for heavy in (10, 1):
        hotkeys.HEAVY, before = heavy, hotkeys.HEAVY
        try:
            got = hotkeys.join_heavy(rows, table, "k", "n", 53).collect()
        finally:
            hotkeys.HEAVY = before
        assert sorted((r.i, r.v) for r in got if r.v) == [(i, "a") for i in range(50)] + [(50, "b"), (51, "c")] and len(got) == 53


def test_range_hash_of_built_pairs():
    """Words that collide in every polynomial hash modulo a power of two do not collide here; pieces of long ranges count."""
    one = bytes(97 + bin(i).count("1") % 2 for i in range(2048))
    two = bytes(98 - bin(i).count("1") % 2 for i in range(2048))
    raw = np.frombuffer(one + two + one, np.uint8)
    h = textblocks.TextHash(raw)(np.array([0, 2048, 4096]), np.array([2048, 4096, 6144]))
    assert h[0] == h[2] != h[1]
    p, base = (1 << 61) - 1, textblocks._BASE61
    whole = sum((b + 1) * pow(base, i, p) for i, b in enumerate(one)) % p
    mixed = textblocks.mix(np.array([whole + 2048 * 0x9E3779B97F4A7C15 & ((1 << 64) - 1)], np.uint64))
    assert h[0] == mixed[0]
    textblocks._PIECE, before = 100, textblocks._PIECE
    try:
        cut = textblocks.TextHash(raw)(np.array([0, 2048, 4096]), np.array([2048, 4096, 6144]))
    finally:
        textblocks._PIECE = before
    assert cut[0] == cut[2] != cut[1]
