"""op8 against a table of all substrings."""

import random
import tracemalloc

import numpy as np

from sentimart.llm import suffix_dedup

from odd_rows import ODD_ROWS, docs_of, llm_spark  # noqa: F401  fixtures


def test_two_stage_order():
    rng = np.random.default_rng(0)
    for t in range(200):
        length = 5
        strings = [bytes(rng.integers(1, 4 if t % 2 else 8, rng.integers(length, 12)).astype(np.uint8)) for _ in range(rng.integers(1, 12))]
        text = np.frombuffer(b"".join(s + b"\0" for s in strings) + b"\0" * length, np.uint8)
        wanted, at = np.zeros(len(text), bool), 0
        for s in strings:
            wanted[at : at + len(s) - length + 1] = True
            at += len(s) + 1
        order = suffix_dedup.two_stage_order(text, wanted, length)
        assert sorted(order) == np.flatnonzero(wanted).tolist()
        keys = [text.tobytes()[i : i + length] for i in order]
        assert keys == sorted(keys)


def brute(rows, length):
    rows = [(suffix_dedup.LAST if k is None else k, (t or "").encode(), k) for k, t in rows]
    first: dict[bytes, int] = {}
    for key, raw, _ in sorted(rows, key=lambda r: r[0]):
        for i in range(len(raw) - length + 1):
            first.setdefault(raw[i : i + length], key)
    out = []
    for key, raw, shown in rows:
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - length + 1):
            if first[raw[i : i + length]] < key:
                gone[i : i + length] = True
        edge = np.flatnonzero(np.diff(gone.astype(int), prepend=0))
        spans = tuple((int(a), int(b)) for a, b in zip(edge[::2], edge[1::2]))
        out.append((shown, len(raw), spans, bytes(c for c, x in zip(raw, gone) if not x)))
    return sorted(out, key=str)


def rows_of(frame):
    return sorted(((r.doc_id, r.n_bytes, tuple((s.start, s.end) for s in r.spans), bytes(r.kept)) for r in frame.collect()), key=str)


def test_removed_bytes(docs_of, monkeypatch):
    rng = random.Random(5)
    words = ["alpha ", "be ", "gamma", "é", "xx ", "the quick brown fox jumps over the lazy dog and runs away "]
    base = ["".join(rng.choice(words) for _ in range(60)) for _ in range(6)]
    rows = [(r, t) for r, t in ODD_ROWS if not t or len(t) < 10_000]
    for i in range(150):
        text = rng.choice(base)
        a = rng.randint(0, len(text))
        text = text[a : a + rng.randint(0, 200)] + "".join(rng.choice("abcdef ") for _ in range(rng.randint(0, 80))) + rng.choice(base)[: rng.randint(0, 300)]
        rows.append((rng.choice([None, i, i, i, i // 2]), rng.choice([text] * 9 + ["a" * rng.randint(40, 150)])))
    for length in (50, 30):
        assert rows_of(suffix_dedup.remove_repeats(docs_of(rows), length)) == brute(rows, length)
    assert suffix_dedup.remove_repeats(docs_of([])).count() == 0


def test_replies_joined_by_shuffle_and_contexts_sorted_in_turns(docs_of, monkeypatch):
    """What holds on larger tables: stored replies, many small sends and sorts, blocks over a segment."""
    for name, value in (("BROADCAST_BYTES", 0), ("SORT_BYTES", 300), ("SEND_BYTES", 200), ("SEGMENT", 1000)):
        monkeypatch.setattr(suffix_dedup, name, value)
    rng = random.Random(6)
    passages = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(50, 300))) for _ in range(12)]
    rows = [(i // 2, "".join(rng.choice("ijklmno ") for _ in range(rng.randint(0, 60))) + rng.choice(passages)[rng.randint(0, 30) :] + rng.choice(passages)) for i in range(120)]
    assert rows_of(suffix_dedup.remove_repeats(docs_of(rows))) == brute(rows, 50)


def test_memory_of_a_sort_does_not_follow_the_part(monkeypatch):
    """A part whose contexts have many repeats is sorted in turns, with the same flags."""
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 123, 62).astype(np.uint8)) for _ in range(20_000)]

    class Row:
        data, sizes, keys = b"".join(texts), np.array([len(t) for t in texts], np.int64).tobytes(), np.arange(len(texts)).tobytes()

    block = suffix_dedup._Block(Row, 50)
    anchors, _, _ = block.anchors()
    _, _, _, _, _, first, last, keys = block.contexts([(0, np.packbits(np.ones(len(anchors), bool)).tobytes(), None)], 1, 1, 50)
    sizes = last - first + 50
    data = [suffix_dedup._joined(block.raw, first, sizes).tobytes()] * 2
    twice = (np.tile(block.turns, 2), np.tile(sizes, 2), np.concatenate([keys, keys + 7]), 50)
    monkeypatch.setattr(suffix_dedup, "SORT_BYTES", 1 << 30)
    whole, most = _traced(suffix_dedup._in_turns, data, *twice)
    monkeypatch.setattr(suffix_dedup, "SORT_BYTES", 1 << 18)
    turns, least = _traced(suffix_dedup._in_turns, data, *twice)
    assert (whole == turns).all() and whole.any() and least < most / 3


def _traced(run, *args):
    tracemalloc.start()
    try:
        return run(*args), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_hot_anchors_and_small_blocks(monkeypatch):
    """The window-by-window way for hot anchors finds what the ordinary one finds."""
    rng = random.Random(1)
    passage = "".join(rng.choice("abcdefghij ") for _ in range(120))
    texts = ["".join(rng.choice("klmno ") for _ in range(rng.randint(0, 70))) + passage[rng.randint(0, 40) :] for _ in range(40)]
    raws = [t.encode() for t in texts]

    class Row:
        data, sizes, keys = b"".join(raws), np.array([len(r) for r in raws], np.int64).tobytes(), np.arange(40).tobytes()

    block = suffix_dedup._Block(Row, 50)
    anchors, several, _ = block.anchors()
    bits = np.packbits(np.ones(len(anchors), bool)).tobytes()
    found = []
    for hot in (None, bits):
        first, last, key, number, part, lead_first, lead_last, lead = block.contexts([(0, bits, hot)], 1, 1, 50)
        size = lead_last - lead_first + 50
        flags = suffix_dedup._smaller_keys(suffix_dedup._joined(block.raw, lead_first, size), size, lead, 50)
        starts = set()
        for f, la, k, n in zip(first, last, key, number):
            starts |= {int(f) + b for b in range(int(la - f) + 1) if k > lead[n] or flags[n] >> b & 1}
        found.append(starts)
    assert found[0] == found[1] and len(found[0]) > 1000
