"""op2 and op10 against the libraries themselves."""

import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from tokenizers import Tokenizer

from sentimart.llm import pieces, token_counts

from odd_rows import ODD_ROWS, docs_of, llm_spark  # noqa: F401  fixtures

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def odd_texts():
    rng = random.Random(3)
    letters = " \n\t  '''strvemld aé1९!?_-中 \x1c▁​\x00😀"
    made = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    made += ["".join(rng.choice(["<|endoftext|>", " ", "\n", "x", "'s"]) for _ in range(rng.randint(0, 9))) for _ in range(500)]
    return made + [t for _, t in ODD_ROWS] + ["'re", "'r", "'rx x'll", "''s", "x   \n y", " " * 999, "ab" * 3000, "a" * 5000]


@pytest.fixture(scope="module")
def texts():
    return odd_texts() + pq.read_table("/root/testdata/sf0.001/documents.parquet").column("text").to_pylist()


def test_counts_equal_the_library(texts):
    library = Tokenizer.from_file(BPE)
    want = [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    counter, col = token_counts.Counter(BPE), pa.array(texts, pa.string())
    for size in (1, 97, len(texts)):
        got = [int(n) for i in range(0, len(texts) if size > 1 else 300, size) for n in counter(col.slice(i, size))]
        assert got == want[: len(got)]


def test_state_maps_compose():
    """Boundaries do not depend on where chunks are cut."""
    import numpy as np

    machine, rng = token_counts.Boundaries(), random.Random(1)
    points = np.array([ord(rng.choice("ab' s re\n1!ll")) for _ in range(2000)] + [0x110000], np.uint32)
    want, old = machine(points).tolist(), token_counts.CHUNK
    try:
        for size in (7, 13, 500, 5000):
            token_counts.CHUNK = size
            assert machine(points).tolist() == want
    finally:
        token_counts.CHUNK = old


def test_full_tables_start_again(texts, monkeypatch):
    monkeypatch.setattr(token_counts, "TABLE_ENTRIES", 50)
    monkeypatch.setattr(pieces, "TABLE_ENTRIES", 50)
    col = pa.array(["some words to count, and more"] * 3 + texts[:50], pa.string())
    counter, table = token_counts.Counter(BPE), pieces.ChunkTable(PIECES)
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert [int(x) for i in range(0, len(col), 5) for x in counter(col.slice(i, 5))] == [len(Tokenizer.from_file(BPE).encode(t or "", add_special_tokens=False).ids) for t in col.to_pylist()]
    assert [x for i in range(0, len(col), 5) for x in pieces._block(col.slice(i, 5), table, False)[0].to_pylist()] == [model.encode(t or "") for t in col.to_pylist()]


def test_pieces_equal_the_library(texts):
    model, table, col = sentencepiece.SentencePieceProcessor(model_file=PIECES), pieces.ChunkTable(PIECES), pa.array(texts, pa.string())
    ids, decoded = pieces._block(col, table, True)
    want = [model.encode(t or "") + [model.eos_id()] for t in texts]
    assert ids.to_pylist() == want
    assert decoded.to_pylist() == [model.decode(w) for w in want]


def test_frames(docs_of):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = docs_of(ODD_ROWS)
    got = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(rows, BPE).collect()}
    library = Tokenizer.from_file(BPE)
    size = lambda t: len(library.encode(t or "", add_special_tokens=False).ids)
    assert got == {(k, len((t or "").encode()), size(t), size(t) > 512) for k, t in ODD_ROWS}
    found = pieces.digests(pieces.encode_decode(rows, PIECES)).collect()
    assert len(found) == len(ODD_ROWS)
    ids = [model.encode(t or "") + [2] for _, t in ODD_ROWS]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert sorted(r.ids_sha256 for r in found) == sorted(sha(" ".join(map(str, x))) for x in ids)
    assert sorted(r.decoded_sha256 for r in found) == sorted(sha(model.decode(x)) for x in ids)
    none = docs_of([])
    assert token_counts.count_tokens(none, BPE).count() == 0 and pieces.encode_decode(none, PIECES).count() == 0
