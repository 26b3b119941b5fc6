"""SentencePiece encoding and decoding by a table of distinct chunks.

In a model none of whose pieces has a whitespace marker after another character, no merge crosses from a
character to a following marker. A text then falls into chunks, each a run of markers with the characters up to
the next marker, and its ids are the chunks' ids in order. Each distinct chunk of a block is segmented once and
kept in a bounded table of the worker; its ids are joined back by position with array gathers, so the library
never sees a word twice while it is in the table. Decoding maps ids to the pieces' bytes; a distinct chunk whose
pieces give back the chunk itself, which is checked when it enters the table, takes its source text's place.

Cases: null and empty texts give the end id alone (or nothing) and an empty decoding; repeated rows and ids give
a row each; an empty table gives an empty table. Only the named columns are read, so further columns may have
any name. Rows of very long texts are handled alone; their memory follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentimart.llm.textblocks import BLOCK_BYTES, TextHash, blocks, per_row, starts_of_rows, text_column

MARK = "▁"
#: Chunks kept by a worker; when full the table starts again, which changes no result.
TABLE_ENTRIES = 600_000

_loaded: dict[str, "ChunkTable"] = {}


class ChunkTable:
    """Ids of distinct chunks under one model, and whether they decode to the chunk itself."""

    def __init__(self, model: str):
        import sentencepiece

        self.model = m = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = [m.id_to_piece(i) for i in range(m.vocab_size())]
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece of this model crosses a whitespace marker")
        if m.decode(m.encode("  a  b")) != "  a  b" or m.encode_as_pieces("a")[0][0] != MARK:
            raise ValueError("the model must keep spaces and put one marker before a text")
        self.end_id = m.eos_id()
        own = [b"" if m.is_control(i) else bytes([int(p[3:5], 16)]) if m.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.piece_size = np.array([len(x) for x in own], np.int64)
        self.piece_at = np.cumsum(self.piece_size) - self.piece_size
        self.piece_raw = np.frombuffer(b"".join(own), np.uint8)
        self._clear()

    def _clear(self) -> None:
        self.known: dict[int, int] = {}
        self.begin, self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.plain = np.zeros(0, bool)

    def of(self, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, raw: np.ndarray) -> np.ndarray:
        """Places in the table of the distinct chunks raw[start:end], each of which begins with a space."""
        if len(self.known) + len(hashes) > TABLE_ENTRIES:
            self._clear()
        keys, known = hashes.tolist(), self.known.get
        at = np.array([known(k, -1) for k in keys], np.int64)
        new = np.flatnonzero(at < 0)
        if len(new):
            text, lone = raw.tobytes(), [self.model.piece_to_id(MARK)]
            # The library puts one marker before a text: the chunk's first space. It gives nothing for an empty text.
            words = [text[a + 1 : b].decode() for a, b in zip(starts[new].tolist(), ends[new].tolist())]
            ids = [x or lone for x in self.model.encode(words, num_threads=1)]
            size = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.array([y for x in ids for y in x], np.int32)
            begin = np.cumsum(size) - size
            plain = np.zeros(len(new), bool)
            decoded, ends_of = gather(self.piece_raw, self.piece_at[flat], self.piece_size[flat])
            made = np.append(0, ends_of)[begin + size] - np.append(0, ends_of)[begin]
            source, source_end = gather(raw, starts[new], ends[new] - starts[new])
            if len(source) == len(decoded) and (made == ends[new] - starts[new]).all():
                wrong = np.flatnonzero(source != decoded)
                plain[:] = True
                plain[np.searchsorted(source_end, wrong, side="right")] = False
            at[new] = np.arange(len(new)) + len(self.size)
            self.begin = np.append(self.begin, begin + len(self.ids))
            self.size, self.ids, self.plain = np.append(self.size, size), np.append(self.ids, flat), np.append(self.plain, plain)
            self.known.update(zip(hashes[new].tolist(), at[new].tolist()))
        return at


def gather(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ranges flat[begin:begin+size] end to end, and where each one ends."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    where = np.arange(total, dtype=np.int64) + np.repeat(begin - (ends - size), size)
    return flat[where], ends


def _block(col: pa.Array, table: ChunkTable, end: bool) -> tuple[pa.Array, pa.Array]:
    """Ids and decodings of a block of texts."""
    col = col.fill_null("")
    if MARK.encode() in text_column(col)[0].tobytes():
        col = pa.compute.replace_substring(col, MARK, " ")
    raw, offsets = text_column(col)
    filled = np.diff(offsets) > 0
    raw = np.insert(raw, offsets[:-1][filled], 32)  # the marker the library puts before each text
    offsets = offsets + np.concatenate([[0], np.cumsum(filled)])
    n = len(filled)
    ids, id_at, decoded = np.zeros(0, np.int32), np.zeros(n + 1, np.int64), col
    if len(raw):
        space = raw == 32
        begin = space.copy()
        begin[1:] &= ~space[:-1]
        starts = np.flatnonzero(begin | starts_of_rows(offsets, len(raw)))
        stops = np.append(starts[1:], len(raw))
        hashes, where, inverse = np.unique(TextHash(raw)(starts, stops), return_index=True, return_inverse=True)
        place = table.of(hashes, starts[where], stops[where], raw)
        ids, ends = gather(table.ids, table.begin[place][inverse], table.size[place][inverse])
        id_at = np.concatenate([[0], ends])[per_row(starts, offsets)]
        if not table.plain[place].all():  # chunks that decode to something else: decode the rows by pieces
            out, ends = gather(table.piece_raw, table.piece_at[ids], table.piece_size[ids])
            at = np.concatenate([[0], ends])[id_at]
            decoded = pa.array([out[a:b].tobytes()[1:].decode("utf-8", "replace") for a, b in zip(at, at[1:])], pa.string())
    if end:
        ids = np.insert(ids, id_at[1:], table.end_id)
        id_at = id_at + np.arange(n + 1)
    return pa.ListArray.from_arrays(pa.array(id_at, pa.int32()), pa.array(ids, pa.int32())), decoded


def encode_decode(df: DataFrame, model: str, text: str = "text", key: str = "doc_id", end: bool = True) -> DataFrame:
    """(key, ids array<int>, decoded string) for each row: the model's ids, an end id last if `end`, and their decoding."""
    kind = df.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model not in _loaded:
            _loaded[model] = ChunkTable(model)
        for b in blocks(batches, "__text", 2 * BLOCK_BYTES):
            ids, decoded = _block(b.column("__text"), _loaded[model], end)
            yield pa.RecordBatch.from_arrays([b.column("__key"), ids, decoded], names=[key, "ids", "decoded"])

    return df.select(df[key].alias("__key"), df[text].alias("__text")).mapInArrow(run, schema)


def digests(encoded: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of encode_decode's rows: the ids in decimal, joined by one space."""
    return encoded.select(
        key,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
