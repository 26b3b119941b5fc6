"""Arrow string columns as flat byte arrays, and hashes of byte ranges: the shared helpers of the text operators."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa

#: Text bytes handled at once; a single longer text forms a block of its own.
BLOCK_BYTES = 1 << 20

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[str, np.ndarray] = {}
_tables: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def text_column(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; a null counts as empty."""
    kind = pa.large_binary()
    flat = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"").cast(kind)
    n = len(flat)
    offsets = np.frombuffer(flat.buffers()[1], dtype=np.int64)[flat.offset : flat.offset + n + 1] if n else np.zeros(1, np.int64)
    data = flat.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(batches: Iterator[pa.RecordBatch], text: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches into runs of rows whose text is about `limit` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_column(batch.column(text))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads sums of products over all bits."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, BLOCK_BYTES + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            step = np.full(size, base, dtype=np.uint64)
            step[0] = 1
            _powers[name] = np.cumprod(step, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


class RangeHash:
    """Polynomial hashes modulo 2**64 of short byte ranges of one buffer, equal for equal bytes in every buffer.

    Ranges must be shorter than 1,024 bytes: from there on two ranges can be built that collide whatever the base.
    """

    def __init__(self, raw: np.ndarray):
        up, self.down = _power(len(raw) + 1)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTE[raw] * up[:-1], out=self.sums[1:], dtype=np.uint64)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


_P = U64((1 << 61) - 1)
_M30, _M31 = U64((1 << 30) - 1), U64((1 << 31) - 1)
_BASE61 = 0x0F3B9E4A5C7D86D7
#: Longer ranges are hashed piece by piece, so that sums stay exact.
_PIECE = 1 << 23


def _fold(x: np.ndarray) -> np.ndarray:
    """x modulo 2**61 - 1, for x below 2**64."""
    x = (x & _P) + (x >> U64(61))
    return np.where(x >= _P, x - _P, x)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo 2**61 - 1."""
    a1, a0, b1, b0 = a >> U64(31), a & _M31, b >> U64(31), b & _M31
    middle, low = a1 * b0 + a0 * b1, a0 * b0
    return _fold(a1 * b1 * U64(2) + (middle >> U64(30)) + ((middle & _M30) << U64(31)) + (low & _P) + (low >> U64(61)))


def _powers61(n: int, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(high, low) halves of the base's powers and its inverse powers."""
    key = f"61:{base}"
    if key not in _tables or len(_tables[key][0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        made = []
        for b in (base, pow(base, -1, int(_P))):
            table = np.ones(1, np.uint64)
            while len(table) < size:
                table = np.concatenate([table, _times(table, U64(pow(b, len(table), int(_P))))])
            made.append(table[:size])
        _tables[key] = (made[0] >> U64(31)).astype(np.uint32), (made[0] & _M31).astype(np.uint32), made[1]
    high, low, inverse = _tables[key]
    return high[:n], low[:n], inverse[:n]


class TextHash:
    """Polynomial hashes modulo the prime 2**61 - 1 of any byte ranges of one buffer, equal for equal bytes in every buffer."""

    def __init__(self, raw: np.ndarray, base: int = _BASE61):
        high, low, self.inverse = _powers61(len(raw) + 1, base)
        value = raw.astype(np.uint64) + U64(1)
        self.high, self.low = np.zeros(len(raw) + 1, np.uint64), np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(value * high[:-1], out=self.high[1:], dtype=np.uint64)
        np.cumsum(value * low[:-1], out=self.low[1:], dtype=np.uint64)

    def _piece(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        high, low = _fold(self.high[end] - self.high[start]), self.low[end] - self.low[start]
        total = _fold((high >> U64(30)) + ((high & _M30) << U64(31)) + _fold(low))
        return mix(_times(total, self.inverse[start]) + (end - start).astype(np.uint64) * U64(0x9E3779B97F4A7C15))

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        start, end = np.asarray(start), np.asarray(end)
        out = self._piece(start, np.minimum(end, start + _PIECE))
        rest = np.flatnonzero(end - start > _PIECE)
        at = start[rest] + _PIECE
        while len(rest):
            out[rest] = mix(out[rest] * U64(0xC2B2AE3D27D4EB4F) + self._piece(at, np.minimum(end[rest], at + _PIECE)))
            at, rest = at + _PIECE, rest
            keep = at < end[rest]
            at, rest = at[keep], rest[keep]
        return out


def starts_of_rows(offsets: np.ndarray, n: int) -> np.ndarray:
    """A flag for each byte at which a non-empty row begins."""
    first = np.zeros(n, bool)
    first[offsets[:-1][np.diff(offsets) > 0]] = True
    return first


def runs(inside: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of `inside` that do not cross a row's start."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin = inside.copy()
    begin[1:] &= first[1:] | ~inside[:-1]
    stop = inside.copy()
    stop[:-1] &= first[1:] | ~inside[1:]
    return np.flatnonzero(begin), np.flatnonzero(stop) + 1


def per_row(positions: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For sorted positions: where each row's share begins, with the total as last entry."""
    return np.searchsorted(positions, offsets, side="left")
