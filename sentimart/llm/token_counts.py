"""Token counts by a compiled transducer.

Two machines, both built from the tokenizer's file:

* The boundary transducer is a deterministic automaton over 11 classes of code points that marks where
  pre-tokens begin (the byte-level pattern with its look-ahead turned into a delayed output). The text is cut
  into chunks of CHUNK code points without regard to words. For each chunk the map from every possible entry
  state to its exit state is computed, all chunks side by side; the maps compose associatively, so a parallel
  prefix scan over them gives each chunk's true entry state, and a second pass marks the boundaries.
* A transition that closes a pre-token is annotated with the number of tokens it emits. Annotations are filled
  in when a pre-token is first met (lowest-rank merges over whole arrays of pre-tokens at once) and kept in a
  bounded table of the worker.

Special strings inside a text are each one token, as the library counts them by default. Cases: null and empty
texts have 0 tokens; repeated rows and ids give a row each; an empty table gives an empty table. Only the named
columns are read, so further columns may have any name. A very long text is a block of its own.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import pre_tokenizers

from sentimart.llm.textblocks import BLOCK_BYTES, TextHash, blocks, per_row, text_column

CHUNK = 64
#: Characters of a chunk after which a constant map is followed as one state.
SETTLE = 6
#: Annotations kept by a worker; when full the table starts again, which changes no result.
TABLE_ENTRIES = 1_000_000
#: Longer pre-tokens are merged one by one with a heap.
WIDE = 40

# Classes of code points. D: s t m d; R V E: themselves; B: l; A: the apostrophe; END: after each text.
LETTER, D, R, V, E, B, NUMBER, SPACE, WHITE, A, OTHER, END = range(12)
_LETTERS = (LETTER, D, R, V, E, B)
# States: before a text; in a run of letters, numbers, others; after one or more white characters, the last a
# space or not; after an apostrophe that begins a pre-token, with r, v or l after it; after a contraction.
(S0, SL, SN, SO, SP1, SPM, SW1, SWM, SA, SAR, SAV, SAB, SC) = range(13)
#: Outputs: a pre-token begins at this character, or began at the one before.
HERE, BEFORE = 1, 2

_white = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def classes() -> np.ndarray:
    """The class of every code point, END's own last."""
    table = np.full(0x110001, OTHER, np.uint8)
    points = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)])
    every = points.astype(np.uint32).tobytes().decode("utf-32-le")
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for m in regex.finditer(pattern, every):
            table[points[m.start() : m.end()]] = kind
    # Unicode versions differ: the library decides where two tables do not agree.
    pieces = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    for c in np.flatnonzero(table != OTHER).tolist():
        if c < 0x110000 and unicodedata.category(chr(c)) == "Cn":
            ch = chr(c)
            table[c] = LETTER if len(pieces(f"x{ch}x")) == 1 else NUMBER if len(pieces(f"1{ch}1")) == 1 else OTHER
    table[_white] = WHITE
    table[[*map(ord, "stmd")]] = D
    for ch, k in (("r", R), ("v", V), ("e", E), ("l", B), (" ", SPACE), ("'", A)):
        table[ord(ch)] = k
    table[0x110000] = END
    return table


def boundary_machine() -> tuple[np.ndarray, np.ndarray]:
    """(next state, output) by state and class."""
    step, out = np.zeros((13, 12), np.uint8), np.zeros((13, 12), np.uint8)
    fresh = {**{k: SL for k in _LETTERS}, NUMBER: SN, SPACE: SP1, WHITE: SW1, A: SA, OTHER: SO}
    joined = {**{k: SL for k in _LETTERS}, NUMBER: SN, A: SO, OTHER: SO}
    for state in range(13):
        for k in range(11):
            step[state, k], out[state, k] = fresh[k], HERE
            if state in (SP1, SPM, SW1, SWM) and k in (SPACE, WHITE):
                step[state, k], out[state, k] = SPM if k == SPACE else SWM, 0
            elif state in (SP1, SPM):
                step[state, k], out[state, k] = joined[k], BEFORE if state == SPM else 0
            elif state == SWM:
                out[state, k] = HERE | BEFORE
            elif state in (SAR, SAV, SAB):
                out[state, k] = BEFORE if k in _LETTERS else HERE | BEFORE
    for state, same in ((SL, _LETTERS), (SN, (NUMBER,)), (SO, (OTHER, A))):
        out[state, list(same)], step[state, list(same)] = 0, state
    for k, to in ((OTHER, SO), (A, SO), (D, SC), (R, SAR), (V, SAV), (B, SAB)):
        step[SA, k], out[SA, k] = to, 0
    for state, k in ((SAR, E), (SAV, E), (SAB, B)):
        step[state, k], out[state, k] = SC, 0
    step[:, END] = S0
    out[[SAR, SAV, SAB], END] = BEFORE
    return step, out


def scan(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition of state maps (rows), in log2(rows) parallel rounds."""
    maps, gap = maps.copy(), 1
    while gap < len(maps):
        maps[gap:] = np.take_along_axis(maps[gap:], maps[:-gap], axis=1)
        gap *= 2
    return maps


class Boundaries:
    def __init__(self):
        self.kind = classes()
        step, out = boundary_machine()
        self.step, self.out = step.reshape(-1), out.reshape(-1)  # by state * 12 + class

    def __call__(self, points: np.ndarray) -> np.ndarray:
        """Indices at which pre-tokens begin in a sequence of code points that has END after each text."""
        n = len(points)
        lanes = -(-n // CHUNK)
        kinds = np.full(lanes * CHUNK, END, np.uint8)
        kinds[:n] = self.kind[points]
        kinds = np.ascontiguousarray(kinds.reshape(lanes, CHUNK).T)
        maps = np.repeat(np.arange(13, dtype=np.uint8)[None, :], lanes, axis=0)
        for row in kinds[:SETTLE]:
            maps = self.step[maps * np.uint8(12) + row[:, None]]
        same = (maps == maps[:, :1]).all(1)  # most maps soon lead to one state only; that one is followed alone
        for own, width in ((same, 1), (~same, 13)):
            part = maps[own, :width]
            for row in kinds[SETTLE:, own]:
                part = self.step[part * np.uint8(12) + row[:, None]]
            maps[own] = part
        state = np.zeros(lanes, np.uint8)
        state[1:] = scan(maps)[:-1, S0]
        marks = np.empty((CHUNK, lanes), np.uint8)
        for row, mark in zip(kinds, marks):
            at = state * np.uint8(12) + row
            mark[:] = self.out[at]
            state = self.step[at]
        marks = marks.T.reshape(-1)[:n]
        begins = marks & HERE
        begins[:-1] |= marks[1:] >> 1
        return np.flatnonzero(begins)


def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Merges:
    """Numbers of tokens of pre-tokens by the ranked merges of a byte-level vocabulary."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec["pre_tokenizer"], spec["model"]
        if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or model["type"] != "BPE" or model.get("ignore_merges") or len(model["vocab"]) >= 1 << 16:
            raise ValueError("only byte-level BPE files without a normalizer are compiled")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that take neighbouring characters aren't compiled")
        self.special = [t["content"] for t in spec["added_tokens"]]
        ids = model["vocab"]
        self.byte_ids = np.zeros(256, np.int64)
        for ch, b in byte_letters().items():
            self.byte_ids[b] = ids[ch]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([ids[a] << 16 | ids[b] for a, b in pairs], np.int64)
        made = np.array([ids[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order, made[order]
        self.none = len(keys)
        self.by_rank = made

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 16 | right
        at = np.minimum(np.searchsorted(self.keys, key), self.none - 1)
        return np.where(self.keys[at] == key, self.rank[at], self.none)

    def count(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sizes = ends - starts
        counts = np.ones(len(sizes), np.int64)
        for size in np.unique(sizes[(sizes > 1) & (sizes <= WIDE)]):
            own = np.flatnonzero(sizes == size)
            counts[own] = self._together(self.byte_ids[raw[starts[own][:, None] + np.arange(size)]])
        for i in np.flatnonzero(sizes > WIDE):
            counts[i] = self._alone(self.byte_ids[raw[starts[i] : ends[i]]])
        return counts

    def _together(self, ids: np.ndarray) -> np.ndarray:
        """Counts for rows of equal length: in each round every row does its lowest-ranked, leftmost merge."""
        n, width = ids.shape
        left = np.full(n, width)
        rows = np.arange(n)
        rank = self.ranks(ids[:, :-1], ids[:, 1:])
        while len(rows) and width > 1:
            at = rank.argmin(1)
            best = rank[np.arange(len(rows)), at]
            on = best < self.none
            if not on.all():
                rows, ids, rank, at, best = rows[on], ids[on], rank[on], at[on], best[on]
                if not len(rows):
                    break
            left[rows] -= 1
            each, width = np.arange(len(rows)), width - 1
            ids[each, at] = self.by_rank[best]
            keep = np.arange(width) + (np.arange(width) > at[:, None])
            ids = np.take_along_axis(ids, keep, 1)
            if width == 1:
                break
            # A used-up row keeps its width by padding: the pairs right of the merge move one to the left.
            keep = np.arange(width - 1) + (np.arange(width - 1) >= at[:, None])
            rank = np.take_along_axis(rank, keep, 1)
            for beside in (at - 1, at):
                ok = np.flatnonzero((beside >= 0) & (beside < width - 1))
                rank[ok, beside[ok]] = self.ranks(ids[ok, beside[ok]], ids[ok, beside[ok] + 1])
        return left

    def _alone(self, ids: np.ndarray) -> int:
        """One long pre-token, with a heap of pairs and linked neighbours."""
        n = len(ids)
        now, after, before = ids.tolist(), [*range(1, n + 1)], [*range(-1, n - 1)]
        heap = [(int(r), i) for i, r in enumerate(self.ranks(ids[:-1], ids[1:])) if r < self.none]
        heapq.heapify(heap)
        lookup = dict(zip(self.keys.tolist(), self.rank.tolist()))
        rank_of = lambda a, b: lookup.get(now[a] << 16 | now[b], self.none)
        left = n
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i] if now[i] >= 0 else n
            if j >= n or rank_of(i, j) != r:
                continue
            now[i], now[j], left = int(self.by_rank[r]), -1, left - 1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (x := rank_of(a, b)) < self.none:
                    heapq.heappush(heap, (x, a))
        return left


class Counter:
    def __init__(self, path: str):
        self.merges, self.boundaries, self.known = Merges(path), Boundaries(), {}

    def __call__(self, col: pa.Array) -> np.ndarray:
        """Tokens of each text."""
        extra = np.zeros(len(col), np.int64)
        texts = raw, offsets = text_column(col)
        cut = [s for s in self.merges.special if s.encode() in raw.tobytes()]
        if not cut:
            return self._segments(*texts)
        import re

        pattern = re.compile("|".join(map(re.escape, sorted(cut, key=len, reverse=True))))
        parts = [pattern.split(x or "") for x in col.to_pylist()]
        extra = np.array([len(p) - 1 for p in parts], np.int64)
        counts = self._segments(*text_column(pa.array([x for p in parts for x in p], pa.string())))
        return np.add.reduceat(counts, np.cumsum([0, *(extra[:-1] + 1)])) + extra

    def _segments(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if not len(raw):
            return np.zeros(len(offsets) - 1, np.int64)
        lead = np.flatnonzero((raw & 0xC0) != 0x80)
        points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        rows = np.searchsorted(lead, offsets)  # offsets in code points
        at = self.boundaries(np.insert(points, rows[1:], 0x110000))
        at -= np.searchsorted(rows[1:] + np.arange(len(rows) - 1), at)  # without the ENDs
        starts = lead[at]
        ends = np.append(starts[1:], len(raw))
        hashes, where, inverse = np.unique(TextHash(raw)(starts, ends), return_index=True, return_inverse=True)
        total = np.concatenate([[0], np.cumsum(self._annotations(hashes, starts[where], ends[where], raw)[inverse])])
        return np.diff(total[per_row(starts, offsets)])

    def _annotations(self, hashes, starts, ends, raw) -> np.ndarray:
        if len(self.known) + len(hashes) > TABLE_ENTRIES:
            self.known = {}
        keys = hashes.tolist()
        known = self.known.get
        counts = np.array([known(k, 0) for k in keys], np.int64)
        new = np.flatnonzero(counts == 0)
        if len(new):
            counts[new] = self.merges.count(raw, starts[new], ends[new])
            self.known.update(zip(hashes[new].tolist(), counts[new].tolist()))
        return counts


_loaded: dict[str, Counter] = {}


def count_tokens(df: DataFrame, tokenizer: str, limit: int = 512, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) for each row; over_limit: more than `limit` tokens."""
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _loaded:
            _loaded[tokenizer] = Counter(tokenizer)
        for b in blocks(batches, "__text", 2 * BLOCK_BYTES):
            counts = _loaded[tokenizer](b.column("__text"))
            sizes = np.diff(text_column(b.column("__text"))[1])
            yield pa.RecordBatch.from_arrays([b.column("__key"), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array(counts > limit)], names=schema.names)

    return df.select(df[key].alias("__key"), df[text].alias("__text")).mapInArrow(run, schema)
