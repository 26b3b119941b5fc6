"""Removal of repeated substrings by two-stage suffix sorting.

Every byte covered by a `length`-byte string that also starts in a row with a smaller key is removed. Texts are
never concatenated across the cluster; what is sorted together is what can be equal:

1. Rows are packed into stored blocks of a few MB of text.
2. Each window of `length` bytes has one anchor, its GRAM-byte substring of least hash; equal windows have equal
   anchors. Blocks send their distinct anchors, dealt by hash, and get back which occur in a second row.
3. For each anchor met again the bytes of its windows, its context, are sent to the part that its hash names, once
   for each distinct context of a block with the block's smallest key. Anchors found in over HOT blocks are dealt
   window by window instead, by the window's hash, so a passage that a third of all rows hold spreads out.
4. A part builds the suffix array of its distinct contexts in two stages: suffixes smaller than their successors
   are sorted directly, the others are induced by scanning the buckets of first bytes in order. Neighbours whose
   common prefix reaches `length` form a group with a smallest key.
5. Blocks get one flag for each context and window start and mark their rows' bytes.

Cases: null and empty texts and texts shorter than `length` keep everything; rows of one key do not take from
each other; null keys count as larger than all others; an empty table gives an empty table. Only the named
columns are read, so further columns may have any name. Tasks hold one block or one part; very long texts are
scanned in overlapping segments.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentimart.llm.scratch import release, stored
from sentimart.llm.textblocks import U64, RangeHash, blocks, mix, text_column

GRAM = 24
BLOCK = 4 << 20
SEGMENT = 1 << 20
#: Text bytes for each bucket of anchors and for each part of contexts.
BUCKET_TEXT, PART_TEXT = 8 << 20, 4 << 20
#: Bytes of contexts that are sorted at once (about 50 times as much memory) and sent to Spark at once.
SORT_BYTES, SEND_BYTES = 2 << 20, 4 << 20
#: Blocks that hold an anchor before its windows are dealt one by one.
HOT = 500
#: Replies to blocks are broadcast up to this many bytes, else joined by shuffle.
BROADCAST_BYTES = 32 << 20
LAST = np.iinfo(np.int64).max
_PLACE = U64((1 << 24) - 1)


def _anchors(raw: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first, last): runs of window starts that share one anchor, in order; windows do not leave their row."""
    edge = np.zeros(len(raw) + 1, np.int32)
    ends = offsets[1:]
    np.add.at(edge, np.maximum(offsets[:-1], ends - (length - 1)), 1)
    np.add.at(edge, ends, -1)
    valid = np.cumsum(edge[:-1]) == 0
    out = []
    width = length - GRAM + 1
    for a in range(0, max(len(raw) - length + 1, 0), SEGMENT):
        part = raw[a : a + SEGMENT + length - 1]
        at = np.arange(len(part) - GRAM + 1)
        own = RangeHash(part)(at, at + GRAM)
        least, span = (own & ~_PLACE) | at.astype(np.uint64), 1
        while 2 * span <= width:
            least, span = np.minimum(least[:-span], least[span:]), 2 * span
        if width > span:
            least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
        starts = np.flatnonzero(valid[a : a + len(least)])
        if not len(starts):
            continue
        anchor = (least[starts] & _PLACE).astype(np.int64)
        new = np.ones(len(starts), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
        first = np.flatnonzero(new)
        out.append((own[anchor[first]], starts[first] + a, starts[np.append(first[1:], len(starts)) - 1] + a))
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out))


class _Block:
    """A block's bytes, its rows' ends and keys, and its runs of window starts."""

    def __init__(self, row, length: int):
        self.raw = np.frombuffer(row.data, np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum(np.frombuffer(row.sizes, np.int64))])
        self.keys = np.frombuffer(row.keys, np.int64)
        self.hash, self.first, self.last = _anchors(self.raw, self.offsets, length)
        self.row_of = np.searchsorted(self.offsets, self.first, side="right") - 1
        self.key_of = self.keys[self.row_of]

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchors in order, whether several rows of the block hold each, and each run's anchor."""
        anchors, inverse = np.unique(self.hash, return_inverse=True)
        low, high = np.full(len(anchors), LAST), np.full(len(anchors), np.iinfo(np.int64).min)
        np.minimum.at(low, inverse, self.key_of)
        np.maximum.at(high, inverse, self.key_of)
        return anchors, low < high, inverse

    def contexts(self, replies, buckets: int, parts: int, length: int):
        """Runs whose anchor is met again, cut into windows where hot: (first, last, key, part, distinct number),
        and of the distinct contexts, by number: part, first, last, smallest key. turns: a number of each of these, the same for those of one anchor."""
        anchors, _, inverse = self.anchors()
        again, hot = np.zeros(len(anchors), bool), np.zeros(len(anchors), bool)
        bucket = (anchors % U64(buckets)).astype(np.int64)
        for b, bits, warm in replies:
            own = np.flatnonzero(bucket == b)
            again[own] = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(own)).astype(bool)
            if warm:
                hot[own] = np.unpackbits(np.frombuffer(warm, np.uint8), count=len(own)).astype(bool)
        keep = np.flatnonzero(again[inverse])
        warm = hot[inverse[keep]]
        runs, single = keep[~warm], keep[warm]
        counts = self.last[single] - self.first[single] + 1
        spread = np.repeat(self.first[single] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        first = np.concatenate([self.first[runs], spread])
        last = np.concatenate([self.last[runs], spread])
        key = np.concatenate([self.key_of[runs], np.repeat(self.key_of[single], counts)])
        content = self._hashes(first, last + length)
        dealt = np.concatenate([self.hash[runs], content[len(runs) :]])
        part = ((dealt >> U64(17)) % U64(parts)).astype(np.int64)
        # Equal contexts of one part, by content; the first of each in order of key has the block's smallest.
        order = np.lexsort((key, content, part))
        new = np.ones(len(order), bool)
        new[1:] = (content[order][1:] != content[order][:-1]) | (part[order][1:] != part[order][:-1])
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        lead = order[new]
        self.turns = (mix(dealt[lead]) >> U64(56)).astype(np.uint8)
        return first, last, key, number, part[lead], first[lead], last[lead], key[lead]

    def _hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The hashes of short ranges, segment by segment: a hash needs 8 bytes and more for each byte of its buffer."""
        out, longest = np.zeros(len(start), np.uint64), int((end - start).max(initial=0))
        segment = start // SEGMENT
        for k in range(-(-len(self.raw) // SEGMENT)):
            own = np.flatnonzero(segment == k)
            if len(own):
                a = k * SEGMENT
                out[own] = RangeHash(self.raw[a : a + SEGMENT + longest])(start[own] - a, end[own] - a)
        return out


def _joined(raw: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The ranges of raw end to end."""
    ends = np.cumsum(size)
    return raw[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first - (ends - size), size)]


def two_stage_order(text: np.ndarray, wanted: np.ndarray, length: int) -> np.ndarray:
    """The wanted positions of text in the order of their suffixes' first `length` bytes.

    text holds strings, each followed by a 0, the smallest byte, and `length` more zeros at the end. Suffixes
    smaller than their successors are sorted directly; larger ones are induced from their successors, whose place
    is known when their bucket is scanned.
    """
    step = np.sign(np.diff(text.astype(np.int16), append=0))
    change = np.where(step != 0, np.arange(len(text)), len(text))
    change = np.minimum.accumulate(change[::-1])[::-1]
    smaller = np.append(step, -1)[change] > 0  # than its successor
    needed = wanted.copy()
    new = np.flatnonzero(needed & ~smaller)
    while len(new):  # what a larger suffix is induced from
        new = new[new + 1 < len(text)] + 1
        new = new[~needed[new]]
        needed[new] = True
        new = new[~smaller[new]]
    direct = np.flatnonzero(needed & smaller)
    windows = np.lib.stride_tricks.sliding_window_view(np.append(text, np.zeros(length, np.uint8)), length)
    direct = direct[np.argsort(np.ascontiguousarray(windows[direct]).view(f"S{length}").ravel(), kind="stable")]
    bounds = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    lone = np.flatnonzero(needed & ~smaller & (np.arange(len(text)) == len(text) - 1))
    for i in lone:
        waiting[text[i]].append(np.array([i]))
    order = []
    for c in range(256):
        induced = [*waiting[c]]
        last = np.concatenate(induced) if induced else np.zeros(0, np.int64)
        while len(last):  # runs of this byte: each is induced from the one just placed
            before = last[last > 0] - 1
            last = before[needed[before] & ~smaller[before] & (text[before] == c)]
            induced.append(last)
        bucket = np.concatenate([*induced, direct[bounds[c] : bounds[c + 1]]])
        if not len(bucket):
            continue
        order.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[needed[before] & (text[before] > c)]
        lead = text[before]
        for d in np.unique(lead):
            waiting[d].append(before[lead == d])
    order = np.concatenate(order) if order else np.zeros(0, np.int64)
    return order[wanted[order]]


def _in_turns(data: list[bytes], turns: np.ndarray, sizes: np.ndarray, keys: np.ndarray, length: int) -> np.ndarray:
    """_smaller_keys of contexts, sorted about SORT_BYTES at a time: only contexts of one turn can have equal windows."""
    raw = np.frombuffer(b"".join(data), np.uint8)
    rounds = min(256, -(-len(raw) // SORT_BYTES))
    if rounds < 2:
        return _smaller_keys(raw, sizes, keys, length)
    flags, begin = np.zeros(len(keys), np.uint32), np.cumsum(sizes) - sizes
    for k in range(rounds):
        own = np.flatnonzero(turns % rounds == k)
        if len(own):
            flags[own] = _smaller_keys(_joined(raw, begin[own], sizes[own]), sizes[own], keys[own], length)
    return flags


def _smaller_keys(raw: np.ndarray, sizes: np.ndarray, keys: np.ndarray, length: int) -> np.ndarray:
    """For contexts (end to end) with their keys: bits of the window starts that a smaller key's context holds too."""
    ends = np.cumsum(sizes)
    content = RangeHash(raw)(ends - sizes, ends)
    _, where, inverse = np.unique(content, return_index=True, return_inverse=True)
    least = np.full(len(where), LAST)
    np.minimum.at(least, inverse, keys)
    size = sizes[where]
    own = _joined(raw, (ends - sizes)[where], size)
    stop = np.cumsum(size)
    text = np.zeros(len(own) + len(size) + length, np.uint8)
    place = np.arange(len(own)) + np.repeat(np.arange(len(size)), size)
    text[place] = own + 1  # no UTF-8 byte is 255
    begin = stop - size + np.arange(len(size))
    count = size - (length - 1)
    starts = np.arange(int(count.sum())) + np.repeat(begin - (np.cumsum(count) - count), count)
    context = np.repeat(np.arange(len(size)), count)
    wanted = np.zeros(len(text), bool)
    wanted[starts] = True
    order = two_stage_order(text, wanted, length)
    windows = np.lib.stride_tricks.sliding_window_view(text, length)
    common = np.ones(len(order), bool)  # whether a window begins a new group: the common prefix ends before `length`
    for a in range(1, len(order), 1 << 17):
        b = min(a + (1 << 17), len(order))
        near = np.ascontiguousarray(windows[order[a - 1 : b]]).view(f"S{length}").ravel()
        common[a:b] = near[1:] != near[:-1]
    first = np.flatnonzero(common)
    rank_of = np.empty(len(text), np.int64)
    rank_of[order] = np.arange(len(order))
    at = rank_of[starts]
    group = np.cumsum(common) - 1
    lowest = np.minimum.reduceat(least[context][np.argsort(at, kind="stable")], first) if len(first) else least[:0]
    found = lowest[group[at]]  # by start: the smallest key of its window
    flags = np.zeros(len(keys), np.uint32)
    base = np.cumsum(count) - count
    for bit in range(int(count.max(initial=0))):
        has = count[inverse] > bit
        flags[has] |= (found[base[inverse[has]] + bit] < keys[has]).astype(np.uint32) << np.uint32(bit)
    return flags


BLOCK_SCHEMA = "data binary, sizes binary, keys binary, n long"


def _to_blocks(df: DataFrame) -> DataFrame:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text", BLOCK):
            raw, offsets = text_column(b.column("text"))
            keys = b.column("key").fill_null(LAST).to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (raw.tobytes(), np.diff(offsets).astype(np.int64).tobytes(), keys.tobytes())] + [pa.array([len(raw)], pa.int64())], names=["data", "sizes", "keys", "n"])

    return df.mapInArrow(pack, BLOCK_SCHEMA).withColumn("block", F.monotonically_increasing_id())


def _reply(table: DataFrame, replies: DataFrame, name: str) -> DataFrame:
    """table with the replies to each block, as one list: (number of its sender, bytes, bytes); what is read here may be deleted."""
    lists = replies.groupBy("block").agg(F.collect_list(F.struct("part", "bits", "more")).alias(name))
    size = replies.agg(F.coalesce(F.sum(F.length("bits") + F.coalesce(F.length("more"), F.lit(0)) + 40), F.lit(0)).alias("n")).first()["n"]
    if size <= BROADCAST_BYTES:
        return table.join(F.broadcast(lists), "block", "left")
    # Blocks are rows of several MB: dealt once here and stored, so that their shuffle files go before others are written.
    joined = stored(table.join(lists, "block", "left"), name)
    release(table, replies)
    return joined


def remove_repeats(df: DataFrame, length: int = 50, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_bytes, spans array<start, end>, kept binary) for each row: removed byte ranges and the remaining bytes."""
    if not GRAM < length <= GRAM + 31:
        raise ValueError(f"length must be over {GRAM} and at most {GRAM + 31}")
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    table = stored(_to_blocks(rows), "blocks")
    total = table.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    buckets, parts = max(8, -(-total // BUCKET_TEXT)), max(8, -(-total // PART_TEXT))

    def send_anchors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                anchors, several, _ = _Block(row, length).anchors()
                bucket = (anchors % U64(buckets)).astype(np.int64)
                out = []
                for b in np.unique(bucket):
                    own = np.flatnonzero(bucket == b)
                    # 40 bits tell anchors of a bucket apart well enough: a false meeting only costs a context.
                    out.append((int(b), row.block, np.ascontiguousarray((anchors[own] >> U64(24)).view(np.uint8).reshape(-1, 8)[:, :5]).tobytes(), np.packbits(several[own]).tobytes()))
                yield pd.DataFrame(out, columns=["part", "block", "anchors", "several"])

    def find_again(group: pd.DataFrame) -> pd.DataFrame:
        sizes = np.array([len(x) // 5 for x in group["anchors"]])
        every = np.zeros((int(sizes.sum()), 8), np.uint8)
        every[:, :5] = np.frombuffer(b"".join(group["anchors"]), np.uint8).reshape(-1, 5)
        values, inverse, counts = np.unique(every.view(np.uint64).ravel(), return_inverse=True, return_counts=True)
        several = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(group["several"], sizes)]).astype(bool)
        met = counts > 1
        met[inverse[several]] = True
        again, hot, ends = met[inverse], (counts > HOT)[inverse], np.cumsum(sizes)
        cut = [(again[e - n : e], hot[e - n : e]) for e, n in zip(ends, sizes)]
        return pd.DataFrame({"part": group["part"], "block": group["block"], "bits": [np.packbits(x).tobytes() for x, _ in cut], "more": [np.packbits(y).tobytes() if y.any() else None for _, y in cut]})

    asked = table.mapInPandas(send_anchors, "part long, block long, anchors binary, several binary")
    again = stored(asked.groupBy("part").applyInPandas(find_again, "part long, block long, bits binary, more binary"), "again")
    known = _reply(table, again, "again")

    def listed(replies) -> list:
        return [] if replies is None else [(r["part"], r["bits"], r["more"]) for r in replies]

    def send_contexts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                block = _Block(row, length)
                _, _, _, _, part, first, last, keys = block.contexts(listed(row.again), buckets, parts, length)
                out, held = [], 0
                cuts = np.flatnonzero(np.diff(part, prepend=-1))
                for a, b in zip(cuts, np.append(cuts[1:], len(part))):
                    sizes = last[a:b] - first[a:b] + length
                    out.append((int(part[a]), row.block, _joined(block.raw, first[a:b], sizes).tobytes(), sizes.astype(np.uint8).tobytes(), keys[a:b].tobytes(), block.turns[a:b].tobytes()))
                    held += int(sizes.sum())
                    if held > SEND_BYTES:
                        yield pd.DataFrame(out, columns=["part", "block", "data", "sizes", "keys", "turns"])
                        out, held = [], 0
                yield pd.DataFrame(out, columns=["part", "block", "data", "sizes", "keys", "turns"])

    def sort_part(group: pd.DataFrame) -> pd.DataFrame:
        sizes = np.frombuffer(b"".join(group["sizes"]), np.uint8).astype(np.int64)
        turns = np.frombuffer(b"".join(group["turns"]), np.uint8)
        flags = _in_turns(group["data"].tolist(), turns, sizes, np.frombuffer(b"".join(group["keys"]), np.int64), length)
        counts = np.array([len(x) for x in group["sizes"]])
        ends = np.cumsum(counts)
        return pd.DataFrame({"part": group["part"], "block": group["block"], "bits": [zlib.compress(flags[e - n : e].tobytes(), 1) for e, n in zip(ends, counts)], "more": None})

    sent = known.mapInPandas(send_contexts, "part long, block long, data binary, sizes binary, keys binary, turns binary")
    flags = stored(sent.groupBy("part").applyInPandas(sort_part, "part long, block long, bits binary, more binary"), "flags")
    ready = _reply(known, flags, "flags")
    kind = df.schema[key].dataType

    def mark(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                block = _Block(row, length)
                first, last, key_of, number, _, _, _, lead = block.contexts(listed(row.again), buckets, parts, length)
                replies = sorted(listed(row.flags))
                bits = np.frombuffer(b"".join(zlib.decompress(r[1]) for r in replies), np.uint32)
                count = last - first + 1
                here = bits[number].astype(np.uint64)
                here[key_of > lead[number]] = U64((1 << 40) - 1)  # a smaller key of this block has the context
                edge = np.zeros(len(block.raw) + 1, np.int32)
                for bit in range(int(count.max(initial=0))):
                    at = first[(count > bit) & ((here >> U64(bit)) & U64(1) == 1)] + bit
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + length, -1)
                gone = np.cumsum(edge[:-1]) > 0
                row_start = np.zeros(len(gone) + 1, bool)
                row_start[block.offsets] = True
                begin = np.flatnonzero(gone & (row_start[:-1] | ~np.concatenate([[False], gone[:-1]])))
                stop = np.flatnonzero(gone & (row_start[1:] | ~np.concatenate([gone[1:], [False]]))) + 1
                cut = np.searchsorted(begin, block.offsets)
                out = []
                for i, (a, b) in enumerate(zip(block.offsets[:-1].tolist(), block.offsets[1:].tolist())):
                    x, y = begin[cut[i] : cut[i + 1]] - a, stop[cut[i] : cut[i + 1]] - a
                    spans = [{"start": int(p), "end": int(q)} for p, q in zip(x, y)]
                    kept = block.raw[a:b] if not spans else block.raw[a:b][~gone[a:b]]
                    out.append((None if block.keys[i] == LAST else int(block.keys[i]), b - a, spans, kept.tobytes()))
                yield pd.DataFrame(out, columns=[key, "n_bytes", "spans", "kept"]).astype({key: "Int64"})

    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([T.StructField(key, T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("spans", span), T.StructField("kept", T.BinaryType())])
    return ready.mapInPandas(mark, schema).withColumn(key, F.col(key).cast(kind))
