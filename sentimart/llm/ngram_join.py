"""N-gram Jaccard join over prefix trees.

Two texts link when their sets of `width`-word shingles overlap by `percent` of the union. The operator returns
every row's class of linked rows; rows with equal sets are one node from the start.

1. A text becomes its sorted set of 64-bit shingle hashes; equal sets become one node.
2. Linked sets differ in at most `apart` shingles, which follows from their sizes. Dealt by hash into apart + 1 +
   spare parts, more than `spare` are equal, so a non-empty one is unless over `spare` are empty (then empty parts
   count too). Parts are made for the set's size class and the next larger one, as a partner's class is the
   same or the next. A part's signature is its sum of hashes. As more than `spare` parts are equal, each set leaves out
   its `spare` weakest ones, in an order that equal parts share: few shingles outside lines that many texts hold, then
   few shingles at all. So a line that unlike texts share makes hardly any signature. The common shingles are counted
   in a sample of at most SAMPLE rows; they bear on the number of candidates only, never on the links found.
3. Sets with a common signature are connected through the smallest of them (a star, not all pairs), a set's further
   hubs through its smallest one, so that a group has about one edge for each set; connected sets form a candidate group.
   A passage that unlike texts share may make a whole part, and such ties would connect ever more of a growing corpus. So
   sets carry parities of their shingles in 2 to 4 bits for each: differing parities can't outnumber the differing shingles,
   which proves most ties wrong. Where a star's set is proved unlike the hub, the star's sets are compared with each other.
4. A group is cut into blocks of about BLOCK_BYTES. Texts travel, not sets, which are larger and do not compress: one
   text of each set goes to its block, where its set is made again. Each block is a trie of its sets in the global
   order, frequent shingles first, so near copies share long paths. A set is looked up before it is inserted: the walk
   adds up the overlap along shared paths and leaves a subtree when overlap plus the shorter remaining length, by
   the subtree's least size, can't reach the need, or when all sets in it are in the looker's class already.
5. Groups of several blocks go on: neighbouring blocks are joined first; if that leaves a group in several
   classes, all pairs of its blocks that hold different classes are. Blocks of one class are left alone, so a large
   group of near copies costs a chain of blocks and not their square. Nothing is capped.

Cases: null texts and texts without words have an empty set and link with nothing; fewer words than `width` make
one shingle of all; repeated rows are one node and a row each in the result; null keys take part, and a class's id
is its smallest non-null key (where keys repeat or are null, the rows are stored with a number of their own); an empty table gives an empty table. Only the named columns are read, so further
columns may have any name. Sets are compared by hashes of their shingles: two texts are misjudged only if
shingles of these two collide in 64 bits.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentimart.llm.hotkeys import join_heavy
from sentimart.llm.scratch import release, stored
from sentimart.llm.textblocks import U64, TextHash, blocks, mix, per_row, runs, starts_of_rows, text_column

#: Bytes of shingle hashes, or of their texts where these are longer, in one trie.
BLOCK_BYTES = 8 << 20
#: Rows in which common shingles are counted; how many of these rows make a shingle common; the most that are sent to tasks.
SAMPLE, COMMON, MOST_COMMON = 20_000, 5, 200_000
#: Sets of one signature that are compared by parities; comparisons of one star. Beyond both, sets stay connected unproved.
STAR, COMPARED = 20_000, 4_000_000
#: How many times the shingles in which linked sets may differ must differ; below, near copies stay one star, for the tries to tell.
SURE = 2
_WORD = (U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9), U64(0x27D4EB2F165667C5), U64(0x85EBCA77C2B2AE63))


def need(n, percent: int):
    """Least overlap of a set of n with any partner."""
    return -(-percent * n // 100)


def need_of_pair(n: int, m: int, percent: int) -> int:
    """Least i with 100 * i >= percent * (n + m - i)."""
    return -(-percent * (n + m) // (100 + percent))


def shingle_sets(col: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each text, end to end, and where each text's begin (and the last ends)."""
    raw, offsets = text_column(col)
    n = len(offsets) - 1
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    upper = (raw >= 65) & (raw <= 90)
    low = raw + (upper * np.uint8(32))
    inside = ~((low == 32) | ((low >= 9) & (low <= 13)))
    starts, ends = runs(inside, starts_of_rows(offsets, len(raw)))
    words = TextHash(low)(starts, ends)
    begin = per_row(starts, offsets)
    counts = np.diff(begin)
    long_enough = np.maximum(counts - width + 1, 0)
    # Position of every full shingle's first word.
    out_ends = np.cumsum(long_enough)
    first = np.arange(int(out_ends[-1])) + np.repeat(begin[:-1] - (out_ends - long_enough), long_enough)
    full = np.zeros(len(first), np.uint64)
    for j in range(width):
        full += words[first + j] * _WORD[j]
    owner = np.repeat(np.arange(n), long_enough)
    short = np.flatnonzero((counts > 0) & (counts < width))
    single = np.zeros(len(short), np.uint64)
    for j in range(width - 1):
        has = counts[short] > j
        single[has] += words[begin[:-1][short][has] + j] * _WORD[j]
    values = np.concatenate([mix(full), mix(single + U64(1) + counts[short].astype(np.uint64))])
    owner = np.concatenate([owner, short])
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(n + 1))


def _set_id(values: np.ndarray, salt: int) -> int:
    return _digest(values, salt)[0]


def _digest(values: np.ndarray, salt: int) -> tuple[int, int]:
    """A set's 128-bit digest: the half that names it and the half that tells two sets of one name apart."""
    made = hashlib.blake2b(values.tobytes(), digest_size=16, salt=salt.to_bytes(2, "little")).digest()
    return int.from_bytes(made[:8], "little", signed=True), int.from_bytes(made[8:], "little", signed=True)


def size_bounds(percent: int, largest: int) -> np.ndarray:
    """Upper ends of the size classes: partners' sizes, at least percent of each other, lie in one class or neighbours."""
    ends = [1]
    while ends[-1] < largest:
        ends.append(max(ends[-1] + 1, (100 * (ends[-1] + 1)) // percent))
    return np.array([*ends, max(ends[-1] + 1, (100 * (ends[-1] + 1)) // percent)], np.int64)


def _in(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Whether each value is in the sorted table."""
    if not len(table):
        return np.zeros(len(values), bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def signatures(values: np.ndarray, begin: np.ndarray, percent: int, common: np.ndarray = np.zeros(0, np.uint64)) -> tuple[np.ndarray, np.ndarray]:
    """(set, signature) of the sets' strong parts in both their classes; common: shingles, sorted, that make no part strong."""
    telling = ~_in(values, common)
    n = np.diff(begin)
    ends = size_bounds(percent, int(n.max(initial=1)))
    own = np.searchsorted(ends, n)
    owner = np.repeat(np.arange(len(n)), n)
    out_set, out_sign = [], []
    for up in (0, 1):
        kind = own + up
        # |A| + |B| <= 2 * end and overlap >= percent of the union: so many shingles differ at most.
        apart = 2 * ends[kind] * (100 - percent) // (100 + percent)
        spare = 4 + apart // 8
        parts = np.where(n > 0, apart + 1 + spare, 0)
        at = np.cumsum(parts) - parts
        total = int(parts.sum())
        slot = at[owner] + ((values >> U64(20)) % parts[owner].astype(np.uint64)).astype(np.int64)
        order = np.argsort(slot, kind="stable")
        sums = np.zeros(total, np.uint64)
        counts = np.bincount(slot, minlength=total)
        filled = np.flatnonzero(counts)
        if len(filled):
            sums[filled] = np.add.reduceat(mix(values[order] ^ U64(0xD6E8FEB86659FD93)), np.cumsum(counts[filled]) - counts[filled])
        set_of = np.repeat(np.arange(len(n)), parts)
        number = np.arange(total) - at[set_of]
        sign = mix(sums * _WORD[0] + number.astype(np.uint64) * _WORD[1] + kind[set_of].astype(np.uint64) * _WORD[2] + counts.astype(np.uint64))
        # The strongest part that two linked sets share is among the last apart + 1 of both.
        order = np.lexsort((sign, counts, np.bincount(slot[telling], minlength=total), set_of))
        keep = np.zeros(total, bool)
        keep[order[number >= spare[set_of]]] = True
        out_set.append(set_of[keep])
        out_sign.append(sign[keep])
    return np.concatenate(out_set), np.concatenate(out_sign)


def parities(values: np.ndarray, begin: np.ndarray) -> list[bytes]:
    """Each set's parities: how many shingles, odd or even, fall on each of 2 to 4 bits a shingle (a power of two, 64 at least).

    Halves laid over each other (xor) are the parities of half as many bits.
    """
    n = np.diff(begin)
    bits = np.left_shift(np.int64(1), np.ceil(np.log2(np.maximum(2 * n, 64))).astype(np.int64))
    at = np.cumsum(bits) - bits
    owner = np.repeat(np.arange(len(n)), n)
    slot = at[owner] + (mix(values ^ U64(0x27D4EB2F165667C5)) & (bits[owner] - 1).astype(np.uint64)).astype(np.int64)
    packed = np.packbits((np.bincount(slot, minlength=int(bits.sum())) & 1).astype(np.uint8)).tobytes()
    return [packed[a // 8 : (a + b) // 8] for a, b in zip(at.tolist(), bits.tolist())]


def _folded(parity: bytes, size: int) -> np.ndarray:
    out = np.frombuffer(parity, np.uint8)
    while len(out) > size:
        out = out[: len(out) // 2] ^ out[len(out) // 2 :]
    return out


def _unlike(differing, total, percent: int):
    """Whether sets of total shingles in all, of which so many differ at least, are far from linked."""
    return differing * (100 + percent) > SURE * total * (100 - percent)


def unlike_pair(a: bytes, n: int, b: bytes, m: int, percent: int) -> bool:
    """Whether the parities of sets of n and m shingles prove that they are not linked."""
    size = min(len(a), len(b))
    return bool(_unlike(int(np.bitwise_count(_folded(a, size) ^ _folded(b, size)).sum()), n + m, percent))


def star_groups(sets: list[bytes], sizes: np.ndarray, percent: int, most: int | None = None) -> np.ndarray:
    """A group's number for each set: sets in different groups are proved unlike; from `most` comparisons on all that are left are one."""
    size = min(map(len, sets))
    bits = np.stack([_folded(s, size) for s in sets]).view(np.uint64)
    group, left, done, most = np.full(len(sets), -1), np.arange(len(sets)), 0, COMPARED if most is None else most
    while len(left):
        number, waiting, left = left[0], [left[0]], left[1:]
        group[number] = number
        while waiting and len(left):
            if done >= most:
                group[left] = number
                return group
            i = waiting.pop()
            done += len(left)
            near = ~_unlike(np.bitwise_count(bits[left] ^ bits[i]).sum(1, dtype=np.int64), sizes[left] + sizes[i], percent)
            group[left[near]] = number
            waiting += left[near].tolist()
            left = left[~near]
    return group


def _sets(df: DataFrame, width: int, salt: int) -> DataFrame:
    """(row, key, n, weight, set_id, check, parity) of each row; weight: bytes of its set or text, the larger; texts without words have no set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text"):
            values, begin = shingle_sets(b.column("text"), width)
            ids = [_digest(values[a:z], salt) if z > a else (None, None) for a, z in zip(begin.tolist(), begin[1:].tolist())]
            n = np.diff(begin)
            weight = np.maximum(8 * n, np.diff(text_column(b.column("text"))[1]))
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("key"), pa.array(n, pa.int64()), pa.array(weight, pa.int64()), pa.array([x for x, _ in ids], pa.int64()), pa.array([y for _, y in ids], pa.int64()), pa.array([p if k else None for p, k in zip(parities(values, begin), n)], pa.binary())], names=["row", "key", "n", "weight", "set_id", "check", "parity"])

    return df.mapInArrow(run, "row long, key long, n long, weight long, set_id long, check long, parity binary")


def _named_sets(df: DataFrame, width: int) -> tuple[DataFrame, int]:
    """The stored sets and the salt under which no two different sets have one name."""
    for salt in range(1 << 16):
        sets = stored(_sets(df, width, salt), "sets")
        if not sets.groupBy("set_id").agg(F.min("check").alias("a"), F.max("check").alias("b")).filter("a <> b").limit(1).count():
            return sets.drop("check"), salt
        release(sets)
    raise ValueError("no salt names all sets apart")


def common_shingles(df: DataFrame, width: int, total: int) -> np.ndarray:
    """The shingles, sorted, that are in COMMON texts or more of a sample of the total rows; the MOST_COMMON most frequent ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text"):
            yield pa.RecordBatch.from_arrays([pa.array(shingle_sets(b.column("text"), width)[0].view(np.int64), pa.int64())], names=["shingle"])

    taken = df.select("text").sample(min(1.0, SAMPLE / max(total, 1)), seed=1).mapInArrow(run, "shingle long")
    counted = stored(taken.groupBy("shingle").count().filter(F.col("count") >= COMMON), "common")
    most = counted.orderBy(F.desc("count"), "shingle").limit(MOST_COMMON).select("shingle").toPandas()["shingle"]
    release(counted)
    return np.sort(most.to_numpy(np.int64).view(np.uint64))


def _signed(df: DataFrame, width: int, percent: int, salt: int, common: np.ndarray = np.zeros(0, np.uint64)) -> DataFrame:
    """(set_id, value) for each signature of each row's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text"):
            values, begin = shingle_sets(b.column("text"), width)
            ids = np.array([_set_id(values[a:z], salt) if z > a else 0 for a, z in zip(begin.tolist(), begin[1:].tolist())], np.int64)
            owner, sign = signatures(values, begin, percent, common)
            yield pa.RecordBatch.from_arrays([pa.array(ids[owner], pa.int64()), pa.array(sign.view(np.int64), pa.int64())], names=["set_id", "value"])

    return df.mapInArrow(run, "set_id long, value long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node connected with each node of edges (a, b); every round's table is stored.

    Each round takes the smallest label around a node; from the fourth on also that label's own label, so long
    paths shorten as they grow.
    """
    pairs = edges.filter("a <> b").select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")), F.struct("a", F.col("a").alias("b")), F.struct(F.col("b").alias("a"), "b"))).alias("e"))
    both = stored(pairs.select("e.a", "e.b").distinct(), "edges")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root"), "labels")
    for turn in range(1 << 30):
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("root").alias("low"), F.max(F.when(F.col("a") == F.col("b"), F.col("root"))).alias("old"))
        if turn >= 3:
            near = near.join(labels.select(F.col("node").alias("low"), F.col("root").alias("top")), "low").select("a", F.least("low", "top").alias("low"), "old")
        new = stored(near.select(F.col("a").alias("node"), F.col("low").alias("root"), (F.col("low") < F.col("old")).alias("moved")), "labels")
        release(labels)
        labels = new.select("node", "root")
        if not new.filter("moved").limit(1).count():
            return labels


class _Node:
    __slots__ = ("children", "least", "longest", "sets", "mixed")

    def __init__(self):
        self.children: dict[int, _Node | int] = {}  # a set number where only one set goes on
        self.least, self.longest = 1 << 62, 0  # of the sets below: smallest size, longest rest after this node
        self.sets: list[int] = []  # sets that end here
        self.mixed = -1  # a set below, for its class; -2 once there are several classes


class Trie:
    """Sets as increasing sequences of ranks, branching where they differ; links found join classes at once."""

    def __init__(self, percent: int, sizes: list[int], ranks: list[list[int]], parent: list[int]):
        self.percent, self.sizes, self.ranks, self.parent, self.root = percent, sizes, ranks, parent, _Node()

    def find(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def _pass(self, node: _Node, i: int, depth: int) -> None:
        """Note that set i goes through or ends at a node at this depth."""
        node.least, node.longest = min(node.least, self.sizes[i]), max(node.longest, len(self.ranks[i]) - depth)
        if node.mixed == -1:
            node.mixed = i
        elif node.mixed >= 0 and self.find(node.mixed) != self.find(i):
            node.mixed = -2

    def insert(self, i: int) -> None:
        node, own = self.root, self.ranks[i]
        for depth in range(len(own) + 1):
            self._pass(node, i, depth)
            if depth == len(own):
                node.sets.append(i)
                return
            below = node.children.get(own[depth])
            if below is None:
                node.children[own[depth]] = i
                return
            if isinstance(below, int):  # two sets now: the lone one moves a node further
                lone, below = below, _Node()
                node.children[own[depth]] = below
                self._pass(below, lone, depth + 1)
                if depth + 1 == len(self.ranks[lone]):
                    below.sets.append(lone)
                else:
                    below.children[self.ranks[lone][depth + 1]] = lone
            node = below

    def _check(self, i: int, j: int, overlap: int) -> None:
        if overlap >= need_of_pair(self.sizes[i], self.sizes[j], self.percent):
            a, b = self.find(i), self.find(j)
            self.parent[max(a, b)] = min(a, b)

    def link(self, i: int) -> None:
        """Join the class of set i, which need not be inserted, with those of all sets in the trie that it links with."""
        size, percent, find, ranks = self.sizes[i], self.percent, self.find, self.ranks[i]
        n, own, smallest, stack = len(ranks), set(ranks), need(self.sizes[i], self.percent), [(self.root, 0, 0, 0)]
        while stack:
            node, depth, at, overlap = stack.pop()
            if node.mixed >= 0 and find(node.mixed) == find(i):
                continue
            if overlap + min(n - at, node.longest) < need_of_pair(size, max(node.least, smallest), percent):
                continue
            for j in node.sets:
                self._check(i, j, overlap)
            for rank, child in node.children.items():
                k = bisect_left(ranks, rank, at)
                met = k < n and ranks[k] == rank
                if not isinstance(child, int):
                    stack.append((child, depth + 1, k + met, overlap + met))
                elif find(child) != find(i):
                    rest = len(self.ranks[child]) - depth - 1
                    if overlap + met + min(n - k - met, rest) >= need_of_pair(size, max(self.sizes[child], smallest), percent):
                        self._check(i, child, overlap + met + sum(r in own for r in self.ranks[child][depth + 1 :]))


def _ranked(sets: list[np.ndarray]) -> list[list[int]]:
    """Sets as ranks of their members, frequent ones first, ties by value; members of one set only get no rank."""
    values, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(values), np.int64)
    rank[np.lexsort((values, -counts))] = np.arange(len(values))
    shared = (counts > 1)[inverse]
    ranks, out, at = rank[inverse], [], 0
    for s in sets:
        own = ranks[at : at + len(s)][shared[at : at + len(s)]]
        at += len(s)
        out.append(np.sort(own).tolist())
    return out


def link_sets(sets: list[np.ndarray], classes: list[int], percent: int, left: int | None = None) -> list[int]:
    """Class numbers after joining linked sets; left: only the first `left` sets are inserted and the others looked up."""
    first: dict[int, int] = {}
    parent = [first.setdefault(c, i) for i, c in enumerate(classes)]
    trie = Trie(percent, [len(s) for s in sets], _ranked(sets), parent)
    order = sorted(range(len(sets)), key=lambda i: (left is not None and i >= left, len(sets[i])))
    for i in order:
        if left is None or i >= left:
            trie.link(i)
        if left is None or i < left:
            trie.insert(i)
    return [trie.find(i) for i in range(len(sets))]


def _edges(ids: np.ndarray, classes: list[int]) -> pd.DataFrame:
    return pd.DataFrame({"a": ids, "b": ids[np.asarray(classes, np.int64)]})


def _sets_of(texts: pd.Series, width: int) -> list[np.ndarray]:
    """The shingle sets of texts given as bytes."""
    out = []
    for b in blocks([pa.RecordBatch.from_arrays([pa.array(texts.tolist(), pa.large_binary())], names=["text"])], "text"):
        values, begin = shingle_sets(b.column("text"), width)
        out += [values[a:z] for a, z in zip(begin.tolist(), begin[1:].tolist())]
    return out


def star_edges(signed: DataFrame) -> DataFrame:
    """Edges (a, b) that connect the sets of each value of signed (set_id, value) with each other; about one for each set.

    Several sets of one value meet through the smallest, their hub; repeated rows of one set are no meeting. Near copies
    have many values and several hubs: a set goes on with the smallest of these, and its others are tied to that one.
    """
    heads = signed.withColumn("hub", F.min("set_id").over(Window.partitionBy("value")))
    return _tied(heads.filter("set_id <> hub").select("set_id", "hub").distinct())


def _tied(star: DataFrame) -> DataFrame:
    """Edges (a, b) that connect what the distinct pairs (set_id, hub) connect, about one for each set."""
    lowest = star.withColumn("b", F.min("hub").over(Window.partitionBy("set_id")))
    # An edge to the lowest hub itself stands for the set's own.
    return lowest.select(F.when(F.col("hub") == F.col("b"), F.col("set_id")).otherwise(F.col("hub")).alias("a"), "b").distinct()


def likely_edges(signed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Edges as star_edges makes them, less those between sets (set_id, n, parity) that their parities prove unlike.

    1. The distinct lists of the sets of one signature (STAR sets at most; longer ones are stars as they are).
    2. Each pair of a set and its list's smallest is kept or proved unlike.
    3. Lists that the kept pairs do not connect, of three sets or more, are parted by comparing their sets with each other.
    """
    # The signatures are shuffled once; a value's sets are found where its rows lie sorted (and spill).
    own = Window.partitionBy("value")
    met = signed.select("value", "set_id", F.min("set_id").over(own).alias("hub"), F.max("set_id").over(own).alias("last"), F.count(F.lit(1)).over(own).alias("n")).filter("hub <> last")
    alone = F.when(F.col("n") > STAR, F.col("set_id"))
    listed = met.groupBy("value", alone.alias("alone")).agg(F.min("hub").alias("hub"), F.sort_array(F.collect_set("set_id")).alias("ids"))
    ids = F.when(F.col("alone").isNull(), F.col("ids")).otherwise(F.array("hub", "alone"))
    lists = stored(listed.select(ids.alias("ids"), F.col("alone").isNotNull().alias("long")).filter("ids[0] <> ids[size(ids) - 1]").distinct(), "lists")
    pairs = lists.filter("not long").select(F.col("ids")[0].alias("hub"), F.explode(F.expr("slice(ids, 2, size(ids) - 1)")).alias("set_id")).distinct()
    pairs = stored(pairs, "pairs")
    named = pairs.select("set_id").union(pairs.select("hub")).distinct()
    known = stored(sets.select("set_id", "n", "parity").join(named, "set_id", "left_semi").groupBy("set_id").agg(F.min(F.struct("n", "parity")).alias("own")), "parities")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            far = [unlike_pair(x["parity"], x["n"], y["parity"], y["n"], percent) for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("set_id"), b.column("hub"), pa.array(far, pa.bool_())], names=["set_id", "hub", "far"])

    both = pairs.join(known.select("set_id", F.col("own").alias("x")), "set_id").join(known.select(F.col("set_id").alias("hub"), F.col("own").alias("y")), "hub")
    judged = stored(both.select("set_id", "hub", "x", "y").mapInArrow(judge, "set_id long, hub long, far boolean"), "judged")
    long = lists.filter("long").select(F.col("ids")[1].alias("set_id"), F.col("ids")[0].alias("hub"))
    edges = stored(_tied(judged.filter("not far").select("set_id", "hub").union(long).distinct()), "near")
    if judged.filter("far").limit(1).count():
        roots = components(edges)
        members = lists.filter("not long and size(ids) > 2").select(F.xxhash64("ids").alias("list"), F.explode("ids").alias("set_id"))
        rooted = members.join(roots.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
        apart = rooted.groupBy("list").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n_sets")).filter("low <> high")
        apart = stored(apart.select("list", "n_sets"), "apart")
        buckets = max(8, (apart.agg(F.sum("n_sets").alias("n")).first()["n"] or 0) // STAR)

        def part(group: pd.DataFrame) -> pd.DataFrame:
            group = group.drop_duplicates(["list", "set_id"]).sort_values(["list", "set_id"])
            cuts = np.flatnonzero(np.diff(group["list"].to_numpy(), prepend=group["list"].iloc[0])).tolist()
            ids, sizes, bits = group["set_id"].to_numpy(np.int64), group["n"].to_numpy(np.int64), group["parity"].tolist()
            found = [a + star_groups(bits[a:z], sizes[a:z], percent) for a, z in zip([0, *cuts], [*cuts, len(ids)])]
            return _edges(ids, np.concatenate(found).tolist()).drop_duplicates()

        compared = members.join(apart.select("list"), "list", "left_semi").join(known, "set_id").select("list", "set_id", "own.n", "own.parity")
        found = compared.groupBy(F.pmod("list", F.lit(buckets)).alias("bucket")).applyInPandas(part, "a long, b long").filter("a <> b")
        edges = stored(edges.union(found.distinct()), "likely")
        release(apart)
    release(lists, pairs, judged, known)
    return edges


def jaccard_classes(df: DataFrame, width: int = 3, percent: int = 90, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_shingles, component_id, set_id) for each row; component_id: the smallest key reachable by links."""
    kind = df.schema[key].dataType
    rows = df.select(F.col(key).cast("long").alias("row"), F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    sets, salt = _named_sets(rows, width)
    if sets.groupBy("key").count().filter("key is null or count > 1").limit(1).count():
        # Keys that do not tell rows apart: the rows get numbers, which have to be stored to stay the same.
        release(sets)
        rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
        sets, salt = _named_sets(rows, width)
    common = common_shingles(rows, width, sets.count())
    groups = components(likely_edges(_signed(rows, width, percent, salt, common), sets, percent))

    # One row of each set in a group stands for it.
    one = sets.join(groups.select(F.col("node").alias("set_id"), "root"), "set_id").groupBy("set_id", "root").agg(F.min(F.struct("row", "weight")).alias("m"))
    placed = stored(_in_blocks(one.select("set_id", "root", "m.row", "m.weight")), "placed")
    texts = rows.select("row", F.col("text").cast("binary").alias("text")).join(placed, "row").select("set_id", "root", "n_blocks", "block", "text")
    classes = _classes(stored(texts, "texts"), width, percent)

    # Classes' ids are found among sets, not rows; sets and classes with many rows do not gather in one task.
    per_set = sets.filter("set_id is not null").groupBy("set_id").agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("n_rows"))
    named = stored(per_set.join(classes, "set_id", "left").withColumn("class", F.coalesce("class", "set_id")), "named")
    lowest = named.groupBy("class").agg(F.min("key").alias("lowest"), F.count(F.lit(1)).alias("n_sets"))
    ids = join_heavy(named, lowest, "class", "n_sets", named.count()).select("set_id", "lowest", "n_rows")
    out = join_heavy(sets.select("key", "n", "set_id"), ids, "set_id", "n_rows", sets.count())
    return out.select(F.col("key").cast(kind).alias(key), F.col("n").alias("n_shingles"), F.coalesce("lowest", "key").cast(kind).alias("component_id"), "set_id")


def keep_one(df: DataFrame, width: int, percent: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """df's rows, all columns, but of each class only the row of the smallest key (nulls last), then text hash.

    Rows are told apart by a number given before anything else. Texts without words stay.
    """
    numbered = stored(df.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    classes = jaccard_classes(numbered.select("__row", text), width, percent, text, "__row")
    rows = numbered.select("__row", F.col(key).alias("__key"), F.xxhash64(text).alias("__text")).join(classes.filter("set_id is not null").select("__row", "component_id"), "__row")
    # A partial minimum: no class meets in one task as rows.
    first = rows.groupBy("component_id").agg(F.min(F.struct(F.col("__key").isNull(), "__key", "__text", "__row")).alias("m")).select(F.col("m.__row").alias("__row"))
    gone = rows.select("__row").join(first, "__row", "left_anti")
    return numbered.join(gone, "__row", "left_anti").drop("__row")


def _in_blocks(sets: DataFrame) -> DataFrame:
    """(row, set_id, root, n_blocks, block) of sets (set_id, root, row, weight): blocks of a group weigh about BLOCK_BYTES each."""
    counts = sets.groupBy("root").agg(F.sum("weight").alias("c"))
    blocks_of = F.ceil(F.col("c") / BLOCK_BYTES).cast("int")
    numbered = sets.join(counts.select("root", blocks_of.alias("n_blocks")), "root")
    return numbered.select("row", "set_id", "root", "n_blocks", F.pmod(F.xxhash64("set_id"), F.col("n_blocks")).cast("int").alias("block"))


def _classes(sets: DataFrame, width: int, percent: int) -> DataFrame:
    """(set_id, class) of the sets (set_id, root, n_blocks, block, text) that are linked with others."""

    def inside(group: pd.DataFrame) -> pd.DataFrame:
        ids = group["set_id"].to_numpy(np.int64)
        return _edges(ids, link_sets(_sets_of(group["text"], width), list(range(len(ids))), percent))

    links = stored(sets.groupBy("root", "block").applyInPandas(inside, "a long, b long").filter("a <> b"), "inside")
    large = sets.filter("n_blocks > 1")
    if not large.limit(1).count():
        return links.select(F.col("a").alias("set_id"), F.col("b").alias("class"))  # each group was one block

    def across(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("side", kind="stable")
        ids = group["set_id"].to_numpy(np.int64)
        return _edges(ids, link_sets(_sets_of(group["text"], width), group["class"].tolist(), percent, int((group["side"] == 0).sum())))

    def meet(pairs: DataFrame, links: DataFrame) -> DataFrame:
        """Links found between the pairs of blocks (root, i, j), given the classes that links make."""
        known = components(links).select(F.col("node").alias("set_id"), F.col("root").alias("class"))
        classed = large.join(known, "set_id", "left").withColumn("class", F.coalesce("class", "set_id"))
        sides = [pairs.withColumn("block", F.col(c)).withColumn("side", F.lit(s)) for s, c in enumerate("ij")]
        met = classed.join(sides[0].union(sides[1]), ["root", "block"])
        return stored(links.union(met.groupBy("root", "i", "j").applyInPandas(across, "a long, b long").filter("a <> b")), "across")

    many = large.select("root", "n_blocks").distinct()
    chain = many.select("root", F.explode(F.sequence(F.lit(1), F.col("n_blocks") - 1)).alias("j")).select("root", (F.col("j") - 1).alias("i"), "j")
    links = meet(chain, links)
    # What the chain has not made one class: pairs of blocks of which one holds a class that the other does not.
    known = components(links).select(F.col("node").alias("set_id"), F.col("root").alias("class"))
    left = large.select("set_id", "root", "block", "n_blocks").join(known, "set_id", "left").withColumn("class", F.coalesce("class", "set_id"))
    of_block = left.groupBy("root", "block", "n_blocks").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    open_groups = of_block.groupBy("root", "n_blocks").agg(F.min("low").alias("low"), F.max("high").alias("high")).filter("low <> high").select("root", "n_blocks")
    every = open_groups.select("root", "n_blocks", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("i"))
    every = every.select("root", "i", F.explode(F.sequence(F.col("i"), F.col("n_blocks") - 1)).alias("j")).filter("j > i + 1")
    one = of_block.select("root", F.col("block").alias("i"), F.col("low").alias("li"), F.col("high").alias("hi"))
    two = of_block.select("root", F.col("block").alias("j"), F.col("low").alias("lj"), F.col("high").alias("hj"))
    apart = every.join(one, ["root", "i"]).join(two, ["root", "j"]).filter("li <> hi or lj <> hj or li <> lj").select("root", "i", "j")
    return components(meet(apart, links)).select(F.col("node").alias("set_id"), F.col("root").alias("class"))
