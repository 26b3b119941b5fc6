"""MinHash near-duplicate classes.

Two texts link when their sets of `width`-word shingles overlap by `percent` of the union (confirmed on the whole sets).
The operator returns every row's class of linked rows; rows with equal sets are one node from the start.

1. A text becomes its sorted set of 64-bit shingle hashes, named by a 128-bit digest; equal sets are one node. A node's
   signature is the least value of each of HASHES universal hashes (a * x + b modulo 2**64, upper half) over the set.
2. The signature is cut into BANDS bands of ROWS minima. Nodes with a band in common are candidates: two sets at 80 %
   share none of the 40 bands with probability 1.2e-7, at 90 % with 1e-15.
3. In each band value the nodes are paired with the smallest of them (a star, not all pairs); pairs whose signatures agree
   in at least MIN_AGREE minima (missed at 80 % with 8e-8) go on, for each node the best one, and are confirmed on
   whole sets that stream past their hub's. Confirmed links are closed by alternating large-star and small-star.
4. Band values that still hold several classes are open: there, all nodes of different classes are compared inside tasks.
   Large values are cut into blocks by bytes, a class with many nodes into blocks of its own, and only blocks with
   different classes meet. A pair counts in its first common band alone. What agrees well enough is confirmed on whole
   sets, again inside the task that holds the two blocks, where classes grow as links are found. Only links leave a task.

So a large group of near copies costs one comparison a node, and only what the stars leave in several classes costs
more. Nothing is capped: every pair with a common band in different classes is compared.

Cases: null texts and texts without words have an empty set and link with nothing; fewer words than `width` make
one shingle of all; repeated rows are one node and a row each in the result; null keys take part, and a class's id
is its smallest non-null key (null if it has none); an empty table gives an empty table. Only the named columns are
read, so further columns may have any name. Shingles are compared by 64-bit hashes: two texts are misjudged only if
shingles of these two collide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentimart.llm.hotkeys import join_heavy
from sentimart.llm.ngram_join import need_of_pair, shingle_sets
from sentimart.llm.scratch import release, stored
from sentimart.llm.stars import components
from sentimart.llm.textblocks import U64, blocks, mix

BANDS, ROWS = 40, 5
HASHES = BANDS * ROWS
#: Minima in which two signatures must agree to be confirmed on whole sets.
MIN_AGREE = 125
#: Bytes of signatures and sets in one block of an open band value.
BLOCK_BYTES = 8 << 20
#: Nodes that are compared with one copy of their hub's set; a hub of more has copies, dealt over as many tasks.
PER_HUB = 256
_COEFFICIENTS = np.random.Generator(np.random.PCG64(61)).integers(0, 1 << 63, (2, HASHES), dtype=np.uint64) * U64(2) + U64(1)


def set_digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def signatures(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The minima of each set (a row each); a set must not be empty."""
    out = np.empty((len(begin) - 1, HASHES), np.uint32)
    if not len(out):
        return out
    x = mix(values) >> U64(32)
    for i in range(HASHES):
        out[:, i] = np.minimum.reduceat(x * _COEFFICIENTS[0, i] + _COEFFICIENTS[1, i], begin[:-1]) >> U64(32)
    return out


def band_values(signs: np.ndarray) -> np.ndarray:
    """One value for each band of each signature."""
    rows = signs.reshape(len(signs), BANDS, ROWS).astype(np.uint64)
    out = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) * U64(0x9E3779B97F4A7C15), (len(signs), BANDS)).copy()
    for r in range(ROWS):
        out = mix(out ^ rows[:, :, r]) + U64(r)
    return out


def _matrix(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint32).reshape(-1, HASHES)


def _sets(df: DataFrame, width: int) -> DataFrame:
    """(key, n, set_id, sign) of each row; texts without words have neither set nor signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text"):
            values, begin = shingle_sets(b.column("text"), width)
            n = np.diff(begin)
            full = np.flatnonzero(n)
            signs = signatures(values, np.append(begin[:-1][full], begin[-1]))
            ids, made = [None] * len(n), [None] * len(n)
            for i, k in enumerate(full.tolist()):
                ids[k], made[k] = set_digest(values[begin[k] : begin[k + 1]]), signs[i].tobytes()
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(made, pa.binary())], names=["key", "n", "set_id", "sign"])

    return df.mapInArrow(run, "key long, n long, set_id binary, sign binary")


def _bands(nodes: DataFrame) -> DataFrame:
    """(value, band, node): each node's band values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                b = whole.slice(at, 2000)
                values = band_values(_matrix(b.column("sign")))
                node = np.repeat(b.column("node").to_numpy(), BANDS)
                band = np.tile(np.arange(BANDS, dtype=np.int32), b.num_rows)
                yield pa.RecordBatch.from_arrays([pa.array(values.ravel().view(np.int64)), pa.array(band), pa.array(node, pa.int64())], names=["value", "band", "node"])

    return nodes.select("node", "sign").mapInArrow(run, "value long, band int, node long")


def _agreement(pairs: DataFrame) -> DataFrame:
    """(node, hub, agree) of pairs (node, hub, sign, hub_sign)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                b = whole.slice(at, 2000)
                agree = (_matrix(b.column("sign")) == _matrix(b.column("hub_sign"))).sum(axis=1)
                yield pa.RecordBatch.from_arrays([b.column("node"), b.column("hub"), pa.array(agree, pa.int32())], names=["node", "hub", "agree"])

    return pairs.mapInArrow(run, "node long, hub long, agree int")


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    need = need_of_pair(len(a), len(b), percent)
    if min(len(a), len(b)) < need:
        return False
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    return int((large[at] == small).sum()) >= need


def _whole_sets(rows: DataFrame, keys: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(node, members) of the nodes in wanted, computed anew from one text each.

    keys (set_id, node, key): the smallest key of each node; null keys are met by a stand-in.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text"):
            values, begin = shingle_sets(b.column("text"), width)
            own = [values[i:j] for i, j in zip(begin.tolist(), begin[1:].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array([set_digest(x) if len(x) else None for x in own], pa.binary()), pa.array([x.tobytes() for x in own], pa.binary())], names=["set_id", "members"])

    named = keys.join(wanted, "node", "left_semi")
    stand_in = F.coalesce("key", F.lit(-(1 << 63)).cast("long")).alias("key")
    texts = rows.select(stand_in, "text").join(named.select(stand_in).distinct(), "key", "left_semi")
    made = texts.mapInArrow(run, "set_id binary, members binary")
    return made.join(named.select("set_id", "node"), "set_id").dropDuplicates(["node"]).select("node", "members")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the pairs (node, hub) that link, one hub a node. Nodes' sets stream past their hub's set."""
    counts = pairs.groupBy("hub").agg(F.count(F.lit(1)).alias("n_pairs")).withColumn("copies", F.ceil(F.col("n_pairs") / PER_HUB).cast("int"))
    hub_rows = counts.join(sets.withColumnRenamed("node", "hub"), "hub").select(
        "hub", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("salt"), F.lit(0).alias("side"), F.col("hub").alias("node"), "members")
    dealt_pairs = join_heavy(pairs, counts, "hub", "n_pairs", pairs.count())
    node_rows = dealt_pairs.join(sets, "node").select("hub", F.pmod(F.xxhash64("node"), F.col("copies")).cast("int").alias("salt"), F.lit(1).alias("side"), "node", "members")
    dealt = hub_rows.unionByName(node_rows).repartition("hub", "salt").sortWithinPartitions("hub", "salt", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, None
        for b in batches:
            links = []
            members = b.column("members")
            for i, (hub, side, node) in enumerate(zip(b.column("hub").to_pylist(), b.column("side").to_pylist(), b.column("node").to_pylist())):
                own = np.frombuffer(members[i].as_py(), np.uint64)
                if side == 0:
                    now, held = hub, own
                elif now == hub and _linked(held, own, percent):
                    links.append((node, hub))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The runs of rows of one group g in batches that are sorted by it."""
    kept: list[pa.RecordBatch] = []
    for b in batches:
        g = b.column("g").to_numpy()
        if not len(g):
            continue
        cuts = [0, *(np.flatnonzero(g[1:] != g[:-1]) + 1).tolist(), len(g)]
        for start, end in zip(cuts, cuts[1:]):
            if kept and kept[0].column("g")[0].as_py() != g[start]:
                yield pa.Table.from_batches(kept)
                kept = []
            kept.append(b.slice(start, end - start))
    if kept:
        yield pa.Table.from_batches(kept)


def _open_groups(shared: DataFrame, nodes: DataFrame, classes: DataFrame) -> DataFrame:
    """(g, side, band, node, class): nodes of open band values, once for each meeting of blocks.

    side 0 meets side 1; side 2 meets its own group.
    """
    weight = nodes.select("node", (F.col("n") * 8 + HASHES * 4).alias("weight"))
    member = shared.select("value", "band", "node").join(classes, "node", "left").withColumn("class", F.coalesce("root", "node")).drop("root")
    several = member.groupBy("value").agg(F.min("class").alias("c0"), F.max("class").alias("c1")).filter("c0 <> c1").select("value")
    member = stored(member.join(several, "value", "left_semi").join(weight, "node"), "minhash-open")
    per_class = member.groupBy("value", "class").agg(F.sum("weight").alias("w")).withColumn("big", F.col("w") > BLOCK_BYTES // 2)
    parts = F.ceil(F.col("w") / BLOCK_BYTES).cast("int")
    own = per_class.filter("big").select("value", "class", parts.alias("parts"))
    rest = per_class.filter("not big").groupBy("value").agg(F.sum("w").alias("w")).select("value", parts.alias("rest_parts"))
    placed = member.join(own, ["value", "class"], "left").join(rest, "value", "left")
    spread = F.xxhash64("node", "value")
    placed = placed.select("value", "band", "node", "class", F.when(F.col("parts").isNotNull(), F.col("class")).alias("pure"),
                           F.pmod(spread, F.coalesce("parts", "rest_parts")).cast("int").alias("part"))
    blocks_of = own.select("value", F.col("class").alias("pure"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).unionByName(
        rest.select("value", F.lit(None).cast("long").alias("pure"), F.explode(F.sequence(F.lit(0), F.col("rest_parts") - 1)).alias("part")))
    name = F.struct(F.coalesce("pure", F.lit(-1)).alias("pure"), "part")
    one, two = blocks_of.select("value", name.alias("i")), blocks_of.select("value", name.alias("j"))
    # Blocks of one class never meet; a mixed block meets itself.
    meet = one.join(two, "value").filter("i < j and (i.pure <> j.pure or i.pure = -1) or i = j and i.pure = -1")
    meet = meet.select("value", "i", "j", F.xxhash64("value", "i.pure", "i.part", "j.pure", "j.part").alias("g"))
    sides = meet.filter("i = j").select("value", F.col("i").alias("at"), "g", F.lit(2).alias("side")).unionByName(
        meet.filter("i <> j").select("value", F.col("i").alias("at"), "g", F.lit(0).alias("side"))).unionByName(
        meet.filter("i <> j").select("value", F.col("j").alias("at"), "g", F.lit(1).alias("side")))
    return placed.withColumn("at", name).join(sides, ["value", "at"]).select("g", "side", "band", "node", "class")


def _plausible(groups: DataFrame) -> DataFrame:
    """(g, side, node, class) of the rows (with sign) that agree well with one of another class, in their first common band."""
    dealt = groups.repartition("g").sortWithinPartitions("g")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches):
            side, cls, band = (t.column(c).to_numpy() for c in ("side", "class", "band"))
            signs = _matrix(t.column("sign"))
            marked = np.zeros(len(side), bool)
            for i in np.flatnonzero(side != 1).tolist():
                partners = np.flatnonzero(side == 1) if side[i] == 0 else np.arange(i + 1, len(side))
                partners = partners[cls[partners] != cls[i]]
                same = signs[partners] == signs[i]
                good = same.sum(axis=1) >= MIN_AGREE
                if good.any():
                    common = same[good].reshape(-1, BANDS, ROWS).all(axis=2)
                    hit = partners[good][common.argmax(axis=1) == band[i]]
                    marked[hit] = True
                    marked[i] |= len(hit) > 0
            if marked.any():
                at = pa.array(np.flatnonzero(marked))
                yield from t.select(["g", "side", "node", "class"]).take(at).combine_chunks().to_batches()

    return dealt.mapInArrow(run, "g long, side int, node long, class long")


def _confirm_groups(groups: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that join the classes of a group's rows (g, side, node, class, members)."""
    dealt = groups.repartition("g").sortWithinPartitions("g")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches):
            side, cls, node = (t.column(c).to_pylist() for c in ("side", "class", "node"))
            sets = [np.frombuffer(x, np.uint64) for x in t.column("members").to_pylist()]
            parent = {c: c for c in cls}

            def find(c: int) -> int:
                while parent[c] != c:
                    parent[c] = parent[parent[c]]
                    c = parent[c]
                return c

            links = []
            for i in range(len(side)):
                for j in range(len(side)) if side[i] == 0 else range(i + 1, len(side)):
                    if side[i] != 1 and (side[i] == 2 or side[j] == 1) and find(cls[i]) != find(cls[j]) and _linked(sets[i], sets[j], percent):
                        parent[find(cls[i])] = find(cls[j])
                        links.append((node[i], node[j]))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def near_duplicates(df: DataFrame, width: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_shingles, component_id, kept) for each row; component_id: the smallest key reachable by links."""
    kind = df.schema[key].dataType
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    sets = stored(_sets(rows, width), "minhash-sets")
    one = sets.filter("set_id is not null").groupBy("set_id").agg(
        F.min("key").alias("key"), F.first("n").alias("n"), F.first("sign").alias("sign"), F.count(F.lit(1)).alias("n_rows"))
    nodes = stored(one.withColumn("node", F.monotonically_increasing_id()), "minhash-nodes")
    signed_rows, sets = sets, stored(sets.select("key", "n", "set_id"), "minhash-rows")
    release(signed_rows)

    bands = _bands(nodes)
    hubs = bands.groupBy("value").agg(F.min("node").alias("hub"), F.max("node").alias("other")).filter("hub <> other").select("value", "hub")
    shared = stored(bands.join(hubs, "value"), "minhash-shared")
    star = stored(shared.filter("node <> hub").select("node", "hub").distinct(), "minhash-star")
    signs = nodes.select("node", "sign")
    hub_signs = star.groupBy("hub").agg(F.count(F.lit(1)).alias("n_pairs")).join(signs.withColumnRenamed("node", "hub").withColumnRenamed("sign", "hub_sign"), "hub")
    signed = join_heavy(star, hub_signs, "hub", "n_pairs", star.count()).join(signs, "node")
    agree = _agreement(signed).filter(F.col("agree") >= MIN_AGREE)
    best = stored(agree.groupBy("node").agg(F.max_by("hub", F.struct("agree", "hub")).alias("hub")), "minhash-best")

    keys = nodes.select("set_id", "node", "key")
    wanted = best.select("node").unionByName(best.select(F.col("hub").alias("node"))).distinct()
    whole = stored(_whole_sets(rows, keys, wanted, width), "minhash-whole")
    links = stored(_confirm(best, whole, percent), "minhash-links")
    release(star, best, whole)
    classes = components(links)

    opened = stored(_open_groups(shared, nodes, classes), "minhash-groups")
    release(shared)
    marked = stored(_plausible(opened.join(signs, "node").select("g", "side", "band", "class", "node", "sign")), "minhash-marked")
    release(opened)
    if marked.limit(1).count():
        more = _whole_sets(rows, keys, marked.select("node").distinct(), width)
        found = stored(_confirm_groups(marked.join(more, "node"), percent), "minhash-more")
        classes = components(links.unionByName(found))

    named = nodes.join(classes, "node", "left").select("set_id", "key", "n_rows", F.coalesce("root", "node").alias("class"))
    lowest = named.groupBy("class").agg(F.min("key").alias("lowest"), F.count(F.lit(1)).alias("n_nodes"))
    n_nodes = nodes.count()
    per_set = join_heavy(named, lowest, "class", "n_nodes", n_nodes).select("set_id", "lowest", "n_rows")
    out = join_heavy(sets.select("key", "n", "set_id"), per_set, "set_id", "n_rows", sets.count())
    component = F.when(F.col("set_id").isNull(), F.col("key")).otherwise(F.col("lowest")).cast(kind)
    return out.select(F.col("key").cast(kind).alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("key").cast(kind).eqNullSafe(component).alias("kept"))
