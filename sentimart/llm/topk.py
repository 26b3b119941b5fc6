"""Exact top-k inner products over norm-sorted vectors with SVD-rotated partial sums.

1. The second-moment matrix of all vectors (d x d, summed in each task before it leaves it) gives the rotation
   that puts most of every inner product into the first coordinates.
2. Vectors are range-partitioned by descending length and packed into blocks of up to BLOCK rows; a block knows its
   greatest length. Queries are packed likewise, QUERIES to a block.
3. Query blocks meet the vector blocks in rounds: first the FIRST blocks with the longest vectors, then, in the order of
   lengths, as many as GROWTH times those met so far. After each round a query's k-th best score bounds its final
   one from below, so a block far down hands on only what beats a large part of all vectors: the rows made grow with
   the logarithm of the number of blocks.
4. A query block meets a block only if the block's greatest length times a query's length reaches that query's bound;
   as lengths fall, the tail of the blocks is skipped. Inside, a pair survives only if its head product plus the
   product of the residual lengths (Cauchy-Schwarz) reaches the bound; survivors get their exact integer score.
5. The k best of each query from each block are merged with those so far by a window that keeps k rows per task before
   its shuffle.

Bounds are widened by a relative slack above the rounding of doubles, so no tie is lost. Products whose lengths
multiply to under 2**53 are exact in doubles; others are computed in 64-bit integers (and wrap beyond them).
Cases: vectors that are null, empty, of another length than the most common one (ties: the longer), or that hold
null or non-finite components take no part, nor do null ids; repeated ids are rows of their own, except that no row
meets a query of its id (queries of one id share one list); score ties go to the smaller id; an empty table gives an empty table. Only the named columns are read, so
further columns may have any name. A task holds one query block, one vector block and their scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentimart.llm.scratch import stored

BLOCK = 4096
QUERIES = 256
#: Rotated coordinates summed before the first pruning.
HEAD = 16
#: Longest blocks, which give the first bounds, and by how much the blocks met grow from round to round.
FIRST, GROWTH = 4, 4
#: Groups into which the blocks are dealt to meet query blocks through an equi-join.
DEALT = 16
SLACK = 1e-9


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component as integers; null for a vector that takes no part."""
    bad = vector.isNull() | (F.size(vector) < 1) | F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~F.coalesce(bad, F.lit(True)), F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")))


SCHEMA = "query_id long, id long, score long"


def _rows(values: pd.Series) -> np.ndarray:
    return np.stack(values.to_numpy()).astype(np.int64)


def _rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of all vectors, strongest first: a width x width matrix."""

    def moment(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for part in parts:
            if len(part):
                x = _rows(part["v"]).astype(np.float64)
                total += x.T @ x
        yield pd.DataFrame({"i": np.repeat(np.arange(width), width), "j": np.tile(np.arange(width), width), "s": total.ravel()})

    sums = vectors.select("v").mapInPandas(moment, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).toPandas()
    total = np.zeros((width, width))
    total[sums["i"], sums["j"]] = sums["s"]
    _, axes = np.linalg.eigh((total + total.T) / 2)
    return np.ascontiguousarray(axes[:, ::-1])


def _packed(vectors: DataFrame, size: int) -> DataFrame:
    """(most, ids, ints): up to `size` vectors a row, in the order of the partition; most: their greatest length."""

    def pack(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for at in range(0, len(part), size):
                own = part.iloc[at : at + size]
                x = _rows(own["v"])
                yield pd.DataFrame({"most": [float(np.sqrt((x.astype(np.float64) ** 2).sum(1)).max())], "ids": [own["id"].to_numpy(np.int64).tobytes()], "ints": [x.tobytes()]})

    return vectors.select("id", "v").mapInPandas(pack, "most double, ids binary, ints binary")


class _Vectors:
    def __init__(self, ids: bytes, ints: bytes, rotation: np.ndarray, head: int):
        self.ids = np.frombuffer(ids, np.int64)
        self.ints = np.frombuffer(ints, np.int64).reshape(len(self.ids), -1)
        self.x = self.ints.astype(np.float64)
        turned = self.x @ rotation
        self.head = turned[:, :head]
        self.rest = np.sqrt((turned[:, head:] ** 2).sum(1))
        self.length = np.sqrt((self.x**2).sum(1))


def _best(q: _Vectors, x: _Vectors, bound: np.ndarray, k: int) -> pd.DataFrame:
    """The k best pairs of each query that reach its bound."""
    slack = SLACK * (1 + q.length[:, None] * x.length[None, :])
    reach = q.head @ x.head.T + q.rest[:, None] * x.rest[None, :] + slack >= bound[:, None]
    reach &= q.ids[:, None] != x.ids[None, :]
    i, j = np.nonzero(reach)
    if q.length.max() * x.length.max() >= 2.0**53:
        score = (q.ints[i] * x.ints[j]).sum(1)
    elif len(i) > reach.size // 16:
        score = (q.x @ x.x.T)[i, j].astype(np.int64)
    else:
        score = np.einsum("ij,ij->i", q.x[i], x.x[j]).astype(np.int64)
    order = np.lexsort((x.ids[j], -score, i))
    i, j, score = i[order], j[order], score[order]
    first = np.searchsorted(i, np.arange(len(q.ids)))
    keep = np.arange(len(i)) - first[i] < k
    return pd.DataFrame({"query_id": q.ids[i[keep]], "id": x.ids[j[keep]], "score": score[keep]})


def _meet(pairs: DataFrame, rotation: np.ndarray, k: int) -> DataFrame:
    """(query_id, id, score) of the pairs (q_ids, q_ints, q_bounds, ids, ints) of blocks."""
    head = min(HEAD, len(rotation))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for row in part.itertuples(index=False):
                q = _Vectors(row.q_ids, row.q_ints, rotation, head)
                bound = np.full(len(q.ids), -np.inf) if row.q_bounds is None else np.frombuffer(row.q_bounds)
                yield _best(q, _Vectors(row.ids, row.ints, rotation, head), bound, k)

    return pairs.select("q_ids", "q_ints", "q_bounds", "ids", "ints").mapInPandas(run, SCHEMA)


def _bounded(queries: DataFrame, best: DataFrame, k: int) -> DataFrame:
    """Adds to the query blocks their queries' bounds, and the least length of a vector that can reach one of them."""
    bounds = best.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("bound"))

    def ids(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for q, raw in zip(part["q"], part["q_ids"]):
                yield pd.DataFrame({"q": q, "at": np.arange(len(raw) // 8), "id": np.frombuffer(raw, np.int64)})

    # Groups of at most QUERIES rows: one block's queries.
    own = queries.select("q", "q_ids").mapInPandas(ids, "q long, at int, id long").join(bounds, "id", "left")
    lists = own.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce("bound", F.lit(float("-inf"))).alias("bound"))))["bound"].alias("bounds"))

    def attach(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for row in part.itertuples(index=False):
                x = np.frombuffer(row.q_ints, np.int64).reshape(len(row.q_ids) // 8, -1).astype(np.float64)
                length, bound = np.sqrt((x**2).sum(1)), np.array(row.bounds, np.float64)
                with np.errstate(divide="ignore", invalid="ignore"):
                    least = np.where((bound > 0) & (length > 0), bound / length, -np.inf)
                out.append((row.q, row.q_ids, row.q_ints, bound.tobytes(), float(least.min()) * (1 - SLACK)))
            yield pd.DataFrame(out, columns=["q", "q_ids", "q_ints", "q_bounds", "least"])

    return queries.join(lists, "q").select("q", "q_ids", "q_ints", "bounds").mapInPandas(attach, "q long, q_ids binary, q_ints binary, q_bounds binary, least double")


def top_k(df: DataFrame, is_query: Column, k: int = 20, scale: int = 64, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(query_id, rank, <key>, score): the k highest integer inner products of each query row with all other rows."""
    rows = df.select(F.col(key).cast("long").alias("id"), quantised(F.col(vector), scale).alias("v"), is_query.alias("is_query")).filter("id is not null and v is not null")
    rows = stored(rows, "vectors")
    widths = rows.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), F.desc("w")).limit(1).collect()
    width = widths[0]["w"] if widths else 1
    rows = rows.filter(F.size("v") == width)
    rotation = _rotation(rows, width)
    length = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    ordered = rows.withColumn("length", length).repartitionByRange(F.desc("length"), F.asc("id")).sortWithinPartitions(F.desc("length"), F.asc("id"))
    blocks = stored(_packed(ordered, BLOCK).withColumn("block", F.monotonically_increasing_id()), "blocks")
    queries = _packed(ordered.filter("is_query"), QUERIES).select(F.monotonically_increasing_id().alias("q"), F.col("ids").alias("q_ids"), F.col("ints").alias("q_ints"))
    queries = stored(queries, "queries")

    # One small row for each block, so one window over all of them; which blocks meet is found on keys only.
    places = blocks.select("block", "most").withColumn("place", F.row_number().over(Window.orderBy(F.desc("most"), "block")))
    places = stored(places.withColumn("deal", F.pmod(F.xxhash64("block"), F.lit(DEALT))), "places")
    n_blocks, low, high = places.count(), 0, FIRST
    best = None
    asking = queries.select("q", "q_ids", "q_ints", F.lit(None).cast("binary").alias("q_bounds"), F.lit(float("-inf")).alias("least"))
    while True:
        dealt = places.filter((F.col("place") > low) & (F.col("place") <= high))
        asked = asking.select("q", "least", F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1)).cast("array<long>")).alias("deal"))
        pairs = asked.join(dealt, "deal").filter("most >= least").select("q", "block")
        met = _meet(pairs.join(asking.drop("least"), "q").join(blocks.drop("most"), "block"), rotation, k)
        met = met if best is None else met.unionByName(best.drop("rank"))
        first = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
        merged = met.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)
        if high >= n_blocks:
            return merged.select("query_id", "rank", F.col("id").alias(key), "score")
        best = stored(merged, "best")
        asking = stored(_bounded(queries, best, k), "bounded")
        low, high = high, high * GROWTH
