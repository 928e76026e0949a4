"""Exact top-k by inner product with a KD-tree for each shard.

Vectors are dealt to shards of bounded size. A shard's tree splits at the median of its widest
component and keeps the tight box of each node; the largest inner product that a query can have
in a box is the sum over components of the better box side. Best-first traversal opens nodes by
that bound and ends when none can beat the k-th score. In a first round each query searches its
own shard only; the k-th score found is sent along to all other shards as the score to beat.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from orderpulse.llm.common import saved

#: Vectors of a shard, about, queries that meet a shard at once, and vectors of a leaf.
SHARD, QUERIES, LEAF = 8192, 1024, 256
#: Scores up to this size are exact as doubles.
EXACT = 2.0 ** 53
FLOOR = -(1 << 63)


class Tree:
    """KD-tree over the rows of an integer matrix, for inner products."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        self.low, self.high, self.children, self.members = [], [], [], []
        self._grow(np.arange(len(rows)))

    def _grow(self, members: np.ndarray) -> int:
        node, own = len(self.low), self.rows[members]
        low, high = own.min(0), own.max(0)
        self.low.append(low)
        self.high.append(high)
        self.children.append(())
        self.members.append(members)
        if len(members) > LEAF and (high > low).any():
            order = np.argsort(own[:, int((high - low).argmax())], kind="stable")
            half = len(order) // 2
            self.members[node] = None
            self.children[node] = (self._grow(members[order[:half]]),
                                   self._grow(members[order[half:]]))
        return node

    def bound(self, node: int, query: np.ndarray):
        """The largest inner product that a row in the node's box can have with the query."""
        return np.maximum(query * self.low[node], query * self.high[node]).sum()

    def best(self, query: np.ndarray, own_id, k: int, beat: int) -> list[tuple[int, int]]:
        """Up to k (score, id) of at least ``beat``, by score and then smaller id; the row
        with ``own_id`` is left out."""
        found: list[tuple[int, int]] = []  # heap of (score, -id), the worst first
        heap = [(-self.bound(0, query), 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < beat or len(found) == k and -bound < found[0][0]:
                break
            if self.children[node]:
                for child in self.children[node]:
                    heapq.heappush(heap, (-self.bound(child, query), child))
                continue
            members = self.members[node]
            scores, ids = self.rows[members] @ query, self.ids[members]
            floor = max(beat, found[0][0]) if len(found) == k else beat
            kept = np.flatnonzero((scores >= floor) & (ids != own_id))
            for at in kept[np.lexsort((ids[kept], -scores[kept]))][:k].tolist():
                item = (int(scores[at]), -int(ids[at]))
                if len(found) < k:
                    heapq.heappush(found, item)
                elif item > found[0]:
                    heapq.heapreplace(found, item)
        return [(score, -minus) for score, minus in sorted(found, reverse=True)]


def _matrix(vectors) -> np.ndarray:
    """Rows of whole numbers; doubles where all inner products are exact, else Python numbers."""
    rows = np.array([np.asarray(v, float) for v in vectors])
    size = float(np.abs(rows).max(initial=0.0))
    if size * size * rows.shape[1] < EXACT:
        return rows
    return np.array([[int(x) for x in row] for row in rows], object)


def _search(k: int):
    def run(key, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "vec_id", "score"]
        if not len(queries) or not len(rows):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in columns})
        both = _matrix([*rows["vector"], *queries["vector"]])
        tree = Tree(rows["vec_id"].to_numpy(), both[:len(rows)])
        out = []
        for q, own, beat in zip(both[len(rows):], queries["query_id"], queries["beat"]):
            out += [(own, vec, min(max(score, FLOOR), -FLOOR - 1))
                    for score, vec in tree.best(q, own, k, beat if beat > FLOOR else -np.inf)]
        return pd.DataFrame(out, columns=columns).astype("int64")
    return run


def _round(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """The k best of each query among the rows of the same (width, shard) and block."""
    keys = ["width", "shard", "block"]
    return queries.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInPandas(
        _search(k), "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, every: int = 50, k: int = 5, shard: int = SHARD) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the largest inner product for each
    query, from rank 1, ties to the smaller vec_id; fewer if there are fewer rows.

    Components become floor(256 x). Queries are the rows whose vec_id is divisible by
    ``every``; candidates are all rows with another vec_id and as many components. Rows whose
    vec_id or vector is null, or that hold null or non-finite components, take no part; the
    same row twice counts once. Scores beyond 64 bits are held at the limit.
    """
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)
                    & (F.abs(x.cast("double")) < float("inf")))
    scaled = F.transform("embedding", lambda x: x.cast("double") * 256.0)
    # Beyond 2^53 a double is whole; below, floor is a long without loss.
    vector = F.transform(scaled, lambda x: F.when(F.abs(x) < EXACT, F.floor(x).cast("double"))
                         .otherwise(x))
    rows = (vectors.select("vec_id", "embedding")
            .filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
            .filter(F.coalesce(fine, F.lit(False)) & (F.size("embedding") > 0))
            .select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector")).distinct()
            .withColumn("width", F.size("vector")))
    rows = saved(rows, "vectors")
    sizes = rows.groupBy("width").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("vec_id") % every == 0).alias("asked")).select(
        "width", F.ceil(F.col("n") / shard).alias("shards"),
        F.ceil(F.col("asked") / QUERIES).alias("blocks"))
    dealt = rows.join(sizes, "width").withColumn(
        "shard", F.pmod(F.xxhash64("vec_id"), F.col("shards")))
    asked = dealt.filter(F.col("vec_id") % every == 0).select(
        F.col("vec_id").alias("query_id"), "vector", "width", "shards",
        F.col("shard").alias("own"),
        F.pmod(F.xxhash64(F.lit("block"), "vec_id"), F.col("blocks")).alias("block"))
    targets = dealt.filter("blocks > 0").select(
        "vec_id", *(F.col(c).alias(c) for c in ("vector", "width", "shard")),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    first = saved(_round(asked.withColumn("shard", F.col("own")).withColumn(
        "beat", F.lit(FLOOR)), targets, k), "own-shard")
    reached = first.groupBy("query_id").agg(
        F.when(F.count("*") >= k, F.min("score")).otherwise(F.lit(FLOOR)).alias("beat"))
    others = asked.join(reached, "query_id", "left").withColumn(
        "beat", F.coalesce("beat", F.lit(FLOOR))).withColumn("shard", F.explode(F.sequence(
            F.lit(0).cast("long"), F.col("shards") - 1))).filter("shard != own")
    found = first.union(_round(others, targets, k))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.distinct().withColumn("rank", F.row_number().over(best))
            .filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
