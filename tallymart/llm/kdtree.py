"""Exact top-k inner products with one KD-tree per shard.

Vectors are dealt into shards by a hash of their id. A task holds one shard and
one block of queries: it builds the shard's tree (median splits on the widest
dimension, tight boxes) and walks it best-first for the whole block. A box
bounds the inner product of every point in it (per component the larger of
query times low and query times high); a node is opened only for queries whose
bound can still beat their kth result. Queries first search the shard they live
in, and the kth result found there travels with them to all other shards.

Every query meets every shard, in blocks; the boxes decide how much of a shard
is read. In 64 dimensions of unrelated values they exclude little, the result
is exact all the same. Shards are repeated once per block of `BLOCK` queries
and queries once per shard of `SHARD` vectors.

Defined cases: vectors that are null or hold a null or non-finite component,
and rows without an id, take no part; empty vectors score 0 against each other;
vectors only meet vectors of their own length; of rows that repeat a vec_id the
smallest vector counts; ties go to the smaller vec_id; an empty table gives an
empty result; further columns are ignored. Scores are exact below 2^53.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymart.llm.text import table
from tallymart.session import cut_lineage

SHARD = 16_384
BLOCK = 4_096
LEAF = 128
STEP = 256  # queries that walk a tree together
FOUND = "query_id long, vec_id long, score long"


class Tree:
    """Nodes as arrays; node i covers rows first[i] to last[i] of the sorted points."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf: int = LEAF):
        order = np.arange(len(ids))
        self.first, self.last, self.kids, self.low, self.high, self.least = [], [], [], [], [], []
        todo = [(0, len(ids), -1)] if len(ids) else []
        while todo:
            a, b, parent = todo.pop()
            here, own = len(self.first), order[a:b]
            block = points[own]
            low, high = block.min(axis=0, initial=np.inf), block.max(axis=0, initial=-np.inf)
            self.first.append(a), self.last.append(b), self.kids.append([])
            self.low.append(low), self.high.append(high), self.least.append(ids[own].min())
            if parent >= 0:
                self.kids[parent].append(here)
            if b - a > leaf and points.shape[1] and (high > low).any():
                wide, mid = int(np.argmax(high - low)), (b - a) // 2
                order[a:b] = own[np.argpartition(block[:, wide], mid)]
                todo += [(a, a + mid, here), (a + mid, b, here)]
        self.ids, self.points = ids[order], points[order]
        self.low, self.high = np.array(self.low), np.array(self.high)

    def search(self, query_ids, queries, best: list[list[tuple[int, int]]], k: int) -> None:
        """Improves `best`, per query its k best (-score, vec_id) in order."""
        if not len(self.ids):
            return
        bound = np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T
        kth = np.array([-x[k - 1][0] if len(x) >= k else -np.inf for x in best])
        tie = np.array([x[k - 1][1] if len(x) >= k else 0 for x in best], dtype=np.int64)
        heap = [(-bound[:, 0].max(), 0)]
        while heap:
            _, node = heapq.heappop(heap)
            b = bound[:, node]
            open_ = np.flatnonzero((b > kth) | ((b == kth) & (self.least[node] < tie)))
            if not len(open_):
                continue
            if self.kids[node]:
                for kid in self.kids[node]:
                    heapq.heappush(heap, (-bound[open_, kid].max(), kid))
                continue
            a, z = self.first[node], self.last[node]
            scores = queries[open_] @ self.points[a:z].T
            for r in np.flatnonzero((scores >= kth[open_, None]).any(axis=1)):
                q = open_[r]
                near = np.flatnonzero((scores[r] >= kth[q]) & (self.ids[a:z] != query_ids[q]))
                if len(near) > 4 * k:  # keep whole ties: ids decide among them
                    least = np.partition(scores[r][near], len(near) - k)[len(near) - k]
                    near = near[scores[r][near] >= least]
                new = [(-int(s), int(i)) for s, i in zip(scores[r][near], self.ids[a:z][near], strict=True)]
                best[q] = sorted({*best[q], *new})[:k]
                if len(best[q]) == k:
                    kth[q], tie[q] = -best[q][-1][0], best[q][-1][1]


def _searcher(k: int):
    def run(shard: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(shard) and len(block):
            tree = Tree(shard["vec_id"].to_numpy(np.int64), _matrix(shard["v"]))
            for at in range(0, len(block), STEP):
                part = block.iloc[at:at + STEP]
                ids = part["vec_id"].to_numpy(np.int64)
                known = [[(-int(s), int(i)) for s, i in zip(a, b, strict=True)]
                         for a, b in zip(part["_scores"], part["_ids"], strict=True)]
                best = [list(x) for x in known]
                tree.search(ids, _matrix(part["v"]), best, k)
                for q, before, after in zip(ids, known, best, strict=True):
                    held = set(before)
                    rows += [(q, i, -s) for s, i in after if (s, i) not in held]
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype("int64")

    return run


def _matrix(arrays: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(a, dtype=np.float64) for a in arrays])


def vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v) with integer components, one row per id."""
    usable = F.col("_id").isNotNull() & F.col("_v").isNotNull() & F.forall(
        "_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.select(F.col(id_col).cast("long").alias("_id"),
                     F.col(vec_col).cast("array<double>").alias("_v")).where(usable).select(
        F.col("_id").alias("vec_id"), F.transform("_v", lambda x: F.floor(x * 256)).alias("v"),
    ).groupBy("vec_id").agg(F.min("v").alias("v"))


def _each(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def top_k(points: DataFrame, queries: DataFrame, k: int = 5, shard: int = SHARD,
          block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best points other than itself.

    `points` and `queries` hold (vec_id, v) and are read several times: pass written rows.
    """
    shards = max(1, -(-points.count() // shard))
    blocks = max(1, -(-queries.count() // block))
    queries = queries.select(*[F.col(c).alias(c) for c in ("vec_id", "v")])  # columns of its own
    dim = F.size("v").alias("_dim")
    home = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("_shard")
    part = F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(blocks)).alias("_block")
    none = [F.array().cast("array<bigint>").alias("_scores"), F.array().cast("array<bigint>").alias("_ids")]
    left = points.select("vec_id", "v", dim, home)
    keys = ["_dim", "_shard"]
    first = cut_lineage(
        left.groupBy(*keys).cogroup(queries.select("vec_id", "v", dim, home, *none).groupBy(*keys))
        .applyInPandas(_searcher(k), FOUND))
    best = first.groupBy("query_id").agg(F.sort_array(F.collect_list(
        F.struct((-F.col("score")).alias("s"), F.col("vec_id").alias("i")))).alias("_best"))  # at most k
    known = queries.join(best, F.col("vec_id") == F.col("query_id"), "left").select(
        "vec_id", "v", dim, part, home,
        F.coalesce(F.transform("_best", lambda x: -x["s"]), none[0]).alias("_scores"),
        F.coalesce(F.transform("_best", lambda x: x["i"]), none[1]).alias("_ids"))
    everywhere = _each(shards).alias("_to")
    known = known.select("*", everywhere).where("_to != _shard").drop("_shard").withColumnRenamed(
        "_to", "_shard")
    keys = ["_dim", "_shard", "_block"]
    wide = left.select("*", _each(blocks).alias("_block"))
    rest = wide.groupBy(*keys).cogroup(known.groupBy(*keys)).applyInPandas(_searcher(k), FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return first.unionByName(rest).withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_kd_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = cut_lineage(vectors(table(spark, sf_dir, "embeddings")))
    return top_k(points, points.where("vec_id % 50 = 0"))


ORACLE = """
WITH e AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id
), s AS (
  SELECT q.vec_id AS query_id, p.vec_id,
         list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * p.v[i]))::BIGINT AS score
  FROM e q JOIN e p ON q.vec_id % 50 = 0 AND p.vec_id <> q.vec_id AND len(p.v) = len(q.v)
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank FROM s)
WHERE rank <= 5
"""
