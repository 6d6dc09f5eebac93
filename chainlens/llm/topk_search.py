"""Exact top-k inner-product search: a ball tree with branch and bound per shard.

Candidates are dealt by hash into shards of bounded size.  A task builds a
ball tree over its shard and answers blocks of queries: nodes are taken in
order of their best inner-product bound, q.c + |q| r, and a node is left out
for a query once its bound is below that query's current kth score.  The kth
score is shared between shards: a first round answers every query on one
shard, and its kth score is the starting bound in all the others.

The work is queries x candidates by nature; it is dealt as (shard, query
block) pairs through an equi-join on the pair's shard number.

Defined results: vectors that are null or hold null or non-finite components
take no part; vectors of another length than the query's are not compared
with it; ties go to the smaller vec_id; rows of equal vec_id are candidates
of their own, but never for a query of that id; an empty table gives no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chainlens.llm.common import by_value, stored

by_value(__name__)

#: Candidates in a shard, vectors in a leaf, queries in a block.
SHARD_ROWS = 8192
LEAF_ROWS = 256
QUERY_BLOCK = 2048


def quantised(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """(vec_id, v array<double>) with v = floor(scale * x), x as double: whole
    numbers, held as doubles; vectors with null or non-finite components go."""
    x = F.transform(F.col("embedding").cast("array<double>"), lambda e: F.floor(e * scale).cast("double"))
    fine = F.forall(F.col("embedding").cast("array<double>"),
                    lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    return (vectors.where(F.col("embedding").isNotNull() & F.col("vec_id").isNotNull()).where(fine)
            .select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("v")))


class BallTree:
    """Balls around the rows of a matrix; leaves are index ranges of ``order``."""

    def __init__(self, rows: np.ndarray, leaf_rows: int):
        self.rows, self.order = rows, np.arange(len(rows))
        self.lo, self.hi, self.kids, centres, radii = [], [], [], [], []
        todo = [(0, len(rows), -1)]
        while todo:
            lo, hi, parent = todo.pop()
            node = len(self.lo)
            if parent >= 0:
                self.kids[parent].append(node)
            part = rows[self.order[lo:hi]]
            c = part.mean(axis=0)
            # a little room for rounding keeps the bound an upper bound
            r = np.sqrt(((part - c) ** 2).sum(axis=1).max()) * (1 + 1e-9) + 1e-9
            self.lo.append(lo), self.hi.append(hi), self.kids.append([])
            centres.append(c), radii.append(r)
            if hi - lo > leaf_rows and r > 1e-6:
                a = part[((part - c) ** 2).sum(axis=1).argmax()]
                b = part[((part - a) ** 2).sum(axis=1).argmax()]
                side = np.argsort(part @ (a - b), kind="stable")
                self.order[lo:hi] = self.order[lo:hi][side]
                mid = (lo + hi) // 2
                todo += [(lo, mid, node), (mid, hi, node)]
        self.centres, self.radii = np.array(centres), np.array(radii)

    def search(self, ids: np.ndarray, q_ids: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int):
        """Top k (scores, ids) of every query, -inf and -1 where fewer; nothing
        below ``floor`` need be found."""
        best = np.full((len(q), k), -np.inf)
        best_id = np.full((len(q), k), -1, dtype=np.int64)
        kth = floor.copy()
        norm = np.sqrt((q ** 2).sum(axis=1))
        bound = lambda node: (q @ self.centres[node] + norm * self.radii[node]) * 1.0 + 1e-6
        heap = [(-np.inf, 0, bound(0))]
        while heap:
            _, node, ub = heapq.heappop(heap)
            live = np.flatnonzero(ub >= kth)  # ties may still hold a smaller id
            if not len(live):
                continue
            if self.kids[node]:
                for kid in self.kids[node]:
                    kid_ub = np.minimum(ub, bound(kid))
                    heapq.heappush(heap, (-(kid_ub - kth)[live].max(), kid, kid_ub))
                continue
            at = self.order[self.lo[node]:self.hi[node]]
            s = q[live] @ self.rows[at].T
            s[q_ids[live][:, None] == ids[at][None, :]] = -np.inf
            all_s = np.hstack([best[live], s])
            all_id = np.hstack([best_id[live], np.where(np.isinf(s), -1, np.broadcast_to(ids[at], s.shape))])
            # by score, ties to the smaller id
            o = np.lexsort((all_id, -all_s), axis=1)[:, :k]
            best[live], best_id[live] = np.take_along_axis(all_s, o, 1), np.take_along_axis(all_id, o, 1)
            kth[live] = np.maximum(floor[live], best[live][:, -1])
        return best, best_id


def _answer(k: int, leaf_rows: int, with_floor: bool):
    def run(key, shard: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(shard) and len(queries):
            rows, ids = np.stack(shard.v.to_numpy()), shard.vec_id.to_numpy()
            tree = BallTree(rows, leaf_rows)
            q, q_ids = np.stack(queries.v.to_numpy()), queries.query_id.to_numpy()
            floor = queries.kth.fillna(-np.inf).to_numpy() if with_floor else np.full(len(q), -np.inf)
            score, found = tree.search(ids, q_ids, q, floor, k)
            keep = found >= 0
            out = {"query_id": np.repeat(q_ids, keep.sum(axis=1)), "vec_id": found[keep], "score": score[keep].astype(np.int64)}
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])
    return run


HITS = "query_id long, vec_id long, score long"


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, shard_rows: int = SHARD_ROWS,
          leaf_rows: int = LEAF_ROWS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of ``vectors`` for every row
    of ``queries`` (both vec_id, v), a query's own id left out."""
    vectors = stored(vectors.withColumn("dim", F.size("v")), "topk-vectors")
    queries = queries.select(F.col("vec_id").alias("query_id"), "v", F.size("v").alias("dim"))
    n, n_q = vectors.count(), queries.count()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-n_q // query_block))
    c = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    q = queries.withColumn("block", F.pmod(F.xxhash64("query_id", F.lit(1)), F.lit(blocks)).cast("int"))

    home = (F.col("block") % shards).cast("int")

    def on(cand, quer, with_floor):
        # one group: a shard and a block of queries, both of bounded size
        cand = (cand.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
                .where((F.col("shard") != home) if with_floor else (F.col("shard") == home)))
        keys = ["dim", "shard", "block"]
        return cand.groupBy(*keys).cogroup(quer.groupBy(*keys)).applyInPandas(_answer(k, leaf_rows, with_floor), HITS)

    # first round: every query on the shard after its block's number, for a kth score to share
    first = stored(on(c, q.withColumn("shard", home), False), "topk-first")
    kth = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("kth")).where(F.col("n") >= k)
    rest = (q.join(kth.select("query_id", F.col("kth").cast("double").alias("kth")), "query_id", "left")
            .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
            .where(F.col("shard") != home))
    hits = first.unionByName(on(c, rest, True)) if shards > 1 else first
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
