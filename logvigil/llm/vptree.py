"""Approximate nearest neighbours by vantage-point trees, one for each shard.

Largest inner product is turned into a metric: candidates get the coordinate sqrt(M^2 - |x|^2) (M: the largest norm),
queries get 0 there, so that a larger product is a smaller distance. Every candidate is in the tree of one shard; a tree
splits at the median distance from a vantage point and knows the range of distances on both sides. A query leaves out a
side whose gap to its ball, times ``relax``, is beyond its k-th nearest so far. ``relax`` 1 is the triangle inequality,
hence exact; larger values leave out more.

Spark deals shards of about ``shard_rows`` candidates to tasks together with blocks of queries, each task answers the k best
of its shard, and the answers are merged for each query. A tree is searched for all queries of a block at once. Memory of a
task is a shard and a block, whatever the table's size.

Vectors that are null, zero or hold null or non-finite components take no part; nor do those without an id or of another
length than most. Equal rows (same id and vector) are one candidate. An id with different vectors is found once, by the vector that
is nearest to any of the query's vectors, and never by a query of the same id.
An empty table gives an empty result; k above the number of candidates gives all of them.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

LEAF = 128
SEED = 1024  # a query starts with the subtree of about this size that it falls into
ROW_BITS = 16
#: Similarities are compared in steps of 2^-40 of the largest one, so that equal vectors tie in spite of rounding.
STEPS = float(1 << 40)
NONE = np.iinfo(np.int64).min


class Tree:
    """Nodes as (lo, hi) for leaves, else (lo, hi, vantage, left, its range of distances, right, its range); a node is the
    consecutive rows lo .. hi-1 of ``order``. At most 2^16 points."""

    def __init__(self, points: np.ndarray, seed: int = 1):
        self.points, rng = points, np.random.default_rng(seed)
        order = np.arange(len(points))
        self.nodes: list[tuple] = []

        def build(lo: int, hi: int) -> int:
            at = len(self.nodes)
            self.nodes.append(())
            if hi - lo <= LEAF:
                self.nodes[at] = (lo, hi)
                return at
            trial = order[rng.integers(lo, hi, 8)]  # the vantage point that spreads some others most
            sample = points[order[rng.integers(lo, hi, 64)]]
            spread = [np.var(np.sqrt(np.maximum(((sample - points[t]) ** 2).sum(1), 0))) for t in trial]
            v = points[trial[int(np.argmax(spread))]]
            d = np.sqrt(np.maximum(((points[order[lo:hi]] - v) ** 2).sum(1), 0))
            by = np.argsort(d, kind="stable")
            order[lo:hi], d = order[lo:hi][by], d[by]
            mid = (hi - lo) // 2
            left, right = build(lo, lo + mid), build(lo + mid, hi)
            self.nodes[at] = (lo, hi, v, left, d[0], d[mid - 1], right, d[mid], d[-1])
            return at

        build(0, len(points))
        self.order = order
        self.sorted = points[order]

    def search(self, queries: np.ndarray, skip: tuple[np.ndarray, np.ndarray], k: int, relax: float, biggest: float, owner: np.ndarray | None = None) -> np.ndarray:
        """Rows of the k best for each query (-1: none), in no certain order; ties go to the smaller row.

        ``skip``: first and one past the last row never to be returned. ``owner``: only the best row of each owner is returned.
        ``biggest`` is M; distance^2 = |q|^2 + M^2 - 2 q.x.
        """
        scale = STEPS / max(biggest**2, 1e-300)
        low = (1 << ROW_BITS) - 1
        q2 = (queries**2).sum(1) + biggest**2
        best = np.full((len(queries), k), NONE)  # similarity in steps, then the row turned round
        worst = np.full(len(queries), NONE)
        seed = np.full(len(queries), -1)

        def one_each(found: np.ndarray) -> np.ndarray:
            """All but the best entry of an owner are emptied."""
            found = np.sort(found, axis=1)[:, ::-1]
            own = np.where(found == NONE, -1 - np.arange(found.shape[1]), owner[np.minimum(low - (found & low), len(owner) - 1)])
            by = np.argsort(own, axis=1, kind="stable")
            sorted_own = np.take_along_axis(own, by, 1)
            again = np.zeros(own.shape, bool)
            np.put_along_axis(again, by[:, 1:], sorted_own[:, 1:] == sorted_own[:, :-1], 1)
            return np.where(again, NONE, found)

        def scan(lo: int, hi: int, active: np.ndarray) -> None:
            ids = self.order[lo:hi]
            keys = np.rint(queries[active] @ self.sorted[lo:hi].T * scale).astype(np.int64) << ROW_BITS | (low - ids)
            keys[(ids >= skip[0][active][:, None]) & (ids < skip[1][active][:, None])] = NONE
            better = keys.max(1) > worst[active]
            active = active[better]
            if len(active):
                both = np.hstack([best[active], keys[better]])
                top = np.partition(both if owner is None else one_each(both), -k, axis=1)[:, -k:]
                best[active], worst[active] = top, top[:, 0]

        def toward(node: tuple, active: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(((queries[active] - node[2]) ** 2).sum(1), 0))

        def start(at: int, active: np.ndarray) -> None:
            node = self.nodes[at]
            if len(node) == 2 or node[1] - node[0] <= SEED:
                seed[active] = at
                scan(node[0], node[1], active)
                return
            near = toward(node, active) <= (node[5] + node[7]) / 2
            for child, ones in ((node[3], active[near]), (node[6], active[~near])):
                if len(ones):
                    start(child, ones)

        def visit(at: int, active: np.ndarray) -> None:
            active = active[seed[active] != at]
            node = self.nodes[at]
            if not len(active):
                return
            if len(node) == 2:
                scan(*node, active)
                return
            d = toward(node, active)
            for child, lo, hi in (node[3:6], node[6:9]):
                found = worst[active]
                radius = np.sqrt(np.maximum(q2[active] - 2 * ((found >> ROW_BITS) - 1) / scale, 0))
                gap = np.maximum(np.maximum(lo - d, d - hi) - 1e-9, 0)
                visit(child, active[(found == NONE) | (gap * relax <= radius)])

        if len(queries):
            start(0, np.arange(len(queries)))
            visit(0, np.arange(len(queries)))
        return np.where(best == NONE, -1, low - (best & low))


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Distinct (id, v as doubles) of the vectors that take part."""
    v = F.col(vec_col).cast("array<double>")
    fine = F.col(id_col).isNotNull() & v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.filter(F.coalesce(fine, F.lit(False))).select(F.col(id_col).alias("id"), v.alias("v"))
    width = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("v") == (width[0] if width else 0)).distinct()


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, relax: float = 4.0, shard_rows: int = 16_384, block_rows: int = 32_768, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest candidates found for each query, its own id left out."""
    base = stored(usable(vectors, id_col, vec_col).withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))), "vectors")
    asked = base.select("id", "v").join(queries.select(F.col(id_col).alias("id")).distinct(), "id", "left_semi")
    shard_rows = min(shard_rows, 1 << (ROW_BITS - 1))  # rows are numbered in ROW_BITS bits
    n, biggest = base.agg(F.count("*"), F.coalesce(F.max("norm"), F.lit(0.0))).first()
    shards, chunks = max(1, math.ceil(n / shard_rows)), max(1, math.ceil(asked.count() / block_rows))
    key = lambda of, salt: F.pmod(F.xxhash64("id", "v", F.lit(salt)), F.lit(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.lit(of - 1)))
    here = base.select("id", "v", key(shards, 1).alias("shard"), every(chunks).alias("chunk"))
    there = asked.select(F.col("id").alias("qid"), F.col("v").alias("q"), key(chunks, 2).alias("chunk"), every(shards).alias("shard"))

    def answer(candidates: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        if candidates.empty or wanted.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        candidates = candidates.sort_values("id", kind="stable")
        ids, x = candidates["id"].to_numpy(), np.stack(candidates["v"].to_numpy())
        lift = np.sqrt(np.maximum(biggest**2 - (x**2).sum(1), 0))
        tree = Tree(np.hstack([x, lift[:, None]]))
        qid, q = wanted["qid"].to_numpy(), np.stack(wanted["q"].to_numpy())
        own = np.searchsorted(ids, qid), np.searchsorted(ids, qid, side="right")  # all rows of the query's id
        first = np.append(True, ids[1:] != ids[:-1])
        owner = None if first.all() else np.cumsum(first)
        out = []
        for lo in range(0, len(q), 1024):
            part = slice(lo, lo + 1024)
            rows = tree.search(np.hstack([q[part], np.zeros((len(q[part]), 1))]), (own[0][part], own[1][part]), k, relax, biggest, owner)
            r, c = np.nonzero(rows >= 0)
            found = rows[r, c]
            score = (x[found] * q[part][r]).sum(1)
            out.append(pd.DataFrame({"query_id": qid[part][r], "vec_id": ids[found], "score": score}))
        return pd.concat(out, ignore_index=True)

    kind = base.schema["id"].dataType.simpleString()
    found = here.groupBy("shard", "chunk").cogroup(there.groupBy("shard", "chunk")).applyInPandas(answer, f"query_id {kind}, vec_id {kind}, score double")
    # an id of several vectors counts once, by its best; both steps use one exchange by query
    found = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
