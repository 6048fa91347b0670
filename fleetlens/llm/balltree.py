"""Exact top-k inner-product search by ball trees, one tree per shard of the vectors.

The vectors are dealt into shards of a bounded number of rows; each shard builds a ball
tree. For a query q no vector in a ball with centre c and radius r scores more than
q.c + |q| r, so nodes are taken in the order of that bound, and a node is left out for
every query whose k-th best score is above it. The queries come in blocks of a bounded
size, each block meets each shard once, and a block walks a tree together.

The k-th score is shared in two steps: a first wave of a few shards gives each query a
k-th score, which all other shards start from. Only scores that can still matter leave a
shard, so what is merged stays small.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.shared import written

LEAF = 64
SCORES = "query_id long, vec_id long, score long"
_SCHEMA = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


class Ball:
    """A node: the rows ``lo..hi`` of the shard, reordered so that a subtree is a range."""

    __slots__ = ("lo", "hi", "centre", "radius", "parts")

    def __init__(self, x: np.ndarray, order: np.ndarray, lo: int, hi: int):
        self.lo, self.hi = lo, hi
        rows = x[order[lo:hi]]
        self.centre = rows.mean(0)
        away = ((rows - self.centre) ** 2).sum(1)
        # A little more than the true radius: rounding must not cut off a row.
        self.radius = float(np.sqrt(away.max())) * (1 + 1e-9) + 1e-6
        self.parts = ()
        if hi - lo > LEAF and away.max() > 0:
            a = rows[away.argmax()]
            b = rows[((rows - a) ** 2).sum(1).argmax()]
            side = rows @ (b - a)
            order[lo:hi] = order[lo:hi][np.argsort(side, kind="stable")]
            mid = (lo + hi) // 2
            self.parts = (Ball(x, order, lo, mid), Ball(x, order, mid, hi))


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Whole-number inner products; beyond the exact range of doubles, by Python numbers."""
    limit = np.abs(q).sum(1, initial=0).max(initial=0) * np.abs(x).max(initial=0)
    if limit < 2**52:
        return (q @ x.T).astype(np.int64)
    exact = q.astype(object) @ x.astype(object).T
    return np.clip(np.vectorize(int, otypes=[object])(exact), -(2**63), 2**63 - 1).astype(np.int64)


def search(ids: np.ndarray, x: np.ndarray, q_ids: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int) -> list[tuple]:
    """Best rows of a shard for each query: (query, id, score), none below ``floor``.

    Keeps up to k rows a query, ties to the smaller id; a row with the query's id is not
    its candidate.
    """
    order = np.arange(len(x))
    root = Ball(x, order, 0, len(x))
    x, ids = x[order], ids[order]
    length = np.sqrt((q**2).sum(1)) * (1 + 1e-9)
    best: list[list] = [[] for _ in q_ids]
    floor = floor.astype(float).copy()

    def bound(node: Ball, who: np.ndarray) -> np.ndarray:
        return q[who] @ node.centre + length[who] * node.radius + 1.0

    everyone = np.arange(len(q_ids))
    heap = [(-float(bound(root, everyone).max()), 0, root, everyone)]
    made = 1
    while heap:
        _, _, node, who = heapq.heappop(heap)
        who = who[bound(node, who) >= floor[who]]
        if not len(who):
            continue
        if node.parts:
            for part in node.parts:
                high = bound(part, who)
                some = who[high >= floor[who]]
                if len(some):
                    heapq.heappush(heap, (-float(high.max()), made, part, some))
                    made += 1
            continue
        rows = slice(node.lo, node.hi)
        score = _scores(q[who], x[rows])
        for i, w in enumerate(who.tolist()):
            use = np.nonzero((score[i] >= floor[w]) & (ids[rows] != q_ids[w]))[0]
            if len(use):
                new = best[w] + list(zip((-score[i][use]).tolist(), ids[rows][use].tolist()))
                best[w] = heapq.nsmallest(k, new)
                if len(best[w]) == k:
                    floor[w] = max(floor[w], -best[w][-1][0])
    return [(int(q_ids[w]), i, -s) for w in range(len(q_ids)) for s, i in best[w]]


def _floor(x: Column) -> Column:
    """Floor as a double; from 2**53 on every double is whole."""
    return F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)


def whole_numbers(vectors: DataFrame, scale: int) -> DataFrame:
    """``vec_id, v, dim``: floor(scale * x) of every component, as whole doubles.

    Rows with a null id, a null vector or a null or non-finite component are left out.
    """
    x = F.transform("embedding", lambda e: _floor(e.cast("double") * scale))
    usable = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
    usable &= F.forall(
        "embedding", lambda e: F.coalesce(F.abs(e.cast("double")) < float("inf"), F.lit(False))
    )
    return vectors.where(usable).select("vec_id", x.alias("v"), F.size("embedding").alias("dim"))


def _blocks(rows: DataFrame, name: str, size: int) -> DataFrame:
    """Rows in groups of about ``size``: ``dim, <name>, ids, vs``."""
    per_dim = rows.groupBy("dim").agg(F.ceil(F.count("*") / size).cast("long").alias("_n"))
    dealt = rows.join(per_dim, "dim").withColumn(name, F.pmod(F.xxhash64("vec_id"), F.col("_n")))
    lists = dealt.groupBy("dim", name).agg(F.collect_list(F.struct("vec_id", "v")).alias("_r"))
    return lists.select("dim", name, F.col("_r.vec_id").alias("ids"), F.col("_r.v").alias("vs"))


def _meet(shards: DataFrame, blocks: DataFrame, floors: DataFrame | None, k: int) -> DataFrame:
    """Every shard with every block of queries of its dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                at = lambda c: batch.column(c)[i].values  # noqa: E731, B023
                dim = batch.column("dim")[i].as_py()
                grid = lambda c: at(c).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)  # noqa: E731, B023
                ids, q_ids = (at(c).to_numpy(zero_copy_only=False) for c in ("ids", "q_ids"))
                if dim == 0:
                    x, q = np.zeros((len(ids), 0)), np.zeros((len(q_ids), 0))
                else:
                    x, q = grid("vs"), grid("q_vs")
                low = dict(batch.column("floors")[i].as_py() or {})
                floor = np.array([low.get(int(w), -np.inf) for w in q_ids], float)
                found = search(ids, x, q_ids, q, floor, k)
                columns = list(zip(*found)) if found else [[], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_SCHEMA)

    asked = blocks.select("dim", "block", F.col("ids").alias("q_ids"), F.col("vs").alias("q_vs"))
    if floors is None:
        asked = asked.withColumn("floors", F.lit(None).cast("map<bigint,bigint>"))
    else:
        asked = asked.join(floors, ["dim", "block"], "left")
    return shards.join(asked, "dim").repartition("shard", "block").mapInArrow(run, SCORES)


def _best(scores: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    vectors: DataFrame,
    every: int = 100,
    k: int = 10,
    scale: int = 1024,
    shard_rows: int = 4096,
    block_rows: int = 1024,
    first_shards: int = 2,
) -> DataFrame:
    """For each row whose id is divisible by ``every``: its ``k`` best other rows.

    ``query_id, rank, vec_id, score``; scores are whole inner products, ties go to the
    smaller id. Only vectors of one length are compared. Rows that share an id are never
    each other's candidates; a repeated query is asked once, with its smallest vector;
    repeated candidates stay. An empty table gives no rows.
    """
    rows = written(whole_numbers(vectors, scale), "topk-vectors")
    queries = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("dim", "v")).alias("_q"))
    queries = queries.select("vec_id", "_q.v", "_q.dim")
    shards = written(_blocks(rows, "shard", shard_rows), "topk-shards")
    blocks = written(_blocks(queries, "block", block_rows), "topk-blocks")
    first = written(_meet(shards.where(F.col("shard") < first_shards), blocks, None, k), "topk-first")
    floors = (
        _best(first, k)
        .where(F.col("rank") == k)
        .select("query_id", "score")
        .join(blocks.select("dim", "block", F.explode("ids").alias("query_id")), "query_id")
        .groupBy("dim", "block")
        .agg(F.map_from_entries(F.collect_list(F.struct("query_id", "score"))).alias("floors"))
    )
    rest = _meet(shards.where(F.col("shard") >= first_shards), blocks, written(floors, "topk-floors"), k)
    found = _best(first.union(rest), k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
