"""Exact top-k by inner product: a KD-tree per shard, searched best-first under a propagated k-th score.

The vectors are dealt into shards by a hash of their id and the queries into blocks; every (shard, block) pair
is one group.  Its task builds a KD-tree over the shard (median splits on the widest dimension, every node with
its tight bounding box) and walks it best-first for all queries of the block at once: each query opens the open
node whose box allows the highest inner product, until no open box reaches its k-th best score.  That k-th score
starts at a bound found beforehand on a small set of seed vectors, travels with the query into every shard, and
rises as leaves are scanned.  Each shard returns at most k rows for a query; a window keeps the best k of all.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from varloom.llm.common import durable

LEAF = 64
#: Values in the seed set that is broadcast: rows x dimensions at most.
SEED_VALUES = 65_536
NONE = np.iinfo(np.int64).min


@dataclass
class Tree:
    """Nodes in order of creation; leaves hold rows start..stop of `order`, inner nodes two children."""

    order: np.ndarray
    low: np.ndarray
    high: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    left: np.ndarray
    right: np.ndarray


def build(vectors: np.ndarray, leaf: int = LEAF) -> Tree:
    order = np.arange(len(vectors))
    low, high, start, stop, left, right = [], [], [], [], [], []
    todo = [(0, len(vectors), -1, False)]
    while todo:
        a, b, parent, is_right = todo.pop()
        node = len(start)
        if parent >= 0:
            (right if is_right else left)[parent] = node
        own = vectors[order[a:b]]
        lo, hi = own.min(axis=0), own.max(axis=0)
        low.append(lo), high.append(hi), start.append(a), stop.append(b), left.append(-1), right.append(-1)
        if b - a > leaf and own.shape[1] and (hi > lo).any():
            middle = (b - a) // 2
            split = np.argpartition(own[:, np.argmax(hi - lo)], middle)
            order[a:b] = order[a:b][split]
            todo += [(a, a + middle, node, False), (a + middle, b, node, True)]
    return Tree(order, np.array(low), np.array(high), *(np.array(x) for x in (start, stop, left, right)))


def better(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's k first by score downwards, then id upwards."""
    at = np.lexsort((ids, -scores), axis=-1)[:, :k]
    return np.take_along_axis(scores, at, 1), np.take_along_axis(ids, at, 1)


def search(
    vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, kth: np.ndarray, k: int, exact=np.float64
) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids (rows of queries x k; NONE where fewer) that reach each query's propagated k-th score.

    A query's candidates are all vectors but the one with its own id.  Missing bounds are -inf.
    """
    tree = build(vectors)
    v, q = vectors.astype(exact), queries.astype(exact)
    positive, negative = np.maximum(q, 0), np.minimum(q, 0)
    bound = positive @ tree.high.T.astype(exact) + negative @ tree.low.T.astype(exact)
    floor = -np.inf if exact is np.float64 else -(1 << 8192)
    top = np.full((len(q), k), floor, dtype=exact)
    top_ids = np.full((len(q), k), np.iinfo(np.int64).max)
    kth = kth.astype(exact)
    open_ = np.zeros(bound.shape, dtype=bool)
    open_[:, 0] = True
    active = np.arange(len(q))
    while len(active):
        rest = np.where(open_[active], bound[active], floor)
        node = rest.argmax(axis=1)
        best = rest[np.arange(len(active)), node]
        # a box that only equals the k-th score may still hold a tie with a smaller id
        go = open_[active, node] & (best >= kth[active])
        active, node = active[go], node[go]
        open_[active, node] = False
        inner = tree.left[node] >= 0
        open_[active[inner], tree.left[node[inner]]] = True
        open_[active[inner], tree.right[node[inner]]] = True
        for n in np.unique(node[~inner]):
            asking = active[~inner][node[~inner] == n]
            rows = tree.order[tree.start[n] : tree.stop[n]]
            scores = q[asking] @ v[rows].T
            keep = (scores >= kth[asking, None]) & (own[asking, None] != ids[rows][None, :])
            hit = keep.any(axis=1)
            if hit.any():
                asking = asking[hit]
                scores = np.where(keep[hit], scores[hit], floor)
                found = np.where(keep[hit], ids[rows][None, :], np.iinfo(np.int64).max)
                top[asking], top_ids[asking] = better(
                    np.concatenate([top[asking], scores], 1), np.concatenate([top_ids[asking], found], 1), k
                )
                kth[asking] = np.maximum(kth[asking], top[asking, k - 1])
    return top, top_ids


def arithmetic(*parts: np.ndarray):
    """float64 where every inner product of integers is exact in it, else Python integers."""
    most = [float(np.abs(x).max(initial=0)) for x in parts]
    width = max(1, *(x.shape[1] for x in parts))
    return np.float64 if max(most) ** 2 * width < 2**52 else object


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(x, dtype=np.float64) for x in column]) if len(column) else np.zeros((0, 0))


def integers(x: np.ndarray, kind) -> np.ndarray:
    return x if kind is np.float64 else np.array([[int(y) for y in row] for row in x], dtype=object)


def quantized(vectors: DataFrame, id_column: str, vector_column: str, scale: float) -> DataFrame:
    """at, id, vector of floor(scale * x); `at` numbers the rows in the order of their ids, so that rows that repeat an id
    stay apart and ties by `at` are ties by id."""
    x: Column = F.col(vector_column).cast("array<double>")
    sound = F.forall(x, lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) < F.lit(float("inf"))))

    edge = sys.float_info.max

    def whole(y: Column) -> Column:  # doubles beyond 2^53 are whole already
        return F.when(F.abs(y) < F.lit(2.0**53), F.floor(y).cast("double")).otherwise(y)

    rows = vectors.filter(x.isNotNull() & sound).select(
        F.col(id_column).cast("long").alias("id"), F.transform(x, lambda y: whole(F.least(F.greatest(F.lit(scale) * y, F.lit(-edge)), F.lit(edge)))).alias("vector")
    )
    order = [F.col("id").asc_nulls_last(), F.xxhash64("vector")]
    spread = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return durable(spread.select(F.monotonically_increasing_id().alias("at"), "id", "vector"))


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: float = 64.0,
    shard_rows: int = 2048,
    block_rows: int = 4096,
) -> DataFrame:
    """query_id, rank, vec_id, score of the k highest integer inner products, ties to the smaller id.

    is_query is a condition on the column `id`.  A row without an id is found (as null, last in ties).  Vectors that are null or hold null,
    NaN or infinite components, take no part.  Only vectors of equal length are compared.  Rows that repeat an
    id are rows of their own: each asks, and is found by all rows but itself.  Fewer than k candidates give fewer rows; an
    empty table gives none.  Scores beyond a long are held at its ends.  Other columns are ignored.
    """
    named = quantized(vectors, id_column, vector_column, scale)
    n = named.count()
    rows = named.withColumn("width", F.size("vector"))
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-n // (20 * block_rows)))
    asked = rows.filter(is_query).drop("id")
    # from here on rows go by `at`, which stands for the id
    rows = rows.withColumn("id", F.col("at")).drop("at")
    asked = asked.withColumnRenamed("at", "id").select("id", "vector", "width")

    # bounded seed set: gives every query a first k-th score to carry along
    widest = rows.agg(F.max("width")).first()[0] or 1
    seeds = rows.orderBy(F.xxhash64("id"), "id").limit(max(k + 1, SEED_VALUES // max(1, widest))).toPandas()
    seed_ids = seeds["id"].to_numpy(np.int64)
    by_width = {w: (matrix(g["vector"]), g["id"].to_numpy(np.int64)) for w, g in seeds.groupby("width")} if len(seed_ids) else {}

    def bounded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.reset_index(drop=True)
            kth = np.full(len(batch), -np.inf)
            for width, group in batch.groupby("width"):
                v, ids = by_width.get(width, (np.zeros((0, width)), np.zeros(0, np.int64)))
                q = matrix(group["vector"])
                if len(v) > k and arithmetic(q, v) is np.float64:
                    scores = np.where(group["id"].to_numpy()[:, None] == ids[None, :], -np.inf, q @ v.T)
                    kth[group.index] = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
            yield batch.assign(kth=kth)

    asked = asked.mapInPandas(bounded, "id long, vector array<double>, width int, kth double")
    pair = [
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(shards)).cast("int").alias("shard"),
    ]
    stored = rows.select("id", "vector", "width", *pair)
    asking = asked.select(
        "id", "vector", "width", "kth",
        F.pmod(F.xxhash64("id", F.lit(2)), F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
    )

    def one_pair(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype=np.int64)]
        if not len(left) or not len(right):
            return out[0]
        v, q = matrix(left["vector"]), matrix(right["vector"])
        kind = arithmetic(v, q)
        kth = right["kth"].to_numpy(np.float64)
        if kind is object:
            kth = np.array([-(1 << 8192) if np.isinf(x) else int(x) for x in kth], dtype=object)
        own = right["id"].to_numpy(np.int64)
        top, ids = search(integers(v, kind), left["id"].to_numpy(np.int64), integers(q, kind), own, kth, k, kind)
        there = ids != np.iinfo(np.int64).max
        scores = top[there]
        if kind is object:
            scores = np.array([min(max(int(x), NONE), -NONE - 1) for x in scores], dtype=np.int64)
        at = np.broadcast_to(own[:, None], ids.shape)[there]
        return pd.DataFrame({"query_id": at, "vec_id": ids[there], "score": scores.astype(np.int64)})

    found = (
        stored.groupBy("shard", "block", "width")
        .cogroup(asking.groupBy("shard", "block", "width"))
        .applyInPandas(one_pair, "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    ids = named.select("at", "id")
    best = best.join(ids.toDF("query_id", "asked"), "query_id").join(ids.toDF("vec_id", "found"), "vec_id")
    return best.select(F.col("asked").alias("query_id"), "rank", F.col("found").alias("vec_id"), "score")


ORACLE = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
), s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.r <> c.r AND q.vec_id % 20 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
