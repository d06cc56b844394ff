"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source should be taken target / source size times on average.  The whole part of that number
is taken outright; the fraction is a probability.  Pivotal rounding pairs fractional documents and moves mass
(words) between them at random until one becomes whole: the pair's expected words stay the same, each document's
expectation too.  Buckets of documents are rounded side by side; each leaves at most one fractional document,
and these residuals meet in a reduction tree, a few buckets to a node, until one is left for a source.  So a
source misses its target by less than the size of one document.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from varloom.llm.common import durable, word_count

#: Documents in a bucket, on average, and residuals that meet in a node of the tree.
BUCKET_ROWS = 2048
FAN_IN = 64
MOST_COPIES = 3


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), most: int = MOST_COPIES) -> DataFrame:
    """source, source_size, target from one row (source, source_size) for each source.

    Sources in code-point order, null last, take the weights in turn and share all sizes; a target stops at
    `most` times its source's size, and the excess goes to the others by weight until none is above.  Sorted by
    the level at which a source fills up, those before the common level are full: one pass of running sums.  Taking more of them
    as full only lowers the level, so the highest one that its own source does not reach is the answer.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    w = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    rows = sizes.withColumn("weight", w).withColumn("full_at", most * F.col("source_size") / F.col("weight"))
    up = Window.orderBy("full_at", F.asc_nulls_last("source"))
    every = Window.partitionBy()
    rows = (
        rows.withColumn("total", F.sum("source_size").over(every))
        .withColumn("filled", F.coalesce(F.sum(most * F.col("source_size")).over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("open_weight", F.sum("weight").over(up.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("total") - F.col("filled")) / F.col("open_weight"))
    )
    level = F.max(F.when(F.col("full_at") >= F.col("level"), F.col("level"))).over(every)
    target = F.least(F.col("weight") * level, (most * F.col("source_size")).cast("double"))
    return rows.select("source", "source_size", target.alias("target"))


def _chance(seed: int, level: int, a: tuple, b: tuple) -> float:
    """A number in [0, 1) that depends on the pair alone, so that reruns agree."""
    told = repr((seed, level, a, b)).encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(told, digest_size=8).digest(), "big") / 2**64


def pivot(sizes: np.ndarray, p: np.ndarray, names: list[tuple], seed: int, level: int) -> tuple[np.ndarray, int]:
    """Rounded probabilities and the index of the one left fractional (-1: none), for documents in a fixed order."""
    p = p.astype(np.float64).copy()
    held = -1
    for i in range(len(p)):
        if sizes[i] <= 0 or p[i] <= 0.0 or p[i] >= 1.0:
            continue
        if held < 0:
            held = i
            continue
        # words that may move from i to held, and from held to i
        a, b = p[held] * sizes[held], p[i] * sizes[i]
        up = min(sizes[held] - a, b)
        down = min(a, sizes[i] - b)
        move = up if _chance(seed, level, names[held], names[i]) * (up + down) < down else -down
        for j, words, edge in ((held, a + move, move), (i, b - move, -move)):
            p[j] = min(1.0, max(0.0, words / sizes[j]))
        # the one that reached its edge is whole exactly, whatever the rounding errors
        if move == up:
            if sizes[held] - a <= b:
                p[held] = 1.0
            else:
                p[i] = 0.0
        elif a <= sizes[i] - b:
            p[held] = 0.0
        else:
            p[i] = 1.0
        if not 0.0 < p[held] < 1.0:
            held = i if 0.0 < p[i] < 1.0 else -1
    return p, held


def mix(
    docs: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), seed: int = 7, keep: tuple[str, ...] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """keep, source, size, source_size, target, copies, taken for every row.

    Size is the number of words (null text: 0).  Rows of size 0 move no words and are taken as
    often as the whole part says.  Null sources form the last source; rows that repeat in all of `keep` and size are
    interchangeable; an empty table gives an empty result.  Other columns are ignored.
    """
    rows = docs.select(*keep, F.col("source").cast("string").alias("source"), word_count(F.col(text)).alias("size"))
    rows = durable(rows)
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("__n"))
    targets = source_targets(per_source.select("source", "source_size"), weights)
    counts = per_source.select("source", F.ceil(F.col("__n") / BUCKET_ROWS).cast("long").alias("__buckets"))
    known = durable(
        targets.alias("t").join(counts.alias("c"), F.expr("t.source <=> c.source")).select("t.source", "source_size", "target", "__buckets")
    )
    ask = rows.alias("d").join(known.alias("t"), F.expr("d.source <=> t.source")).select("d.*", "source_size", "target", "__buckets")
    mean = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    ask = (
        ask.withColumn("__mean", mean)
        .withColumn("copies", F.floor("__mean").cast("int"))
        .withColumn("__p", F.col("__mean") - F.col("copies"))
        .withColumn("__bucket", F.pmod(F.xxhash64(*keep, "size"), F.col("__buckets")))
        .drop("__mean", "__buckets")
    )
    schema = ask.schema
    sort = ["size", *keep]

    def rounded(level: int):
        def one(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values(sort, kind="stable", na_position="last").reset_index(drop=True)
            names = list(group[sort].itertuples(index=False, name=None))
            p, held = pivot(group["size"].to_numpy(np.int64), group["__p"].to_numpy(np.float64), names, seed, level)
            group["copies"] = group["copies"] + (p == 1.0).astype(np.int32)
            group["__p"] = 0.0
            if held >= 0:
                group.loc[held, "__p"] = p[held]
            return group

        return one

    current = durable(ask.groupBy("source", "__bucket").applyInPandas(rounded(0), schema))
    done = current.filter("__p = 0")
    left = current.filter("__p > 0")
    widest = known.agg(F.max("__buckets")).first()[0] or 1
    level = 0
    while widest > 1:
        level += 1
        widest = -(-widest // FAN_IN)
        left = left.withColumn("__bucket", F.floor(F.col("__bucket") / FAN_IN))
        left = durable(left.groupBy("source", "__bucket").applyInPandas(rounded(level), schema))
        done = done.unionByName(left.filter("__p = 0"))
        left = left.filter("__p > 0")
    # the last fraction of a source is decided by itself
    chance = F.pmod(F.xxhash64(*keep, "size", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    last = left.withColumn("copies", F.col("copies") + (chance < F.col("__p")).cast("int"))
    return done.unionByName(last).select(
        *keep, "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken")
    )
