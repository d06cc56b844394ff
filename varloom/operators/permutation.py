"""Permutation tests: rounds that leave settled markers behind, and the largest statistic of every permutation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varloom.functions.hashing import BOUND, seeded
from varloom.operators.durable import durable

#: Statistics that differ by less, relatively, are ties: sums of the same numbers in another order must not decide.
TIE = 1e-9
#: Samples whose hashes under all seeds of a round one task works out.
SAMPLES_A_TASK = 4000
#: Distinct values of a trait up to which a value moves as one byte, its place among them.
LEVELS = 256


def _traits(samples: DataFrame, trait: str) -> DataFrame:
    rows = samples.select("sample_id", F.col(trait).cast("double").alias("y")).filter("sample_id is not null and y is not null")
    return rows.groupBy("sample_id").agg(F.min("y").alias("y"))


def _spread(traits: DataFrame) -> DataFrame:
    """The traits, at rest, in tasks of SAMPLES_A_TASK: a checkpoint of so few bytes is one task, and each row becomes many."""
    traits = durable(traits)
    return traits.repartition(max(1, traits.count() // SAMPLES_A_TASK))


def shuffled(traits: DataFrame, seeds: list[int], parts: int = 256) -> DataFrame:
    """sample_id, ys: the trait (sample_id, y) under a seeded permutation of the samples for each seed, in their order.

    Samples are ranked by hashes of their ids, receivers under seed 0 and donors under each seed.  Ranks come from
    ranks within hash parts plus the sizes of the parts before, so no task sorts all samples; seeds are not 0.
    """
    orders = F.explode(F.array(*(F.struct(F.lit(s).alias("seed"), seeded(F.col("sample_id"), s).alias("o")) for s in (0, *seeds)))).alias("x")
    rows = traits.select("sample_id", "y", orders).select("sample_id", "y", "x.seed", "x.o")
    rows = rows.withColumn("part", F.floor(F.col("o") / float(BOUND) * parts).cast("int"))
    sizes = rows.groupBy("seed", "part").count()  # at most parts rows for each seed
    earlier = Window.partitionBy("seed").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("seed", "part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("seed", "part").orderBy("o", "sample_id"))
    ranked = rows.withColumn("rn", rank).join(F.broadcast(before), ["seed", "part"]).withColumn("rank", F.col("before") + F.col("rn"))
    # a rank's sample and values meet as narrow rows: combined before they move, each would be as wide as the seeds
    met = ranked.select("rank", "sample_id", "seed", "y").repartition("rank").groupBy("rank")
    own = F.max(F.when(F.col("seed") == 0, F.col("sample_id"))).alias("sample_id")
    return met.agg(own, F.array(*(F.max(F.when(F.col("seed") == s, F.col("y"))) for s in seeds)).alias("ys")).select("sample_id", "ys")


def _levels(traits: DataFrame) -> np.ndarray | None:
    """The distinct values of a trait in order, if they are few."""
    found = [r["y"] for r in traits.select("y").distinct().limit(LEVELS + 1).collect()]
    return np.sort(np.array(found, np.float64)) if len(found) <= LEVELS else None


def _packed(values: DataFrame, levels: np.ndarray | None) -> DataFrame:
    """sample_id, ys: the arrays ys as bytes, of places among the levels or of doubles."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            codes = flat if levels is None else np.searchsorted(levels, flat).astype(np.uint8)
            rows = [row.tobytes() for row in codes.reshape(len(batch), -1)] if len(batch) else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=["sample_id", "ys"])

    return values.select("sample_id", "ys").mapInArrow(pack, f"sample_id {values.schema['sample_id'].dataType.simpleString()}, ys binary")


def _statistics(calls: DataFrame, values: DataFrame, count: int, levels: np.ndarray | None) -> DataFrame:
    """variant_id, n, stats: squared correlations of dosage with each of `count` traits, over the called samples.

    A call moves to its marker with its sample's packed traits; tasks sort their calls and add up a marker at a time.
    """

    def finish(ids: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        n, d, dd = sums[:, 0:1], sums[:, 1:2], sums[:, 2:3]
        y, yy, dy = (sums[:, 3 + i * count : 3 + (i + 1) * count] for i in range(3))
        spread = (n * dd - d * d) * (n * yy - y * y)
        top = (n * dy - d * y) ** 2
        stats = np.divide(top, spread, out=np.zeros_like(top), where=spread > 0)
        flat = pa.array(stats.ravel(), pa.float64(), mask=~(spread > 0).ravel())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * count, pa.int32()), flat)
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n[:, 0].astype(np.int64)), lists], names=["variant_id", "n", "stats"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last marker may go on in the next batch
        for batch in batches:
            if not len(batch):
                continue
            ids, d = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy()[:, None]
            codes = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.float64 if levels is None else np.uint8).reshape(len(d), count)
            y = codes if levels is None else levels[codes]
            starts = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
            names, sums = ids[starts], np.add.reduceat(np.hstack([np.ones_like(d), d, d * d, y, y * y, d * y]), starts, axis=0)
            if held is not None and held[0][0] == names[0]:
                sums[0] += held[1][0]
            elif held is not None:
                yield finish(*held)
            if len(names) > 1:
                yield finish(names[:-1], sums[:-1])
            held = names[-1:], sums[-1:].copy()
        if held is not None:
            yield finish(*held)

    rows = calls.join(_packed(values, levels), "sample_id").select("variant_id", F.col("dosage").cast("double").alias("d"), "ys")
    ordered = rows.repartition("variant_id").sortWithinPartitions("variant_id")
    return ordered.mapInArrow(add_up, f"variant_id {calls.schema['variant_id'].dataType.simpleString()}, n long, stats array<double>")


def _observed(genotypes: DataFrame, traits: DataFrame, levels: np.ndarray | None) -> tuple[DataFrame, DataFrame]:
    calls = durable(genotypes.filter("dosage is not null and variant_id is not null").select("variant_id", "sample_id", "dosage").join(traits.select("sample_id"), "sample_id", "left_semi"))
    found = _statistics(calls, traits.select("sample_id", F.array("y").alias("ys")), 1, levels)
    return calls, durable(found.select("variant_id", "n", F.col("stats")[0].alias("stat")).filter("stat is not null"))


def permute_until_settled(genotypes: DataFrame, samples: DataFrame, trait: str, most: int = 10_000, enough: int = 10, per_round: int = 50) -> DataFrame:
    """variant_id, n, stat, exceeding, permutations, p of an adaptive permutation test of dosage and trait.

    stat is their squared correlation over samples with both.  Permutation k (1, 2, ...) gives the trait of all
    samples in the order of seed k.  A marker leaves at the permutation that brings the `enough`-th statistic as
    large as its own: p = enough / permutations.  Markers still open after `most` have
    p = (exceeding + 1) / (most + 1).  A round works out per_round permutations for the open markers only, as sums by
    marker, and the calls read shrink with them.  Markers without variation of dosage or trait are left out;
    a sample listed twice counts once, with its least value; null keys are left out.
    """
    traits = _spread(_traits(samples, trait))
    levels = _levels(traits)
    calls, state = _observed(genotypes, traits, levels)
    none = F.lit(0).cast("long")
    state = state.select("variant_id", "n", "stat", none.alias("exceeding"), none.alias("permutations"), F.lit(False).alias("settled"))
    held = state.count()
    for first in range(1, most + 1, per_round) if held else ():
        seeds = list(range(first, min(first + per_round, most + 1)))
        found = _statistics(calls, shuffled(traits, seeds), len(seeds), levels)
        hits = F.array(*(F.when(F.col("stats")[i] >= F.col("stat") * (1 - TIE), i + 1) for i in range(len(seeds))))
        state = state.join(found.select("variant_id", "stats"), "variant_id", "left").withColumn("hits", F.when(~F.col("settled"), F.filter(hits, lambda x: x.isNotNull())))
        missing = (enough - F.col("exceeding")).cast("int")
        done = F.coalesce(F.size("hits") >= missing, F.lit(False)) & ~F.col("settled")
        state = durable(
            state.select(
                "variant_id", "n", "stat",
                F.when(F.col("settled"), F.col("exceeding")).when(done, F.lit(enough)).otherwise(F.col("exceeding") + F.size("hits")).cast("long").alias("exceeding"),
                F.when(F.col("settled"), F.col("permutations")).when(done, F.lit(first - 1) + F.get("hits", missing - 1)).otherwise(F.lit(seeds[-1])).cast("long").alias("permutations"),
                (F.col("settled") | done).alias("settled"),
            )
        )
        still = state.filter("not settled").select("variant_id")
        left = still.count()
        if not left:
            break
        if 2 * left <= held:
            calls, held = durable(calls.join(still, "variant_id", "left_semi")), left
    p = F.when(F.col("settled"), F.lit(float(enough)) / F.col("permutations")).otherwise((F.col("exceeding") + 1) / F.lit(float(most + 1)))
    return state.select("variant_id", "n", "stat", "exceeding", "permutations", p.alias("p"))


def permute_maxima(genotypes: DataFrame, samples: DataFrame, trait: str, permutations: int = 1000, per_round: int = 50) -> DataFrame:
    """variant_id, n, stat, p_family: the share, with one added above and below, of permutations whose largest
    statistic over all markers is at least the marker's.

    The same statistic, permutations and left-out rows as in permute_until_settled; every marker takes part in every
    permutation.  Only one number for each permutation is kept, so what goes to every task is bounded by their count.
    """
    traits = _spread(_traits(samples, trait))
    levels = _levels(traits)
    calls, observed = _observed(genotypes, traits, levels)
    largest: list[float] = []
    for first in range(1, permutations + 1, per_round):
        seeds = list(range(first, min(first + per_round, permutations + 1)))
        found = _statistics(calls, shuffled(traits, seeds), len(seeds), levels)
        row = found.agg(*(F.max(F.col("stats")[i]) for i in range(len(seeds)))).first()
        largest += [x for x in row if x is not None]
    reached = F.size(F.filter(F.array(*map(F.lit, largest)).cast("array<double>"), lambda x: x >= F.col("stat") * (1 - TIE)))
    return observed.select("variant_id", "n", "stat", ((reached + 1) / F.lit(float(permutations + 1))).alias("p_family"))
