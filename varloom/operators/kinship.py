"""Relatedness: allele sharing of all pairs by blocks, linkage pruning and sets of unrelated samples."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varloom.operators.durable import released as durable
from varloom.operators.graphs import connected_components, numbered
from varloom.operators.intervals import position_rank
from varloom.operators.summaries import allele_freq

#: Samples and sites of a block.  A pair of sample blocks holds four numbers for each of its pairs of samples.
BLOCK = (256, 4096)
#: Pairs of calls that a task lists, or holds before it counts them.
HELD_PAIRS = 2_000_000
#: Parts of a stretch's samples, which tasks of window_sums take side by side.
SAMPLE_PARTS = 16
#: Edges of a cover that one task finishes.
LAST_EDGES = 20_000


# ---- allele sharing


def _product(x: Column, n: int) -> Column:
    """x (x - 1) ... of n factors."""
    out = F.lit(1.0)
    for i in range(n):
        out = out * (x - i)
    return out


def expected_sharing(sites: DataFrame) -> DataFrame:
    """One row: the mean probabilities e<i><k> of sharing i alleles by state, given k by descent, over sites (ac, an).

    Products of frequencies such as p^2 q^2 are estimated without bias by draws without replacement from a site's alleles.
    """
    x, n = F.col("an") - F.col("ac"), F.col("an")

    def drawn(p: int, q: int) -> Column:
        return F.try_divide(_product(x.cast("double"), p) * _product(F.col("ac").cast("double"), q), _product(n.cast("double"), p + q))

    made = {
        "e00": 2 * drawn(2, 2),
        "e10": 4 * drawn(3, 1) + 4 * drawn(1, 3),
        "e20": drawn(4, 0) + 4 * drawn(2, 2) + drawn(0, 4),
        "e11": 2 * drawn(2, 1) + 2 * drawn(1, 2),
        "e21": drawn(3, 0) + drawn(2, 1) + drawn(1, 2) + drawn(0, 3),
    }
    return sites.filter("an > 3").agg(*(F.avg(c).alias(name) for name, c in made.items()))


def descent_shares(ibs0: np.ndarray, ibs1: np.ndarray, ibs2: np.ndarray, e: dict[str, float]) -> list[np.ndarray]:
    """z0, z1, z2 by the method of moments, brought back into [0, 1]: the first share above 1 takes all, and shares
    below 0 become 0, one after the other, while the other two keep their ratio."""
    n = ibs0 + ibs1 + ibs2
    with np.errstate(all="ignore"):
        z0 = ibs0 / (e["e00"] * n)
        z1 = (ibs1 - z0 * e["e10"] * n) / (e["e11"] * n)
        z = [z0, z1, (ibs2 - z0 * e["e20"] * n - z1 * e["e21"] * n) / n]
        for high in range(3):
            over = z[high] > 1
            z = [np.where(over, float(k == high), v) for k, v in enumerate(z)]
        for low in range(3):
            under, rest = z[low] < 0, sum(v for k, v in enumerate(z) if k != low)
            z = [np.where(under, 0.0 if k == low else v / rest, v) for k, v in enumerate(z)]
    return z


def _stored(cells: np.ndarray, block: tuple[int, int]) -> bytes:
    """A block's cells (dosage, sample and site in one number): as they are if they are few, else as three bit planes."""
    whole = 3 * block[0] * block[1]
    if 4 * len(cells) < whole // 8:
        return b"c" + cells.astype("<u4").tobytes()
    planes = np.zeros(whole, bool)
    planes[cells] = True
    return b"p" + np.packbits(planes).tobytes()


def _cells(stored: bytes) -> np.ndarray | None:
    return np.frombuffer(stored, "<u4", offset=1).astype(np.int64) if stored[:1] == b"c" else None


def _dense(stored: bytes, block: tuple[int, int]) -> np.ndarray:
    cells, whole = _cells(stored), 3 * block[0] * block[1]
    if cells is None:
        flat = np.unpackbits(np.frombuffer(stored, np.uint8, offset=1), count=whole)
    else:
        flat = np.zeros(whole, np.uint8)
        flat[cells] = 1
    return flat.reshape(3, *block).astype(np.float32)


def shared_counts(left: bytes, right: bytes, block: tuple[int, int]) -> np.ndarray:
    """ibs0, ibs2 and sites called in both, for every pair of samples of two stored blocks of the same sites."""
    a, b = _cells(left), _cells(right)
    size, sites = block
    if a is None or b is None or len(a) * len(b) > 4 * size * size * sites:
        x, y = _dense(left, block), _dense(right, block)
        return np.stack([x[0] @ y[2].T + x[2] @ y[0].T, sum(x[d] @ y[d].T for d in range(3)), x.sum(axis=0) @ y.sum(axis=0).T]).astype(np.float64)
    # few calls: those of a site meet by sorting
    b = b[np.argsort(b % sites, kind="stable")]
    site = b % sites
    starts, stops = np.searchsorted(site, a % sites, "left"), np.searchsorted(site, a % sites, "right")
    times = stops - starts
    i = np.repeat(np.arange(len(a)), times)
    j = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(starts, times)
    u, v = a[i] // sites, b[j] // sites
    pair, far = (u % size) * size + v % size, np.abs(u // size - v // size)
    count = lambda keep: np.bincount(pair[keep], minlength=size * size).reshape(size, size)
    return np.stack([count(far == 2), count(far == 0), count(far >= 0)]).astype(np.float64)


def _planes(rows: DataFrame, block: tuple[int, int]) -> DataFrame:
    """block, part, bits: the calls of a block of samples at a part of the sites, from at (sample), site, dosage.

    Tasks sort their rows and pack one block at a time.
    """

    shape = block

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, held = None, []

        def done() -> pd.DataFrame:
            return pd.DataFrame({"block": [key[0]], "part": [key[1]], "bits": [_stored(np.concatenate(held), shape)]})

        for batch in batches:
            block, part, cell = (batch[c].to_numpy() for c in ("block", "part", "cell"))
            cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(part) != 0)) + 1
            for own in np.split(np.arange(len(batch)), cuts):
                if len(own):
                    here = (int(block[own[0]]), int(part[own[0]]))
                    if key and here != key:
                        yield done()
                        held = []
                    key = here
                    held.append(cell[own])
        if key:
            yield done()

    cell = (F.col("dosage") * shape[0] + F.pmod("at", F.lit(shape[0]))) * shape[1] + F.pmod("site", F.lit(shape[1]))
    placed = rows.select(F.floor(F.col("at") / shape[0]).alias("block"), F.floor(F.col("site") / shape[1]).alias("part"), cell.cast("long").alias("cell"))
    return placed.repartition("block", "part").sortWithinPartitions("block", "part").mapInPandas(pack, "block long, part long, bits binary")


def _block_pairs(planes: DataFrame, last: int, least_shared: int, least: float, e: dict[str, float], shape: tuple[int, int]) -> DataFrame:
    """a, b (sample numbers), counts and shares of the pairs that reach `least`, from products of blocks.

    Each block goes to the pairs of blocks that it is in; a task streams the parts of a pair and adds up its counts.
    """

    def finish(key: tuple, counts: np.ndarray) -> pd.DataFrame:
        ibs0, ibs2, both = counts
        wanted = both >= max(1, least_shared)
        if key[0] == key[1]:
            wanted &= np.triu(np.ones_like(wanted), 1)
        i, j = np.nonzero(wanted)
        seen = [m[i, j] for m in (ibs0, both - ibs0 - ibs2, ibs2)]
        z = descent_shares(*seen, e)
        made = dict(zip(("ibs0", "ibs1", "ibs2"), (x.astype(np.int64) for x in seen))) | dict(zip(("z0", "z1", "z2"), z)) | {"pi_hat": z[1] / 2 + z[2]}
        rows = pd.DataFrame({"a": key[0] * shape[0] + i, "b": key[1] * shape[0] + j} | made)
        return rows[rows["pi_hat"] >= least]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, counts, left = None, None, None
        for batch in batches:
            for i, j, part, side, bits in zip(*(c.to_pylist() for c in batch.columns)):
                if (i, j) != key:
                    if key:
                        yield pa.RecordBatch.from_pandas(finish(key, counts), preserve_index=False)
                    key, counts, left = (i, j), np.zeros((3, shape[0], shape[0])), None
                if side == 0:
                    left = (part, bits)
                if (side == 1 or i == j) and left and left[0] == part:
                    counts += shared_counts(left[1], bits, shape)
        if key:
            yield pa.RecordBatch.from_pandas(finish(key, counts), preserve_index=False)

    high = F.transform(F.sequence(F.col("block"), F.lit(last)), lambda j: F.struct(F.col("block").alias("i"), j.alias("j"), F.lit(0).alias("side")))
    low = F.transform(F.sequence(F.lit(0).cast("long"), F.col("block")), lambda i: F.struct(i.alias("i"), F.col("block").alias("j"), F.lit(1).alias("side")))
    own = F.filter(F.concat(high, low), lambda p: (p["i"] != p["j"]) | (p["side"] == 0))
    pairs = planes.select(F.explode(own).alias("p"), "part", "bits").select("p.i", "p.j", "part", "p.side", "bits")
    ordered = pairs.repartition("i", "j").sortWithinPartitions("i", "j", "part", "side")
    return ordered.mapInArrow(count, "a long, b long, ibs0 long, ibs1 long, ibs2 long, z0 double, z1 double, z2 double, pi_hat double")


def _listed_pairs(rows: DataFrame, buckets: int, least_shared: int, least: float, e: dict[str, float]) -> DataFrame:
    """The same rows as _block_pairs from pairs of calls, for sites that few samples are called at.

    rows: at, site, dosage.  A site's calls meet in one task as four bytes each, sorted by sample; each goes to the bucket
    of its sample with the calls after it, so that a pair of calls moves as four bytes.  A bucket's task counts them up.
    """

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        site, cell = np.zeros(0, np.int64), np.zeros(0, np.uint32)

        def sent(site: np.ndarray, cell: np.ndarray) -> Iterator[pa.RecordBatch]:
            after = np.searchsorted(site, site, "right") - np.arange(len(site)) - 1
            ends = np.cumsum(after)
            start = 0
            while start < len(site):
                stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + HELD_PAIRS, "right")))
                bucket = (cell[start:stop] >> 2).astype(np.int64) % buckets
                order = np.argsort(bucket, kind="stable")
                names, firsts = np.unique(bucket[order], return_index=True)
                made = []
                for own in np.split(order + start, firsts[1:]):
                    times = after[own]
                    others = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(own + 1, times)
                    made.append((cell[own].tobytes(), times.astype("<u4").tobytes(), cell[others].tobytes()))
                columns = [pa.array(names, pa.int64()), *(pa.array(list(c), pa.binary()) for c in zip(*made))]
                yield pa.RecordBatch.from_arrays(columns, names=["bucket", "cells", "times", "others"])
                start = stop

        for batch in batches:
            site = np.concatenate([site, batch.column(0).to_numpy()])
            cell = np.concatenate([cell, batch.column(1).to_numpy().astype("<u4")])
            whole = int(np.searchsorted(site, site[-1])) if len(site) else 0  # the last site may go on in the next batch
            yield from sent(site[:whole], cell[:whole])
            site, cell = site[whole:], cell[whole:]
        yield from sent(site, cell)

    def finish(keys: np.ndarray, n: np.ndarray) -> pd.DataFrame:
        pair, place = np.unique(keys >> np.uint64(2), return_inverse=True)
        counts = np.zeros((3, len(pair)))
        np.add.at(counts, ((keys & np.uint64(3)).astype(int), place), n)
        wanted = counts.sum(axis=0) >= max(1, least_shared)
        pair, (ibs2, ibs1, ibs0) = pair[wanted], counts[:, wanted]
        z = descent_shares(ibs0, ibs1, ibs2, e)
        seen = dict(zip(("ibs0", "ibs1", "ibs2"), (x.astype(np.int64) for x in (ibs0, ibs1, ibs2))))
        rows = pd.DataFrame({"a": (pair >> np.uint64(30)).astype(np.int64), "b": (pair & np.uint64(2**30 - 1)).astype(np.int64)} | seen | dict(zip(("z0", "z1", "z2"), z)) | {"pi_hat": z[1] / 2 + z[2]})
        return rows[rows["pi_hat"] >= least]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held, keys, n = None, [], np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def merged() -> tuple[np.ndarray, np.ndarray]:
            every = np.concatenate([keys, *held])
            times = np.concatenate([n, np.ones(len(every) - len(keys), np.int64)])
            found, place = np.unique(every, return_inverse=True)
            return found, np.bincount(place, times, len(found)).astype(np.int64)

        for batch in batches:
            for at, cells, times, others in zip(*(c.to_pylist() for c in batch.columns)):
                if at != bucket:
                    if bucket is not None:
                        yield pa.RecordBatch.from_pandas(finish(*merged()), preserve_index=False)
                    bucket, held, keys, n = at, [], np.zeros(0, np.uint64), np.zeros(0, np.int64)
                x = np.repeat(np.frombuffer(cells, "<u4"), np.frombuffer(times, "<u4")).astype(np.uint64)
                y = np.frombuffer(others, "<u4").astype(np.uint64)
                far = np.abs((x & np.uint64(3)).astype(np.int8) - (y & np.uint64(3)).astype(np.int8)).astype(np.uint64)
                made = ((x >> np.uint64(2)) << np.uint64(32)) | ((y >> np.uint64(2)) << np.uint64(2)) | far
                held.append(made[x >> np.uint64(2) != y >> np.uint64(2)])
                if sum(map(len, held)) > max(HELD_PAIRS, len(keys)):
                    keys, n = merged()
                    held = []
        if bucket is not None:
            yield pa.RecordBatch.from_pandas(finish(*merged()), preserve_index=False)

    cells = rows.select("site", (F.col("at") * 4 + F.col("dosage")).cast("long").alias("cell"))
    by_site = cells.repartition("site").sortWithinPartitions("site", "cell")
    sent = by_site.mapInArrow(listed, "bucket long, cells binary, times binary, others binary")
    ordered = sent.repartition(max(1, min(buckets, 4096)), "bucket").sortWithinPartitions("bucket")
    return ordered.mapInArrow(count, "a long, b long, ibs0 long, ibs1 long, ibs2 long, z0 double, z1 double, z2 double, pi_hat double")


def ibd_estimate(genotypes: DataFrame, least_maf: float, least: float = 0.0, least_shared: int = 1, block: tuple[int, int] = BLOCK) -> DataFrame:
    """id1, id2, ibs0, ibs1, ibs2, z0, z1, z2, pi_hat of pairs of samples with pi_hat of at least `least`.

    Sites of the frequency count, where both samples are called; pairs with fewer than least_shared such sites are left
    out, and those whose shares cannot be worked out (no expected difference at all).  Where sites have many calls, sample
    blocks are packed into bit planes, and products of planes give the counts of a pair of blocks; where they have few,
    pairs of calls are listed, which grows with the sites.  The way that moves fewer bytes is taken.
    """
    frequencies = durable(allele_freq(genotypes).filter(F.col("maf") >= least_maf).select("variant_id", "ac", "an"))
    found = expected_sharing(frequencies).first()
    e = {k: found[k] if found[k] is not None else math.nan for k in ("e00", "e10", "e20", "e11", "e21")}
    called = genotypes.filter("dosage is not null")
    samples = durable(numbered(called, "sample_id", "at"))
    sites = durable(numbered(frequencies, "variant_id", "site"))
    size = samples.agg(F.max("at").alias("m")).first()["m"]
    rows = called.join(sites, "variant_id").join(samples, "sample_id").select("at", "site", "dosage")
    n = frequencies.agg(F.sum("an").alias("calls"), F.sum(F.col("an").cast("double") * F.col("an")).alias("squares"), F.count("*").alias("sites")).first()
    listed, blocks = (n["squares"] or 0) / 8, (size or 0) // block[0] + 1  # an is twice the calls
    stored = min(2.0 * (n["calls"] or 0), 3 / 8 * blocks * block[0] * n["sites"])
    if 4 * listed <= stored * blocks:
        pairs = _listed_pairs(rows, int(listed / HELD_PAIRS) + 1, least_shared, least, e)
    else:
        pairs = _block_pairs(durable(_planes(rows, block)), blocks - 1, least_shared, least, e, block)
    named = pairs.join(samples.select(F.col("at").alias("a"), F.col("sample_id").alias("s1")), "a").join(samples.select(F.col("at").alias("b"), F.col("sample_id").alias("s2")), "b")
    return named.select(F.least("s1", "s2").alias("id1"), F.greatest("s1", "s2").alias("id2"), "ibs0", "ibs1", "ibs2", "z0", "z1", "z2", "pi_hat")


# ---- linkage pruning


def window_sums(genotypes: DataFrame, ranked: DataFrame, window: int) -> DataFrame:
    """chrom, r1, r2, n, sx, sy, sxy, sxx, syy of pairs of markers less than two windows apart that share samples.

    ranked: variant_id, chrom, r (from 0).  Calls go to the (at most two) stretches of two windows that hold their
    marker.  A task makes a matrix of its samples by the stretch's markers and adds up products of matrices, so that
    pairs of markers meet as sums only; parts of a stretch's samples are summed after it.
    """
    places = 2 * window

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[tuple, np.ndarray] = {}
        rest = None

        def add(rows: pd.DataFrame) -> None:
            # a sample with one call in the stretch is in no pair of markers; most are, where calls are sparse
            first = np.append(True, np.logical_or.reduce([rows[c].to_numpy()[1:] != rows[c].to_numpy()[:-1] for c in ("chrom", "stretch", "sample_id")]))[: len(rows)]
            rows = rows[~(first & np.append(first[1:], True)[: len(rows)])]
            for key, own in rows.groupby(["chrom", "stretch"], sort=False):
                ids, sample = np.unique(own["sample_id"].to_numpy(), return_inverse=True)
                for at in range(0, len(ids), 4096):
                    here = (sample >= at) & (sample < at + 4096)
                    called, x = np.zeros((min(4096, len(ids) - at), places)), np.zeros((min(4096, len(ids) - at), places))
                    called[sample[here] - at, own["place"].to_numpy()[here]] = 1
                    x[sample[here] - at, own["place"].to_numpy()[here]] = own["dosage"].to_numpy()[here]
                    head, hx = called[:, :window], x[:, :window]
                    made = np.stack([head.T @ called, hx.T @ called, head.T @ x, hx.T @ x, (hx * hx).T @ called, head.T @ (x * x)])
                    total[key] = total[key] + made if key in total else made

        def out(keys: list[tuple]) -> Iterator[pd.DataFrame]:
            for key in keys:
                made = total.pop(key)
                i, j = np.nonzero(np.triu(made[0], 1))
                if len(i):
                    chrom, stretch = key
                    values = {n: made[k][i, j].astype(np.int64) for k, n in enumerate(("n", "sx", "sy", "sxy", "sxx", "syy"))}
                    yield pd.DataFrame({"chrom": chrom, "r1": stretch * window + i, "r2": stretch * window + j} | values)

        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            last = rows.iloc[-1]
            open_ = (rows["chrom"] == last["chrom"]) & (rows["stretch"] == last["stretch"]) & (rows["sample_id"] == last["sample_id"])
            rest = rows[open_]  # the last sample may go on in the next batch
            add(rows[~open_])
            yield from out([k for k in total if k != (last["chrom"], last["stretch"])])
        if rest is not None:
            add(rest)
        yield from out(list(total))

    stretch = F.floor(F.col("r") / window)
    placed = genotypes.filter("dosage is not null").join(ranked.select("variant_id", "chrom", "r"), "variant_id")
    placed = placed.withColumn("stretch", F.explode(F.filter(F.array(stretch, stretch - 1), lambda k: k >= 0)))
    rows = placed.select("chrom", "stretch", "sample_id", (F.col("r") - F.col("stretch") * window).cast("int").alias("place"), F.col("dosage").cast("double").alias("dosage"))
    salt = F.floor(F.pmod(F.xxhash64("sample_id"), F.lit(1 << 20)) / F.lit((1 << 20) // SAMPLE_PARTS))
    ordered = rows.repartition("chrom", "stretch", salt).sortWithinPartitions("chrom", "stretch", "sample_id")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    names = ("n", "sx", "sy", "sxy", "sxx", "syy")
    parts = ordered.mapInPandas(sums, f"chrom {kinds['chrom']}, r1 long, r2 long, " + ", ".join(f"{n} long" for n in names))
    return parts.groupBy("chrom", "r1", "r2").agg(*(F.sum(n).alias(n) for n in names))


def linked_markers(genotypes: DataFrame, variants: DataFrame, window: int, step: int, most_r2: float) -> DataFrame:
    """chrom, v1, v2, r2 (the later one's rank, from 0): pairs that meet in a window of so many markers of a chromosome,
    windows starting every `step` markers, and have a squared correlation above most_r2 over samples called at both."""
    ranked = durable(position_rank(variants.select("variant_id", "chrom", "pos"), "variant_id").select("variant_id", "chrom", (F.col("rank") - 1).alias("r")))
    s = window_sums(genotypes, ranked, window).filter(F.col("r2") < F.floor(F.col("r1") / step) * step + window)
    n, sx, sy = (F.col(c).cast("double") for c in ("n", "sx", "sy"))
    top = n * F.col("sxy") - sx * sy
    bottom = (n * F.col("sxx") - sx * sx) * (n * F.col("syy") - sy * sy)
    linked = s.filter((bottom > 0) & (top * top > bottom * (most_r2 * (1 + 1e-12))))
    first, second = (ranked.select("chrom", F.col("r").alias(r), F.col("variant_id").alias(v)) for r, v in (("r1", "v1"), ("r2", "v2")))
    return linked.join(first, ["chrom", "r1"]).join(second, ["chrom", "r2"]).select("chrom", "v1", "v2", "r2")


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """kept (null: not known yet) of each later marker, in order, from its earlier neighbours.

    A neighbour is known from an earlier round or from earlier in this task, which looks back one window only.
    """
    made: dict[tuple, bool | None] = {}
    chrom, marker, place, states, out = None, None, None, [], []

    def close():
        if marker is not None:
            kept = False if any(states) else None if None in states else True
            made[marker] = kept
            out.append((marker, kept))

    for batch in batches:
        for c, v1, reach, v2, r2, known in zip(*(col.to_pylist() for col in batch.columns)):
            if c != chrom:
                close()
                made.clear()
                chrom, marker, place, states = c, None, None, []
            if v2 != marker:
                close()
                marker, place, states = v2, r2, []
                if len(made) > 4 * reach:
                    for old in list(made)[: len(made) - 2 * reach]:
                        del made[old]
            states.append(known if known is not None else made.get(v1))
        if len(out) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array([v for v, _ in out], pa.int64()), pa.array([k for _, k in out], pa.bool_())], names=["variant_id", "kept"])
            out.clear()
    close()
    yield pa.RecordBatch.from_arrays([pa.array([v for v, _ in out], pa.int64()), pa.array([k for _, k in out], pa.bool_())], names=["variant_id", "kept"])


def greedy_markers(variants: DataFrame, links: DataFrame, window: int, most_rounds: int = 1000) -> DataFrame:
    """variant_id of markers kept by the greedy rule in rank order: a marker goes if an earlier kept one is linked to it.

    links: chrom, v1, v2, r2 (rank of v2, the later one).  Ranges of markers are decided side by side.  A round decides all markers
    whose earlier neighbours are decided, in order within each range; what hangs on an undecided marker of another range
    waits for the next round, and ranges become fewer as the undecided do.
    """
    links = durable(links.select("chrom", "v1", "v2", "r2"))
    heads = links.select(F.col("v1").alias("variant_id")).distinct().join(links.select(F.col("v2").alias("variant_id")).distinct(), "variant_id", "left_anti")
    status = durable(heads.withColumn("kept", F.lit(True)))  # markers without earlier neighbours
    left, gone = links, None
    for _ in range(most_rounds):
        known = left.join(status.select(F.col("variant_id").alias("v1"), "kept"), "v1", "left")
        ordered = known.select("chrom", "v1", F.lit(window).alias("reach"), "v2", "r2", "kept").repartitionByRange("chrom", "r2").sortWithinPartitions("chrom", "r2", "v2")
        found = durable(ordered.mapInArrow(_decide, "variant_id long, kept boolean"))
        settled = found.filter("kept is not null")
        dropped = settled.filter("not kept").select("variant_id")
        gone = dropped if gone is None else gone.unionByName(dropped)
        open_ = found.filter("kept is null").select(F.col("variant_id").alias("v2"))
        if not open_.limit(1).count():
            break
        status = durable(status.unionByName(settled))
        left = durable(left.join(open_, "v2", "left_semi"))
    else:
        raise RuntimeError(f"pruning did not come to rest in {most_rounds} rounds")
    return variants.select("variant_id").join(gone, "variant_id", "left_anti")


def ld_prune(genotypes: DataFrame, variants: DataFrame, window: int = 100, step: int = 10, most_r2: float = 0.2) -> DataFrame:
    """variant_id of the markers that greedy pruning keeps, by windows of `window` markers every `step` markers."""
    return greedy_markers(variants, linked_markers(genotypes, variants, window, step, most_r2), window)


# ---- unrelated samples


def related_at(pairs: DataFrame, least: float, value: str = "pi_hat") -> DataFrame:
    return pairs.filter(F.col(value) >= least).select("id1", "id2")


def ranked_preference(samples: DataFrame, listed: DataFrame) -> DataFrame:
    """sample_id, rank: samples that the preference list does not name go before those it names, these in its order."""
    joined = samples.select("sample_id").join(listed.select("sample_id", F.col("rank").cast("double").alias("at")), "sample_id", "left")
    return joined.select("sample_id", F.coalesce("at", F.lit(-1.0)).alias("rank"))


def greedy_nodes(edges: list[tuple], rank: dict) -> list:
    """The greedy cover of a few edges, by a heap whose entries go stale when a degree falls."""
    near: dict = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    heap = [(-len(n), rank.get(v, math.inf), v) for v, n in near.items()]
    heapq.heapify(heap)
    out = []
    while heap:
        degree, place, v = heapq.heappop(heap)
        if not near.get(v) or degree != -len(near[v]):
            continue
        out.append(v)
        for u in near.pop(v):
            near[u].discard(v)
            heapq.heappush(heap, (-len(near[u]), rank.get(u, math.inf), u))
    return out


def _ranks(group: pd.DataFrame) -> dict:
    known = {**dict(zip(group["a"], group["ra"])), **dict(zip(group["b"], group["rb"]))}
    return {k: math.inf if v is None or v != v else v for k, v in known.items()}


def greedy_cover(edges: DataFrame, rank: DataFrame, last_edges: int = LAST_EDGES, most_rounds: int = 10_000) -> DataFrame:
    """node of the vertices that a greedy cover takes: always one of the highest degree, ties to the lower rank, then
    to the smaller node.

    edges: a, b (each pair once); rank: node, rank.  Taking a vertex only lowers its neighbours' degrees, so one that comes
    before all its neighbours is taken before any of them, whatever happens elsewhere.  A round takes all such vertices;
    once no more than last_edges edges are left, one task does the rest, with the same result.
    """
    left, taken = edges.select("a", "b"), None
    for _ in range(most_rounds):
        left = durable(left)
        if left.count() <= last_edges:
            break
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        degree = both.groupBy("a").agg(F.count("*").alias("n")).join(rank.select(F.col("node").alias("a"), "rank"), "a", "left")
        order = degree.select("a", F.struct((-F.col("n")).alias("n"), F.coalesce("rank", F.lit(float("inf"))).alias("rank"), F.col("a").alias("node")).alias("order"))
        order = durable(order)
        near = both.join(order.toDF("b", "other"), "b").groupBy("a").agg(F.min("other").alias("first"))
        own = durable(order.join(near, "a").filter("order < first").select(F.col("a").alias("node")))
        taken = own if taken is None else taken.unionByName(own)
        left = left.join(own.toDF("a"), "a", "left_anti").join(own.toDF("b"), "b", "left_anti")
    else:
        raise RuntimeError(f"the cover was not found in {most_rounds} rounds")
    rest = left.join(rank.toDF("a", "ra"), "a", "left").join(rank.toDF("b", "rb"), "b", "left")
    kind = edges.schema["a"].dataType.simpleString()

    def finish(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"node": greedy_nodes(list(zip(group["a"], group["b"])), _ranks(group))}, dtype=np.int64)

    last = rest.withColumn("last", F.lit(0)).groupBy("last").applyInPandas(finish, f"node {kind}")
    return last if taken is None else taken.unionByName(last)


def _covers(near: dict, budget: int) -> bool:
    """Whether so many vertices can touch all edges: reductions to a kernel, then a bounded search."""
    near = {v: set(n) for v, n in near.items() if n}

    def take(v) -> None:
        for u in near.pop(v, ()):
            near[u].discard(v)
            if not near[u]:
                del near[u]

    changed = True
    while changed and budget >= 0:
        changed = False
        for v in list(near):
            if v not in near:
                continue
            if len(near[v]) > budget:  # its neighbours are too many to be taken in its place
                take(v)
                budget, changed = budget - 1, True
            elif len(near[v]) == 1:  # its only neighbour covers all that it does
                take(next(iter(near[v])))
                budget, changed = budget - 1, True
    if budget < 0:
        return False
    if not near:
        return True
    widest = max(near, key=lambda v: (len(near[v]), v))
    if sum(map(len, near.values())) > 2 * budget * len(near[widest]):
        return False
    if len(near[widest]) == 2:  # only cycles are left
        return _cycles(near) <= budget

    def without(vs) -> dict:
        return {v: n - vs for v, n in near.items() if v not in vs}

    return _covers(without({widest}), budget - 1) or _covers(without(set(near[widest])), budget - len(near[widest]))


def _cycles(near: dict) -> int:
    """The least cover of disjoint cycles: half of each, rounded up."""
    seen, total = set(), 0
    for v in near:
        size, rest = 0, [v]
        while rest:
            u = rest.pop()
            if u not in seen:
                seen.add(u)
                size += 1
                rest += near[u]
        total += -(-size // 2)
    return total


def exact_cover(edges: list[tuple], rank: dict) -> list:
    """The smallest set that touches all edges; of equally small ones, the earliest combination in preference order."""
    near: dict = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    order = sorted(near, key=lambda v: (rank.get(v, math.inf), v))
    size = next(k for k in range(len(order) + 1) if _covers(near, k))
    out = []
    for v in order:  # a vertex that is in no smallest cover with those chosen so far is in none with more chosen either
        rest = {u: n - {v} for u, n in near.items() if u != v}
        if len(out) < size and _covers(rest, size - len(out) - 1):
            out.append(v)
            near = rest
    return out


def unrelated_set(pairs: DataFrame, preference: DataFrame | None = None, exact_up_to: int = 0) -> DataFrame:
    """sample_id of the samples to drop so that no pair is left.

    preference (sample_id, rank) says who goes first among equals; families of up to exact_up_to members get the smallest
    set, larger ones the greedy one.  Only families of that bound are ever one group; larger ones are taken apart in rounds.
    """
    edges = pairs.filter("id1 <> id2").select(F.least("id1", "id2").alias("a"), F.greatest("id1", "id2").alias("b")).distinct()
    edges = durable(edges)
    members = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    rank = members.withColumn("rank", F.lit(float("inf")))
    if preference is not None:
        listed = preference.select(F.col("sample_id").alias("node"), F.col("rank").cast("double").alias("rank"))
        rank = members.join(listed, "node", "left")
    rank = durable(rank)
    if not exact_up_to:
        return greedy_cover(edges, rank).select(F.col("node").alias("sample_id"))
    families = durable(connected_components(edges.toDF("id1", "id2")))
    small = families.groupBy("component").agg(F.count("*").alias("n")).filter(F.col("n") <= exact_up_to).select("component")
    named = durable(edges.join(families, F.col("a") == F.col("node")).join(small.withColumn("small", F.lit(True)), "component", "left").select("component", "a", "b", F.col("small").isNotNull().alias("small")))
    rows = named.filter("small").join(rank.toDF("a", "ra"), "a").join(rank.toDF("b", "rb"), "b")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family, edges, known = None, [], {}

        def dropped() -> list:
            return exact_cover(edges, {k: math.inf if v is None or v != v else v for k, v in known.items()}) if edges else []

        for batch in batches:
            out = []
            for c, a, b, ra, rb in zip(*(col.to_pylist() for col in batch.columns)):
                if c != family:  # the last family may go on in the next batch
                    out += dropped()
                    family, edges, known = c, [], {}
                edges.append((a, b))
                known |= {a: ra, b: rb}
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], names=["sample_id"])
        yield pa.RecordBatch.from_arrays([pa.array(dropped(), pa.int64())], names=["sample_id"])

    # families are small and many, so a task takes them as a stream, not one call for each
    ordered = rows.select("component", "a", "b", "ra", "rb").repartition("component").sortWithinPartitions("component")
    exact = ordered.mapInArrow(each, "sample_id long")
    large = durable(named.filter("not small").select("a", "b"))
    if not large.limit(1).count():
        return exact
    return exact.unionByName(greedy_cover(large, rank).select(F.col("node").alias("sample_id")))


def kinship_drop(genotypes: DataFrame, variants: DataFrame, least_pi_hat: float, least_maf: float, window: int = 100, step: int = 10, most_r2: float = 0.2, least_shared: int = 1) -> tuple[DataFrame, DataFrame]:
    """Pruned markers, and samples to drop: pairs are related from pi_hat on, which the pruned markers' genotypes give,
    and of related samples those with more missing calls go first."""
    kept = durable(ld_prune(genotypes, variants, window, step, most_r2))
    pruned = durable(genotypes.join(kept, "variant_id", "left_semi"))
    missing = pruned.groupBy("sample_id").agg((-F.avg(F.col("dosage").isNull().cast("double"))).alias("rank"))
    related = durable(ibd_estimate(pruned, least_maf, least_pi_hat, least_shared))
    return kept, unrelated_set(related, missing)
