"""Related samples, pruned markers and unrelated sets against plain versions."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from varloom.operators import kinship


def plain_prune(calls, order, window, step, most_r2):
    """Greedy pruning marker by marker; calls: variant -> {sample: dosage}."""
    kept = []
    for j, v in enumerate(order):
        good = True
        for i in range(max(0, j - window), j):
            u = order[i]
            if i in kept and j < i // step * step + window:
                both = sorted(calls[u].keys() & calls[v].keys())
                x, y = np.array([calls[u][s] for s in both], float), np.array([calls[v][s] for s in both], float)
                if len(both) and x.std() > 0 and y.std() > 0 and np.corrcoef(x, y)[0, 1] ** 2 > most_r2 + 1e-9:
                    good = False
        if good:
            kept.append(j)
    return {order[i] for i in kept}


def table(spark, calls):
    return spark.createDataFrame([(s, v, d) for v, own in calls.items() for s, d in own.items()], "sample_id long, variant_id long, dosage int")


@pytest.mark.parametrize("window,step,rate", [(8, 1, 0.15), (10, 4, 0.3), (25, 10, 0.05)])
def test_pruning_on_chained_chromosomes(spark, window, step, rate):
    """Every marker is linked to the one before, so what is kept hangs on all markers before it."""
    rng = random.Random(window)
    calls, sites, v = {}, [], 0
    for chrom in (1, 2):
        own = {s: rng.randint(0, 2) for s in range(60)}
        for i in range(150):
            own = {s: rng.randint(0, 2) if rng.random() < rate else d for s, d in own.items()}
            calls[v] = {s: d for s, d in own.items() if rng.random() > 0.1}
            sites.append((v, chrom, 10 * i))
            v += 1
    genotypes = table(spark, calls)
    variants = spark.createDataFrame(sites, "variant_id long, chrom int, pos long")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # ranges that wait for each other
    try:
        got = {r.variant_id for r in kinship.ld_prune(genotypes, variants, window, step, 0.3).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = set()
    for chrom in (1, 2):
        want |= plain_prune(calls, [v for v, c, _ in sites if c == chrom], window, step, 0.3)
    assert got == want


def plain_shares(calls_a, calls_b, e):
    both = calls_a.keys() & calls_b.keys()
    n, counts = len(both), [sum(abs(calls_a[v] - calls_b[v]) == d for v in both) for d in (2, 1, 0)]
    z0 = counts[0] / (e[0] * n)
    z1 = (counts[1] - z0 * e[1] * n) / (e[3] * n)
    z = [z0, z1, (counts[2] - z0 * e[2] * n - z1 * e[4] * n) / n]
    for i in range(3):
        if z[i] > 1:
            z = [float(k == i) for k in range(3)]
    for i in range(3):
        if z[i] < 0:
            rest = sum(z[k] for k in range(3) if k != i)
            z = [0.0 if k == i else z[k] / rest for k in range(3)]
    return (*counts, *z, z[1] / 2 + z[2])


@pytest.mark.parametrize("dense", [True, False])
def test_sharing_of_all_pairs(spark, dense):
    rng = random.Random(3)
    founders = [[rng.randint(0, 1) for _ in range(300)] for _ in range(40)]
    people = {s: [founders[2 * s][v] + founders[2 * s + 1][v] for v in range(300)] for s in range(20)}
    people[20] = [founders[0][v] + founders[2][v] for v in range(300)]  # a child of 0 and 1
    people[21] = list(people[5])
    calls = {s: {v: d for v, d in enumerate(own) if rng.random() < (0.9 if dense else 0.2)} for s, own in people.items()}
    genotypes = spark.createDataFrame([(s * 7, v, d) for s, own in calls.items() for v, d in own.items()], "sample_id long, variant_id long, dosage int")
    counts = {v: [d for own in calls.values() for u, d in own.items() if u == v] for v in range(300)}
    used = {v: (2 * len(ds) - sum(ds), sum(ds)) for v, ds in counts.items() if ds and min(sum(ds), 2 * len(ds) - sum(ds)) / (2 * len(ds)) >= 0.1}

    def drawn(p, q):
        out = []
        for x, y in used.values():
            n = x + y
            if n > 3:
                out.append(math.perm(x, p) * math.perm(y, q) / math.perm(n, p + q))
        return np.mean(out)

    e = (2 * drawn(2, 2), 4 * drawn(3, 1) + 4 * drawn(1, 3), drawn(4, 0) + 4 * drawn(2, 2) + drawn(0, 4), 2 * drawn(2, 1) + 2 * drawn(1, 2), drawn(3, 0) + drawn(2, 1) + drawn(1, 2) + drawn(0, 3))
    calls = {s: {v: d for v, d in own.items() if v in used} for s, own in calls.items()}
    for least in (0.0, 0.3):
        want = {}
        for a, b in itertools.combinations(sorted(calls), 2):
            if len(calls[a].keys() & calls[b].keys()) >= 5:
                shares = plain_shares(calls[a], calls[b], e)
                if shares[-1] >= least:
                    want[7 * a, 7 * b] = shares
        got = {(r.id1, r.id2): tuple(r)[2:] for r in kinship.ibd_estimate(genotypes, 0.1, least, 5, (8, 32)).collect()}
        assert got.keys() == want.keys()
        for pair, shares in want.items():
            assert got[pair] == pytest.approx(shares, abs=1e-9)
    if dense:
        assert want[35, 147][-1] > 0.9 and 0.35 < want[0, 140][-1] < 0.65


def plain_greedy(edges, rank):
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    out = set()
    while any(near.values()):
        worst = min((v for v in near if near[v]), key=lambda v: (-len(near[v]), rank.get(v, math.inf), v))
        for other in near.pop(worst):
            near[other].discard(worst)
        out.add(worst)
    return out


def plain_exact(edges, rank):
    nodes = sorted({v for e in edges for v in e}, key=lambda v: (rank.get(v, math.inf), v))
    for size in range(len(nodes) + 1):
        for some in itertools.combinations(nodes, size):
            if all(a in some or b in some for a, b in edges):
                return list(some)


def random_edges(rng, nodes, n):
    return sorted({tuple(sorted(rng.sample(range(nodes), 2))) for _ in range(n)})


def test_greedy_cover_is_the_plain_one(spark):
    """By rounds alone, by rounds and a last task, and by the last task alone."""
    rng = random.Random(8)
    edges = random_edges(rng, 60, 70) + [(200, i) for i in range(201, 240)] + list(itertools.combinations(range(300, 304), 2))
    rank = {v: float(rng.randint(0, 3)) for v in range(50)}
    df = spark.createDataFrame(edges, "a long, b long")
    ranks = spark.createDataFrame(list(rank.items()), "node long, rank double")
    want = plain_greedy(edges, rank)
    for last in (0, 30):
        assert {r.node for r in kinship.greedy_cover(df, ranks, last).collect()} == want
    preference = ranks.withColumnRenamed("node", "sample_id")
    pairs = df.toDF("id1", "id2")
    assert {r.sample_id for r in kinship.unrelated_set(pairs, preference).collect()} == want
    assert {r.sample_id for r in kinship.unrelated_set(pairs.unionByName(pairs.select(F.col("id2").alias("id1"), F.col("id1").alias("id2")))).collect()} == plain_greedy(edges, {})


def test_exact_cover_is_the_first_of_the_smallest():
    rng = random.Random(9)
    for n in range(150):
        edges = random_edges(rng, rng.randint(2, 11), rng.randint(1, 20))
        rank = {v: rng.randint(0, 4) for v in range(8)}
        assert kinship.exact_cover(edges, rank) == plain_exact(edges, rank), edges
    ring = [(i, (i + 1) % 31) for i in range(31)]
    assert len(kinship.exact_cover(ring, {})) == 16


def test_families_by_size(spark):
    rng = random.Random(10)
    small, large = random_edges(rng, 9, 12), [(a + 100, b + 100) for a, b in random_edges(rng, 60, 90)]
    df = spark.createDataFrame(small + large, "id1 long, id2 long")
    got = {r.sample_id for r in kinship.unrelated_set(df, exact_up_to=10).collect()}
    assert {v for v in got if v < 100} | {v for v in got if v >= 100} == got
    assert len({v for v in got if v < 100}) == len(plain_exact(small, {}))
    assert all(a in got or b in got for a, b in small + large)


def test_preference_names_go_last(spark):
    samples = spark.createDataFrame([(1,), (2,), (3,)], "sample_id long")
    listed = spark.createDataFrame([(2, 5.0)], "sample_id long, rank double")
    ranked = kinship.ranked_preference(samples, listed)
    pairs = spark.createDataFrame([(2, 3)], "id1 long, id2 long")
    assert [r.sample_id for r in kinship.unrelated_set(pairs, ranked, exact_up_to=5).collect()] == [3]


def test_no_pairs_and_no_calls(spark):
    none = spark.createDataFrame([], "id1 long, id2 long")
    assert kinship.unrelated_set(none).count() == 0 and kinship.unrelated_set(none, exact_up_to=5).count() == 0
    genotypes = spark.createDataFrame([], "sample_id long, variant_id long, dosage int")
    variants = spark.createDataFrame([(1, 1, 5)], "variant_id long, chrom int, pos long")
    assert kinship.ibd_estimate(genotypes, 0.1).count() == 0
    assert kinship.ld_prune(genotypes, variants).count() == 1


def test_kinship_comes_from_the_genotypes(spark):
    rng = random.Random(2)
    n, markers = 12, 400
    calls = {s: [rng.randint(0, 1) + rng.randint(0, 1) for _ in range(markers)] for s in range(n)}
    calls[7] = list(calls[3])  # the same person twice
    rows = [(s, v, None if s == 7 and v % 20 == 0 else d) for s, own in calls.items() for v, d in enumerate(own)]
    genotypes = spark.createDataFrame(rows, "sample_id long, variant_id long, dosage int")
    variants = spark.createDataFrame([(v, 1, 10_000 * v) for v in range(markers)], "variant_id long, chrom int, pos long")
    kept, gone = kinship.kinship_drop(genotypes, variants, 0.6, 0.05, window=10, step=5, most_r2=0.95)
    assert kept.count() == markers
    assert [r.sample_id for r in gone.collect()] == [7]


def test_few_calls_of_many_samples_are_listed(spark, monkeypatch):
    """Sites with few calls: the pairs of blocks, which grow with the square of the samples, are not made."""
    rng = random.Random(4)
    rows = sorted({(s, 40 * (s // 20) + rng.randrange(40)) for s in range(400) for _ in range(25)})
    genotypes = spark.createDataFrame([(s, v, rng.randint(0, 2)) for s, v in rows], "sample_id long, variant_id long, dosage int")

    def found():
        return {(r.id1, r.id2): tuple(r)[2:] for r in kinship.ibd_estimate(genotypes, 0.1, 0.2, 3, (8, 32)).collect()}

    blocks, listed = kinship._block_pairs, kinship._listed_pairs
    monkeypatch.setattr(kinship, "_listed_pairs", lambda rows, buckets, *rest: blocks(kinship._planes(rows, (8, 32)), 400 // 8, *rest, (8, 32)))
    want = found()
    monkeypatch.setattr(kinship, "HELD_PAIRS", 50)
    monkeypatch.setattr(kinship, "_listed_pairs", lambda rows, buckets, *rest: listed(rows, 7, *rest))
    monkeypatch.setattr(kinship, "_block_pairs", None)
    got = found()
    assert got.keys() == want.keys() and len(got) > 100
    for pair, shares in want.items():
        assert got[pair] == pytest.approx(shares, abs=1e-9)
