"""Exact tests, quantiles, mixtures and annotation rules against plain versions."""

import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest

from varloom.operators import equilibrium, graphs, joins, statistics, summaries


def plain_p(a, h, b, mid=False):
    n, minor = a + h + b, h + 2 * min(a, b)
    logs = {}
    for x in range(minor % 2, minor + 1, 2):
        r = (minor - x) // 2
        logs[x] = x * math.log(2) - sum(math.lgamma(k + 1) for k in (x, r, n - x - r))
    top = max(logs.values())
    w = {x: math.exp(v - top) for x, v in logs.items()}
    total = sum(v for v in w.values() if v <= w[h] * (1 + 1e-7))
    return (total - (w[h] / 2 if mid else 0)) / sum(w.values())


def test_equilibrium_p():
    for triple in [*itertools.product(range(6), repeat=3), (50, 57, 14), (1469, 138, 5), (0, 1000, 0), (30_000, 900, 60), (5, 0, 100_000)]:
        if sum(triple):
            for mid in (False, True):
                assert equilibrium.exact_p(*triple, mid) == pytest.approx(plain_p(*triple, mid), rel=1e-9, abs=1e-12), triple


def test_equilibrium_rows(spark):
    rows = [(1, 0), (1, 1), (1, 2), (2, 0), (2, 0), (3, None), (4, 1)] + [(5, None)]
    genotypes = spark.createDataFrame([(i, v, d) for i, (v, d) in enumerate(rows)], "sample_id long, variant_id long, dosage int")
    got = {r.variant_id: r.p for r in summaries.hardy_weinberg(genotypes).collect()}
    assert got[3] is None and got[5] is None and got[2] == 1.0 and got[1] == pytest.approx(plain_p(1, 1, 1)) and got[4] == pytest.approx(plain_p(0, 1, 0))


def test_quantiles(spark):
    rng = random.Random(1)
    rows = [(g, rng.choice([rng.random(), round(rng.random(), 1), None])) for g, n in (("a", 3), ("b", 40), ("c", 5000), ("d", 1)) for _ in range(n)] + [("d", 2.5), ("a", 0.25)]
    shares = [0.0, 0.001, 0.1, 0.5, 0.77, 1.0]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {(r.g, r.share): r.value for r in statistics.exact_quantiles(df, "x", shares, "g").collect()}
    for g in "abcd":
        x = [v for k, v in rows if k == g and v is not None]
        for q in shares:
            assert got[g, q] == pytest.approx(np.quantile(x, q), abs=1e-12), (g, q)
    assert statistics.exact_median(df.filter("x > 9"), "x") is None


def test_vectorised_tails():
    x = np.concatenate([np.linspace(0, 12, 400), [0.0, 1.9999, 2.0, 26.0]])
    assert statistics.erfc(x) == pytest.approx([math.erfc(v) for v in x], rel=1e-12)
    assert np.isnan(statistics.erfc(np.array([np.nan]))).all()
    values = [0.1, 0.5, 1.0, 3.7, 10.0, 250.5]
    assert statistics.log_gamma(values) == pytest.approx([math.lgamma(v) for v in values], rel=1e-12, abs=1e-12)
    t, n = np.array([0.0, 1.0, 2.0, -3.0]), 1  # one degree of freedom: Cauchy
    assert statistics.beta_tail(n / (n + t * t), n / 2, 0.5) == pytest.approx(1 - 2 * np.arctan(np.abs(t)) / math.pi, abs=1e-12)
    assert statistics.student_p.func(pd.Series([1.0, None, 2.0]), pd.Series([2.0, 2.0, 0.0])).isna().tolist() == [False, True, True]


def plain_mixture(x, k, rounds=60):
    n, d = x.shape
    mean, cov = x.mean(axis=0), np.cov(x.T, bias=True).reshape(d, d) + 1e-6 * np.eye(d)
    values, axes = np.linalg.eigh(cov)
    axis = axes[:, -1] * np.sign(axes[np.abs(axes[:, -1]).argmax(), -1])
    parts = [(1 / k, mean + s * math.sqrt(values[-1]) * axis, cov) for s in np.linspace(-1, 1, k)]
    before = -math.inf
    for _ in range(rounds):
        density = np.stack([w / math.sqrt((2 * math.pi) ** d * np.linalg.det(c)) * np.exp(-0.5 * np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)) for w, m, c in parts])
        like = np.log(density.sum(axis=0)).mean()
        share = density / density.sum(axis=0)
        parts = []
        for s in share:
            m = s @ x / s.sum()
            parts.append((s.sum() / n, m, ((x - m) * s[:, None]).T @ (x - m) / s.sum() + 1e-6 * np.eye(d)))
        if like - before < 1e-7:
            break
        before = like
    return parts


def test_recalibration_scores_and_tranches(spark):
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal((0, 0), 1, (700, 2)), rng.normal((4, 3), 0.5, (300, 2))])
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(x)] + [(5000, None, 1.0)]
    sites = spark.createDataFrame(rows, "variant_id long, p double, q double")
    truth = sites.filter("variant_id % 3 <> 0 and variant_id < 1000").select("variant_id")
    got = {r.variant_id: (r.score, r.tranche) for r in graphs.recalibrate_variants(sites, ["p", "q"], truth).collect()}
    assert len(got) == 1000 and 5000 not in got
    z = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    known = np.arange(1000) % 3 != 0
    parts = plain_mixture(z[known], 2)
    density = sum(w / (2 * math.pi * math.sqrt(np.linalg.det(c))) * np.exp(-0.5 * np.einsum("ij,jk,ik->i", z - m, np.linalg.inv(c), z - m)) for w, m, c in parts)
    score = np.log(density)
    assert [got[i][0] for i in range(1000)] == pytest.approx(score.tolist(), abs=1e-5)
    cuts = [(name, np.quantile(score[known], share)) for name, share in ((90.0, 0.1), (99.0, 0.01), (99.9, 0.001))]
    want = [next((name for name, cut in cuts if s >= cut), 100.0) for s in score]
    assert sum(a != got[i][1] for i, a in enumerate(want)) <= 3  # scores at a cut
    none = graphs.recalibrate_variants(sites, ["p", "q"], truth.limit(0)).collect()
    assert len(none) == 1000 and all(r.score is None for r in none)


def test_repeated_annotation_gives_a_whole_record(spark):
    sites = spark.createDataFrame([(1, 5, "A", "G"), (1, 6, "A", "G")], "chrom int, pos long, ref string, alt string")
    source = spark.createDataFrame([(1, 5, "A", "G", "b", "y"), (1, 5, "A", "G", "a", "z"), (1, 5, "A", "G", None, "a")], "chrom int, pos long, ref string, alt string, x string, y string")
    got = {r.pos: (r.x, r.y) for r in joins.annotate_sites(sites, (source, ["x", "y"])).collect()}
    assert got == {5: ("a", "z"), 6: (None, None)}


def test_concordance_totals_and_null_filters(spark):
    calls = spark.createDataFrame([(s, v, (s + v) % 3) for s in (1, 2) for v in (1, 2, 3)], "sample_id long, variant_id long, dosage int")
    variants = spark.createDataFrame([(1, None, "A", "G"), (2, "PASS", "A", "G"), (3, "PASS", "AC", "G")], "variant_id long, filter string, ref string, alt string")
    rows = summaries.genotype_concordance(calls, calls, variants).collect()
    keys = [(r.sample_id, r.type, r.filter, r.all_samples, r.all_types, r.raw) for r in rows]
    assert len(set(keys)) == len(keys)
    n = {k: sum(v for name, v in r.asDict().items() if "__" in name) for k, r in zip(keys, rows)}
    assert n[None, None, None, True, True, True] == 6 and n[None, None, "PASS", True, True, False] == 4
    assert n[1, "SNP", None, False, False, True] == 2 and n[1, "INDEL", "PASS", False, False, False] == 1


def test_ancestry_without_a_large_class(spark):
    rows = spark.createDataFrame([(1, [0.1, 0.2], "x"), (2, [0.3, 0.1], None)], "vec_id long, embedding array<double>, label string")
    assert [(r.ancestry, r.posterior) for r in graphs.ancestry_qda(rows, 2, 0.5).collect()] == [("Other", None)] * 2


def test_prefix_maxima_are_carried_over_ranges(spark):
    from varloom.operators import intervals

    rng = random.Random(6)
    rows = [(c, i, rng.randint(0, 10_000) if rng.random() < 0.9 else None) for c in (1, 2, None) for i in range(400)]
    df = spark.createDataFrame(rows, "chrom int, at long, x long")
    spans = [(c, s, s + rng.choice([0, 5, 60, 900])) for c in (1, 2) for s in (rng.randint(0, 40_000) for _ in range(500))]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r.chrom, r.at): r.top for r in intervals.with_prefix_maximum(df, ["chrom"], ["at"], top="x").collect()}
        merged = sorted(map(tuple, intervals.merge_intervals(spark.createDataFrame(spans, "chrom int, start long, stop long"), 3).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for c in (1, 2, None):
        top = None
        for k, i, x in rows:
            if k == c:
                assert got[c, i] == top
                top = x if top is None else top if x is None else max(top, x)
    want = []
    for c, a, b in sorted((c, max(0, a - 3), b + 3) for c, a, b in spans):
        if want and want[-1][0] == c and a <= want[-1][2]:
            want[-1] = (c, want[-1][1], max(want[-1][2], b))
        else:
            want.append((c, a, b))
    assert merged == want
