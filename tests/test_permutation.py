"""Permutation tests and panel projection against plain versions on small tables."""

import hashlib

import numpy as np
import pytest

from varloom.operators import graphs, permutation, projection


def table(spark, n, m, seed):
    rng = np.random.default_rng(seed)
    g = rng.binomial(2, 0.4, (n, m)).astype(float)
    y = np.round(rng.normal(size=n) + 0.8 * g[:, 0], 2)
    g[rng.random((n, m)) < 0.1] = np.nan
    rows = [(i, j, None if np.isnan(g[i, j]) else int(g[i, j])) for i in range(n) for j in range(m)]
    samples = [(i, None if i % 13 == 5 else float(y[i])) for i in range(n)]
    return g, samples, spark.createDataFrame(rows, "sample_id long, variant_id long, dosage int"), spark.createDataFrame(samples, "sample_id long, trait double")


def orders(samples, seeds):
    """The trait of every sample under each permutation, by plain sorts of the hashes."""
    y = dict(samples)
    place = lambda seed: sorted(y, key=lambda i: (int(hashlib.md5(f"{i}:{seed}".encode()).hexdigest()[:15], 16), i))
    own = place(0)
    return [{a: y[b] for a, b in zip(own, place(s))} for s in seeds]


def squared(g, traits, j):
    pairs = [(g[i, j], traits[i]) for i in traits if not np.isnan(g[i, j])]
    return np.corrcoef(*zip(*pairs))[0, 1] ** 2


@pytest.fixture(scope="module")
def plain(spark):
    g, samples, genotypes, traits = table(spark, 60, 8, 2)
    known = [(i, y) for i, y in samples if y is not None]
    own = [squared(g, dict(known), j) for j in range(8)]
    permuted = np.array([[squared(g, y, j) for j in range(8)] for y in orders(known, range(1, 41))])
    return genotypes, traits, np.array(own), permuted


def test_stopping_early_is_the_whole_permutation_cut_off(spark, plain):
    genotypes, traits, own, permuted = plain
    got = {r.variant_id: r for r in permutation.permute_until_settled(genotypes, traits, "trait", most=40, enough=3, per_round=7).collect()}
    assert sorted(got) == list(range(8))
    for j, r in got.items():
        hits = np.flatnonzero(permuted[:, j] >= own[j] * (1 - 1e-9)) + 1
        assert abs(r.stat - own[j]) < 1e-9
        if len(hits) >= 3:
            assert (r.exceeding, r.permutations) == (3, hits[2]) and abs(r.p - 3 / hits[2]) < 1e-12
        else:
            assert (r.exceeding, r.permutations) == (len(hits), 40) and abs(r.p - (len(hits) + 1) / 41) < 1e-12
    assert any(r.permutations == 40 for r in got.values()) and any(r.permutations < 40 for r in got.values())


def test_rounds_of_any_size_agree(spark, plain):
    genotypes, traits, _, _ = plain
    a, b = ({tuple(r) for r in permutation.permute_until_settled(genotypes, traits, "trait", most=16, enough=3, per_round=k).collect()} for k in (16, 6))
    assert {x[:2] + x[3:] for x in a} == {x[:2] + x[3:] for x in b}


def test_maxima_are_over_all_markers(spark, plain):
    genotypes, traits, own, permuted = plain
    got = {r.variant_id: r.p_family for r in permutation.permute_maxima(genotypes, traits, "trait", permutations=40, per_round=15).collect()}
    top = permuted.max(axis=1)
    assert got == pytest.approx({j: (1 + (top >= own[j] * (1 - 1e-9)).sum()) / 41 for j in range(8)})


def test_permutations_of_odd_tables(spark):
    genotypes = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (3, 1, 2), (None, 1, 2), (1, None, 2), (1, 2, 1), (2, 2, 1), (1, 3, None)], "sample_id long, variant_id long, dosage int")
    samples = spark.createDataFrame([(1, 5.0, "a"), (1, 1.0, "b"), (2, 2.0, "c"), (3, 4.0, "d"), (None, 9.0, "e"), (4, None, "f")], "sample_id long, trait double, dosage string")
    got = permutation.permute_until_settled(genotypes, samples, "trait", most=5, enough=2, per_round=2).collect()
    assert [(r.variant_id, r.n) for r in got] == [(1, 3)] and abs(got[0].stat - np.corrcoef([0, 1, 2], [1, 2, 4])[0, 1] ** 2) < 1e-12
    none = genotypes.limit(0)
    assert permutation.permute_until_settled(none, samples, "trait", most=5).count() == 0
    assert permutation.permute_maxima(none, samples, "trait", permutations=5).count() == 0


def test_projection_is_least_squares_on_called_markers(spark):
    g, _, genotypes, _ = table(spark, 50, 40, 4)
    members = np.arange(30)
    panel = spark.createDataFrame([(int(i),) for i in members], "sample_id long")
    got = {r.sample_id: r for r in projection.project_on_panel(genotypes, panel, 2).collect()}
    own = g[members]
    p = np.nanmean(own, axis=0) / 2
    z = (g - 2 * p) / np.sqrt(2 * p * (1 - p))
    filled = np.nan_to_num(z[members])
    _, vectors = np.linalg.eigh(filled @ filled.T)
    u = vectors[:, :-3:-1]
    w = filled.T @ u
    assert len(got) == 50 and sum(r.in_panel for r in got.values()) == 30
    for i, r in got.items():
        called = ~np.isnan(g[i])
        want = np.linalg.lstsq(w[called], z[i, called], rcond=None)[0]
        assert r.markers == called.sum() and np.allclose(np.abs(r.scores), np.abs(want), atol=1e-5)


def test_panel_samples_without_gaps_keep_their_scores(spark):
    rng = np.random.default_rng(8)
    g = rng.binomial(2, 0.5, (20, 30))
    genotypes = spark.createDataFrame([(i, j, int(g[i, j])) for i in range(20) for j in range(30)], "sample_id long, variant_id long, dosage int")
    scores = {(r.sample_id, r.pc): r.value for r in graphs.pca(genotypes, 2).collect()}
    for r in projection.project_on_panel(genotypes, genotypes.select("sample_id"), 2).collect():
        assert np.allclose(r.scores, [scores[r.sample_id, 1], scores[r.sample_id, 2]], atol=1e-5)


def test_projection_of_odd_samples(spark):
    loadings = spark.createDataFrame([(1, 0.5, [1.0, 0.0]), (2, 0.5, [0.0, 1.0]), (3, 1.0, [1.0, 1.0])], "variant_id long, p double, w array<double>")
    genotypes = spark.createDataFrame([(1, 1, 2), (1, 2, 0), (1, 3, 2), (2, 1, 2), (3, 3, 1), (4, 1, None), (None, 1, 1)], "sample_id long, variant_id long, dosage int")
    got = {r.sample_id: (r.markers, r.scores) for r in projection.project(genotypes, loadings, 2).collect()}
    assert got[1][0] == 2 and np.allclose(got[1][1], [2**0.5, -(2**0.5)])
    assert got[2] == (1, None) and sorted(got) == [1, 2]
