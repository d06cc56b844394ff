"""Score tests with covariates, medians without a single task, and ids of repeated markers, against plain versions."""

import random
import statistics as plain

import numpy as np
import pytest

from varloom.operators import statistics


def test_adjusted_scores_are_those_of_a_dense_null_model(spark):
    rng = np.random.default_rng(4)
    n, m = 50, 6
    z, g = np.column_stack([np.ones(n), rng.integers(1, 3, n), rng.normal(size=n)]), rng.integers(0, 3, (n, m)).astype(float)
    y = z @ [1.0, 2.0, -1.0] + rng.normal(size=n)
    g[rng.random((n, m)) < 0.1] = np.nan
    g[np.arange(n) >= 2, 5] = np.nan  # two calls for three coefficients
    rows = [(i, j, None if np.isnan(g[i, j]) else int(g[i, j])) for i in range(n) for j in range(m)]
    people = [(i, float(y[i]), int(z[i, 1]), float(z[i, 2])) for i in range(n)] + [(n, None, 1, 0.0), (n + 1, 5.0, None, 0.0)]
    rows += [(n, 0, 2), (n + 1, 0, 2)]
    made = statistics.score_stats_adjusted(
        spark.createDataFrame(rows, "sample_id long, variant_id long, dosage int"), spark.createDataFrame(people, "sample_id long, trait double, sex int, age double"), "trait", ["sex", "age"]
    )
    got = {r.variant_id: r for r in made.collect()}
    e = y - z @ np.linalg.lstsq(z, y, rcond=None)[0]
    for j in range(m):
        seen = ~np.isnan(g[:, j])
        x, zz = g[seen, j], z[seen]
        rest = x - zz @ np.linalg.lstsq(zz, x, rcond=None)[0]
        assert got[j].n == seen.sum() and np.isclose(got[j].u, x @ e[seen]) and np.isclose(got[j].v, (e @ e) / n * (rest @ rest), atol=1e-6)


@pytest.mark.parametrize("values", [[3.0], [1.0, 4.0], [2.0] * 900 + [5.0] * 7, [float(x % 97) for x in range(5000)], list(range(25001))])
def test_median(spark, values):
    values = [float(v) for v in values]
    random.Random(2).shuffle(values)
    df = spark.createDataFrame([(v,) for v in [*values, None]], "x double")
    assert statistics.exact_median(df, "x") == plain.median(values)


def test_median_of_nothing(spark):
    assert statistics.exact_median(spark.createDataFrame([(None,)], "x double"), "x") is None
    out = statistics.genomic_control(spark.createDataFrame([], "id long, chisq double"))
    assert out.columns == ["id", "chisq", "lambda", "chisq_gc"] and out.count() == 0


def test_ids_of_repeated_markers(spark):
    rows = [(1, 1, 10, ".", 0), (2, 1, 20, ".", 2), (3, 1, 20, ".", 3), (4, 1, 5, "a", 0), (5, 1, 6, "a", 2), (6, 1, 7, "a", 3)]
    rows += [(7, 1, 8, "b", 0), (8, 1, 9, "b", 3), (9, 1, 9, "c", 3), (10, 1, 9, None, 3), (11, 1, 9, "d", 1), (12, 1, 9, "d", 1)]
    out = statistics.label_duplicates(spark.createDataFrame(rows, "k int, chrom int, pos int, rsid string, type int"))
    got = {r.k: (r.marker, r.unresolved) for r in out.collect()}
    want = ["chr1:10", "chr1:20", "chr1:20", "a_t0", "a", "a_t3", "b", "b_t3", "c", None, "d", "d"]
    assert [got[i + 1][0] for i in range(12)] == want
    assert sorted(k for k, v in got.items() if v[1]) == [2, 3, 11, 12]
    assert out.columns == ["k", "chrom", "pos", "rsid", "type", "marker", "unresolved"]


def test_markers_without_variance_have_no_p(spark):
    # an exact fit has no standard error, a constant dosage no variance
    people = spark.createDataFrame([(i, float(2 * (i % 3)), i % 2) for i in range(9)], "sample_id long, y double, z int")
    calls = spark.createDataFrame([(i, 1, 1) for i in range(9)] + [(i, 2, i % 3) for i in range(9)], "sample_id long, variant_id long, dosage int")
    scores = {r.variant_id: r.p for r in statistics.score_stats(calls, people, "y").collect()}
    assert scores[1] is None and scores[2] < 0.01
    fits = {r.variant_id: r for r in statistics.assoc_linear_adjusted(calls, people, "y", ["z"]).collect()}
    assert fits[1].p is None and abs(fits[2].beta - 2) < 1e-9
