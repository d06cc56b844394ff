"""Components, stacked ridge and p-values against plain versions on small tables."""

import math
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from varloom.operators import graphs, statistics


def cohort(spark, n, m, seed):
    rng = np.random.default_rng(seed)
    share = rng.uniform(0.2, 0.8, m)
    group = rng.integers(0, 2, n)
    p = np.clip(share[None, :] + 0.18 * np.where(group[:, None] == 1, 1, -1) * rng.choice((-1, 1), m)[None, :], 0.02, 0.98)
    g = rng.binomial(2, p).astype(float)
    g[rng.random((n, m)) < 0.05] = np.nan
    rows = [(i, j, None if np.isnan(g[i, j]) else int(g[i, j])) for i in range(n) for j in range(m)]
    return g, spark.createDataFrame(rows, "sample_id long, variant_id long, dosage int")


def test_pca_is_the_dense_decomposition(spark):
    g, genotypes = cohort(spark, 60, 90, 3)
    f = np.nanmean(g, axis=0) / 2
    z = np.where(np.isnan(g), 0.0, (g - 2 * f) / np.sqrt(2 * f * (1 - f)))
    values, vectors = np.linalg.eigh(z @ z.T)
    got = np.zeros((60, 3))
    for r in graphs.pca(genotypes, 3).collect():
        got[r.sample_id, r.pc - 1] = r.value
    for i in range(3):
        assert abs(abs(got[:, i] @ vectors[:, -1 - i]) - 1) < 1e-6
        assert got[np.abs(got[:, i]).argmax(), i] > 0


def test_outliers_leave_the_components(spark):
    _, genotypes = cohort(spark, 50, 80, 5)
    odd = spark.createDataFrame([(999, j, 2 * (j % 2)) for j in range(80)], "sample_id long, variant_id long, dosage int")
    scores = graphs.pca_without_outliers(genotypes.unionByName(odd), 1, most_z=3.5)
    assert scores.filter("sample_id < 50").count() == 50


def test_stacked_ridge_is_one_ridge_over_the_other_blocks(spark):
    rng = np.random.default_rng(1)
    chroms, n = [1, 1, 2, 3], 40
    p, y = rng.normal(size=(n, 4)), rng.normal(size=n)
    rows = [(chroms[b], b, i, float(y[i]), float(p[i, b])) for i in range(n) for b in range(4)]
    made = statistics.stacked(spark.createDataFrame(rows, "chrom int, block int, sample_id long, y double, prediction double"), 2.0)
    got = {(r.sample_id, r.chrom): r.offset for r in made.collect()}
    for c in (1, 2, 3):
        x = p[:, [b for b in range(4) if chroms[b] != c]]
        want = x @ np.linalg.solve(x.T @ x + 2.0 * np.eye(x.shape[1]), x.T @ y)
        assert np.allclose([got[i, c] for i in range(n)], want)


def test_p_values(spark):
    # t with 1 and 2 degrees of freedom has closed forms; with many it is normal
    assert math.isclose(statistics.beta_tail(1 / (1 + 3.0**2), 0.5, 0.5), 1 - 2 / math.pi * math.atan(3), rel_tol=1e-12)
    assert math.isclose(statistics.beta_tail(2 / (2 + 1.5**2), 1.0, 0.5), 1 - 1.5 / math.sqrt(2 + 1.5**2), rel_tol=1e-12)
    assert math.isclose(statistics.beta_tail(1e7 / (1e7 + 4), 5e6, 0.5), math.erfc(2 / math.sqrt(2)), rel_tol=1e-5)
    df = spark.createDataFrame([(3.841459, 2.0, 5.0), (None, None, 5.0)], "c double, t double, n double")
    rows = df.select(statistics.chisq1_p("c").alias("a"), statistics.student_p("t", "n").alias("b")).collect()
    assert abs(rows[0].a - 0.05) < 1e-7 and abs(rows[0].b - 0.1019395) < 1e-6


def test_pca_with_restarts_over_blocks_and_parts(spark, monkeypatch):
    """A flat spectrum takes many rounds; what a round holds stays bounded, and the vectors are those of the dense matrix."""
    rng = np.random.default_rng(12)
    g = rng.integers(0, 3, (120, 90)).astype(float)
    g[rng.random(g.shape) < 0.6] = np.nan
    rows = [(5 * i + 3, v, int(d)) for (i, v), d in np.ndenumerate(g) if not np.isnan(d)]
    for name, value in (("BLOCK_SAMPLES", 25), ("PART_CALLS", 400), ("MOST_BASIS", 16), ("KEPT_BASIS", 6)):
        monkeypatch.setattr(graphs, name, value)
    sizes, gram = [], graphs._gram
    monkeypatch.setattr(graphs, "_gram", lambda basis: sizes.append(len(made := gram(basis))) or made)
    found = {(r.sample_id, r.pc): r.value for r in graphs.pca(spark.createDataFrame(rows, "sample_id long, variant_id long, dosage int"), 2).collect()}
    assert max(sizes) <= 6 * 4 + 4 and len(sizes) > 7
    p = np.nanmean(g, axis=0) / 2
    z = np.nan_to_num((g - 2 * p) / np.sqrt(2 * p * (1 - p)))
    want = np.linalg.eigh(z @ z.T)[1][:, ::-1]
    for pc in (1, 2):
        got = np.array([found[5 * i + 3, pc] for i in range(120)])
        assert abs(got @ want[:, pc - 1]) > 1 - 1e-8 and got[np.abs(got).argmax()] > 0


def test_stacked_ridge_makes_no_matrix_of_blocks(spark, monkeypatch):
    """Many blocks that each sample meets few of, as the dense ridge gives it, without summed outer products."""
    monkeypatch.setattr(statistics, "outer_sums", None)
    rng = np.random.default_rng(6)
    blocks, n = 60, 80
    x = np.where(rng.random((n, blocks)) < 0.1, rng.normal(0, 3, (n, blocks)), 0.0)
    y = rng.normal(0, 1, n)
    rows = [(b % 3 + 1, b // 3, s, float(y[s]), float(x[s, b])) for s in range(n) for b in range(blocks) if x[s, b]]
    made = statistics.stacked(spark.createDataFrame(rows, "chrom int, block int, sample_id long, y double, prediction double"), 0.5)
    for r in made.collect():
        own = x[:, np.arange(blocks) % 3 + 1 != r.chrom]
        w = np.linalg.solve(own.T @ own + 0.5 * np.eye(own.shape[1]), own.T @ y)
        assert r.offset == pytest.approx(own[r.sample_id] @ w, rel=1e-7, abs=1e-9)


def test_pca_leaves_no_rounds_behind(spark, monkeypatch):
    """Neither checkpoints nor shuffle files grow with the rounds, and in the end only the scores' checkpoint is left."""
    _, genotypes = cohort(spark, 40, 60, 8)
    genotypes = genotypes.checkpoint() if spark.sparkContext.getCheckpointDir() else graphs.durable(genotypes)
    folder = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    blocks = spark._jsparkSession.sparkContext().env().blockManager().diskBlockManager()
    held = lambda: sum(1 for b in blocks.getAllBlocks().mkString("\n").split("\n") if b.startswith("shuffle_"))
    before, files, gram, checkpoints = set(folder.glob("rdd-*")), [], graphs._gram, []
    monkeypatch.setattr(graphs, "_gram", lambda basis: checkpoints.append(len(set(folder.glob("rdd-*")) - before)) or files.append(held()) or gram(basis))
    graphs.pca(genotypes, 2)
    assert len(checkpoints) > 5 and max(checkpoints) <= 3
    assert len(set(folder.glob("rdd-*")) - before) == 1
    # files are removed in the background
    assert max(files[5:]) <= files[0] + 200


def test_calls_of_the_matrix_are_small_and_come_by_block(spark, monkeypatch):
    monkeypatch.setattr(graphs, "PART_CALLS", 16 * 50)
    rng = np.random.default_rng(9)
    rows = [(int(s), v, int(d)) for v in range(30) for s, d in enumerate(rng.integers(0, 3, 20))]
    rows += [(s, 99, 1 if s else None) for s in range(20)] + [(0, 100, 2), (None, 3, 2), (5, None, 1)]  # the last marker does not vary
    calls = spark.createDataFrame(rows, "sample_id long, variant_id long, dosage int")
    packed = graphs._packed_calls(calls).collect()
    assert sum(r.calls for r in packed) == 30 * 20 + 19 and all(len(r.d) == r.calls and len(r.s) == 8 * r.calls for r in packed)
    assert max(r.calls for r in packed) <= 80 and sum(len(r.n) // 4 for r in packed) == 31
    assert sum(np.frombuffer(r.n, "<i4").sum() for r in packed) == 30 * 20 + 19
    half = graphs._packed_calls(calls.withColumn("dosage", calls.dosage / 4)).collect()
    assert all(len(r.d) == 8 * r.calls for r in half)
    # blocks come as batches of their own, and only those with calls
    tile = {"bounds": np.array([0, 2, 2, 3]), "v": np.array([0, 1, 1], "<i4"), "s": np.array([0, 3, 1], "<u2"), "d": np.array([0, 2, 1], "<i1"), "mean": np.array([1.0, 0.5]), "scale": np.array([1.0, 2.0])}
    sent = {"block": pa.array([2, 0, 1], pa.int32()), "b": [np.ones((n, 2)).tobytes() for n in (2, 4, 4)]}
    made = graphs._times(pa.table({k: pa.array([x.tobytes()], pa.binary()) for k, x in tile.items()}), pa.table(sent), 2)
    assert made["block"].to_pylist() == [2, 0] and made["n"].num_chunks == 2
    z = np.array([-1.0, 3.0, 1.0])
    y = [z[0], z[1] + z[2]]
    assert np.frombuffer(made["n"][0].as_py()).reshape(2, 2)[:, 0].tolist() == [0, z[2] * y[1]]
    assert np.frombuffer(made["n"][1].as_py()).reshape(4, 2)[:, 1].tolist() == [z[0] * y[0], 0, 0, z[1] * y[1]]
