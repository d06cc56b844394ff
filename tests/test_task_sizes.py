"""Sizes of tasks: how much of a shuffle one takes, and what a call becomes in it."""

from __future__ import annotations

import time

import numpy as np
from pyspark.sql import functions as F


from varloom.operators import graphs, kinship, permutation, summaries
from varloom.plans.registry import ADVISORY, TASK_BYTES, small_tasks


def test_tasks_are_small_unless_the_session_says_otherwise(spark):
    before = spark.conf.get(ADVISORY, None)
    try:
        spark.conf.unset(ADVISORY)
        small_tasks(spark)
        assert spark.conf.get(ADVISORY) == TASK_BYTES
        spark.conf.set(ADVISORY, "5m")
        small_tasks(spark)
        assert spark.conf.get(ADVISORY) == "5m"
    finally:
        spark.conf.unset(ADVISORY) if before is None else spark.conf.set(ADVISORY, before)


def test_sample_summary_takes_each_call_once(spark):
    calls = spark.createDataFrame([(1, 1, 2), (1, 2, 1), (1, 3, None), (1, 4, 1), (2, 3, 0), (3, 5, 1)], "sample_id long, variant_id long, dosage int")
    sites = spark.createDataFrame([(1, "PASS", "a"), (2, "LowQual", "b"), (3, None, "a"), (4, "LowQual", "a"), (5, ".", None)], "variant_id long, filter string, gene string")
    out = summaries.sample_summary(calls, sites)
    assert "Expand" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.columns == ["sample_id"] + [f"{c}_{s}" for s in ("raw", "pass") for c in ("calls", "variant_calls", "alt_alleles", "genes")]
    assert sorted(map(tuple, out.collect())) == [(1, 3, 3, 4, 2, 1, 1, 2, 1), (2, 1, 0, 0, 0, 0, 0, 0, 0), (3, 1, 1, 1, 0, 1, 1, 1, 0)]


def test_sample_summary_names_the_genes(spark):
    """Genes hit by name, several at a site, and calls with a filter of their own."""
    rows = [(1, 1, 2, "PASS"), (1, 2, 1, None), (1, 3, 1, "PASS"), (1, 4, 2, "q10"), (2, 1, 0, "PASS"), (2, 5, None, None)]
    calls = spark.createDataFrame(rows, "sample_id long, variant_id long, dosage int, ft string")
    sites = spark.createDataFrame([(1, "PASS", ["b", "a"]), (2, ".", ["a", "c"]), (3, "LowQual", ["d"]), (4, "PASS", ["e"]), (5, "PASS", None)], "variant_id long, filter string, gene array<string>")
    found = {r["sample_id"]: r.asDict() for r in summaries.sample_summary(calls, sites, lists=True).collect()}
    assert {n: found[1][n] for n in found[1] if n.endswith("_raw")} == {"calls_raw": 4, "variant_calls_raw": 4, "alt_alleles_raw": 6, "genes_raw": 5, "gene_list_raw": "a,b,c,d,e"}
    assert {n: found[1][n] for n in found[1] if n.endswith("_pass")} == {"calls_pass": 2, "variant_calls_pass": 2, "alt_alleles_pass": 3, "genes_pass": 3, "gene_list_pass": "a,b,c"}
    assert (found[2]["calls_raw"], found[2]["genes_raw"], found[2]["gene_list_raw"]) == (1, 0, "")
    one = sites.withColumn("gene", F.col("gene")[0])
    assert {r["sample_id"]: (r["genes_pass"], r["gene_list_pass"]) for r in summaries.sample_summary(calls, one, lists=True).collect()} == {1: (2, "a,b"), 2: (0, "")}


def test_permutations_spread_their_samples(spark):
    traits = spark.range(9000).selectExpr("id AS sample_id", "cast(id % 2 AS double) AS y").coalesce(1)
    assert permutation._spread(traits).rdd.getNumPartitions() == 9000 // permutation.SAMPLES_A_TASK


def test_values_of_few_levels_move_as_bytes(spark):
    values = spark.createDataFrame([(1, [0.5, 2.0, 0.5]), (2, [2.0, 2.0, 0.5])], "sample_id long, ys array<double>")
    few = {r["sample_id"]: bytes(r["ys"]) for r in permutation._packed(values, np.array([0.5, 2.0])).collect()}
    assert few == {1: b"\0\1\0", 2: b"\1\1\0"}
    whole = {r["sample_id"]: np.frombuffer(r["ys"]).tolist() for r in permutation._packed(values, None).collect()}
    assert whole == {1: [0.5, 2.0, 0.5], 2: [2.0, 2.0, 0.5]}


def test_sums_of_markers_take_samples_of_several_calls(spark):
    rng = np.random.default_rng(4)
    calls = sorted({(int(s), int(v)) for s, v in zip(rng.integers(0, 300, 900), rng.integers(0, 40, 900))})
    calls = [(s, v, (s * v) % 3) for s, v in calls] + [(1000 + i, i % 40, 2) for i in range(200)]  # these have one call each
    genotypes = spark.createDataFrame(calls, "sample_id long, variant_id long, dosage int")
    ranked = spark.createDataFrame([(v, 1, v) for v in range(40)], "variant_id long, chrom int, r long")
    found = {(r["r1"], r["r2"]): (r["n"], r["sx"], r["sy"], r["sxy"]) for r in kinship.window_sums(genotypes, ranked, 10).collect()}
    by = {}
    for s, v, d in calls:
        by.setdefault(s, []).append((v, d))
    want = {}
    for own in by.values():
        for a, x in own:
            for b, y in own:
                if a < b < a // 10 * 10 + 20:
                    want[a, b] = tuple(np.add(want.get((a, b), (0, 0, 0, 0)), (1, x, y, x * y)).tolist())
    assert found == want


def test_a_mixture_reads_rows_as_matrices(spark):
    rows = spark.range(1000).selectExpr("array(cast(id AS double), cast(id % 7 AS double)) AS x").coalesce(1)
    blocks = graphs._row_blocks(rows).collect()
    assert len(blocks) == 1
    assert np.frombuffer(blocks[0]["x"]).reshape(-1, 2)[:, 1].sum() == sum(i % 7 for i in range(1000))


def test_families_are_a_stream(spark):
    pairs = spark.createDataFrame([(i, i + 1) for i in range(400) if i % 4 != 3], "id1 long, id2 long")
    out = kinship.unrelated_set(pairs, exact_up_to=24)
    assert "FlatMapGroupsInPandas" not in out._jdf.queryExecution().optimizedPlan().toString()
    # of a chain a - b - c - d, b with c or d is the earliest smallest set after a with c
    assert sorted(r[0] for r in out.collect()) == sorted(x for i in range(0, 400, 4) for x in (i, i + 2))


def test_a_checkpoint_of_kinship_leaves_no_shuffle_behind(spark):
    blocks = spark._jsparkSession.sparkContext().env().blockManager().diskBlockManager()
    held = lambda: sum(1 for b in blocks.getAllBlocks().mkString("\n").split("\n") if b.startswith("shuffle_"))
    before = held()
    rows = kinship.durable(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    # files are removed in the background
    left = next((n for _ in range(50) if (n := held()) <= before or time.sleep(0.1)), held())
    assert left <= before
    assert len(rows.collect()) == 7
