"""Projection of samples on the principal components of a reference panel."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.operators.durable import durable
from varloom.operators.graphs import pca


def standardised(dosage: Column, p: Column) -> Column:
    """Dosage in deviations from its mean, for a marker of allele frequency p."""
    return (dosage - 2 * p) / F.sqrt(2 * p * (1 - p))


def marker_loadings(genotypes: DataFrame, scores: DataFrame, k: int) -> DataFrame:
    """variant_id, p, w: allele frequency and the sums of standardised dosage times score, an array of k numbers.

    Scores are those of `pca` (sample_id, pc, value).  A marker needs a panel call and variation; calls of samples
    without scores count for p only.
    """
    called = genotypes.filter("dosage is not null and variant_id is not null")
    known = called.groupBy("variant_id").agg((F.avg("dosage") / 2).alias("p")).filter("p > 0 and p < 1")
    wide = scores.groupBy("sample_id").agg(*(F.max(F.when(F.col("pc") == i + 1, F.col("value"))).alias(f"u{i}") for i in range(k)))
    rows = called.join(wide, "sample_id").join(known, "variant_id")
    z = standardised(F.col("dosage"), F.col("p"))
    sums = [F.coalesce(F.sum(z * F.col(f"u{i}")), F.lit(0.0)) for i in range(k)]
    return rows.groupBy("variant_id").agg(F.first("p").alias("p"), F.array(*sums).alias("w"))


def project(genotypes: DataFrame, loadings: DataFrame, k: int) -> DataFrame:
    """sample_id, markers, scores: the least-squares scores of each sample on the markers called in it.

    The k-by-k normal equations of a sample are sums over its calls, combined before the shuffle, so a sample's calls
    are never one group.  Missing calls and markers without loadings are left out; scores (an array of k numbers) are
    null where the called markers do not determine them.  Samples without any such marker give no row.
    """
    used = loadings.select("variant_id", "p", "w").filter("p > 0 and p < 1")
    rows = genotypes.filter("dosage is not null and sample_id is not null").select("sample_id", "variant_id", "dosage").join(used, "variant_id")
    z = standardised(F.col("dosage"), F.col("p"))
    w = [F.col("w")[i] for i in range(k)]
    upper = [(i, j) for i in range(k) for j in range(i, k)]
    table = rows.groupBy("sample_id").agg(
        F.count("*").alias("markers"), F.array(*(F.sum(w[i] * w[j]) for i, j in upper)).alias("g"), F.array(*(F.sum(w[i] * z) for i in range(k))).alias("h")
    )

    def solve(batches):
        for batch in batches:
            if not len(batch):
                continue
            flat, h = np.stack(batch["g"].to_numpy()).astype(float), np.stack(batch["h"].to_numpy()).astype(float)
            g = np.zeros((len(batch), k, k))
            for at, (i, j) in enumerate(upper):
                g[:, i, j] = g[:, j, i] = flat[:, at]
            good = np.isfinite(flat).all(axis=1) & np.isfinite(h).all(axis=1)
            g[~good] = 0
            spread = np.linalg.eigvalsh(g)
            good &= spread[:, 0] > 1e-12 * np.maximum(spread[:, -1], 1e-300)
            found = np.zeros((len(batch), k))
            if good.any():
                found[good] = np.linalg.solve(g[good], h[good][:, :, None])[:, :, 0]
            yield pd.DataFrame({"sample_id": batch["sample_id"], "markers": batch["markers"], "scores": [list(x) if ok else None for x, ok in zip(found, good)]})

    return table.mapInPandas(solve, f"sample_id {table.schema['sample_id'].dataType.simpleString()}, markers long, scores array<double>")


def project_on_panel(genotypes: DataFrame, panel: DataFrame, k: int) -> DataFrame:
    """sample_id, in_panel, markers, scores of all samples on the k leading components of the panel's samples.

    `panel` holds sample_id; frequencies, components and loadings come from its samples alone, and every sample,
    panel included, is then projected on its called markers.
    """
    members = panel.select("sample_id").filter("sample_id is not null").distinct()
    calls = durable(genotypes.filter("dosage is not null").select("sample_id", "variant_id", "dosage"))
    own = durable(calls.join(members, "sample_id", "left_semi"))
    loadings = durable(marker_loadings(own, pca(own, k), k))
    mark = members.withColumn("in_panel", F.lit(True))
    return project(calls, loadings, k).join(mark, "sample_id", "left").select("sample_id", F.coalesce("in_panel", F.lit(False)).alias("in_panel"), "markers", "scores")
