"""Exact test of Hardy-Weinberg equilibrium."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Counts whose probabilities differ by less than this share are equally likely.
EVEN = 1e-7


def heterozygote_probabilities(n: int, minor: int) -> tuple[np.ndarray, np.ndarray]:
    """The possible heterozygote counts among n genotypes with so many copies of the rarer allele, and their
    probabilities: a recurrence outwards from the likeliest count, so that nothing overflows."""
    het = np.arange(minor % 2, minor + 1, 2)
    rare = (minor - het) / 2
    common = n - het - rare
    ratio = 4 * rare[:-1] * common[:-1] / ((het[:-1] + 2.0) * (het[:-1] + 1.0))  # of each count to the one before
    mode = int(np.searchsorted(-ratio, -1.0))
    up, down = np.cumprod(ratio[mode:]), np.cumprod(1 / ratio[:mode][::-1])
    weight = np.concatenate([down[::-1], [1.0], up])
    return het, weight / weight.sum()


def exact_p(hom_ref: int, het: int, hom_alt: int, mid: bool = False) -> float:
    """Probability of all heterozygote counts that are no likelier than the one seen (mid: of it, half)."""
    n, minor = hom_ref + het + hom_alt, het + 2 * min(hom_ref, hom_alt)
    counts, p = heterozygote_probabilities(n, minor)
    seen = p[(het - counts[0]) // 2]
    total = float(p[p <= seen * (1 + EVEN)].sum())
    return min(1.0, total - 0.5 * float(seen) if mid else total)


def with_exact_p(counts: DataFrame, mid: bool = False) -> DataFrame:
    """Rows of genotype counts (hom_ref, het, hom_alt) with p; null without calls, 1 with one allele only.

    Each distinct triple of counts is worked out once and joined back, as most of the many rare markers of a cohort
    share few triples.  A triple costs time in proportion to the copies of its rarer allele.
    """
    triple = ["hom_ref", "het", "hom_alt"]

    def solved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(p=[exact_p(*map(int, t), mid) for t in batch[triple].itertuples(index=False)])

    own = counts.select(*(F.col(c).cast("long").alias(f"__{c}") for c in triple)).distinct().filter("__hom_ref + __het + __hom_alt > 0")
    found = own.toDF(*triple).mapInPandas(solved, "hom_ref long, het long, hom_alt long, p double").toDF(*(f"__{c}" for c in triple), "p")
    same = F.lit(True)
    for c in triple:
        same = same & (counts[c] == found[f"__{c}"])
    return counts.join(found, same, "left").drop(*(f"__{c}" for c in triple))
