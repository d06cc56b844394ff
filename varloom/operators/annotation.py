"""Flattening of nested annotations, per alternative allele."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.functions import ranks
from varloom.operators.summaries import allele_freq


def flatten_annotations(sites: DataFrame, transcripts: DataFrame) -> DataFrame:
    """One row per site and transcript of its own allele, with typed columns and the impact's rank."""
    t = transcripts.select("variant_id", "alt", "k", "effect", "impact", "feature", "canonical", "aa_len")
    rows = sites.select("variant_id", "chrom", "pos", "ref", "alt", "af", "clnsig", "hgmd").join(t, ["variant_id", "alt"])
    return rows.select(
        "variant_id", "k", F.element_at(F.split("effect", "&"), 1).alias("first_effect"), F.size(F.split("effect", "&")).alias("effects"),
        ranks.impact_rank(F.col("impact")).alias("impact_rank"), ranks.significance_rank(F.col("clnsig")).alias("significance"), ranks.hgmd_rank(F.col("hgmd")).alias("hgmd_rank"),
    )


def flatten_carriers(genotypes: DataFrame, sites: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Per site: frequency and counts of its own allele, the first transcript, and sorted carrier lists by zygosity."""
    who = F.col("sample_id")
    carriers = genotypes.filter("dosage > 0").groupBy("variant_id").agg(
        F.array_sort(F.collect_set(F.when(F.col("dosage") == 1, who))).alias("het"), F.array_sort(F.collect_set(F.when(F.col("dosage") == 2, who))).alias("hom")
    )
    first = transcripts.groupBy("variant_id").agg(F.min_by(F.struct("effect", "impact"), "k").alias("t"))
    out = sites.join(carriers, "variant_id").join(allele_freq(genotypes), "variant_id").join(first, "variant_id", "left")
    return out.select("variant_id", "ac", "an", allele_freq_rounded().alias("frq"), "t.effect", "t.impact", "clnsig", "hgmd", "het", "hom")


def allele_freq_rounded():
    return F.round(F.col("ac") / F.col("an"), 6)
