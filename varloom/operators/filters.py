"""Projections, predicates and quality filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.functions import alleles, ranks
from varloom.operators.equilibrium import with_exact_p
from varloom.operators.intervals import in_regions
from varloom.operators.statistics import exact_quantiles
from varloom.operators.summaries import allele_freq, genotype_counts


def vcf_query(sites: DataFrame, template: str) -> DataFrame:
    """Site columns and INFO keys named by a template such as `%CHROM\\t%POS\\t%INFO/AF`."""
    fields = [f for f in template.replace("\\t", "\t").split("\t") if f]
    made = []
    for field in fields:
        name = field.lstrip("%").strip()
        made.append(F.col("info")[name[5:]].alias(name[5:].lower()) if name.startswith("INFO/") else F.col(name.lower()))
    return sites.select(*made)


def select_variants(
    genotypes: DataFrame, variants: DataFrame, regions: DataFrame | None = None, samples: DataFrame | None = None,
    without: DataFrame | None = None, passing: bool = False, variant_only: bool = False, most_missing: float | None = None,
) -> DataFrame:
    """Sites with AC and AN of the selected samples beside the original ones."""
    sites = variants.filter(F.col("filter").isin("PASS", ".")) if passing else variants
    if regions is not None:
        sites = in_regions(sites, regions)
    chosen = genotypes
    if samples is not None:
        chosen = chosen.join(samples.select("sample_id"), "sample_id", "left_semi")
    if without is not None:
        chosen = chosen.join(without.select("sample_id"), "sample_id", "left_anti")
    before = allele_freq(genotypes).select("variant_id", F.col("ac").alias("ac_orig"), F.col("an").alias("an_orig"))
    after = chosen.groupBy("variant_id").agg(
        F.coalesce(F.sum("dosage"), F.lit(0)).alias("ac"), (2 * F.count("dosage")).alias("an"), F.avg(F.col("dosage").isNull().cast("int")).alias("missing")
    )
    out = sites.join(after, "variant_id").join(before, "variant_id")
    if variant_only:
        out = out.filter("ac > 0")
    if most_missing is not None:
        out = out.filter(F.col("missing") <= most_missing)
    return out.select("variant_id", "chrom", "pos", "ac", "an", "ac_orig", "an_orig")


def drop_format_fields(genotypes: DataFrame, fields: tuple[str, ...] = ("PL", "AO", "QA", "AD")) -> DataFrame:
    return genotypes.drop(*fields)


def view_variants(variants: DataFrame, expression: str | None = None, regions: DataFrame | None = None) -> DataFrame:
    """Sites by region and expression; a call without any criterion is refused."""
    if expression is None and regions is None:
        raise ValueError("view_variants needs a region list or an expression")
    out = variants if regions is None else in_regions(variants, regions)
    return out if expression is None else out.filter(F.expr(expression))


def filter_reads_by_region(reads: DataFrame, regions: DataFrame) -> DataFrame:
    """Alignments (rname, pos, length) that overlap a region."""
    spans = reads.withColumn("__stop", F.col("pos") + F.col("length") - 1)
    return in_regions(spans, regions, chrom="rname", start="pos", stop="__stop").drop("__stop")


def exclude_filtered(rows: DataFrame) -> DataFrame:
    """FILTER is PASS or '.', and a genotype's own filter too where it has one."""
    out = rows.filter(F.col("filter").isin("PASS", "."))
    return out.filter(F.col("ft").isNull() | F.col("ft").isin("PASS", ".")) if "ft" in rows.columns else out


def biallelic_snp(variants: DataFrame) -> DataFrame:
    return variants.filter(alleles.is_base(F.col("ref")) & alleles.is_base(F.col("alt")))


def maf_range(afs: Column) -> Column:
    """min(1 - sum, max) of an array of alternative frequencies."""
    return F.least(1 - F.aggregate(afs, F.lit(0.0), lambda s, x: s + x), F.array_max(afs))


def maf_range_filter(sites: DataFrame, low: float, high: float, afs: str = "afs") -> DataFrame:
    return sites.filter(maf_range(F.col(afs)).between(low, high))


def effect_role_filter(transcripts: DataFrame, roles: list[str], impacts: list[str], no_warning: bool = False) -> DataFrame:
    """Keys of sites with a transcript whose effects (an & list) meet the roles or whose impact is listed."""
    hit = F.arrays_overlap(F.split("effect", "&"), F.array(*map(F.lit, roles))) | F.col("impact").isin(impacts)
    if no_warning:
        hit = hit & (F.col("warning") == "")
    return transcripts.filter(hit).select("variant_id").distinct()


def deleterious_vote(sites: DataFrame, predictors: list[str], least: int) -> DataFrame:
    """Sites with at least `least` deleterious predictors; `least` is capped at their number."""
    return sites.filter(ranks.deleterious_votes(predictors) >= min(least, len(predictors)))


def clinvar_numeric_filter(sites: DataFrame, level: int, column: str = "clnsig_codes") -> DataFrame:
    return sites.filter(F.exists(F.split(column, "[,|&]"), lambda v: v.try_cast("int") >= level))


def clinvar_pred_filter(sites: DataFrame, include: list[str], exclude: list[str], review: list[str]) -> DataFrame:
    """Significance among include (empty: any), none among exclude, review status among review (empty: any)."""
    values = F.split("clnsig", "[,|&]")
    keep = F.lit(True)
    if include:
        keep = keep & F.arrays_overlap(values, F.array(*map(F.lit, include)))
    if exclude:
        keep = keep & ~F.arrays_overlap(values, F.array(*map(F.lit, exclude)))
    if review:
        keep = keep & F.col("review").isin(review)
    return sites.filter(keep)


def pass_intersection(sites: DataFrame, *keys: DataFrame, on: str = "variant_id") -> DataFrame:
    """Sites whose key is in every pass list."""
    for own in keys:
        sites = sites.join(own.select(on), on, "left_semi")
    return sites


def annot_filter(
    sites: DataFrame, transcripts: DataFrame, most_af: float, impact: int | None = None, ensembl: bool = True, canonical: bool = False,
    star: int | None = None, significance: int = 0, hgmd: int | None = None, genes: DataFrame | None = None,
) -> DataFrame:
    """Sites with an alternative frequency in (0, most_af] and any of: a transcript of the impact, a ClinVar
    record of the stars and significance, an HGMD class of the rank; in a listed gene, if there is a list."""
    out = sites.filter((F.col("af") > 0) & (F.col("af") <= most_af))
    tests = []
    if impact is not None:
        t = transcripts.filter(F.col("feature").startswith("E") if ensembl else ~F.col("feature").startswith("E"))
        if canonical:
            t = t.filter("canonical = 'YES'")
        level = t.groupBy("variant_id").agg(F.max(ranks.impact_rank(F.col("impact"))).alias("__level"))
        out = out.join(level, "variant_id", "left")
        tests.append(F.coalesce("__level", F.lit(0)) >= impact)
    if star is not None:
        tests.append((ranks.review_stars(F.col("review")) >= star) & (ranks.significance_rank(F.col("clnsig")) >= significance))
    if hgmd is not None:
        tests.append(ranks.hgmd_rank(F.col("hgmd")) >= hgmd)
    if tests:
        any_of = tests[0]
        for t in tests[1:]:
            any_of = any_of | t
        out = out.filter(any_of)
    if genes is not None:
        out = out.join(genes.select("gene"), "gene", "left_semi")
    return out.drop("__level")


def position_allele_filter(sites: DataFrame, listed: DataFrame) -> DataFrame:
    """Sites at listed (chrom, pos, alleles); a null or empty allele array admits any."""
    s, r = sites.alias("s"), listed.alias("r")
    any_allele = F.col("r.alleles").isNull() | (F.size("r.alleles") == 0)
    on = (F.col("s.chrom") == F.col("r.chrom")) & (F.col("s.pos") == F.col("r.pos")) & (any_allele | F.array_contains("r.alleles", F.col("s.alt")))
    return s.join(r, on, "left_semi")


def gene_filter(sites: DataFrame, genes: DataFrame) -> DataFrame:
    return sites.join(genes.select("gene"), "gene", "left_semi")


def annot_expression_filter(transcripts: DataFrame, expression: str) -> DataFrame:
    """Keys of sites with any transcript for which the expression holds."""
    return transcripts.filter(F.expr(expression)).select("variant_id").distinct()


def hard_filter(variants: DataFrame, label: str, expression: str) -> DataFrame:
    """The label is added to FILTER where the expression holds; PASS and '.' give way to it."""
    old = F.when(~F.col("filter").isin("PASS", "."), F.col("filter"))
    return variants.withColumn("filter", F.when(F.expr(expression), F.concat_ws(";", old, F.lit(label))).otherwise(F.col("filter")))


def apply_recalibration(variants: DataFrame, scores: DataFrame, truth: DataFrame, sensitivity: float) -> DataFrame:
    """FILTER of each type of variant by its score: PASS from the threshold on that keeps the asked share of the
    truth sites, else a tranche label.  The thresholds are one row per type."""
    typed = variants.withColumn("__type", alleles.variant_type(F.col("ref"), F.col("alt"))).join(scores, "variant_id", "left")
    known = typed.join(truth.select("variant_id"), "variant_id", "left_semi")
    limits = exact_quantiles(known, "score", [1 - sensitivity], "__type").select("__type", F.col("value").alias("__limit"))
    low = F.col("score").isNotNull() & (F.col("score") < F.col("__limit"))
    out = typed.join(F.broadcast(limits), "__type", "left")
    return out.withColumn("filter", F.when(low, F.lit(f"Tranche{sensitivity * 100:g}")).otherwise(F.lit("PASS"))).drop("__limit", "__type")


def marker_maf_filter(genotypes: DataFrame, least: float) -> DataFrame:
    """Markers that fail the minor-allele frequency (or have no call)."""
    return allele_freq(genotypes).filter(F.coalesce("maf", F.lit(-1.0)) < least).select("variant_id")


def call_filter(genotypes: DataFrame, by: str, most_missing: float) -> DataFrame:
    """Markers (by variant_id) or samples (by sample_id) that miss more than the rate."""
    return genotypes.groupBy(by).agg(F.avg(F.col("dosage").isNull().cast("int")).alias("f")).filter(F.col("f") > most_missing).select(by)


def drop_marker_sample(genotypes: DataFrame, markers: DataFrame | None = None, samples: DataFrame | None = None) -> DataFrame:
    if markers is None and samples is None:
        raise ValueError("drop_marker_sample needs a marker list or a sample list")
    out = genotypes
    if markers is not None:
        out = out.join(markers.select("variant_id"), "variant_id", "left_anti")
    if samples is not None:
        out = out.join(samples.select("sample_id"), "sample_id", "left_anti")
    return out


def extract_marker_sample(genotypes: DataFrame, variants: DataFrame, regions: DataFrame, samples: DataFrame, least_maf: float) -> DataFrame:
    inside = in_regions(variants, regions).select("variant_id")
    out = genotypes.join(samples.select("sample_id"), "sample_id", "left_semi").join(inside, "variant_id", "left_semi")
    common = allele_freq(out).filter(F.col("maf") >= least_maf).select("variant_id")
    return out.join(common, "variant_id", "left_semi")


def hwe_geno_maf_qc(genotypes: DataFrame, least_maf: float, most_missing: float, least_p: float) -> DataFrame:
    """Markers that pass the frequency, the missing rate and the exact test of equilibrium, from one aggregate.

    The test is worked out only for markers that pass the other two.
    """
    c = genotype_counts(genotypes)
    n = F.col("hom_ref") + F.col("het") + F.col("hom_alt")
    af = F.when(n > 0, (F.col("het") + 2 * F.col("hom_alt")) / (2 * n))
    keep = (F.least(af, 1 - af) >= least_maf) & (F.col("missing") / (n + F.col("missing")) <= most_missing)
    return with_exact_p(c.filter(keep)).filter(F.col("p") >= least_p).select("variant_id")


def drop_palindromic(variants: DataFrame) -> DataFrame:
    return variants.filter(~alleles.palindromic(F.col("ref"), F.col("alt")))


def reject_multiallelic(variants: DataFrame) -> DataFrame:
    """One row: how many markers have an allele longer than one base, and whether that stops the run."""
    long = F.count_if((F.length("ref") > 1) | (F.length("alt") > 1))
    return variants.agg(long.alias("multi")).withColumn("stop", F.col("multi") > 1)


def result_threshold(results: DataFrame, least_maf: float, least_cases: int) -> DataFrame:
    """Association rows by frequency (text `allele:maf`) and cases."""
    maf = F.element_at(F.split("var1_maf", ":"), 2).try_cast("double")
    return results.withColumn("maf", maf).filter((F.col("maf") > least_maf) & (F.col("num_cases") >= least_cases))


def drop_missing_covariates(samples: DataFrame, covariates: list[str]) -> DataFrame:
    return samples.dropna(subset=covariates)


def exclude_regions(variants: DataFrame, regions: DataFrame) -> DataFrame:
    return in_regions(variants, regions, how="left_anti")


def exclude_marker_list(variants: DataFrame, listed: DataFrame, on: str = "variant_id") -> DataFrame:
    return variants.join(listed.select(on), on, "left_anti")


def vcf_to_markers(variants: DataFrame, genotypes: DataFrame, least_maf: float) -> DataFrame:
    """Passing biallelic SNPs with ids filled from chrom:pos:allele and a frequency floor."""
    common = allele_freq(genotypes).filter(F.col("maf") >= least_maf).select("variant_id")
    name = F.coalesce(alleles.missing_to_null(F.col("id")), F.concat_ws(":", "chrom", "pos", "alt"))
    return exclude_filtered(biallelic_snp(variants)).withColumn("id", name).join(common, "variant_id", "left_semi")


def fill_marker_ids(markers: DataFrame) -> DataFrame:
    return markers.withColumn("id", F.when(F.col("id") == F.col("pos").cast("string"), F.concat_ws(":", "chrom", "pos")).otherwise(F.col("id")))


def chrom_subset(variants: DataFrame, first: int = 1, last: int = 22) -> DataFrame:
    return variants.filter(F.col("chrom").cast("string").try_cast("int").between(first, last))
