"""Aggregations over long genotypes (sample_id, variant_id, dosage; null dosage: no call)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varloom.functions.hashing import BOUND, seeded
from varloom.operators.equilibrium import with_exact_p


def _n(condition: Column) -> Column:
    return F.count_if(condition)


def sample_summary(genotypes: DataFrame, variants: DataFrame, lists: bool = False) -> DataFrame:
    """Per sample, raw and for passing calls: called and variant genotypes, alternative alleles, genes hit.

    A call passes where its site does and its own filter (ft, if there is such a column) is null or PASS.  A site's gene
    is a name or an array of names.  lists: also the comma lists of the genes hit, in order.
    """
    rows = genotypes.join(variants.select("variant_id", "filter", "gene"), "variant_id")
    called, alt = F.col("dosage").isNotNull(), F.col("dosage") > 0
    passing = F.col("filter").isin("PASS", ".")
    if "ft" in genotypes.columns:
        passing = passing & F.coalesce(F.col("ft") == "PASS", F.lit(True))
    sides, several = {"raw": F.lit(True), "pass": passing}, rows.schema["gene"].dataType.typeName() == "array"
    # by gene first: a count of distinct genes would take every call three times
    parts = {}
    for name, keep in sides.items():
        parts |= {f"calls_{name}": _n(keep & called), f"variant_calls_{name}": _n(keep & alt), f"alt_alleles_{name}": F.coalesce(F.sum(F.when(keep, F.col("dosage"))), F.lit(0))}
    by_gene = rows.groupBy("sample_id", "gene").agg(*(c.alias(n) for n, c in parts.items()))
    out = []
    for name in sides:
        out += [F.sum(n).alias(n) for n in parts if n.endswith(f"_{name}")]
        hit = F.col(f"variant_calls_{name}") > 0
        genes = F.collect_set(F.when(hit, F.col("gene")))
        genes = F.array_compact(F.array_distinct(F.flatten(genes))) if several else genes
        out.append((F.size(genes).cast("long") if several or lists else _n(F.col("gene").isNotNull() & hit)).alias(f"genes_{name}"))
        if lists:
            out.append(F.array_join(F.array_sort(genes), ",").alias(f"gene_list_{name}"))
    return by_gene.groupBy("sample_id").agg(*out)


def sample_genes(genotypes: DataFrame, variants: DataFrame) -> DataFrame:
    """Per sample, the comma list of genes with an alternative allele at a passing site."""
    rows = genotypes.filter("dosage > 0").join(variants.filter("filter = 'PASS'").select("variant_id", "gene"), "variant_id")
    return rows.groupBy("sample_id").agg(F.array_join(F.array_sort(F.collect_set("gene")), ",").alias("genes"))


def site_genes(hits: DataFrame) -> DataFrame:
    """Gene hits (chrom, pos, gene) collapsed to one comma list per position."""
    return hits.groupBy("chrom", "pos").agg(F.array_join(F.array_sort(F.collect_list("gene")), ",").alias("genes"))


def allele_freq(genotypes: DataFrame) -> DataFrame:
    """AC, AN, AF and MAF per variant; AF is null without a call."""
    out = genotypes.groupBy("variant_id").agg(F.coalesce(F.sum("dosage"), F.lit(0)).alias("ac"), (2 * F.count("dosage")).alias("an"))
    af = F.when(F.col("an") > 0, F.col("ac") / F.col("an"))
    return out.withColumn("af", af).withColumn("maf", F.least(F.col("af"), 1 - F.col("af")))


def genotype_counts(genotypes: DataFrame, *by: str) -> DataFrame:
    return genotypes.groupBy(*(by or ("variant_id",))).agg(
        _n(F.col("dosage") == 0).alias("hom_ref"), _n(F.col("dosage") == 1).alias("het"), _n(F.col("dosage") == 2).alias("hom_alt"), _n(F.col("dosage").isNull()).alias("missing")
    )


def hwe_chisq(ref: Column, het: Column, alt: Column) -> Column:
    """Chi-square of Hardy-Weinberg equilibrium; null without calls or with one allele only."""
    n = ref + het + alt
    p = (2 * ref + het) / (2.0 * n)
    q = 1 - p

    def term(seen: Column, expected: Column) -> Column:
        return (seen - expected) * (seen - expected) / expected

    value = term(ref, n * p * p) + term(het, 2 * n * p * q) + term(alt, n * q * q)
    return F.when((n > 0) & (2 * ref + het > 0) & (2 * alt + het > 0), value)


def hardy_weinberg(genotypes: DataFrame, mid: bool = False) -> DataFrame:
    """Genotype counts, chi-square and the exact p of every marker (mid: the mid-p)."""
    c = genotype_counts(genotypes)
    return with_exact_p(c.withColumn("chisq", hwe_chisq(F.col("hom_ref"), F.col("het"), F.col("hom_alt"))), mid)


def site_annotations(genotypes: DataFrame) -> DataFrame:
    """Chromosome counts, genotype counts, HWE chi-square and inbreeding coefficient of every site, in one shuffle."""
    c = genotype_counts(genotypes)
    n = F.col("hom_ref") + F.col("het") + F.col("hom_alt")
    c = c.withColumn("an", 2 * n).withColumn("ac", F.col("het") + 2 * F.col("hom_alt"))
    p = F.col("ac") / F.col("an")
    expected = 2 * p * (1 - p) * n
    varies = (F.col("ac") > 0) & (F.col("ac") < F.col("an"))
    return c.withColumn("chisq", hwe_chisq(F.col("hom_ref"), F.col("het"), F.col("hom_alt"))).withColumn("inbreeding", F.when(varies, 1 - F.col("het") / expected))


def titv_ratio(variants: DataFrame, *by: str) -> DataFrame:
    from varloom.functions.alleles import transition

    ti = transition(F.col("ref"), F.col("alt"))
    out = variants.groupBy(*by).agg(_n(ti).alias("ti"), _n(~ti).alias("tv"))
    return out.withColumn("ratio", F.when(F.col("tv") > 0, F.col("ti") / F.col("tv")))


def missing_summary(genotypes: DataFrame, by: str) -> DataFrame:
    """Missing calls, all rows and the share, by variant_id or by sample_id."""
    return genotypes.groupBy(by).agg(_n(F.col("dosage").isNull()).alias("n_miss"), F.count("*").alias("n_geno"), F.avg(F.col("dosage").isNull().cast("int")).alias("f_miss"))


def case_control_genotypes(genotypes: DataFrame, samples: DataFrame, phenotypes: list[str], covariates: list[str]) -> DataFrame:
    """Per phenotype (coded 1 control, 2 case) and variant: genotype counts of cases and controls, over samples
    with all covariates."""
    long = samples.dropna(subset=covariates).unpivot(["sample_id"], phenotypes, "phenotype", "status").filter("status in (1, 2)")
    rows = genotypes.join(long, "sample_id")
    counts = [
        _n((F.col("status") == s) & (F.col("dosage") == d)).alias(f"{who}_{g}")
        for s, who in ((2, "case"), (1, "control"))
        for d, g in ((0, "hom_ref"), (1, "het"), (2, "hom_alt"))
    ]
    return rows.groupBy("phenotype", "variant_id").agg(*counts)


# ---- concordance

STATES = ("NO_CALL", "HOM_REF", "HET", "HOM_VAR", "UNAVAILABLE", "MIXED")


def genotype_state(there: Column, dosage: Column) -> Column:
    return F.when(there.isNull(), "UNAVAILABLE").when(dosage.isNull(), "NO_CALL").when(dosage == 0, "HOM_REF").when(dosage == 1, "HET").otherwise("HOM_VAR")


def paired_states(evaluated: DataFrame, compared: DataFrame) -> DataFrame:
    """sample_id, variant_id, eval_state, comp_state of all genotypes of either call set."""
    mark = F.lit(1)
    a = evaluated.select("sample_id", "variant_id", F.col("dosage").alias("d1"), mark.alias("t1"))
    b = compared.select("sample_id", "variant_id", F.col("dosage").alias("d2"), mark.alias("t2"))
    return a.join(b, ["sample_id", "variant_id"], "full").select(
        "sample_id", "variant_id", genotype_state(F.col("t1"), F.col("d1")).alias("eval_state"), genotype_state(F.col("t2"), F.col("d2")).alias("comp_state")
    )


def genotype_concordance(evaluated: DataFrame, compared: DataFrame, variants: DataFrame) -> DataFrame:
    """Contingency counts by sample, variant type (SNP, INDEL) and filter class.

    all_samples, all_types and raw mark totals, whose sample_id, type or filter is null; rows that are not raw are of
    PASS sites.  Samples are counted first by type and by whether the site passes; only that small table is rolled up.
    """
    kind = F.when((F.length("ref") == 1) & (F.length("alt") == 1), "SNP").otherwise("INDEL")
    passing = F.coalesce(F.col("filter") == "PASS", F.lit(False))
    sites = variants.select("variant_id", kind.alias("type"), passing.alias("passing"))
    counted = paired_states(evaluated, compared).join(sites, "variant_id").groupBy("sample_id", "type", "passing").agg(*_cells())
    names = [cell_name(2 + i) for i in range(len(STATES) ** 2)]
    # twice the small table: all sites, and those that pass
    sides = F.when(F.col("passing"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))
    both = counted.withColumn("raw", F.explode(sides))
    sets = [[F.col(c) for c in own] for own in (["sample_id", "type", "raw"], ["sample_id", "raw"], ["type", "raw"], ["raw"])]
    totals = both.groupingSets(sets, "sample_id", "type", "raw").agg(F.grouping("sample_id").alias("s"), F.grouping("type").alias("t"), *(F.sum(n).alias(n) for n in names))
    filter_ = F.when(~F.col("raw"), "PASS")
    return totals.select("sample_id", "type", filter_.alias("filter"), (F.col("s") == 1).alias("all_samples"), (F.col("t") == 1).alias("all_types"), "raw", *names)


def _cells() -> list[Column]:
    return [_n((F.col("eval_state") == e) & (F.col("comp_state") == c)).alias(f"{e}__{c}".lower()) for e in STATES for c in STATES]


def concordance_table(pairs: DataFrame, *by: str) -> DataFrame:
    return pairs.groupBy(*by).agg(*_cells())


# Cells (row-major from 2, as eval x comp) of numerator and denominator of every ratio.
RATIOS = {
    "nrs": ((16, 17, 22, 23), (10, 11, 16, 17, 22, 23, 4, 5, 28, 29)),
    "nrs_r": ((16, 17, 22, 23), (15, 21, 16, 17, 22, 23, 14, 20, 18, 24)),
    "ogc": ((9, 16, 23), (9, 10, 11, 15, 16, 17, 21, 22, 23)),
    "ogc_m": ((9, 16, 23, 2), (9, 10, 11, 8, 15, 16, 17, 14, 21, 22, 23, 20, 3, 4, 5, 2)),
    "ogc_mu": ((9, 16, 23, 2, 30, 26, 6), (9, 10, 11, 8, 12, 15, 16, 17, 14, 18, 21, 22, 23, 20, 24, 3, 4, 5, 2, 6, 27, 28, 29, 26, 30)),
    "hhc": ((16,), (16, 17, 10, 22, 15)),
    "hhc_m": ((16,), (15, 16, 17, 14, 10, 22, 4)),
    "nrc": ((16, 23), (15, 16, 17, 21, 22, 23)),
    "nrc_r": ((16, 23), (10, 11, 16, 17, 22, 23)),
    "rec": ((16, 23), (10, 11, 16, 17, 22, 23, 4, 5, 28, 29)),
    "rec_r": ((16, 23), (15, 21, 16, 17, 22, 23, 14, 20, 18, 24)),
}
NRD = ((23, 16), (10, 11, 15, 16, 17, 21, 22, 23))


def cell_name(n: int) -> str:
    return f"{STATES[(n - 2) // 6]}__{STATES[(n - 2) % 6]}".lower()


def concordance_metrics(table: DataFrame, keep: list[str]) -> DataFrame:
    """The twelve ratios of a contingency table to five digits; null where the denominator is 0."""

    def ratio(cells: tuple) -> Column:
        top, bottom = (sum((F.col(cell_name(n)) for n in side[1:]), F.col(cell_name(side[0]))) for side in cells)
        return F.when(bottom > 0, top / bottom)

    made = {name: ratio(cells) for name, cells in RATIOS.items()} | {"nrd": 1 - ratio(NRD)}
    return table.select(*keep, *(F.round(c, 5).alias(n) for n, c in made.items()))


def duplicate_pairs(samples: DataFrame, subject: Column, seed: int = 1) -> DataFrame:
    """One pair (id1, id2) for every subject with two samples or more, chosen by a seeded hash."""
    order = Window.partitionBy("subject").orderBy(seeded(F.col("sample_id"), seed), "sample_id")
    picked = samples.select(subject.alias("subject"), "sample_id").withColumn("i", F.row_number().over(order)).filter("i <= 2")
    out = picked.groupBy("subject").agg(F.min(F.when(F.col("i") == 1, F.col("sample_id"))).alias("id1"), F.min(F.when(F.col("i") == 2, F.col("sample_id"))).alias("id2"))
    return out.filter("id2 is not null")


# ---- phenotype matrices


def icd_matrix(counts: DataFrame, least_count: int, least_patients: int, codes: list[str] | None = None) -> DataFrame:
    """pt_id, code, status of the full grid of patients and qualifying codes: 1 from least_count on, null below,
    0 without a record.  A code qualifies with least_patients patients at least_count."""
    if codes is not None:
        counts = counts.filter(F.col("code").isin(codes))
    enough = counts.filter(F.col("n") >= least_count).groupBy("code").agg(F.count_distinct("pt_id").alias("p")).filter(F.col("p") >= least_patients).select("code")
    # the grid is the result; the few qualifying codes go to every patient as one array
    listed = enough.agg(F.collect_list("code").alias("codes"))
    grid = counts.select("pt_id").distinct().join(F.broadcast(listed)).select("pt_id", F.explode("codes").alias("code"))
    status = F.when(F.col("n").isNull(), 0).when(F.col("n") >= least_count, 1)
    return grid.join(counts, ["pt_id", "code"], "left").select("pt_id", "code", status.alias("status"))


def matrix(long: DataFrame, key: str, name: str, value: str, names: list[str]) -> DataFrame:
    """Wide form with the named columns; missing cells are null."""
    return long.groupBy(key).pivot(name, names).agg(F.first(value, ignorenulls=True))


def covariate_table(demographics: DataFrame, extract_year: int) -> DataFrame:
    """Age at death or extract, its square, bmi, lower-case sex and race; unknown sex and empty ids are left out."""
    end = F.when(F.col("death_year") < extract_year, F.col("death_year")).otherwise(F.lit(extract_year))
    rows = demographics.filter("pt_id is not null and sex <> 'Unknown'")
    age = F.datediff(F.make_date(end, F.lit(1), F.lit(1)), F.make_date("birth_year", F.lit(1), F.lit(1))) / 365.0
    return rows.select("pt_id", age.alias("age"), (age * age).alias("age2"), "bmi", F.lower("sex").alias("sex"), F.lower("race").alias("race"))


# ---- bins


def bin_burden(genotypes: DataFrame, variants: DataFrame, most_maf: float, least_loci: int, bins: DataFrame | None = None) -> DataFrame:
    """Weighted burden of rare variants per bin and sample; without bins (variant_id, bin, weight) genes are bins."""
    if bins is None:
        bins = variants.select("variant_id", F.col("gene").alias("bin"), F.lit(1.0).alias("weight"))
    rare = allele_freq(genotypes).filter((F.col("maf") > 0) & (F.col("maf") <= most_maf)).select("variant_id")
    loci = bins.join(rare, "variant_id")
    large = loci.groupBy("bin").agg(F.count_distinct("variant_id").alias("loci")).filter(F.col("loci") >= least_loci)
    rows = genotypes.filter("dosage > 0").join(loci, "variant_id").join(large.select("bin"), "bin")
    return rows.groupBy("bin", "sample_id").agg(F.sum(F.col("weight") * F.col("dosage")).alias("score"))


def bin_summary(genotypes: DataFrame, samples: DataFrame, loci: DataFrame) -> DataFrame:
    """Per bin: loci, cases, controls, alternative alleles and capacity (two per called genotype) of each group."""
    status = samples.filter("case_status is not null").select("sample_id", "case_status")
    size = status.agg(_n(F.col("case_status") == 2).alias("num_cases"), _n(F.col("case_status") == 1).alias("num_controls"))
    rows = genotypes.join(loci, "variant_id").join(status, "sample_id")
    case, control = F.col("case_status") == 2, F.col("case_status") == 1
    out = rows.groupBy("bin").agg(
        F.count_distinct("variant_id").alias("num_loci"),
        F.coalesce(F.sum(F.when(case, F.col("dosage"))), F.lit(0)).alias("case_vars"),
        F.coalesce(F.sum(F.when(control, F.col("dosage"))), F.lit(0)).alias("control_vars"),
        (2 * _n(case & F.col("dosage").isNotNull())).alias("case_capacity"),
        (2 * _n(control & F.col("dosage").isNotNull())).alias("control_capacity"),
    )
    return out.join(F.broadcast(size))


def setid_expand(loci: DataFrame) -> DataFrame:
    """bin, variant_id for every bin of a locus's |-separated list, once each."""
    return loci.select(F.explode(F.split("bins", "\\|")).alias("bin"), "variant_id").filter("bin <> ''").dropDuplicates(["bin", "variant_id"])


def permute_phenotypes(samples: DataFrame, seed: int, column: str = "case_status", parts: int = 64) -> DataFrame:
    """sample_id and the phenotype of another sample, a seeded permutation.

    Rows and donors are both ranked by hashes of their ids, under seed 0 and the given one; ranks come from ranks within hash parts plus the
    sizes of the parts before, so no single task sorts all samples.
    """

    def ranked(order: Column, name: str, value: Column) -> DataFrame:
        rows = samples.select(order.alias("o"), "sample_id", value.alias(name))
        rows = rows.withColumn("part", F.floor(F.col("o") / float(BOUND) * parts).cast("int"))
        sizes = rows.groupBy("part").count()
        before = sizes.withColumn("before", F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
        rows = rows.withColumn("rn", F.row_number().over(Window.partitionBy("part").orderBy("o", "sample_id")))
        return rows.join(F.broadcast(before), "part").select((F.coalesce("before", F.lit(0)) + F.col("rn")).alias("rank"), name)

    own = ranked(seeded(F.col("sample_id"), 0), "own", F.col("sample_id"))
    donor = ranked(seeded(F.col("sample_id"), seed), "donor", F.struct(F.col(column).alias("v")))
    return own.join(donor, "rank").select(F.col("own").alias("sample_id"), F.col("donor.v").alias(column))


def permutation_pvalue(baseline: DataFrame, permuted: DataFrame, by: list[str]) -> DataFrame:
    """Share of permutations with p strictly below the baseline's; `bound` is 1/N where there is none."""
    rows = permuted.join(baseline.select(*by, F.col("p").alias("p0")), by)
    out = rows.groupBy(*by).agg(_n(F.col("p") < F.col("p0")).alias("below"), F.count("*").alias("n"))
    return out.select(*by, (F.col("below") / F.col("n")).alias("p_perm"), F.when(F.col("below") == 0, 1.0 / F.col("n")).alias("bound"))


def cost_rollup(jobs: DataFrame, first, last, group: str, price: str, at: str) -> DataFrame:
    """Sum of prices per group in a half-open time window."""
    return jobs.filter((F.col(at) >= first) & (F.col(at) < last)).groupBy(group).agg(F.sum(price).alias("cost"), F.count("*").alias("jobs"))


def unique_samples(genotypes: DataFrame, variants: DataFrame) -> DataFrame:
    """Distinct carriers over all passing variants, as one row."""
    carried = genotypes.filter("dosage > 0").join(variants.filter("filter = 'PASS'"), "variant_id", "left_semi")
    return carried.agg(F.count_distinct("sample_id").alias("carriers"))
