"""Queries on filters, summaries, concordance and phenotype matrices."""

from __future__ import annotations

from pyspark.sql import functions as F

from varloom.functions import alleles, ranks
from varloom.operators import annotation, filters, kinship, summaries
from varloom.plans.registry import register, small_tasks
from varloom.plans.surrogates import WITH, Views


def query(name: str, sql: str | None = None):
    """Register a function of the views under a name, with its oracle behind the views' WITH clause."""

    def keep(f):
        register(name, None if sql is None else WITH + "\n" + sql)(lambda spark, sf_dir: f(Views(small_tasks(spark), sf_dir)))
        return f

    return keep


def six(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


AF = """, af AS (SELECT variant_id, CAST(coalesce(sum(dosage), 0) AS BIGINT) AS ac, 2 * count(dosage) AS an,
  CAST(sum(dosage) AS DOUBLE) / nullif(2 * count(dosage), 0) AS f FROM genotypes GROUP BY variant_id),
 maf AS (SELECT *, least(f, 1 - f) AS maf FROM af)"""
GC = """, gc AS (SELECT variant_id, count(*) FILTER (dosage = 0) AS hom_ref, count(*) FILTER (dosage = 1) AS het,
  count(*) FILTER (dosage = 2) AS hom_alt, count(*) FILTER (dosage IS NULL) AS missing FROM genotypes GROUP BY variant_id),
 hw AS (SELECT *, hom_ref + het + hom_alt AS n, CASE WHEN hom_ref + het + hom_alt > 0 THEN (2.0 * hom_ref + het) / (2 * (hom_ref + het + hom_alt)) END AS p FROM gc),
 hwe AS (SELECT *, CASE WHEN p > 0 AND p < 1 THEN pow(hom_ref - n * p * p, 2) / (n * p * p) + pow(het - 2 * n * p * (1 - p), 2) / (2 * n * p * (1 - p))
   + pow(hom_alt - n * (1 - p) * (1 - p), 2) / (n * (1 - p) * (1 - p)) END AS chisq FROM hw)"""
INSIDE = "EXISTS (SELECT 1 FROM intervals i WHERE i.chrom = v.chrom AND v.pos BETWEEN i.start AND i.stop)"


# ---- summaries


@query("sample_summary", """SELECT sample_id, count(dosage) AS calls_raw, count(*) FILTER (dosage > 0) AS variant_calls_raw,
 CAST(coalesce(sum(dosage), 0) AS BIGINT) AS alt_alleles_raw, count(DISTINCT gene) FILTER (dosage > 0) AS genes_raw,
 coalesce(string_agg(DISTINCT gene, ',' ORDER BY gene) FILTER (dosage > 0), '') AS gene_list_raw,
 count(dosage) FILTER (filter = 'PASS') AS calls_pass, count(*) FILTER (dosage > 0 AND filter = 'PASS') AS variant_calls_pass,
 CAST(coalesce(sum(dosage) FILTER (filter = 'PASS'), 0) AS BIGINT) AS alt_alleles_pass, count(DISTINCT gene) FILTER (dosage > 0 AND filter = 'PASS') AS genes_pass,
 coalesce(string_agg(DISTINCT gene, ',' ORDER BY gene) FILTER (dosage > 0 AND filter = 'PASS'), '') AS gene_list_pass
 FROM genotypes JOIN variants USING (variant_id) GROUP BY sample_id""")  # fmt: skip
def _(v):
    return summaries.sample_summary(v.genotypes, v.variants, lists=True)


@query("sample_genes", """SELECT sample_id, string_agg(DISTINCT gene, ',' ORDER BY gene) AS genes FROM genotypes JOIN variants USING (variant_id)
 WHERE dosage > 0 AND filter = 'PASS' GROUP BY sample_id""")  # fmt: skip
def _(v):
    return summaries.sample_genes(v.genotypes, v.variants)


@query("site_genes", """SELECT v.chrom, pos, string_agg(g.gene, ',' ORDER BY g.gene) AS genes FROM variants v JOIN genes g
 ON g.chrom = v.chrom AND v.pos BETWEEN g.start AND g.stop GROUP BY v.chrom, pos""")  # fmt: skip
def _(v):
    from varloom.operators.intervals import range_join

    hits = range_join(v.variants.select("chrom", "pos"), v.genes).select("chrom", "pos", F.col("r_gene").alias("gene"))
    return summaries.site_genes(hits)


@query("allele_freq", AF + " SELECT variant_id, ac, an, round(f, 6) AS af, round(maf, 6) AS maf FROM maf")
def _(v):
    return six(summaries.allele_freq(v.genotypes), "af", "maf")


@query("site_annotations", GC + """ SELECT variant_id, hom_ref, het, hom_alt, missing, 2 * n AS an, het + 2 * hom_alt AS ac, round(chisq, 6) AS chisq,
 CASE WHEN p > 0 AND p < 1 THEN round(1 - het / (2 * p * (1 - p) * n), 6) END AS inbreeding FROM hwe""")  # fmt: skip
def _(v):
    return six(summaries.site_annotations(v.genotypes), "chisq", "inbreeding")


# every heterozygote count of each distinct triple, with the logarithm of its probability (up to a constant)
EXACT = """, tr AS (SELECT DISTINCT hom_ref, het, hom_alt, hom_ref + het + hom_alt AS n, het + 2 * least(hom_ref, hom_alt) AS m FROM gc WHERE hom_ref + het + hom_alt > 0),
 ps AS (SELECT hom_ref, het, hom_alt, h, h * ln(2) - lgamma(h + 1) - lgamma((m - h) // 2 + 1) - lgamma(n - h - (m - h) // 2 + 1) AS l FROM tr, unnest(range(m % 2, m + 1, 2)) u(h)),
 ex AS (SELECT hom_ref, het, hom_alt, max(l) AS top, max(CASE WHEN h = het THEN l END) AS seen FROM ps GROUP BY ALL),
 pv AS (SELECT hom_ref, het, hom_alt, sum(CASE WHEN l <= seen + 1e-7 THEN exp(l - top) ELSE 0 END) / sum(exp(l - top)) AS p_exact FROM ps JOIN ex USING (hom_ref, het, hom_alt) GROUP BY ALL)"""


@query("hardy_weinberg", GC + EXACT + " SELECT variant_id, hom_ref, het, hom_alt, missing, round(chisq, 6) AS chisq, round(p_exact, 6) AS p FROM hwe LEFT JOIN pv USING (hom_ref, het, hom_alt)")
def _(v):
    return six(summaries.hardy_weinberg(v.genotypes), "chisq", "p")


@query("titv_ratio", """, t AS (SELECT filter, count(*) FILTER (ref || alt IN ('AG', 'GA', 'CT', 'TC')) AS ti, count(*) FILTER (ref || alt NOT IN ('AG', 'GA', 'CT', 'TC')) AS tv
 FROM variants GROUP BY filter) SELECT filter, ti, tv, round(CASE WHEN tv > 0 THEN CAST(ti AS DOUBLE) / tv END, 6) AS ratio FROM t""")  # fmt: skip
def _(v):
    return six(summaries.titv_ratio(v.variants, "filter"), "ratio")


@query("missing_summary", """SELECT 'marker' AS kind, variant_id AS id, count(*) FILTER (dosage IS NULL) AS n_miss, count(*) AS n_geno,
 round(avg(CASE WHEN dosage IS NULL THEN 1.0 ELSE 0 END), 6) AS f_miss FROM genotypes GROUP BY variant_id UNION ALL
 SELECT 'sample', sample_id, count(*) FILTER (dosage IS NULL), count(*), round(avg(CASE WHEN dosage IS NULL THEN 1.0 ELSE 0 END), 6) FROM genotypes GROUP BY sample_id""")  # fmt: skip
def _(v):
    marker = summaries.missing_summary(v.genotypes, "variant_id").select(F.lit("marker").alias("kind"), F.col("variant_id").alias("id"), "n_miss", "n_geno", "f_miss")
    sample = summaries.missing_summary(v.genotypes, "sample_id").select(F.lit("sample").alias("kind"), F.col("sample_id").alias("id"), "n_miss", "n_geno", "f_miss")
    return six(marker.unionByName(sample), "f_miss")


@query("case_control_genotypes", """, p AS (SELECT sample_id, 'case_status' AS phenotype, case_status AS status FROM samples WHERE trait IS NOT NULL AND case_status IS NOT NULL
 UNION ALL SELECT sample_id, 'sex', sex FROM samples WHERE trait IS NOT NULL)
 SELECT phenotype, variant_id, count(*) FILTER (status = 2 AND dosage = 0) AS case_hom_ref, count(*) FILTER (status = 2 AND dosage = 1) AS case_het,
 count(*) FILTER (status = 2 AND dosage = 2) AS case_hom_alt, count(*) FILTER (status = 1 AND dosage = 0) AS control_hom_ref,
 count(*) FILTER (status = 1 AND dosage = 1) AS control_het, count(*) FILTER (status = 1 AND dosage = 2) AS control_hom_alt
 FROM genotypes JOIN p USING (sample_id) GROUP BY phenotype, variant_id""")  # fmt: skip
def _(v):
    return summaries.case_control_genotypes(v.genotypes, v.samples, ["case_status", "sex"], ["trait"])


STATE = "CASE WHEN {t} IS NULL THEN 'UNAVAILABLE' WHEN {d} IS NULL THEN 'NO_CALL' WHEN {d} = 0 THEN 'HOM_REF' WHEN {d} = 1 THEN 'HET' ELSE 'HOM_VAR' END"
PAIRED = f""", st AS (SELECT coalesce(a.sample_id, b.sample_id) AS sample_id, coalesce(a.variant_id, b.variant_id) AS variant_id,
 {STATE.format(t="a.sample_id", d="a.dosage")} AS e, {STATE.format(t="b.sample_id", d="b.dosage")} AS c
 FROM genotypes a FULL JOIN calls2 b ON a.sample_id = b.sample_id AND a.variant_id = b.variant_id), sv AS (SELECT st.*, filter FROM st JOIN variants USING (variant_id))"""
CELLS = ", ".join(f"count(*) FILTER (e = '{e}' AND c = '{c}') AS {summaries.cell_name(2 + 6 * i + j)}" for i, e in enumerate(summaries.STATES) for j, c in enumerate(summaries.STATES))


# sites as they come: some without a filter, some indels
MIXED_SITES = "SELECT variant_id, CASE WHEN variant_id % 7 = 0 THEN NULL ELSE filter END AS filter, ref, CASE WHEN variant_id % 5 = 0 THEN alt || ref ELSE alt END AS alt FROM {variants}"


@query("genotype_concordance", PAIRED + f""", ms AS ({MIXED_SITES.replace("{variants}", "variants")}), sf AS (SELECT sample_id, e, c, m.filter, CASE WHEN length(ref) = 1 AND length(alt) = 1 THEN 'SNP' ELSE 'INDEL' END AS type FROM st JOIN ms m USING (variant_id))
 SELECT sample_id, type, CAST(NULL AS VARCHAR) AS filter, grouping(sample_id) = 1 AS all_samples, grouping(type) = 1 AS all_types, true AS raw, {CELLS} FROM sf GROUP BY CUBE (sample_id, type) UNION ALL
 SELECT sample_id, type, 'PASS', grouping(sample_id) = 1, grouping(type) = 1, false, {CELLS} FROM sf WHERE filter = 'PASS' GROUP BY CUBE (sample_id, type)""")
def _(v):
    return summaries.genotype_concordance(v.genotypes, v.calls2, v.spark.sql(MIXED_SITES, variants=v.variants))


def _ratio_sql(cells, minus=False):
    top, bottom = (" + ".join(summaries.cell_name(n) for n in side) for side in cells)
    core = f"CAST({top} AS DOUBLE) / nullif({bottom}, 0)"
    return f"round({'1 - ' + core if minus else core}, 5)"


@query("concordance_metrics", PAIRED + f""", ct AS (SELECT sample_id, {CELLS} FROM sv GROUP BY sample_id) SELECT sample_id, """ + ", ".join(f"{_ratio_sql(c)} AS {n}" for n, c in summaries.RATIOS.items()) + f", {_ratio_sql(summaries.NRD, True)} AS nrd FROM ct")
def _(v):
    return summaries.concordance_metrics(summaries.concordance_table(summaries.paired_states(v.genotypes, v.calls2), "sample_id"), ["sample_id"])


HASH = "CAST('0x' || substr(md5(CAST(sample_id AS VARCHAR) || ':{seed}'), 1, 15) AS BIGINT)"


@query("duplicate_pairs", f""", r AS (SELECT fid, sample_id, row_number() OVER (PARTITION BY fid ORDER BY {HASH.format(seed=1)}, sample_id) AS i FROM samples)
 SELECT fid AS subject, max(sample_id) FILTER (i = 1) AS id1, max(sample_id) FILTER (i = 2) AS id2 FROM r GROUP BY fid HAVING count(*) > 1""")  # fmt: skip
def _(v):
    return summaries.duplicate_pairs(v.samples, F.col("fid"))


@query("icd_matrix", """, q AS (SELECT code FROM codes WHERE n >= 2 GROUP BY code HAVING count(DISTINCT pt_id) >= 5)
 SELECT p.pt_id, q.code, CAST(CASE WHEN c.n IS NULL THEN 0 WHEN c.n >= 2 THEN 1 END AS INT) AS status FROM (SELECT DISTINCT pt_id FROM codes) p CROSS JOIN q
 LEFT JOIN codes c ON c.pt_id = p.pt_id AND c.code = q.code""")  # fmt: skip
def _(v):
    return summaries.icd_matrix(v.codes, 2, 5)


EVENT_NAMES = ["click", "error", "purchase", "signup", "view"]


@query("lab_matrix", "SELECT pt_id, " + ", ".join(f"round(max(median_lab) FILTER (lab_name = '{n}'), 6) AS {n}" for n in EVENT_NAMES) + " FROM labs GROUP BY pt_id")
def _(v):
    return six(summaries.matrix(v.labs, "pt_id", "lab_name", "median_lab", EVENT_NAMES), *EVENT_NAMES)


@query("covariate_table", """, a AS (SELECT *, date_diff('day', make_date(birth_year, 1, 1), make_date(CASE WHEN death_year < 2015 THEN death_year ELSE 2015 END, 1, 1)) / 365.0 AS age FROM demographics
 WHERE sex <> 'Unknown') SELECT pt_id, round(age, 6) AS age, round(age * age, 4) AS age2, bmi, lower(sex) AS sex, lower(race) AS race FROM a""")  # fmt: skip
def _(v):
    return summaries.covariate_table(v.demographics, 2015).withColumns({"age": F.round("age", 6), "age2": F.round("age2", 4)})


@query("bin_burden", AF + """, rare AS (SELECT variant_id, gene FROM maf JOIN variants USING (variant_id) WHERE maf > 0 AND maf <= 0.45),
 big AS (SELECT gene FROM rare GROUP BY gene HAVING count(*) >= 5) SELECT gene AS bin, sample_id, CAST(sum(dosage) AS DOUBLE) AS score
 FROM genotypes JOIN rare USING (variant_id) JOIN big USING (gene) WHERE dosage > 0 GROUP BY gene, sample_id""")  # fmt: skip
def _(v):
    return summaries.bin_burden(v.genotypes, v.variants, 0.45, 5)


@query("bin_summary", """SELECT gene AS bin, count(DISTINCT variant_id) AS num_loci, CAST(coalesce(sum(dosage) FILTER (case_status = 2), 0) AS BIGINT) AS case_vars,
 CAST(coalesce(sum(dosage) FILTER (case_status = 1), 0) AS BIGINT) AS control_vars, 2 * count(dosage) FILTER (case_status = 2) AS case_capacity,
 2 * count(dosage) FILTER (case_status = 1) AS control_capacity, (SELECT count(*) FROM samples WHERE case_status = 2) AS num_cases,
 (SELECT count(*) FROM samples WHERE case_status = 1) AS num_controls
 FROM genotypes JOIN variants USING (variant_id) JOIN samples USING (sample_id) WHERE case_status IS NOT NULL GROUP BY gene""")  # fmt: skip
def _(v):
    return summaries.bin_summary(v.genotypes, v.samples, v.variants.select("variant_id", F.col("gene").alias("bin")))


@query("setid_expand", """, l AS (SELECT variant_id, gene || '|' || filter || '|' || gene AS bins FROM variants) SELECT DISTINCT unnest(string_split(bins, '|')) AS bin, variant_id FROM l""")
def _(v):
    return summaries.setid_expand(v.variants.select("variant_id", F.concat_ws("|", "gene", "filter", "gene").alias("bins")))


@query("permute_phenotypes", f""", o AS (SELECT sample_id, row_number() OVER (ORDER BY {HASH.format(seed=0)}, sample_id) AS r FROM samples),
 d AS (SELECT case_status, row_number() OVER (ORDER BY {HASH.format(seed=11)}, sample_id) AS r FROM samples) SELECT sample_id, case_status FROM o JOIN d USING (r)""")  # fmt: skip
def _(v):
    return summaries.permute_phenotypes(v.samples, 11)


@query("permutation_pvalue", """, b AS (SELECT code, round(avg(CAST(pt_id * 7 % 100 AS DOUBLE) / 100), 4) + 0.00003 AS p FROM codes GROUP BY code),
 m AS (SELECT code, pt_id, CAST((pt_id * 31 + n) % 100 AS DOUBLE) / 100 AS p FROM codes),
 x AS (SELECT code, count(*) FILTER (m.p < b.p) AS below, count(*) AS n FROM m JOIN b USING (code) GROUP BY code)
 SELECT code, round(below / n, 6) AS p_perm, round(CASE WHEN below = 0 THEN 1.0 / n END, 6) AS bound FROM x""")  # fmt: skip
def _(v):
    base = v.codes.groupBy("code").agg((F.round(F.avg((F.col("pt_id") * 7 % 100).cast("double") / 100), 4) + 0.00003).alias("p"))
    permuted = v.codes.select("code", "pt_id", (((F.col("pt_id") * 31 + F.col("n")) % 100).cast("double") / 100).alias("p"))
    return six(summaries.permutation_pvalue(base, permuted, ["code"]), "p_perm", "bound")


IBD = AF + """, cs AS (SELECT variant_id, CAST(an - ac AS DOUBLE) AS x, CAST(ac AS DOUBLE) AS y, CAST(an AS DOUBLE) AS t FROM maf WHERE maf >= 0.2),
 k AS (SELECT avg(2 * x * (x - 1) * y * (y - 1) / d4) AS e00, avg((4 * x * (x - 1) * (x - 2) * y + 4 * y * (y - 1) * (y - 2) * x) / d4) AS e10,
  avg((x * (x - 1) * (x - 2) * (x - 3) + 4 * x * (x - 1) * y * (y - 1) + y * (y - 1) * (y - 2) * (y - 3)) / d4) AS e20,
  avg((2 * x * (x - 1) * y + 2 * x * y * (y - 1)) / d3) AS e11, avg((x * (x - 1) * (x - 2) + x * (x - 1) * y + x * y * (y - 1) + y * (y - 1) * (y - 2)) / d3) AS e21
  FROM (SELECT *, t * (t - 1) * (t - 2) * (t - 3) AS d4, t * (t - 1) * (t - 2) AS d3 FROM cs WHERE t > 3)),
 c AS (SELECT g.variant_id, sample_id, dosage FROM genotypes g JOIN cs USING (variant_id) WHERE dosage IS NOT NULL),
 i AS (SELECT a.sample_id AS id1, b.sample_id AS id2, count(*) AS n, count(*) FILTER (abs(a.dosage - b.dosage) = 2) AS ibs0, count(*) FILTER (abs(a.dosage - b.dosage) = 1) AS ibs1,
  count(*) FILTER (a.dosage = b.dosage) AS ibs2 FROM c a JOIN c b ON a.variant_id = b.variant_id AND a.sample_id < b.sample_id GROUP BY 1, 2 HAVING count(*) >= {shared}),
 z AS (SELECT *, (ibs1 - z0 * e10 * n) / (e11 * n) AS z1 FROM (SELECT i.*, k.*, ibs0 / (e00 * n) AS z0 FROM i, k)),
 y AS (SELECT *, (ibs2 - z0 * e20 * n - z1 * e21 * n) / n AS z2 FROM z),
 y0 AS (SELECT id1, id2, ibs0, ibs1, ibs2, CASE WHEN z0 > 1 THEN [1.0, 0, 0] WHEN z1 > 1 THEN [0.0, 1, 0] WHEN z2 > 1 THEN [0.0, 0, 1] ELSE [z0, z1, z2] END AS z FROM y),
 y1 AS (SELECT * REPLACE (CASE WHEN z[1] < 0 THEN [0.0, z[2] / (z[2] + z[3]), z[3] / (z[2] + z[3])] ELSE z END AS z) FROM y0),
 y2 AS (SELECT * REPLACE (CASE WHEN z[2] < 0 THEN [z[1] / (z[1] + z[3]), 0.0, z[3] / (z[1] + z[3])] ELSE z END AS z) FROM y1),
 y3 AS (SELECT * REPLACE (CASE WHEN z[3] < 0 THEN [z[1] / (z[1] + z[2]), z[2] / (z[1] + z[2]), 0.0] ELSE z END AS z) FROM y2),
 ibd AS (SELECT id1, id2, ibs0, ibs1, ibs2, z[1] AS z0, z[2] AS z1, z[3] AS z2, z[2] / 2 + z[3] AS pi_hat FROM y3)"""


@query("ibd_estimate", IBD.replace("{shared}", "2") + " SELECT id1, id2, ibs0, ibs1, ibs2, round(z0, 6) AS z0, round(z1, 6) AS z1, round(z2, 6) AS z2, round(pi_hat, 6) AS pi_hat FROM ibd WHERE pi_hat >= 0.2")
def _(v):
    return six(kinship.ibd_estimate(v.genotypes, 0.2, 0.2, 2), "z0", "z1", "z2", "pi_hat")


@query("cost_rollup", """SELECT o_orderpriority AS project, round(sum(o_totalprice), 2) AS cost, count(*) AS jobs FROM orders
 WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1997-01-01' GROUP BY o_orderpriority""")  # fmt: skip
def _(v):
    out = summaries.cost_rollup(v.orders.withColumnRenamed("o_orderpriority", "project"), F.lit("1995-01-01").cast("timestamp"), F.lit("1997-01-01").cast("timestamp"), "project", "o_totalprice", "o_orderdate")
    return out.withColumn("cost", F.round("cost", 2))


@query("unique_samples", "SELECT count(DISTINCT sample_id) AS carriers FROM genotypes JOIN variants USING (variant_id) WHERE dosage > 0 AND filter = 'PASS'")
def _(v):
    return summaries.unique_samples(v.genotypes, v.variants)


# ---- filters


@query("select_variants", """, s AS (SELECT variant_id, CAST(coalesce(sum(dosage), 0) AS BIGINT) AS ac, 2 * count(dosage) AS an, avg(CASE WHEN dosage IS NULL THEN 1.0 ELSE 0 END) AS miss
 FROM genotypes WHERE sample_id IN (SELECT sample_id FROM samples WHERE sex = 1) GROUP BY variant_id)""" + AF + f""" SELECT v.variant_id, v.chrom, v.pos, s.ac, s.an, af.ac AS ac_orig, af.an AS an_orig
 FROM variants v JOIN s USING (variant_id) JOIN af USING (variant_id) WHERE filter = 'PASS' AND s.ac > 0 AND miss <= 0.2 AND {INSIDE}""")  # fmt: skip
def _(v):
    return filters.select_variants(v.genotypes, v.variants, v.intervals, v.samples.filter("sex = 1"), passing=True, variant_only=True, most_missing=0.2)


@query("drop_format_fields", "SELECT sample_id, variant_id FROM genotypes")
def _(v):
    return filters.drop_format_fields(v.genotypes, ("dosage", "PL"))


@query("view_variants", f"SELECT v.* FROM variants v WHERE ref = 'A' AND {INSIDE}")
def _(v):
    return filters.view_variants(v.variants, "ref = 'A'", v.intervals)


@query("slice_regions", f"SELECT v.variant_id, v.chrom, v.pos FROM variants v WHERE {INSIDE}")
def _(v):
    from varloom.operators.intervals import in_regions, merge_intervals

    return in_regions(v.variants, merge_intervals(v.intervals)).select("variant_id", "chrom", "pos")


@query("filter_reads_by_region", """, r AS (SELECT o_orderkey AS read_id, CAST(1 + o_custkey % 5 AS INT) AS rname, 1000 + 97 * o_orderkey AS pos, 100 + o_custkey % 50 AS length FROM orders)
 SELECT read_id, rname, pos, length FROM r WHERE EXISTS (SELECT 1 FROM intervals i WHERE i.chrom = rname AND r.pos <= i.stop AND r.pos + length - 1 >= i.start)""")  # fmt: skip
def _(v):
    reads = v.orders.select(F.col("o_orderkey").alias("read_id"), (1 + F.col("o_custkey") % 5).cast("int").alias("rname"), (1000 + 97 * F.col("o_orderkey")).alias("pos"), (100 + F.col("o_custkey") % 50).alias("length"))
    return filters.filter_reads_by_region(reads, v.intervals)


@query("exclude_filtered", "SELECT * FROM variants WHERE filter = 'PASS'")
def _(v):
    return filters.exclude_filtered(v.variants)


@query("biallelic_snp", "SELECT * FROM variants WHERE length(ref) = 1 AND length(alt) = 1")
def _(v):
    return filters.biallelic_snp(v.variants)


@query("variant_type", """, t AS (SELECT variant_id, ref, CASE variant_id % 4 WHEN 0 THEN alt || 'A' WHEN 1 THEN alt || ',' || alt || 'TT' ELSE alt END AS alt FROM variants)
 SELECT variant_id, CASE variant_id % 4 WHEN 0 THEN 'INDEL' WHEN 1 THEN 'MIXED' ELSE 'SNP' END AS kind FROM t""")  # fmt: skip
def _(v):
    alt = F.when(F.col("variant_id") % 4 == 0, F.concat("alt", F.lit("A"))).when(F.col("variant_id") % 4 == 1, F.concat("alt", F.lit(","), "alt", F.lit("TT"))).otherwise(F.col("alt"))
    return v.variants.select("variant_id", alleles.variant_type(F.col("ref"), alt).alias("kind"))


@query("maf_range_filter", "SELECT variant_id FROM clinical WHERE least(1 - (af + af / 2), af) BETWEEN 0.01 AND 0.1")
def _(v):
    rows = v.clinical.select("variant_id", F.array(F.col("af"), F.col("af") / 2).alias("afs"))
    return filters.maf_range_filter(rows, 0.01, 0.1).select("variant_id")


@query("effect_role_filter", "SELECT DISTINCT variant_id FROM transcripts WHERE (effect LIKE '%splice_region_variant%' OR effect = 'stop_gained' OR impact IN ('LOW')) AND warning = ''")
def _(v):
    return filters.effect_role_filter(v.transcripts, ["splice_region_variant", "stop_gained"], ["LOW"], True)


@query("deleterious_vote", """SELECT variant_id FROM clinical WHERE 1 + CAST(Polyphen2_HDIV = 'P' AS INT) + CAST(MutationTaster <> 'N' AS INT) + CAST(MutationAssessor <> 'L' AS INT) >= 3""")
def _(v):
    return filters.deleterious_vote(v.clinical, ["SIFT", "Polyphen2_HDIV", "MutationTaster", "MutationAssessor"], 3).select("variant_id")


@query("clinvar_numeric_filter", "SELECT variant_id FROM variants WHERE variant_id % 7 >= 4 OR variant_id % 5 >= 4")
def _(v):
    rows = v.variants.select("variant_id", F.concat_ws("|", (F.col("variant_id") % 7).cast("string"), (F.col("variant_id") % 5).cast("string")).alias("clnsig_codes"))
    return filters.clinvar_numeric_filter(rows, 4).select("variant_id")


@query("clinvar_pred_filter", "SELECT variant_id FROM clinical WHERE clnsig IN ('Pathogenic', 'risk_factor', 'Benign') AND clnsig <> 'Benign' AND review IN ('practice_guideline', 'reviewed_by_expert_panel')")
def _(v):
    return filters.clinvar_pred_filter(v.clinical, ["Pathogenic", "risk_factor", "Benign"], ["Benign"], ["practice_guideline", "reviewed_by_expert_panel"]).select("variant_id")


@query("pass_intersection", "SELECT variant_id FROM variants WHERE filter = 'PASS' AND variant_id IN (SELECT variant_id FROM clinical WHERE af < 0.1) AND variant_id IN (SELECT variant_id FROM transcripts WHERE impact = 'HIGH')")
def _(v):
    return filters.pass_intersection(v.variants.filter("filter = 'PASS'"), v.clinical.filter("af < 0.1"), v.transcripts.filter("impact = 'HIGH'")).select("variant_id")


RANK_SQL = {
    "impact": "CASE impact WHEN 'HIGH' THEN 4 WHEN 'MODERATE' THEN 3 WHEN 'LOW' THEN 2 WHEN 'MODIFIER' THEN 1 ELSE 0 END",
    "star": "CASE lower(review) WHEN 'classified_by_single_submitter' THEN 1 WHEN 'criteria_provided,_single_submitter' THEN 1 WHEN 'criteria_provided,_multiple_submitters,_no_conflicts' THEN 2 WHEN 'reviewed_by_expert_panel' THEN 3 WHEN 'practice_guideline' THEN 4 ELSE 0 END",
    "sig": "CASE clnsig WHEN 'Pathogenic' THEN 8 WHEN 'Likely_pathogenic' THEN 7 WHEN 'drug_response' THEN 6 WHEN 'protective' THEN 5 WHEN 'risk_factor' THEN 4 WHEN 'Uncertain_significance' THEN 3 WHEN 'Likely_benign' THEN 2 WHEN 'Benign' THEN 1 ELSE 0 END",
    "hgmd": "CASE hgmd WHEN 'DM' THEN 6 WHEN 'DM?' THEN 5 WHEN 'DP' THEN 4 WHEN 'DFP' THEN 3 WHEN 'FTV' THEN 2 WHEN 'FP' THEN 1 ELSE 0 END",
}


@query("annot_filter", f"""SELECT variant_id FROM clinical c WHERE af > 0 AND af <= 0.15 AND (({RANK_SQL['star']} >= 2 AND {RANK_SQL['sig']} >= 5) OR {RANK_SQL['hgmd']} >= 5
 OR EXISTS (SELECT 1 FROM transcripts t WHERE t.variant_id = c.variant_id AND feature LIKE 'E%' AND canonical = 'YES' AND {RANK_SQL['impact']} >= 3))
 AND gene IN (SELECT p_brand FROM part WHERE p_partkey % 3 = 0)""")  # fmt: skip
def _(v):
    genes = v.part.filter("p_partkey % 3 = 0").select(F.col("p_brand").alias("gene")).distinct()
    return filters.annot_filter(v.clinical, v.transcripts, 0.15, impact=3, canonical=True, star=2, significance=5, hgmd=5, genes=genes).select("variant_id")


@query("rank_impact", f"SELECT variant_id, k, {RANK_SQL['impact']} AS rank FROM transcripts")
def _(v):
    return v.transcripts.select("variant_id", "k", ranks.impact_rank(F.col("impact")).alias("rank"))


@query("rank_clinvar_star", f"SELECT variant_id, {RANK_SQL['star']} AS rank FROM clinical")
def _(v):
    return v.clinical.select("variant_id", ranks.review_stars(F.col("review")).alias("rank"))


@query("rank_clinvar_sig", f"SELECT variant_id, {RANK_SQL['sig']} AS rank FROM clinical")
def _(v):
    return v.clinical.select("variant_id", ranks.significance_rank(F.col("clnsig")).alias("rank"))


@query("rank_hgmd", f"SELECT variant_id, {RANK_SQL['hgmd']} AS rank FROM clinical")
def _(v):
    return v.clinical.select("variant_id", ranks.hgmd_rank(F.col("hgmd")).alias("rank"))


@query("position_allele_filter", """, l AS (SELECT chrom, pos, CASE WHEN variant_id % 2 = 0 THEN alt END AS a, CASE WHEN variant_id % 3 = 0 THEN 'N' ELSE alt END AS b FROM variants WHERE variant_id % 4 < 2)
 SELECT v.variant_id FROM variants v WHERE EXISTS (SELECT 1 FROM l WHERE l.chrom = v.chrom AND l.pos = v.pos AND (l.a IS NULL OR v.alt = l.b))""")  # fmt: skip
def _(v):
    a = F.when(F.col("variant_id") % 2 == 0, F.array(F.when(F.col("variant_id") % 3 == 0, "N").otherwise(F.col("alt")))).otherwise(F.array().cast("array<string>"))
    return filters.position_allele_filter(v.variants, v.variants.filter("variant_id % 4 < 2").select("chrom", "pos", a.alias("alleles"))).select("variant_id")


@query("gene_filter", "SELECT variant_id FROM variants WHERE gene IN (SELECT gene FROM genes GROUP BY gene HAVING min(start) < 5000)")
def _(v):
    return filters.gene_filter(v.variants, v.genes.groupBy("gene").agg(F.min("start").alias("s")).filter("s < 5000")).select("variant_id")


@query("annot_expression_filter", "SELECT DISTINCT variant_id FROM transcripts WHERE impact IN ('HIGH', 'MODERATE') AND aa_len > 30 AND canonical = 'YES'")
def _(v):
    return filters.annot_expression_filter(v.transcripts, "impact IN ('HIGH', 'MODERATE') AND aa_len > 30 AND canonical = 'YES'")


@query("hard_filter", "SELECT variant_id, CASE WHEN pos % 2 = 0 THEN CASE WHEN filter = 'PASS' THEN 'Even' ELSE filter || ';Even' END ELSE filter END AS filter FROM variants")
def _(v):
    return filters.hard_filter(v.variants, "Even", "pos % 2 = 0").select("variant_id", "filter")


@query("apply_recalibration", """, s AS (SELECT variant_id, CAST(variant_id * 37 % 101 AS DOUBLE) AS score FROM variants WHERE variant_id % 6 <> 0),
 lim AS (SELECT quantile_cont(score, 0.1) AS lim FROM s WHERE variant_id % 3 = 1)
 SELECT v.variant_id, CASE WHEN score < lim THEN 'Tranche90' ELSE 'PASS' END AS filter FROM variants v LEFT JOIN s USING (variant_id) CROSS JOIN lim""")  # fmt: skip
def _(v):
    scores = v.variants.filter("variant_id % 6 <> 0").select("variant_id", (F.col("variant_id") * 37 % 101).cast("double").alias("score"))
    return filters.apply_recalibration(v.variants, scores, v.variants.filter("variant_id % 3 = 1"), 0.9).select("variant_id", "filter")


@query("marker_maf_filter", AF + " SELECT variant_id FROM maf WHERE coalesce(maf, -1) < 0.4")
def _(v):
    return filters.marker_maf_filter(v.genotypes, 0.4)


@query("marker_call_filter", "SELECT variant_id FROM genotypes GROUP BY variant_id HAVING avg(CASE WHEN dosage IS NULL THEN 1.0 ELSE 0 END) > 0.1")
def _(v):
    return filters.call_filter(v.genotypes, "variant_id", 0.1)


@query("sample_call_filter", "SELECT sample_id FROM genotypes GROUP BY sample_id HAVING avg(CASE WHEN dosage IS NULL THEN 1.0 ELSE 0 END) > 0.1")
def _(v):
    return filters.call_filter(v.genotypes, "sample_id", 0.1)


@query("drop_marker_sample", "SELECT sample_id, variant_id, dosage FROM genotypes WHERE variant_id NOT IN (SELECT variant_id FROM variants WHERE filter <> 'PASS') AND sample_id NOT IN (SELECT sample_id FROM samples WHERE case_status IS NULL)")
def _(v):
    return filters.drop_marker_sample(v.genotypes, v.variants.filter("filter <> 'PASS'"), v.samples.filter("case_status IS NULL")).select("sample_id", "variant_id", "dosage")


@query("extract_marker_sample", f""", x AS (SELECT g.* FROM genotypes g JOIN variants v USING (variant_id) WHERE {INSIDE} AND sample_id IN (SELECT sample_id FROM samples WHERE case_status = 2)),
 m AS (SELECT variant_id, CAST(sum(dosage) AS DOUBLE) / (2 * count(dosage)) AS f FROM x GROUP BY variant_id)
 SELECT sample_id, x.variant_id, dosage FROM x JOIN m USING (variant_id) WHERE least(f, 1 - f) >= 0.3""")  # fmt: skip
def _(v):
    return filters.extract_marker_sample(v.genotypes, v.variants, v.intervals, v.samples.filter("case_status = 2"), 0.3).select("sample_id", "variant_id", "dosage")


@query("hwe_geno_maf_qc", GC + EXACT + " SELECT variant_id FROM hwe JOIN pv USING (hom_ref, het, hom_alt) WHERE least(p, 1 - p) >= 0.3 AND missing <= 0.15 * (n + missing) AND p_exact >= 0.0112")
def _(v):
    return filters.hwe_geno_maf_qc(v.genotypes, 0.3, 0.15, 0.0112)


@query("drop_palindromic", "SELECT variant_id FROM variants WHERE ref || alt NOT IN ('AT', 'TA', 'CG', 'GC')")
def _(v):
    return filters.drop_palindromic(v.variants).select("variant_id")


@query("reject_multiallelic", "SELECT count(*) AS multi, count(*) > 1 AS stop FROM variants WHERE variant_id % 50 = 0")
def _(v):
    alt = F.when(F.col("variant_id") % 50 == 0, F.concat("alt", F.lit("A"))).otherwise(F.col("alt"))
    return filters.reject_multiallelic(v.variants.withColumn("alt", alt))


@query("result_threshold", AF + """, r AS (SELECT variant_id, alt, round(maf, 4) AS m, variant_id % 90 AS num_cases FROM maf JOIN variants USING (variant_id))
 SELECT variant_id, m AS maf, num_cases FROM r WHERE m > 0.35 AND num_cases >= 20""")  # fmt: skip
def _(v):
    r = summaries.allele_freq(v.genotypes).join(v.variants, "variant_id")
    r = r.select("variant_id", F.concat_ws(":", "alt", F.round("maf", 4).cast("string")).alias("var1_maf"), (F.col("variant_id") % 90).alias("num_cases"))
    return filters.result_threshold(r, 0.35, 20).select("variant_id", "maf", "num_cases")


@query("drop_missing_covariates", "SELECT pt_id FROM demographics WHERE bmi IS NOT NULL AND death_year IS NOT NULL")
def _(v):
    return filters.drop_missing_covariates(v.demographics, ["bmi", "death_year"]).select("pt_id")


@query("exclude_regions", f"SELECT v.variant_id FROM variants v WHERE NOT {INSIDE}")
def _(v):
    return filters.exclude_regions(v.variants, v.intervals).select("variant_id")


@query("exclude_marker_list", "SELECT variant_id FROM variants WHERE variant_id NOT IN (SELECT variant_id FROM clinical WHERE clnsig = 'Benign')")
def _(v):
    return filters.exclude_marker_list(v.variants, v.clinical.filter("clnsig = 'Benign'")).select("variant_id")


@query("vcf_to_markers", AF + """ SELECT variant_id, CASE WHEN variant_id % 2 = 0 THEN 'rs' || variant_id ELSE chrom || ':' || pos || ':' || alt END AS id
 FROM variants JOIN maf USING (variant_id) WHERE filter = 'PASS' AND maf >= 0.3""")  # fmt: skip
def _(v):
    named = v.variants.withColumn("id", F.when(F.col("variant_id") % 2 == 0, F.concat(F.lit("rs"), F.col("variant_id"))).otherwise("."))
    return filters.vcf_to_markers(named, v.genotypes, 0.3).select("variant_id", "id")


@query("fill_marker_ids", "SELECT variant_id, CASE WHEN variant_id % 2 = 0 THEN chrom || ':' || pos ELSE 'rs' || variant_id END AS id FROM variants")
def _(v):
    named = v.variants.withColumn("id", F.when(F.col("variant_id") % 2 == 0, F.col("pos").cast("string")).otherwise(F.concat(F.lit("rs"), F.col("variant_id"))))
    return filters.fill_marker_ids(named).select("variant_id", "id")


@query("chrom_subset", "SELECT variant_id FROM variants WHERE chrom BETWEEN 2 AND 4")
def _(v):
    names = F.when(F.col("chrom") == 5, "X").otherwise(F.col("chrom").cast("string"))
    return filters.chrom_subset(v.variants.withColumn("chrom", names), 2, 22).select("variant_id")


# ---- alleles


@query("strip_alleles", """, t AS (SELECT variant_id, pos, CASE variant_id % 3 WHEN 0 THEN 'CA' || ref WHEN 1 THEN ref || 'GG' ELSE ref END AS r, CASE variant_id % 3 WHEN 0 THEN 'CA' || alt || 'T' WHEN 1 THEN alt || 'GG' ELSE alt END AS a, ref, alt FROM variants)
 SELECT variant_id, pos + CASE WHEN variant_id % 3 = 0 THEN CASE WHEN ref = alt THEN 3 ELSE 2 END WHEN variant_id % 3 = 1 AND ref = alt THEN 3 ELSE 0 END AS new_pos,
 CASE WHEN variant_id % 3 = 0 THEN CASE WHEN ref = alt THEN '.' ELSE ref END WHEN variant_id % 3 = 1 AND ref = alt THEN '.' ELSE ref END AS new_ref,
 CASE WHEN variant_id % 3 = 0 THEN CASE WHEN ref = alt THEN 'T' ELSE alt || 'T' END WHEN variant_id % 3 = 1 AND ref = alt THEN '.' ELSE alt END AS new_alt FROM t""")  # fmt: skip
def _(v):
    k = F.col("variant_id") % 3
    r = F.when(k == 0, F.concat(F.lit("CA"), "ref")).when(k == 1, F.concat("ref", F.lit("GG"))).otherwise(F.col("ref"))
    a = F.when(k == 0, F.concat(F.lit("CA"), "alt", F.lit("T"))).when(k == 1, F.concat("alt", F.lit("GG"))).otherwise(F.col("alt"))
    out = v.variants.select("variant_id", alleles.strip_alleles(F.col("pos"), r, a).alias("x"))
    return out.select("variant_id", F.col("x.pos").alias("new_pos"), F.col("x.ref").alias("new_ref"), F.col("x.alt").alias("new_alt"))


@query("fix_monomorphic", """SELECT variant_id, CASE WHEN variant_id % 3 = 0 THEN alt WHEN variant_id % 3 = 1 THEN ref ELSE ref END AS a, CASE WHEN variant_id % 3 = 0 THEN ref ELSE alt END AS b
 FROM variants WHERE ref <> alt""")  # fmt: skip
def _(v):
    k = F.col("variant_id") % 3
    flip = alleles.complement
    a = F.when(k == 0, "0").when(k == 1, F.col("ref")).otherwise(flip(F.col("ref")))
    b = F.when(k == 0, F.col("ref")).when(k == 1, F.lit("0")).otherwise(flip(F.col("alt")))
    x = alleles.fix_monomorphic(a, b, F.col("ref"), F.col("alt"))
    return v.variants.filter("ref <> alt").select("variant_id", x[0].alias("a"), x[1].alias("b"))


@query("hard_call", """, p AS (SELECT sample_id, variant_id, CAST(sample_id * variant_id % 10 AS DOUBLE) / 10 AS x, dosage FROM genotypes)
 SELECT sample_id, variant_id, CAST(CASE WHEN x >= 0.9 THEN 0 WHEN x < 0.1 THEN 1 END AS INT) AS call FROM p""")  # fmt: skip
def _(v):
    x = (F.col("sample_id") * F.col("variant_id") % 10).cast("double") / 10
    return v.genotypes.select("sample_id", "variant_id", alleles.hard_call(x, F.when(x < 0.1, 1.0).otherwise(0.1), F.lit(0.0)).alias("call"))


@query("major_recode", AF + " SELECT variant_id, CASE WHEN f > 0.5 THEN alt ELSE ref END AS major, CASE WHEN f > 0.5 THEN ref ELSE alt END AS minor, round(CASE WHEN f > 0.5 THEN 1 - f ELSE f END, 6) AS freq FROM maf JOIN variants USING (variant_id)")
def _(v):
    rows = summaries.allele_freq(v.genotypes).join(v.variants, "variant_id")
    swap = F.col("af") > 0.5
    return rows.select("variant_id", F.when(swap, F.col("alt")).otherwise(F.col("ref")).alias("major"), F.when(swap, F.col("ref")).otherwise(F.col("alt")).alias("minor"), F.round(F.when(swap, 1 - F.col("af")).otherwise(F.col("af")), 6).alias("freq"))


@query("flatten_annotations", f"""SELECT variant_id, k, string_split(effect, '&')[1] AS first_effect, CAST(len(string_split(effect, '&')) AS INT) AS effects, {RANK_SQL['impact']} AS impact_rank,
 {RANK_SQL['sig']} AS significance, {RANK_SQL['hgmd']} AS hgmd_rank FROM clinical JOIN transcripts USING (variant_id, alt)""")  # fmt: skip
def _(v):
    return annotation.flatten_annotations(v.clinical, v.transcripts)


@query("flatten_carriers", AF + """, c AS (SELECT variant_id, string_agg(CASE WHEN dosage = 1 THEN sample_id END, ',' ORDER BY sample_id) AS het, string_agg(CASE WHEN dosage = 2 THEN sample_id END, ',' ORDER BY sample_id) AS hom
 FROM genotypes WHERE dosage > 0 GROUP BY variant_id), t AS (SELECT * FROM transcripts WHERE k = 0)
 SELECT variant_id, ac, an, round(f, 6) AS frq, t.effect, t.impact, clnsig, hgmd, coalesce(het, '') AS het, coalesce(hom, '') AS hom
 FROM clinical JOIN af USING (variant_id) JOIN c USING (variant_id) LEFT JOIN t USING (variant_id)""")  # fmt: skip
def _(v):
    return annotation.flatten_carriers(v.genotypes, v.clinical, v.transcripts).withColumns({c: F.array_join(c, ",") for c in ("het", "hom")})
