"""Annotation joins, call-set merges and panel merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varloom.functions import alleles
from varloom.functions.hashing import BOUND, seeded
from varloom.operators.intervals import nearest_gene, range_join, with_prefix_maximum

SITE = ["chrom", "pos", "ref", "alt"]


def explode_alts(sites: DataFrame) -> DataFrame:
    """One row per alternative allele of a comma list, with its 1-based allele_index."""
    rows = sites.select("*", F.posexplode(F.split("alt", ",")).alias("__i", "__alt"))
    return rows.withColumn("alt", F.col("__alt")).withColumn("allele_index", F.col("__i") + 1).drop("__i", "__alt")


def annotate_sites(sites: DataFrame, *sources: tuple[DataFrame, list[str]]) -> DataFrame:
    """Left joins of annotation columns on (chrom, pos, ref, alt), one source after the other; a source that
    repeats a site gives its first record, as a whole, by the values of the columns in order (nulls last)."""
    out = explode_alts(sites)
    for source, columns in sources:
        order = F.struct(*(x for c in columns for x in (F.col(c).isNull(), F.col(c))))
        one = source.groupBy(*SITE).agg(F.min_by(F.struct(*columns), order).alias("__record"))
        out = out.join(one.select(*SITE, "__record.*"), SITE, "left")
    return out


def annotate_results(results: DataFrame, code_text: DataFrame, genes: DataFrame, catalog: DataFrame, grasp: DataFrame, most_p: float | None = None) -> DataFrame:
    """Association rows (result_id, code, variant_id, chrom, pos) with code text, genes, nearest genes, catalogue
    traits and reported phenotypes; 'NA' where there is none, one output row per input row.

    Every many-valued side is collapsed to one row per key before it is joined.
    """
    points = results.select("variant_id", "chrom", "pos").distinct()
    inside = range_join(points, genes).groupBy("variant_id").agg(F.array_join(F.array_sort(F.collect_set("r_gene")), ",").alias("genes"))
    near = nearest_gene(points, genes)
    traits = catalog.groupBy("chrom", "pos").agg(F.array_join(F.array_sort(F.collect_set("trait")), ",").alias("traits"))
    reported = grasp if most_p is None else grasp.filter(F.col("p") < most_p)
    reported = reported.groupBy("variant_id").agg(F.array_join(F.array_sort(F.collect_set("phenotype")), ",").alias("phenotypes"))
    text = code_text.groupBy("code").agg(F.min("text").alias("text"))
    out = results.join(text, "code", "left").join(inside, "variant_id", "left").join(near, "variant_id", "left")
    out = out.join(traits, ["chrom", "pos"], "left").join(reported, "variant_id", "left")
    names = ["text", "genes", "up_gene", "down_gene", "traits", "phenotypes"]
    return out.select("result_id", *(F.coalesce(F.col(n), F.lit("NA")).alias(n) for n in names))


def assign_known_ids(sites: DataFrame, known: DataFrame) -> DataFrame:
    one = known.groupBy(*SITE).agg(F.min("id").alias("__known"))
    return sites.join(one, SITE, "left").withColumn("id", F.coalesce("__known", "id")).drop("__known")


def concordant_sites(sites: DataFrame, other: DataFrame) -> DataFrame:
    return sites.join(other.select(*SITE), SITE, "left_semi")


def merge_callsets(callsets: list[DataFrame]) -> DataFrame:
    """Genotypes of several call sets in one long table; the first source wins where they share a cell."""
    rows = None
    for i, one in enumerate(callsets):
        own = one.select("sample_id", "variant_id", "dosage", F.lit(i).alias("source"))
        rows = own if rows is None else rows.unionByName(own)
    first = F.min_by(F.struct("dosage", "source"), "source")
    out = rows.groupBy("sample_id", "variant_id").agg(first.alias("x"), F.count("*").alias("copies"))
    return out.select("sample_id", "variant_id", "x.dosage", "x.source", "copies")


def merge_sites(sites: DataFrame) -> DataFrame:
    """One row per (chrom, pos, ref) with the sorted alternatives of all sources."""
    return explode_alts(sites).groupBy("chrom", "pos", "ref").agg(F.array_join(F.array_sort(F.collect_set("alt")), ",").alias("alt"))


def merge_gvcf_blocks(variants: DataFrame, calls: DataFrame, blocks: DataFrame) -> DataFrame:
    """Genotypes at all variant sites: called ones, and dosage 0 where a sample's reference block
    (sample_id, chrom, start, stop) covers the site."""
    covered = range_join(variants.select("variant_id", "chrom", "pos"), blocks).select(F.col("r_sample_id").alias("sample_id"), "variant_id").distinct()
    reference = covered.join(calls.select("sample_id", "variant_id"), ["sample_id", "variant_id"], "left_anti").withColumn("dosage", F.lit(0).cast("long"))
    return calls.select("sample_id", "variant_id", "dosage").unionByName(reference)


def join_imputed_groups(groups: DataFrame) -> DataFrame:
    """Markers that all files hold, from rows (file, pos, a1, a2, rsid, freq, info, type).

    The key is the position and the unordered allele pair.  Where a file has the alleles the other way round,
    its frequency is turned; info values average without -1, type is the least, the label is the one with the
    highest rs number, or the least label.
    """
    a1, a2 = F.lower("a1"), F.lower("a2")
    rows = groups.withColumn("lo", F.least(a1, a2)).withColumn("hi", F.greatest(a1, a2)).withColumn("swap", a1 > a2)
    rows = rows.withColumn("freq", F.when(F.col("swap"), 1 - F.col("freq")).otherwise(F.col("freq")))
    files = groups.agg(F.count_distinct("file").alias("files"))
    number = F.regexp_extract("rsid", "^rs([0-9]+)$", 1).try_cast("long")
    out = rows.groupBy("pos", "lo", "hi").agg(
        F.count_distinct("file").alias("n"),
        F.avg("freq").alias("freq"),
        F.avg(F.nullif(F.col("info"), F.lit(-1.0))).alias("info"),
        F.min("type").alias("type"),
        F.coalesce(F.max_by("rsid", number), F.min("rsid")).alias("label"),
    )
    return out.join(F.broadcast(files), F.col("n") == F.col("files")).drop("n", "files")


def imputed_triples(probabilities: DataFrame) -> DataFrame:
    """Genotype probabilities with the allele pair in order: swapped markers have their triple reversed."""
    swap = F.lower("a1") > F.lower("a2")
    return probabilities.select(
        "file", "pos", "sample_id", F.least(F.lower("a1"), F.lower("a2")).alias("lo"), F.greatest(F.lower("a1"), F.lower("a2")).alias("hi"),
        F.when(swap, F.col("p22")).otherwise(F.col("p11")).alias("p11"), "p12", F.when(swap, F.col("p11")).otherwise(F.col("p22")).alias("p22"),
    )


def first_file_samples(samples: DataFrame) -> DataFrame:
    """sample_id, file, dupe: the first file of a sample holds it, the rest are duplicates."""
    order = Window.partitionBy("sample_id").orderBy("file")
    return samples.withColumn("dupe", F.row_number().over(order) > 1)


def marker_order_check(markers: DataFrame) -> DataFrame:
    """Markers of the second file that come after one which the first file has later, with `beyond`, the furthest such
    marker, and its line in the first file."""
    def ranked(file: int, name: str) -> DataFrame:
        own = markers.filter(F.col("file") == file)
        return own.select("chrom", "marker", F.col("line").alias(name))

    both = ranked(0, "first").join(ranked(1, "second"), ["chrom", "marker"]).withColumn("__at", F.struct("first", "marker"))
    seen = with_prefix_maximum(both, ["chrom"], ["second", "marker"], furthest="__at")
    late = seen.filter(F.col("first") < F.col("furthest.first"))
    return late.select("chrom", "marker", "first", "second", F.col("furthest.marker").alias("beyond"), F.col("furthest.first").alias("beyond_first"))


def swapped_markers(late: DataFrame, markers: DataFrame) -> DataFrame:
    """chrom, marker, swapped: every marker of the first file that a late marker (of marker_order_check) comes after only
    in the second one's order, the furthest one included."""
    spans = late.select("chrom", "marker", (F.col("first") + 1).alias("start"), F.col("beyond_first").alias("stop"))
    points = markers.filter("file = 0").select("chrom", F.col("line").alias("pos"), F.col("marker").alias("swapped"))
    return range_join(points, spans).select("chrom", F.col("r_marker").alias("marker"), "swapped")


def merge_plink(inputs: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Genotypes of the samples that every input has, and the samples that some input lacks."""
    rows = None
    for i, one in enumerate(inputs):
        own = one.select("sample_id", "variant_id", "dosage", F.lit(i).alias("file"))
        rows = own if rows is None else rows.unionByName(own)
    held = rows.groupBy("sample_id").agg(F.count_distinct("file").alias("n"))
    lacking = held.filter(F.col("n") < len(inputs)).select("sample_id")
    kept = rows.join(held.filter(F.col("n") == len(inputs)), "sample_id", "left_semi")
    return kept.groupBy("sample_id", "variant_id").agg(F.min_by("dosage", "file").alias("dosage")), lacking


def merge_reference_panel(markers: DataFrame, panel: DataFrame) -> DataFrame:
    """Markers shared with a panel, with the strand mended: palindromes go, alleles that only match as
    complements are flipped, and what still differs goes.  flipped and swapped tell what was done."""
    p = panel.select("chrom", "pos", F.col("ref").alias("p_ref"), F.col("alt").alias("p_alt"))
    rows = markers.filter(~alleles.palindromic(F.col("ref"), F.col("alt"))).join(p, ["chrom", "pos"])
    own = alleles.canonical_pair(F.col("ref"), F.col("alt"))
    other = alleles.canonical_pair(alleles.complement(F.col("ref")), alleles.complement(F.col("alt")))
    ours = alleles.canonical_pair(F.col("p_ref"), F.col("p_alt"))
    rows = rows.withColumn("flipped", own != ours).filter((own == ours) | (other == ours))
    first = F.when(F.col("flipped"), alleles.complement(F.col("ref"))).otherwise(F.col("ref"))
    return rows.withColumn("swapped", first != F.col("p_ref"))


def population_labels(samples: DataFrame, panel: DataFrame) -> DataFrame:
    return samples.join(panel.select("sample_id", "population"), "sample_id", "left").withColumn("population", F.coalesce("population", F.lit("UNK")))


def rename_samples(genotypes: DataFrame, names: DataFrame) -> DataFrame:
    """Samples renamed through (old_id, new_id); unmapped ones are dropped."""
    return genotypes.join(names, genotypes["sample_id"] == names["old_id"]).withColumn("sample_id", F.col("new_id")).drop("old_id", "new_id")


def pheno_status_fill(fam: DataFrame, status: DataFrame) -> DataFrame:
    return fam.join(status.select("sample_id", "status"), "sample_id", "left").withColumn("status", F.coalesce("status", F.lit(-9)))


def case_check(cases: DataFrame, genotypes: DataFrame) -> DataFrame:
    return cases.join(genotypes.select("sample_id"), "sample_id", "left_anti")


def id_overlap_check(phenotypes: DataFrame, genotypes: DataFrame) -> DataFrame:
    """How many phenotype ids have genotypes; `ok` is false at zero."""
    both = phenotypes.select("sample_id").distinct().join(genotypes.select("sample_id"), "sample_id", "left_semi")
    return both.agg(F.count("*").alias("matching")).withColumn("ok", F.col("matching") > 0)


def code_grid(counts: DataFrame, codes: DataFrame) -> DataFrame:
    """Every patient with every qualifying code, and the count where there is one."""
    listed = codes.agg(F.collect_set("code").alias("codes"))  # one row, as long as the code list
    grid = counts.select("pt_id").distinct().join(F.broadcast(listed)).select("pt_id", F.explode("codes").alias("code"))
    return grid.join(counts, ["pt_id", "code"], "left")


def relationship_map_join(dropped: DataFrame, fam: DataFrame) -> DataFrame:
    return dropped.join(fam, "sample_id").select("fid", "sample_id")


def strand_update(markers: DataFrame, strand: DataFrame) -> DataFrame:
    """Chromosome and position from the strand file, alleles complemented on strand '-', only listed markers."""
    s = strand.select("variant_id", F.col("chrom").alias("s_chrom"), F.col("pos").alias("s_pos"), "strand")
    rows = markers.join(s, "variant_id")

    def turned(c: str):
        return F.when(F.col("strand") == "-", alleles.complement(F.col(c))).otherwise(F.col(c))

    return rows.select("variant_id", F.col("s_chrom").alias("chrom"), F.col("s_pos").alias("pos"), turned("ref").alias("ref"), turned("alt").alias("alt"))


# ---- set operations and sorts


def sort_by_contig(rows: DataFrame, contigs: list[str]) -> DataFrame:
    """Order by sequence-dictionary index, position and source; contigs that are not listed come last."""
    index = F.array_position(F.array(*map(F.lit, contigs)), F.col("chrom").cast("string"))
    return rows.orderBy(F.when(index == 0, F.lit(1 << 30)).otherwise(index), "pos", *(["source"] if "source" in rows.columns else []))


def cat_variants(parts: list[DataFrame]) -> DataFrame:
    """Union of files with the same columns, with the file's number as source."""
    out = None
    for i, part in enumerate(parts):
        own = part.withColumn("source", F.lit(i))
        out = own if out is None else out.unionByName(own)
    return out


def numeric_sort_results(results: DataFrame) -> DataFrame:
    return results.orderBy(F.col("chrom").try_cast("int"), F.col("pos").try_cast("long"), F.col("p").try_cast("double"))


def intersect_keys(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def except_keys(a: DataFrame, b: DataFrame, on: str) -> DataFrame:
    return a.join(b.select(on), on, "left_anti")


def distinct_keys(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The first row seen of each key, in the order of a column."""
    return rows.groupBy(key).agg(F.min(order).alias(order))


def dup_groups(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).count().filter("count > 1")


def random_half(samples: DataFrame, seed: int) -> DataFrame:
    """Half of the samples, those with the smaller seeded hashes, as pseudo-cases.

    The median hash is found by rank counting within 4096 hash ranges, so no task sorts all samples.
    """
    h = seeded(F.col("sample_id"), seed)
    rows = samples.select("sample_id").withColumn("h", h).withColumn("part", F.floor(F.col("h") / float(BOUND) * 4096).cast("int"))
    sizes = rows.groupBy("part").count()
    running = sizes.withColumn("before", F.coalesce(F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    running = running.withColumn("total", F.sum("count").over(Window.partitionBy())).drop("count")
    rank = F.row_number().over(Window.partitionBy("part").orderBy("h", "sample_id"))
    rows = rows.withColumn("rn", rank).join(F.broadcast(running), "part")
    return rows.select("sample_id", ((F.col("before") + F.col("rn")) * 2 <= F.col("total")).alias("pseudo_case"))
