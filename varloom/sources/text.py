"""Readers of the delimited formats, as expressions on a DataFrame of lines (column value).

Each reader works on lines from `spark.read.text` (or `readStream`), so tests and queries can feed it any lines.
Uncompressed text splits across tasks; headers are found by filter, never by reading in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.functions.alleles import gt_dosage, missing_to_null, plain_chrom

# Column layouts.
BIM = "chrom string, id string, cm double, pos long, a1 string, a2 string"
FAM = "fid string, iid string, father string, mother string, sex int, pheno double"
MAP = "chrom string, id string, cm double, pos long"
INFO_COLUMNS = ("snp_id", "rs_id", "position", "exp_freq_a1", "info", "certainty", "type", "info_type0", "concord_type0", "r2_type0")


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """value, file of all lines of one or many (gzipped) text files."""
    return spark.read.text(paths).withColumn("file", F.input_file_name())


def _fields(sep: str = "\t") -> Column:
    return F.split("value", sep)


def vcf_samples(lines: DataFrame) -> list[str]:
    """Sample names of the #CHROM line (the header is the only part that reaches the driver)."""
    head = lines.filter(F.col("value").startswith("#CHROM")).select("value").first()
    return head[0].split("\t")[9:] if head else []


def scan_vcf(lines: DataFrame) -> DataFrame:
    """chrom, pos, id, ref, alts, qual, filter, info (map), format, calls (array) of the data lines."""
    f = F.col("f")
    rows = lines.filter(~F.col("value").startswith("#") & (F.length("value") > 0)).select(_fields().alias("f"))
    info = F.str_to_map(f[7], F.lit(";"), F.lit("="))
    return rows.select(
        plain_chrom(f[0]).alias("chrom"), f[1].cast("long").alias("pos"), f[2].alias("id"), f[3].alias("ref"), F.split(f[4], ",").alias("alts"),
        missing_to_null(f[5]).try_cast("double").alias("qual"), f[6].alias("filter"), info.alias("info"), F.get(f, F.lit(8)).alias("format"),
        F.slice(f, F.lit(10), F.greatest(F.size(f) - 9, F.lit(0))).alias("calls"),
    )


def melt_genotypes(sites: DataFrame, samples: list[str]) -> DataFrame:
    """One row per site and sample: gt, dosage, phased and ft, by the FORMAT order of each row."""
    names = F.array(*map(F.lit, samples))
    rows = sites.select("chrom", "pos", "id", F.split("format", ":").alias("keys"), F.posexplode("calls").alias("i", "call"))
    parts = F.split("call", ":")

    def field(name: str) -> Column:
        at = F.array_position("keys", name).cast("int")
        return F.when(at > 0, F.get(parts, at - 1))

    rows = rows.select("chrom", "pos", "id", F.element_at(names, F.col("i") + 1).alias("sample"), field("GT").alias("gt"), field("FT").alias("ft"))
    return rows.select("*", gt_dosage(F.col("gt")).alias("dosage"), F.col("gt").contains("|").alias("phased"))


def info_fields(lines: DataFrame, key: str) -> list[str]:
    """Names of the |-separated sub-fields that a header line's Description lists for an INFO key."""
    row = lines.filter(F.col("value").startswith(f"##INFO=<ID={key},")).select("value").first()
    return [x.strip() for x in row[0].rsplit(":", 1)[-1].strip(' ">\'').split("|")] if row else []


def parse_annotations(value: Column, names: list[str]) -> Column:
    """array<map> of an annotation list: records by comma, fields by |."""
    keys = F.array(*map(F.lit, names))
    return F.transform(F.split(value, ","), lambda r: F.map_from_arrays(keys, F.slice(F.concat(F.split(r, "\\|"), F.array_repeat(F.lit(""), len(names))), 1, len(names))))


def scan_plink(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """.bim, .fam or .map text by its fixed layout; 0 alleles and -9 are missing."""
    out = spark.read.csv(path, sep="\t", schema=schema)
    return out.withColumns({c: F.nullif(F.col(c), F.lit("0")) for c in ("a1", "a2") if c in out.columns})


def plink_rows(lines: DataFrame, schema: str) -> DataFrame:
    """The same from lines, split at blanks."""
    fields = [x.strip().split(" ") for x in schema.split(",")]
    return lines.select(*(F.split(F.trim("value"), "\\s+")[i].cast(kind).alias(name) for i, (name, kind) in enumerate(fields)))


def scan_impute2(lines: DataFrame, samples: list[str]) -> DataFrame:
    """snp_id, rsid, pos, a1, a2, sample_id, p11, p12, p22: five columns and three probabilities per sample."""
    f = F.col("f")
    rows = lines.select(F.split(F.trim("value"), " ").alias("f"))
    names = F.array(*map(F.lit, samples))
    each = rows.select(f[0].alias("snp_id"), f[1].alias("rsid"), f[2].cast("long").alias("pos"), f[3].alias("a1"), f[4].alias("a2"), "f", F.explode(F.sequence(F.lit(0), F.lit(len(samples) - 1))).alias("i"))

    def p(k: int) -> Column:
        return F.get(f, 5 + 3 * F.col("i") + k).cast("double")

    return each.select("snp_id", "rsid", "pos", "a1", "a2", F.element_at(names, F.col("i") + 1).alias("sample_id"), p(0).alias("p11"), p(1).alias("p12"), p(2).alias("p22"))


def scan_impute2_info(lines: DataFrame) -> DataFrame:
    """The ten-column info table without its header line; -1 is missing."""
    f = F.split(F.trim("value"), " ")
    rows = lines.filter(~F.col("value").startswith("snp_id "))
    number = lambda i: F.nullif(f[i].try_cast("double"), F.lit(-1.0))
    return rows.select(f[0].alias("snp_id"), f[1].alias("rsid"), f[2].cast("long").alias("pos"), *(number(i).alias(INFO_COLUMNS[i]) for i in range(3, 10)))


def impute2_mismatches(genotypes: DataFrame, info: DataFrame) -> DataFrame:
    """Markers that only one of the two files has."""
    a, b = genotypes.select("rsid", "pos").distinct(), info.select("rsid", "pos").distinct()
    return a.join(b, ["rsid", "pos"], "left_anti").withColumn("only_in", F.lit("genotypes")).unionByName(b.join(a, ["rsid", "pos"], "left_anti").withColumn("only_in", F.lit("info")))


def scan_intervals(lines: DataFrame) -> DataFrame:
    """chrom, start, stop of BED rows, `chr:start-end` or a bare `chr`; other lines are dropped, bounds sorted."""
    v = F.trim("value")
    bed = r"^(\S+)\s+(\d+)\s+(\d+)"
    span = r"^([^:\s]+):(\d+)-(\d+)$"
    bare = r"^([^:\s]+)$"
    name = F.when(v.rlike(bed), F.regexp_extract(v, bed, 1)).when(v.rlike(span), F.regexp_extract(v, span, 1)).when(v.rlike(bare), v)

    def bound(group: int) -> Column:
        return F.when(v.rlike(bed), F.regexp_extract(v, bed, group)).when(v.rlike(span), F.regexp_extract(v, span, group)).cast("long")

    rows = lines.select(plain_chrom(name).alias("chrom"), bound(2).alias("a"), bound(3).alias("b")).filter("chrom is not null")
    return rows.select("chrom", F.least("a", "b").alias("start"), F.greatest("a", "b").alias("stop"))


def scan_delimited(spark: SparkSession, path: str, schema: str | None = None, sep: str = "\t") -> DataFrame:
    """A table with a header; NA and empty fields are null, a quote within quotes is doubled."""
    return spark.read.csv(path, sep=sep, header=True, schema=schema, nullValue="NA", quote='"', escape='"')


def scan_rdb(spark: SparkSession, url: str, query: str, column: str | None = None, bounds: tuple[int, int, int] | None = None) -> DataFrame:
    """A relational extract over JDBC, read in parallel ranges of a numeric column if its bounds are given."""
    reader = spark.read.format("jdbc").option("url", url)
    if column and bounds:
        low, high, parts = bounds
        return reader.option("dbtable", f"({query}) q").option("partitionColumn", column).option("lowerBound", low).option("upperBound", high).option("numPartitions", parts).load()
    return reader.option("query", query).load()


def scan_evec(lines: DataFrame) -> DataFrame:
    """sample_id, pcs (array<double>) of eigenvector text: the line of eigenvalues and the last column go."""
    f = F.split(F.trim("value"), "\\s+")
    rows = lines.filter(~F.trim("value").startswith("#eigvals")).filter(F.size(f) > 2)
    return rows.select(f[0].alias("sample_id"), F.transform(F.slice(f, F.lit(2), F.size(f) - 2), lambda x: x.cast("double")).alias("pcs"))


def scan_bins(lines: DataFrame, sep: str = ",") -> DataFrame:
    """Long rows (outcome, row, status, i, value) of bin files `<prefix>-<outcome>-bins.csv`; `row` is the first
    field (a preamble name, `... p-value`, `Gene(s)` or a sample id), i the bin's column."""
    outcome = F.regexp_extract("file", r"[^/]*?-([^/]*)-bins\.csv$", 1)
    f = F.split("value", sep)
    rows = lines.select(outcome.alias("outcome"), f[0].alias("row"), F.get(f, F.lit(1)).alias("status"), F.posexplode(F.slice(f, F.lit(3), F.greatest(F.size(f) - 2, F.lit(0)))).alias("i", "value"))
    return rows.withColumn("value", missing_to_null(F.col("value")))


def extract(table: DataFrame, query: str) -> DataFrame:
    """A relational extract from a table that is at hand as a DataFrame, called {source} in the query."""
    return table.sparkSession.sql(query, source=table)


def pair_inputs(data: DataFrame, companions: DataFrame) -> DataFrame:
    """data, companion of paths (column path) that share a base name."""
    base = F.regexp_extract(F.col("path"), r"([^/]+?)(\.[a-z]+)*$", 1)
    a = data.select(F.col("path").alias("data"), base.alias("base"))
    b = companions.select(F.col("path").alias("companion"), base.alias("base"))
    return a.join(b, "base").select("data", "companion")


def scan_many(spark: SparkSession, data: list[str], companions: list[str]) -> DataFrame:
    """The same for lists of paths; fails where they do not all pair up."""
    frames = [spark.createDataFrame([(p,) for p in paths], "path string") for paths in (data, companions)]
    both = pair_inputs(*frames)
    if not both.count() == len(data) == len(companions):
        raise ValueError("inputs and companions do not pair up")
    return both


def scan_ped(lines: DataFrame) -> DataFrame:
    """fid, iid, father, mother, sex, pheno, calls of .ped lines: calls is an array of (a1, a2) in marker order.

    Fields go by blanks; 0 alleles, -9 phenotypes and 0 parents are missing.  Comments and empty lines are left out.
    """
    f = F.col("f")
    rows = lines.filter(~F.trim("value").startswith("#") & (F.trim("value") != "")).select(F.split(F.trim("value"), "\\s+").alias("f"))
    known = lambda i: F.nullif(F.get(f, i), F.lit("0"))
    markers = F.floor((F.size(f) - 6) / 2).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), markers - 1), lambda i: F.struct(known(2 * i + 6).alias("a1"), known(2 * i + 7).alias("a2")))
    calls = F.when(markers > 0, pairs).otherwise(F.slice(pairs, 1, 0))
    pheno = F.nullif(F.get(f, F.lit(5)).try_cast("double"), F.lit(-9.0))
    return rows.select(f[0].alias("fid"), f[1].alias("iid"), known(F.lit(2)).alias("father"), known(F.lit(3)).alias("mother"), F.get(f, F.lit(4)).try_cast("int").alias("sex"), pheno.alias("pheno"), calls.alias("calls"))


def melt_ped(people: DataFrame, markers: DataFrame) -> DataFrame:
    """iid, id, dosage: copies of the marker's a1 in each call, null where an allele is missing or not the marker's.

    `markers` holds at (from 0, the order of the calls), id, a1 and a2.
    """
    rows = people.select("iid", F.posexplode("calls").alias("at", "call")).join(markers.select("at", "id", "a1", "a2"), "at")
    copies = lambda c: F.when(c == F.col("a1"), 1).when(c == F.col("a2"), 0)
    return rows.select("iid", "id", (copies(F.col("call.a1")) + copies(F.col("call.a2"))).alias("dosage"))
