"""The text readers on streams: the same expressions over `readStream`, for files that keep arriving."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.sources.text import melt_genotypes, scan_vcf


def stream_lines(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """value, file of the lines of text files as they land in a folder."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder).withColumn("file", F.input_file_name())


def stream_genotypes(lines: DataFrame, samples: list[str]) -> DataFrame:
    """Long genotypes of streamed VCF lines; sample names come from a header read beforehand."""
    return melt_genotypes(scan_vcf(lines), samples)


def running_allele_counts(genotypes: DataFrame) -> DataFrame:
    """AC and AN per site over everything that has arrived (use with output mode complete or update)."""
    return genotypes.groupBy("chrom", "pos").agg(F.coalesce(F.sum("dosage"), F.lit(0)).alias("ac"), (2 * F.count("dosage")).alias("an"))
