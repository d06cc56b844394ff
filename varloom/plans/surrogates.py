"""Cohort views over the star-schema tables: samples, variants, genotypes and what else the queries need.

The same SQL runs in Spark and in DuckDB, so a query and its oracle start from equal rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_VIEWS = {
    "samples": """SELECT c_custkey AS sample_id, c_nationkey AS fid, CAST(1 + c_custkey % 2 AS INT) AS sex,
        CASE WHEN c_acctbal < 0 THEN 2 WHEN c_custkey % 17 = 0 THEN NULL ELSE 1 END AS case_status,
        c_acctbal AS trait, r_name AS population
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "variants": """SELECT p_partkey AS variant_id, CAST(1 + p_partkey % 5 AS INT) AS chrom, 1000 + 137 * p_partkey AS pos,
        SUBSTR('ACGT', CAST(1 + p_partkey % 4 AS INT), 1) AS ref,
        SUBSTR('ACGT', CAST(1 + (p_partkey % 4 + 1 + p_size % 3) % 4 AS INT), 1) AS alt,
        CASE WHEN p_partkey % 10 = 0 THEN 'LowQual' ELSE 'PASS' END AS filter, p_brand AS gene FROM {part}""",
    "genotypes": """SELECT o_custkey AS sample_id, l_partkey AS variant_id,
        MIN(CASE WHEN (l_orderkey + l_linenumber) % 11 = 0 THEN NULL ELSE (l_orderkey + l_linenumber) % 3 END) AS dosage
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey""",
    "intervals": """SELECT s_suppkey AS interval_id, CAST(1 + s_nationkey % 5 AS INT) AS chrom, 1000 + 2740 * s_suppkey AS start,
        1000 + 2740 * s_suppkey + 137 * (10 + 8 * s_nationkey) AS stop FROM {supplier}""",
    "pairs": """SELECT c_custkey AS id1, c_custkey + 1 AS id2, CAST(c_custkey * 7 % 100 AS DOUBLE) / 100 AS pi_hat
        FROM {customer} WHERE c_custkey % 4 <> 3 AND c_custkey + 1 IN (SELECT c_custkey FROM {customer})""",
    "codes": "SELECT user_id AS pt_id, event_type AS code, COUNT(*) AS n FROM {events} GROUP BY user_id, event_type",
    "labs": "SELECT user_id AS pt_id, event_type AS lab_name, MEDIAN(value) AS median_lab FROM {events} GROUP BY user_id, event_type",
    "calls2": """SELECT sample_id, variant_id,
        CASE WHEN (sample_id + variant_id) % 9 = 0 THEN (dosage + 1) % 3 ELSE dosage END AS dosage
        FROM {genotypes} WHERE (sample_id + 2 * variant_id) % 13 <> 0""",
    "transcripts": """SELECT variant_id, chrom, pos, alt, gene, k, 10 * (variant_id % 7) + 3 * k AS aa_len,
        CASE (variant_id + k) % 4 WHEN 0 THEN 'stop_gained' WHEN 1 THEN 'missense_variant&splice_region_variant'
             WHEN 2 THEN 'synonymous_variant' ELSE 'intron_variant' END AS effect,
        CASE (variant_id + k) % 4 WHEN 0 THEN 'HIGH' WHEN 1 THEN 'MODERATE' WHEN 2 THEN 'LOW' ELSE 'MODIFIER' END AS impact,
        CASE WHEN (variant_id + 2 * k) % 3 = 0 THEN 'NM_' ELSE 'ENST' END AS feature,
        CASE WHEN k = 0 THEN 'YES' ELSE '' END AS canonical,
        CASE WHEN (variant_id * 3 + k) % 5 = 0 THEN 'WARNING_REF' ELSE '' END AS warning
        FROM {variants} CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2) t""",
    "clinical": """SELECT variant_id, chrom, pos, ref, alt, gene, CAST(variant_id * 13 % 200 AS DOUBLE) / 1000 AS af,
        CASE variant_id % 9 WHEN 0 THEN 'Pathogenic' WHEN 1 THEN 'Likely_pathogenic' WHEN 2 THEN 'drug_response'
             WHEN 3 THEN 'protective' WHEN 4 THEN 'risk_factor' WHEN 5 THEN 'Uncertain_significance'
             WHEN 6 THEN 'Likely_benign' WHEN 7 THEN 'Benign' ELSE '.' END AS clnsig,
        CASE variant_id % 6 WHEN 0 THEN 'criteria_provided,_single_submitter' WHEN 1 THEN 'criteria_provided,_multiple_submitters,_no_conflicts'
             WHEN 2 THEN 'reviewed_by_expert_panel' WHEN 3 THEN 'practice_guideline' WHEN 4 THEN 'Classified_by_single_submitter' ELSE 'no_assertion' END AS review,
        CASE variant_id % 7 WHEN 0 THEN 'DM' WHEN 1 THEN 'DM?' WHEN 2 THEN 'DP' WHEN 3 THEN 'DFP' WHEN 4 THEN 'FTV' WHEN 5 THEN 'FP' ELSE 'R' END AS hgmd,
        CASE WHEN variant_id % 2 = 0 THEN 'D' ELSE 'T&D' END AS SIFT, CASE variant_id % 3 WHEN 0 THEN 'P' WHEN 1 THEN 'B' ELSE '.' END AS Polyphen2_HDIV,
        CASE variant_id % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'D&N' END AS MutationTaster, CASE variant_id % 5 WHEN 0 THEN 'H' WHEN 1 THEN 'M' ELSE 'L' END AS MutationAssessor
        FROM {variants}""",
    "genes": """SELECT gene, chrom, MIN(pos) AS start, MIN(pos) + 900 AS stop FROM {variants} GROUP BY gene, chrom""",
    "demographics": """SELECT c_custkey AS pt_id, CASE WHEN c_custkey % 11 = 0 THEN 'Unknown' WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS sex,
        UPPER(c_mktsegment) AS race, CAST(1930 + c_custkey % 70 AS INT) AS birth_year,
        CASE WHEN c_custkey % 13 = 0 THEN CAST(2001 + c_custkey % 20 AS INT) END AS death_year,
        CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE 18 + c_custkey % 25 END AS bmi FROM {customer}""",
}
_BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings")


def _plain(sql: str) -> str:
    return sql.replace("{", "").replace("}", "")


#: All views as a WITH clause for DuckDB.
WITH = "WITH RECURSIVE " + ",\n".join(f"{name} AS ({_plain(sql)})" for name, sql in _VIEWS.items())


class Views:
    """Attribute access gives a table or view of an input folder as a DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in _BASE:
            made = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        elif name in _VIEWS:
            sql = _VIEWS[name]
            made = self.spark.sql(sql, **{n: getattr(self, n) for n in (*_BASE, *_VIEWS) if "{" + n + "}" in sql})
        else:
            raise AttributeError(name)
        setattr(self, name, made)
        return made
