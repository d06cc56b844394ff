"""Queries on panel projection and permutation tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from varloom.operators import permutation, projection
from varloom.plans.cohort import query, six

# every permutation of every marker, then the rule that stops
SHUFFLED = """, tr AS (SELECT sample_id, CAST(min(case_status) AS DOUBLE) AS y FROM samples WHERE case_status IS NOT NULL GROUP BY sample_id),
 rk AS MATERIALIZED (SELECT s, sample_id, y, row_number() OVER (PARTITION BY s ORDER BY CAST('0x' || substr(md5(sample_id || ':' || s), 1, 15) AS BIGINT), sample_id) AS r
  FROM tr CROSS JOIN (SELECT unnest(range(0, {last})) AS s)),
 sh AS (SELECT a.sample_id, b.s, b.y FROM rk a JOIN rk b ON a.r = b.r WHERE a.s = 0 AND b.s > 0 UNION ALL SELECT sample_id, 0, y FROM tr),
 sm AS (SELECT variant_id, s, CAST(count(*) AS DOUBLE) AS n, CAST(sum(dosage) AS DOUBLE) AS d, CAST(sum(dosage * dosage) AS DOUBLE) AS dd, sum(y) AS y, sum(y * y) AS yy, sum(dosage * y) AS dy
  FROM genotypes JOIN sh USING (sample_id) WHERE dosage IS NOT NULL GROUP BY 1, 2),
 st AS MATERIALIZED (SELECT variant_id, s, n, pow(n * dy - d * y, 2) / ((n * dd - d * d) * (n * yy - y * y)) AS stat FROM sm WHERE (n * dd - d * d) * (n * yy - y * y) > 0),
 ob AS (SELECT variant_id, n, stat FROM st WHERE s = 0)"""


@query("permute_until_settled", SHUFFLED.format(last=101) + """, pm AS (SELECT variant_id, s, sum(CASE WHEN st.stat >= ob.stat * (1 - 1e-9) THEN 1 ELSE 0 END) OVER (PARTITION BY variant_id ORDER BY s) AS hits
  FROM ob JOIN st USING (variant_id) WHERE s > 0),
 en AS (SELECT variant_id, min(s) FILTER (hits >= 5) AS stop, max(hits) AS hits FROM pm GROUP BY variant_id)
 SELECT variant_id, CAST(n AS BIGINT) AS n, round(stat, 6) AS stat, CAST(CASE WHEN stop IS NULL THEN coalesce(hits, 0) ELSE 5 END AS BIGINT) AS exceeding, CAST(coalesce(stop, 100) AS BIGINT) AS permutations,
  round(CASE WHEN stop IS NULL THEN (coalesce(hits, 0) + 1) / 101.0 ELSE 5.0 / stop END, 6) AS p FROM ob LEFT JOIN en USING (variant_id)""")  # fmt: skip
def _(v):
    return six(permutation.permute_until_settled(v.genotypes, v.samples, "case_status", most=100, enough=5, per_round=25), "stat", "p")


@query("permute_maxima", SHUFFLED.format(last=51) + """, mx AS (SELECT s, max(stat) AS top FROM st WHERE s > 0 GROUP BY s)
 SELECT variant_id, CAST(n AS BIGINT) AS n, round(stat, 6) AS stat, round((1 + (SELECT count(*) FROM mx WHERE top >= ob.stat * (1 - 1e-9))) / 51.0, 6) AS p_family FROM ob""")  # fmt: skip
def _(v):
    return six(permutation.permute_maxima(v.genotypes, v.samples, "case_status", permutations=50, per_round=25), "stat", "p_family")


@query("project_samples", """, fq AS (SELECT variant_id, avg(dosage) / 2 AS p FROM genotypes WHERE dosage IS NOT NULL GROUP BY variant_id),
 ld AS (SELECT variant_id, p, CAST(embedding[1] AS DOUBLE) AS a, CAST(embedding[2] AS DOUBLE) AS b FROM fq JOIN embeddings ON vec_id = variant_id WHERE p > 0 AND p < 1),
 zs AS (SELECT sample_id, a, b, (dosage - 2 * p) / sqrt(2 * p * (1 - p)) AS z FROM genotypes JOIN ld USING (variant_id) WHERE dosage IS NOT NULL),
 ne AS (SELECT sample_id, count(*) AS markers, sum(a * a) AS aa, sum(a * b) AS ab, sum(b * b) AS bb, sum(a * z) AS az, sum(b * z) AS bz FROM zs GROUP BY sample_id)
 SELECT sample_id, markers, CASE WHEN markers > 1 THEN round((bb * az - ab * bz) / (aa * bb - ab * ab), 5) END AS pc1, CASE WHEN markers > 1 THEN round((aa * bz - ab * az) / (aa * bb - ab * ab), 5) END AS pc2 FROM ne""")  # fmt: skip
def _(v):
    called = v.genotypes.filter("dosage is not null").groupBy("variant_id").agg((F.avg("dosage") / 2).alias("p"))
    loadings = called.join(v.embeddings.select(F.col("vec_id").alias("variant_id"), F.slice("embedding", 1, 2).cast("array<double>").alias("w")), "variant_id")
    rows = projection.project(v.genotypes, loadings, 2)
    return rows.select("sample_id", "markers", F.round(F.col("scores")[0], 5).alias("pc1"), F.round(F.col("scores")[1], 5).alias("pc2"))


@query("panel_projection")
def _(v):
    return projection.project_on_panel(v.genotypes, v.samples.filter("population = 'EUROPE'"), 2)
