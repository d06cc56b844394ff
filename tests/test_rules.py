"""Hand-made cases for single rules, and invariants."""

import itertools

import pytest
from pyspark.sql import functions as F

from varloom.functions import alleles, ranks
from varloom.operators import filters, graphs, intervals, joins, kinship, models, statistics, summaries
from varloom.sources import sinks, text
from varloom.streaming import sources as streams


def one(spark, value, **columns):
    row = spark.createDataFrame([tuple(columns.values())], ", ".join(f"{k} {'long' if isinstance(v, int) else 'string'}" for k, v in columns.items()))
    return row.select(value.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "pos, ref, alt, want",
    [
        (10, "A", "G", (10, "A", "G")), (10, "CAT", "CAG", (12, "T", "G")), (10, "CA", "C", (11, "A", ".")), (10, "C", "CTT", (11, ".", "TT")),
        (10, "ACGG", "TCGG", (10, "A", "T")), (10, "AAA", "AAA", (13, ".", ".")), (10, "GT", "AT", (10, "G", "A")),
    ],
)
def test_strip_alleles(spark, pos, ref, alt, want):
    assert tuple(one(spark, alleles.strip_alleles(F.col("pos"), F.col("ref"), F.col("alt")), pos=pos, ref=ref, alt=alt)) == want


@pytest.mark.parametrize(
    "a, b, pa, pb, want",
    [("0", "A", "A", "G", ["G", "A"]), ("A", "0", "G", "A", ["A", "G"]), ("T", "C", "A", "G", ["A", "G"]), ("A", "C", "A", "G", None), ("0", "T", "A", "G", None)],
)
def test_fix_monomorphic(spark, a, b, pa, pb, want):
    assert one(spark, alleles.fix_monomorphic(*map(F.col, ("a", "b", "pa", "pb"))), a=a, b=b, pa=pa, pb=pb) == want


@pytest.mark.parametrize("gt, want", [("0/1", 1), ("1|1", 2), ("./.", None), ("0|.", None), ("2/1", 2), ("0", 0)])
def test_genotypes_split_on_both_separators(spark, gt, want):
    assert one(spark, alleles.gt_dosage(F.col("gt")), gt=gt) == want


@pytest.mark.parametrize("value, rank", [("Pathogenic", 8), ("Likely_pathogenic", 7), ("Likely_benign", 2), ("Benign", 1), ("not_provided", 3), ("x", 0)])
def test_significance(spark, value, rank):
    assert one(spark, ranks.significance_rank(F.col("v")), v=value) == rank


def test_nested_intervals_keep_the_later_end(spark):
    df = spark.createDataFrame([(1, 10, 100), (1, 20, 30), (1, 100, 120), (1, 130, 125), (2, 5, 6)], "chrom int, start long, stop long")
    got = sorted(map(tuple, intervals.merge_intervals(df).collect()))
    assert got == [(1, 10, 120), (1, 125, 130), (2, 5, 6)]


def test_range_join_of_all_widths_and_open_bounds(spark):
    points = [(i, "1" if i % 3 else "2", p) for i, p in enumerate([0, 1, 99_999, 100_000, 6_400_000, 123_456_789, 5_000_000_000])]
    regions = [(0, "1", 0, 0), (1, "1", 99_999, 100_001), (2, "1", 50, 9_000_000), (3, "2", None, None), (4, "1", 7_000_000_000, 1), (5, "1", 100_000_000, 130_000_000)]
    p, r = spark.createDataFrame(points, "id long, chrom string, pos long"), spark.createDataFrame(regions, "region long, chrom string, start long, stop long")
    want = sorted((i, k) for i, c, x in points for k, rc, a, b in regions if c == rc and (a is None or min(a, b) <= x <= max(a, b)))
    assert sorted((x.id, x.r_region) for x in intervals.range_join(p, r).collect()) == want
    inside = {i for i, _ in want}
    assert {x.id for x in intervals.in_regions(p, r).collect()} == inside
    assert {x.id for x in intervals.in_regions(p, r, "left_anti").collect()} == {i for i, *_ in points} - inside


def test_spans_meet_regions(spark):
    spans = [(0, 1, 10, 20), (1, 1, 0, 10_000_000), (2, 1, 90, 91), (3, 2, 10, 20), (4, 1, 31, 40)]
    regions = [(1, 15, 16), (1, 20, 30), (1, 9_000_000, 9_500_000)]
    s = spark.createDataFrame(spans, "id long, chrom int, a long, b long")
    r = spark.createDataFrame(regions, "chrom int, start long, stop long")
    want = {i for i, c, a, b in spans if any(c == rc and a <= y and b >= x for rc, x, y in regions)}
    assert {x.id for x in intervals.in_regions(s, r, start="a", stop="b").collect()} == want


def test_text_readers(spark):
    lines = [
        "##fileformat=VCFv4.2", '##INFO=<ID=CSQ,Number=.,Type=String,Description="Consequence. Format: Allele|IMPACT|SYMBOL">',
        "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2", "chr1\t5\t.\tA\tG,T\t.\tPASS\tAF=0.1;DB\tFT:GT\tPASS:0|1\tq:./.", "X\t9\trs1\tC\tT\t30\tq\t.\tGT\t1/1\t0/0",
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    assert text.vcf_samples(df) == ["S1", "S2"] and text.info_fields(df, "CSQ") == ["Allele", "IMPACT", "SYMBOL"]
    rows = {(r.chrom, r["sample"]): (r.dosage, r.phased, r.ft) for r in text.melt_genotypes(text.scan_vcf(df), ["S1", "S2"]).collect()}
    assert rows == {("1", "S1"): (1, True, "PASS"), ("1", "S2"): (None, False, "q"), ("X", "S1"): (2, False, None), ("X", "S2"): (0, False, None)}
    first = text.scan_vcf(df).filter("pos = 5").first()
    assert first.alts == ["G", "T"] and first.info == {"AF": "0.1", "DB": None} and first.qual is None
    cut = sorted(r.value for r in sinks.sites_only(df).collect())
    assert "X\t9\trs1\tC\tT\t30\tq\t." in cut
    parsed = df.select(text.parse_annotations(F.lit("G|HIGH|B1,T|LOW"), ["Allele", "IMPACT", "SYMBOL"]).alias("x")).first().x
    assert parsed == [{"Allele": "G", "IMPACT": "HIGH", "SYMBOL": "B1"}, {"Allele": "T", "IMPACT": "LOW", "SYMBOL": ""}]


def test_packed_bed(spark):
    g = spark.createDataFrame([(1, 7, 0), (2, 7, 1), (3, 7, 2), (4, 7, None), (5, 7, 2)], "sample_id long, variant_id long, dosage long")
    s = spark.createDataFrame([(i,) for i in range(1, 7)], "sample_id long")
    assert bytes(sinks.packed_bed(g, s).first().bed) == bytes([0b01111000, 0b0111])


def test_files_round_trip(spark, tmp_path):
    v = spark.createDataFrame([("1", 5, "a", "A", "G", "PASS"), ("2", 3, "b", "C", "T", "q")], "chrom string, pos long, id string, ref string, alt string, filter string")
    lines = v.select("chrom", "pos", sinks.vcf_line(F.lit("AF=0.5")).alias("line"))
    sinks.sink_vcf(lines, ["##x", "#CHROM\tPOS"], ["2", "1"]).select("line").write.text(f"{tmp_path}/vcf")
    back = text.read_lines(spark, f"{tmp_path}/vcf")
    assert [r.id for r in text.scan_vcf(back).orderBy("pos").collect()] == ["b", "a"]
    sinks.plink_lines(v).write.text(f"{tmp_path}/bim")
    assert text.scan_plink(spark, f"{tmp_path}/bim", text.BIM).count() == 2
    v.write.csv(f"{tmp_path}/tsv", sep="\t", header=True)
    assert text.scan_delimited(spark, f"{tmp_path}/tsv").count() == 2
    assert text.scan_many(spark, ["/a/x.vcf.gz", "/a/y.vcf.gz"], ["/b/x.tbi", "/b/y.tbi"]).count() == 2
    with pytest.raises(ValueError):
        text.scan_many(spark, ["/a/x.vcf.gz"], ["/b/z.tbi"])


def test_stream_of_vcf_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n in (1, 2):
        (tmp_path / f"in/{n}.vcf").write_text(f"##x\nchr1\t{n}\t.\tA\tG\t.\tPASS\t.\tGT\t0/1\t1|1\n")
    counts = streams.running_allele_counts(streams.stream_genotypes(streams.stream_lines(spark, f"{tmp_path}/in", 1), ["S1", "S2"]))
    query = counts.writeStream.outputMode("complete").format("memory").queryName("allele_counts").start()
    query.processAllAvailable()
    query.stop()
    assert sorted(map(tuple, spark.table("allele_counts").collect())) == [("1", 1, 3, 4), ("1", 2, 3, 4)]


def test_unrelated_set_leaves_no_pair(spark):
    edges = [(1, 2), (2, 3), (3, 4), (10, 11), (10, 12), (10, 13), (20, 21)]
    df = spark.createDataFrame(edges, "id1 long, id2 long")
    for exact in (0, 10):
        gone = {r.sample_id for r in kinship.unrelated_set(df, exact_up_to=exact).collect()}
        assert all(a in gone or b in gone for a, b in edges)
        assert 10 in gone and len(gone) == 4
    ranked = spark.createDataFrame([(21, 1.0), (20, 2.0)], "sample_id long, rank double")
    assert 21 in {r.sample_id for r in kinship.unrelated_set(df, ranked).collect()}


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 200), (200, 150)]
    got = {r.node: r.component for r in graphs.connected_components(spark.createDataFrame(edges, "id1 long, id2 long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and {got[i] for i in (100, 150, 200)} == {100}


def test_fdr_is_monotone_and_permutation_is_one(spark):
    rows = spark.createDataFrame([(i, (i * 37 % 101) / 101) for i in range(101)] + [(200, 0.0), (201, 1.0)], "id long, p double")
    q = [r.q for r in statistics.fdr_bh(rows, "id").orderBy("p", "id").collect()]
    assert q == sorted(q) and max(q) <= 1 and len(q) == 103
    samples = spark.createDataFrame([(i, i % 3) for i in range(50)], "sample_id long, case_status int")
    out = summaries.permute_phenotypes(samples, 1).collect()
    assert sorted(r.sample_id for r in out) == list(range(50))
    assert sorted(r.case_status for r in out) == sorted(i % 3 for i in range(50))
    halves = joins.random_half(samples, 3).collect()
    assert sum(r.pseudo_case for r in halves) == 25


def test_fisher_against_enumeration(spark):
    from math import comb

    def plain(a, b, c, d):
        n, r, k = a + b + c + d, a + b, a + c
        p = {x: comb(r, x) * comb(n - r, k - x) / comb(n, k) for x in range(max(0, k - n + r), min(r, k) + 1)}
        return sum(v for v in p.values() if v <= p[a] * (1 + 1e-9))

    tables = [t for t in itertools.product(range(4), repeat=4) if sum(t)]
    got = spark.createDataFrame(tables, "a long, b long, c long, d long").select("*", statistics.fisher_p("a", "b", "c", "d").alias("p")).collect()
    assert all(abs(r.p - plain(r.a, r.b, r.c, r.d)) < 1e-9 for r in got)


def test_regressions_agree_with_closed_forms(spark):
    samples = spark.createDataFrame([(i, float(i % 7), 1 + (i * i % 5 > 1), float(i % 3)) for i in range(60)], "sample_id long, trait double, case_status int, age double")
    g = spark.createDataFrame([(i, 1, i % 2) for i in range(60)], "sample_id long, variant_id long, dosage long")
    a = statistics.assoc_linear(g, samples, "trait").first()
    b = statistics.assoc_linear_adjusted(g, samples, "trait", []).first()
    assert abs(a.beta - b.beta) < 1e-9 and a.n == b.n == 60
    # a logistic model with one 0/1 predictor has the log odds ratio as its coefficient
    import math

    n = {(d, y): sum(1 for i in range(60) if i % 2 == d and (i * i % 5 > 1) == y) for d in (0, 1) for y in (False, True)}
    want = math.log(n[1, True] * n[0, False] / (n[1, False] * n[0, True]))
    assert abs(models.assoc_logistic(g, samples).first().beta - want) < 1e-6
    assert abs(models.assoc_logistic(g, samples, firth=True).first().beta) < abs(want) + 1e-9


def test_concordance_of_equal_sets_is_one(spark):
    g = spark.createDataFrame([(s, v, (s + v) % 3) for s in range(6) for v in range(9)], "sample_id long, variant_id long, dosage long")
    m = summaries.concordance_metrics(summaries.concordance_table(summaries.paired_states(g, g)), []).first()
    assert m.nrs == m.ogc == m.hhc == m.nrc == 1.0 and m.nrd == 0.0


def test_refusals(spark):
    df = spark.createDataFrame([(1,)], "variant_id long")
    with pytest.raises(ValueError):
        filters.view_variants(df)
    with pytest.raises(ValueError):
        filters.drop_marker_sample(df)


def test_hard_filter_joins_labels(spark):
    df = spark.createDataFrame([(1, "PASS"), (2, "q10"), (3, ".")], "variant_id long, filter string")
    assert [r.filter for r in filters.hard_filter(df, "low", "variant_id < 3").orderBy("variant_id").collect()] == ["low", "q10;low", "."]
