"""Packed and text pedigree files, against what was written."""

import random
import time

import pytest

from varloom.sources import packed, sinks, text


def made(spark, n, m, seed):
    rng = random.Random(seed)
    rows = [(i, j, rng.choice((0, 1, 2, None))) for i in range(n) for j in range(m)]
    genotypes = spark.createDataFrame(rows, "sample_id long, variant_id long, dosage int")
    lines = sinks.packed_bed(genotypes, genotypes.select("sample_id")).orderBy("variant_id").collect()
    return [[r[2] for r in rows if r[1] == j] for j in range(m)], [bytes(r.bed) for r in lines]


@pytest.mark.parametrize("n", [1, 7, 8])
def test_bed_in_ranges(spark, tmp_path, n):
    want, records = made(spark, n, 23, n)
    path = tmp_path / "a.bed"
    path.write_bytes(packed.MAGIC + b"".join(records))
    read = packed.scan_bed(spark, str(path), n, split_bytes=5 * -(-n // 4))
    assert read.rdd.getNumPartitions() == 5
    assert [(r.file, r.record, r.dosages) for r in read.orderBy("record").collect()] == [("a.bed", j, x) for j, x in enumerate(want)]
    some = packed.scan_bed(spark, str(path), n, first=4, last=9, split_bytes=3 * -(-n // 4))
    assert some.rdd.getNumPartitions() == 2 and [r.record for r in some.orderBy("record").collect()] == [4, 5, 6, 7, 8, 9]


def test_folders_empty_and_wrong_files(spark, tmp_path):
    want, records = made(spark, 5, 6, 1)
    (tmp_path / "x.bed").write_bytes(packed.MAGIC + b"".join(records[:4]))
    (tmp_path / "y.bed").write_bytes(packed.MAGIC + b"".join(records[4:]))
    (tmp_path / "z.bed").write_bytes(packed.MAGIC)
    (tmp_path / "x.bim").write_text("")
    rows = packed.scan_bed(spark, tmp_path.as_uri(), 5).orderBy("file", "record").collect()
    assert [r.dosages for r in rows] == want and [r.file for r in rows] == ["x.bed"] * 4 + ["y.bed"] * 2
    assert packed.scan_bed(spark, str(tmp_path / "z.bed"), 5).count() == 0
    with pytest.raises(Exception, match="do not hold records"):
        packed.scan_bed(spark, str(tmp_path / "x.bed"), 40).count()
    (tmp_path / "x.bed").write_bytes(b"\x6c\x1b\x00" + b"".join(records[:4]))
    with pytest.raises(Exception, match="no marker-by-marker"):
        packed.scan_bed(spark, str(tmp_path / "x.bed"), 5).count()


def test_ped_lines(spark):
    lines = spark.createDataFrame([("# comment",), ("f1 i1 0 0 1 -9 A A  G 0",), ("f1\ti2 i1 0 2 1.5 A C T G",), ("",), ("f2 i3 0 0 x 2",)], "value string")
    people = text.scan_ped(lines)
    got = {r.iid: r for r in people.collect()}
    assert (got["i1"].father, got["i1"].sex, got["i1"].pheno) == (None, 1, None) and (got["i2"].father, got["i2"].pheno) == ("i1", 1.5)
    assert [tuple(c) for c in got["i1"].calls] == [("A", "A"), ("G", None)] and got["i3"].calls == [] and got["i3"].sex is None
    markers = spark.createDataFrame([(0, "m0", "A", "C"), (1, "m1", "G", "A")], "at int, id string, a1 string, a2 string")
    assert {(r.iid, r.id): r.dosage for r in text.melt_ped(people, markers).collect()} == {("i1", "m0"): 2, ("i1", "m1"): None, ("i2", "m0"): 1, ("i2", "m1"): None}


def test_sizes_without_bytes_and_bytes_in_many_tasks(spark, monkeypatch):
    rows = [(i, j, (i + j) % 3) for i in range(9) for j in range(40) if (i * j) % 4]
    genotypes = spark.createDataFrame([*rows, (99, 1000, 1)], "sample_id long, variant_id long, dosage int")
    samples = spark.createDataFrame([(i,) for i in range(13)], "sample_id long")
    for name, value in (("TASK_BYTES", 8), ("BED_BYTES", 9)):
        monkeypatch.setattr(sinks, name, value)
    made = sinks.packed_bed(genotypes, samples)
    assert made.rdd.getNumPartitions() >= 15  # 30 variants of four bytes
    sizes = sinks.bed_sizes(genotypes, samples)
    assert "MapInArrow" not in sizes._jdf.queryExecution().toString() and "collect_list" not in sizes._jdf.queryExecution().toString()
    assert {r.variant_id: r.bytes for r in sizes.collect()} == {r.variant_id: len(r.bed) for r in made.collect()}


def test_packing_leaves_no_shuffle_behind(spark):
    """The calls of a variant move as one array, and the shuffles before it are gone when the bytes are made."""
    rows = [(i, j, (i + j) % 3 if (i + j) % 5 else None) for i in range(11) for j in range(50) if (i * j) % 4]
    genotypes = spark.createDataFrame(rows, "sample_id long, variant_id long, dosage int").repartition(6)
    samples = spark.createDataFrame([(i,) for i in range(11)], "sample_id long")
    blocks = spark._jsparkSession.sparkContext().env().blockManager().diskBlockManager()
    held = lambda: {b for b in blocks.getAllBlocks().mkString("\n").split("\n") if b.startswith("shuffle_")}
    before = held()
    made = sinks.packed_bed(genotypes, samples)
    assert len([f for f in made._jdf.queryExecution().analyzed().toString().split("\n") if "LogicalRDD [variant_id" in f and f.count("#") == 2]) == 1
    # numbering the samples is a query of its own, whose files stay; those of the calls are removed in the background
    own = lambda: {b.split("_")[1] for b in held() - before}
    left = next((n for _ in range(50) if len(n := own()) <= 1 or time.sleep(0.1)), own())
    assert len(left) <= 1
    codes = {0: 0, None: 1, 1: 2, 2: 3}
    for r in made.collect():
        calls = {i: codes[d] for i, j, d in rows if j == r.variant_id}
        assert [r.bed[i // 4] >> 2 * (i % 4) & 3 for i in range(12)] == [calls.get(i, 1) if i < 11 else 0 for i in range(12)]
