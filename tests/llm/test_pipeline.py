"""The pipeline's stages against plain versions of what each has to do with its own input."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from varloom.llm import mixing, simhash

SF = "/root/testdata/sf0.01"


def shingles(text, size=5):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i : i + size]) for i in range(len(w) - size + 1)} or ({b" ".join(w)} if w else set())


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
        out[name] = docs
    return out


def test_columns(stages):
    for name in ("toxicity", "near_duplicates", "secrets", "mixing"):
        assert stages[name].columns == stages["documents"].columns


def test_toxic_rows_go_and_clean_rows_stay(spark, stages):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    left = {r.doc_id for r in stages["toxicity"].select("doc_id").collect()}
    toxic = [i for i, t in labels.items() if t]
    clean = [i for i, t in labels.items() if not t]
    assert sum(i in left for i in toxic) <= 0.4 * len(toxic)
    assert sum(i not in left for i in clean) <= 0.01 * len(clean)


def test_one_of_each_group_stays(stages):
    before = {r.doc_id: r.text for r in stages["toxicity"].collect()}
    after = {r.doc_id for r in stages["near_duplicates"].collect()}
    assert after <= set(before) and stages["near_duplicates"].count() == len(after)
    sets = {i: shingles(t) for i, t in before.items()}
    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    near = {i: {i} for i in sets}
    for i, s in sets.items():
        shared = Counter(j for x in s if len(holders[x]) < 300 for j in holders[x])
        near[i] |= {j for j, n in shared.items() if n / (len(s) + len(sets[j]) - n) >= 0.8}
        near[i] |= {j for j in sets if not s and not sets[j]}
    left = [i for i in after if len(near[i] & after) > 1]
    assert len(left) <= 0.03 * sum(len(n) > 1 for n in near.values())
    # a dropped document has a copy of some kind
    similar = {i for i, s in sets.items() if i not in after for j in after if len(s & sets[j]) >= 0.5 * len(s | sets[j]) or not s}
    assert len([i for i in before if i not in after and i not in similar]) <= 0.02 * len(before)


def test_secrets_are_masked(stages):
    before = {r.doc_id: r.text for r in stages["near_duplicates"].collect()}
    after = {r.doc_id: r for r in stages["secrets"].collect()}
    assert set(before) == set(after)
    pattern = re.compile(r"AKIA[A-Z0-9]{12,}|[0-9a-f]{32,}")
    changed = [i for i in before if before[i] != after[i].text]
    assert {i for i, t in before.items() if pattern.search(t)} <= set(changed)
    assert not any(pattern.search(r.text) for r in after.values())
    assert all("[SECRET]" in after[i].text and after[i].n_chars == len(after[i].text) for i in changed)


def test_mix_takes_whole_copies(stages):
    size = {r.doc_id: (r.source, len(r.text.split())) for r in stages["secrets"].collect()}
    rows = stages["mixing"].collect()
    copies = Counter(r.doc_id for r in rows)
    assert set(copies) <= set(size) and max(copies.values()) <= 3
    want = {r.source: r.target for r in mixing.mix(stages["secrets"]).select("source", "target").distinct().collect()}
    got = Counter()
    for i, n in copies.items():
        got[size[i][0]] += n * size[i][1]
    for source, target in want.items():
        assert abs(got[source] - target) <= max(n for s, n in size.values() if s == source)


def test_packing_holds_every_copy(stages):
    docs = Counter(r.doc_id for r in stages["mixing"].select("doc_id").collect())
    first = Counter(r.doc_id for r in stages["packing"].filter("piece = 0").select("doc_id").collect())
    assert docs == first


def test_odd_rows(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(None, "same text", "en", None, 1), (None, None, None, "s", None), (7, None, "en", "s", 0), (7, "same text", "en", "s", 9), (7, "same text", "en", "s", 9), (8, "x" * 30000, "en", "s", 1)]
    docs = spark.createDataFrame(rows, base.schema)
    clashing = docs.selectExpr("*", "1 as rejected", "'x' as severity", "'y' as spans", "2 as blob", "3 as copies", "4 as size", "5 as grade", "'z' as fp", "6 as target")
    for some in (docs, docs.limit(0), clashing):
        out = some
        for _, stage in corpus_pipeline.STAGES:
            before = out.columns
            out = stage(spark, out, SF)
            assert out.columns == before or stage is corpus_pipeline.STAGES[-1][1]
        out.collect()


def test_wide_fingerprints_follow_similarity(spark):
    words = [f"w{i * 7919 % 5003}" for i in range(400)]
    near = [*words]
    for i in (50, 150, 250, 350):
        near[i] = "other"
    far = [f"v{i}" for i in range(400)]
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(far)), (4, ""), (5, None), (6, " ".join(words).upper())], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.similar_documents(df).collect()}
    assert got == {1: 1, 2: 1, 6: 1, 3: 3, 4: 4, 5: 4}


def test_run(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").agg(F.count("*")).first()[0] > 0
