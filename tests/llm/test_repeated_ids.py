"""Rows that share a doc_id, or have none, in the stage that drops near copies."""

import corpus_pipeline


def test_each_group_keeps_one_row(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(80)) for x in "abcd")
    rows = [(7, a), (7, b), (3, b), (7, a), (None, c), (None, c + " more"), (None, d), (9, d), (None, None), (None, "")]
    base = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").schema
    docs = spark.createDataFrame([(i, t, "en", "s", n) for n, (i, t) in enumerate(rows)], base)
    for some in (docs, docs.repartition(5)):
        out = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, some, "").collect()]
        assert sorted(out, key=str) == sorted([(7, a), (3, b), (9, d), *[x for x in out if x[0] is None]], key=str)
        loose = [t or "" for i, t in out if i is None]
        assert len(loose) == 2 and "" in loose and (c in loose or c + " more" in loose)
