"""A corpus pipeline from five of the training-data operators.

Every stage takes (spark, docs, sf_dir) and gives the next one's docs, with the columns of documents; the last
gives the packed pieces.  Stages are written as Parquet and read again between them.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from varloom.llm import mixing, packing, secrets, simhash, toxicity
from varloom.llm.common import empty_for_null, table
from varloom.plans.registry import shipped

#: The stages draw on trained models, fingerprints and random rounding, which SQL cannot express.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model does not reject.  Texts without words stay."""
    model = toxicity.train(toxicity.labelled(docs, table(spark, sf_dir, "labels")))
    # names of our own inside, as docs may have columns that are called like the scores
    own = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    scored = toxicity.score(own, model, keep=tuple(own.columns), text=own.columns[docs.columns.index("text")])
    return scored.filter(~F.col("rejected")).select(*own.columns).toDF(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicate texts: the least by doc_id (nulls last), then by a hash of the text.

    Groups are texts linked by a similarity of 0.8 or more of their five-word shingles.  A row belongs to its text's
    group, whatever other rows have its doc_id; rows that share doc_id and text are settled by their other columns.
    """
    groups = simhash.similar_rows(docs.select("doc_id", "text"), size=5)
    ranked = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash")).alias("x")
    name = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit("null")).alias("__name")
    kept = groups.groupBy("group").agg(ranked).select(F.col("x.hash").alias("__hash"), F.col("x.doc_id").alias("doc_id")).select("__hash", name)
    # the window goes by the keys of the join, so that texts are shuffled once
    rows = docs.select("*", simhash.text_hash("text").alias("__hash"), name).join(kept, ["__hash", "__name"])
    first = F.row_number().over(Window.partitionBy("__hash", "__name").orderBy(F.xxhash64(*docs.columns)))
    return rows.withColumn("__first", first).filter("__first = 1").select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with the secrets in its text replaced by a mark and n_chars brought up to date."""
    columns = docs.columns
    scanned = secrets.scan_paths(docs, spans="__spans")
    text = secrets.redacted(F.col("text"), F.col("__spans"))
    out = scanned.withColumn("__clean", text)
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        changed = F.size("__spans") > 0
        out = out.withColumn("n_chars", F.when(changed, F.length("__clean").cast(kind)).otherwise(F.col("n_chars")))
    return out.withColumn("text", F.col("__clean")).select(*columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it (0 to 3 times).

    Rows that repeat doc_id, source and text are taken as often as all of them together.
    """
    mark = F.xxhash64(empty_for_null("text"), empty_for_null(F.col("source").cast("string")))
    marked = docs.withColumn("__mark", mark)
    taken = mixing.mix(marked, keep=("doc_id", "__mark")).groupBy("doc_id", "__mark").agg(F.sum("copies").cast("int").alias("__copies"))
    taken = taken.filter("__copies > 0").select(F.col("doc_id").alias("__id"), F.col("__mark").alias("__of"), "__copies")
    same = marked["doc_id"].eqNullSafe(taken["__id"]) & (marked["__mark"] == taken["__of"])
    rows = marked.join(taken, same)
    first = F.row_number().over(Window.partitionBy("doc_id", "__mark").orderBy("doc_id"))
    rows = rows.withColumn("__first", first).filter("__first = 1")
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document in sequences of 4096 tokens."""
    return packing.pack(docs, capacity=4096)


STAGES = [
    ("toxicity", shipped(drop_toxic)),
    ("near_duplicates", shipped(drop_near_copies)),
    ("secrets", shipped(mask_secrets)),
    ("mixing", shipped(mix_sources)),
    ("packing", shipped(pack_sequences)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written to the shared folder and read again."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    shared = shared or tempfile.mkdtemp(prefix="spark-pipeline-")
    base = f"{shared}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
