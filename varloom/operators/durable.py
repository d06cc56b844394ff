"""Reliable checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def durable(df: DataFrame) -> DataFrame:
    """Computed once, with its lineage cut by a checkpoint in the folder that the cluster shares.

    The cluster names that folder in spark.checkpoint.dir.  Only a local session may go without: elsewhere executors
    would not see a folder of the driver, so that this fails.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if shared is None and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return df.checkpoint(eager=True)


#: Spark's setting to remove the shuffle files of a query once it has ended.
REMOVES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def released(df: DataFrame) -> DataFrame:
    """durable, with the shuffle files behind it removed: nothing reads them again once the checkpoint is written."""
    conf = df.sparkSession.conf
    before = conf.get(REMOVES_SHUFFLES, None)
    conf.set(REMOVES_SHUFFLES, "true")
    try:
        return durable(df.select("*"))  # a query of its own, made under the setting
    finally:
        conf.unset(REMOVES_SHUFFLES) if before is None else conf.set(REMOVES_SHUFFLES, before)


def dropped(df: DataFrame) -> None:
    """Removes the files of a checkpoint that durable or released gave, which nothing may read again."""
    context = df.sparkSession.sparkContext
    files = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if files.isDefined():
        path = context._jvm.org.apache.hadoop.fs.Path(files.get())
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path in the folder that the cluster shares; the same rule for local sessions as in `durable`."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="spark-files-")
    return f"{shared}/{name}-{uuid.uuid4().hex}"
