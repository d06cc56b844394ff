"""Small helpers that every operator of this subpackage uses."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.operators.durable import durable  # noqa: F401  the operators here take it from this module

WORD_BREAK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: The characters that are not of words.
WHITE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of small fields that one task takes, and the least tasks, after a checkpoint.
ROWS_A_TASK, LEAST_TASKS = 50_000, 8


def tasks_for(rows: int, per_task: int = ROWS_A_TASK) -> int:
    return max(LEAST_TASKS, rows // per_task)


#: Spark's setting to remove the shuffle files of a query once it has ended.
REMOVES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settled(df: DataFrame) -> DataFrame:
    """durable, in as many tasks as its rows need, whatever the number of shuffle partitions that made it.

    Nothing reads the shuffles behind a reliable checkpoint again, so Spark is told to remove them when it is written.
    """
    conf = df.sparkSession.conf
    before = conf.get(REMOVES_SHUFFLES, None)
    conf.set(REMOVES_SHUFFLES, "true")
    try:
        df = durable(df.select("*"))  # a query of its own, made under the setting
    finally:
        conf.unset(REMOVES_SHUFFLES) if before is None else conf.set(REMOVES_SHUFFLES, before)
    return df.coalesce(tasks_for(df.count()))


def empty_for_null(column: Column | str) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c, F.lit(""))


def space_for_null(column: Column) -> Column:
    return F.coalesce(column, F.lit(" "))


def word_count(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


#: Characters of text that a Python task works on at once (one document at least); bounds its memory.
BLOCK_CHARS = 1_000_000
ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
Made = tuple[np.ndarray | None, list]


def text_blocks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """(position, texts) in blocks of bounded size."""
    start, chars = 0, 0
    for i, text in enumerate(texts):
        if i > start and chars + len(text) > BLOCK_CHARS:
            yield start, texts[start:i]
            start, chars = i, 0
        chars += len(text)
    if start < len(texts):
        yield start, texts[start:]


def map_texts(docs: DataFrame, keep: Sequence[str], text: str, made: dict[str, str], work: Callable[[], Callable[[list[str]], Made]]) -> DataFrame:
    """The columns `keep` of docs and the columns `made` that Python derives from whole texts (null: empty).

    work() runs once in each task and returns the function for a block of texts: it gives, for the rows it
    makes, the positions of their texts (None: one row for each text, in order) and the values of each column.
    Kept columns pass through as Arrow arrays, so keys with nulls and large integers stay exact.
    """
    names = [*(f"k{i}" for i in range(len(keep))), *(f"m{i}" for i in range(len(made)))]
    kinds = [ARROW[k] for k in made.values()]

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = work()
        for batch in stream:
            texts, kept = batch.column(len(keep)).to_pylist(), batch.columns[: len(keep)]
            for start, block in text_blocks(texts):
                index, values = of(block)
                if index is None:
                    own = [c.slice(start, len(block)) for c in kept]
                else:
                    own = [c.take(pa.array(index + start, pa.int64())) for c in kept]
                arrays = [pa.array(v, k) for v, k in zip(values, kinds)]
                yield pa.RecordBatch.from_arrays([*own, *arrays], names=names)

    rows = docs.select(*(F.col(c).alias(n) for c, n in zip(keep, names)), empty_for_null(text).alias("t"))
    fields = [f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in zip(keep, names)]
    schema = ", ".join([*fields, *(f"{n} {k}" for n, k in zip(names[len(keep) :], made.values()))])
    return rows.mapInArrow(batches, schema).toDF(*keep, *made)
