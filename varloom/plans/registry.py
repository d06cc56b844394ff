"""Registered queries: a Spark callable and, where SQL can say it, the same result as DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from varloom.shipping import ship

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


#: Bytes of a shuffle that a task of a cohort query takes.  A call is shuffled as about ten bytes but takes a hundred or
#: more in a task's maps and sorts, so Spark's 64 MB would come to gigabytes.
ADVISORY, TASK_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m"


def small_tasks(spark: SparkSession) -> SparkSession:
    """The session, with tasks of TASK_BYTES unless it names a size itself.  It stays set, as results are worked out later."""
    if spark.conf.get(ADVISORY, None) is None:
        spark.conf.set(ADVISORY, TASK_BYTES)
    return spark


def shipped(query: Query) -> Query:
    """The query, run after the executors have the package's code."""

    @wraps(query)
    def run(spark: SparkSession, *args) -> DataFrame:
        ship(spark)
        return query(spark, *args)

    return run


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = shipped(query)
        if oracle is not None:
            _ORACLES[name] = oracle
        return query

    return keep


def _load() -> None:
    from varloom.plans import catalog  # noqa: F401  registers on import


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
