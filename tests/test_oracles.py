"""Every registered query with an oracle gives the rows that DuckDB gives for its SQL."""

import math
from collections import Counter

import duckdb
import pytest

from varloom.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, bool):
        return x
    if isinstance(x, (int, float)) or type(x).__name__ == "Decimal":
        return f"{float(x) + 0.0:.8g}"
    return str(x)


def bag(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_oracle(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    got = bag(df.collect(), df.columns)
    cur = duck.execute(registry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    want = bag(cur.fetchall(), names)
    assert sorted(df.columns) == sorted(names)
    assert want, "the oracle has no rows"
    only_got, only_want = got - want, want - got
    assert not only_got and not only_want, f"{sum(only_got.values())} / {sum(only_want.values())}: {list(only_got)[:3]} / {list(only_want)[:3]}"


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_rows(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0
