"""The prefix trie against nested dictionaries, in one and in many small blocks, and against its SQL version."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from varloom.llm import queries, trie

SF = "/root/testdata/sf0.01"


def plain(rows):
    """Every node as a row, by listing the members of every prefix."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            name = hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, name, role or "", text or ""))
    turns = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    made = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        made[c] = turns.get(base, [])[:h] + turns[c][h:]
    members = defaultdict(list)
    for c, seq in made.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    below = defaultdict(list)
    for path in members:
        if path:
            below[path[:-1]].append(path)

    def up(path):
        saved = (len(members[path]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        kids = [up(p) for p in below[path]]
        leaves = sum(k[0] for k in kids) if kids else 1
        saved += sum(k[1] for k in kids)
        ends = ",".join(map(str, sorted(c for c in members[path] if len(made[c]) == len(path))))
        out.append((min(members[path]), len(path), min(members[path[:-1]]) if path else None, len(members[path]), len(below[path]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
        return leaves, saved

    out = []
    if made:
        up(())
    return out


@pytest.fixture(scope="module")
def odd(spark):
    rnd = random.Random(4)
    rows = []
    for conv in [*range(-45, 260, 1), None]:
        for t in range(rnd.choice([1, 2, 3, 4, 9])):
            rows.append((conv, rnd.choice([None, t, t, t]), rnd.choice(["user", "assistant", None]), rnd.choice(["a b", "a b", "c\td e", None, ""])))
    for conv in range(500, 560):  # long copies that part late
        rows += [(conv, t, "user", "same words here") for t in range(30)] + [(conv, 30, "user", f"{conv % 3}")]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' as name", "1 as keys", "2 as depth", "3 as h"), rows


def found(table):
    return Counter(map(tuple, trie.prefix_trie(trie.rebuilt(trie.turns_in_order(table))).collect()))


def test_odd_rows(odd):
    table, rows = odd
    assert found(table) == Counter(plain(rows))


@pytest.mark.parametrize("turns,sequences,last", [(1, 1, 4), (12, 3, 10), (40, 2, 1000)])
def test_small_blocks(turns, sequences, last):
    """The same nodes from blocks of any size, contracted and joined again and again."""
    rnd = random.Random(turns)
    paths = sorted({tuple(rnd.choices("abc", k=rnd.randint(0, 7))) for _ in range(200)} | {("z",) * 9 + (x,) for x in "abc"} | {()})
    items = [(list(p), list(range(1, len(p) + 1)), [(len(p), 1, i, 0, 0, 0, f"e{i}")]) for i, p in enumerate(paths)]

    def up(path):
        under = [q for q in paths if q[: len(path)] == path]
        kids = {q[: len(path) + 1] for q in under if len(q) > len(path)}
        saved = sum(up(k)[1] for k in kids) + ((len(under) - 1) * len(path) if path else 0)
        leaves = sum(up(k)[0] for k in kids) or 1
        want[path] = (paths.index(under[0]), len(path), len(under), len(kids), leaves, saved, f"e{paths.index(path)}" if path in paths else trie.NO_ENDS)
        return leaves, saved

    want = {}
    up(())
    nodes, named = [], False
    while len(items) > last:
        open_ = []
        for at in range(0, len(items), max(4, sequences)):
            done, rest = trie.settle(items[at : at + max(4, sequences)], False, named)
            nodes += done
            open_ += rest
        items, named = open_, True
    nodes += trie.settle(items, True, True)[0]
    assert Counter((n[0], n[1], *n[3:8]) for n in nodes) == Counter(want.values())
    by_name = {n[8]: n[0] for n in nodes if n[8]}
    parents = Counter((n[0], n[1], by_name[n[9]] if n[9] else n[2]) for n in nodes)
    assert parents == Counter((v[0], v[1], want[p[:-1]][0] if p else None) for p, v in want.items())


def test_blocks_in_spark(odd, monkeypatch):
    table, rows = odd
    monkeypatch.setattr(trie, "LAST_BLOCK", 20)
    spark = table.sparkSession
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "30")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(table) == Counter(plain(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_empty_table(spark):
    assert not found(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))


def test_query_equals_sql_and_plain_version(spark):
    got = queries.queries()["op13_conversation_trie"](spark, SF)
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{SF}/conversations.parquet'")
    want = con.sql(trie.ORACLE)
    assert want.columns == got.columns
    rows = Counter(map(tuple, got.collect()))
    assert rows == Counter(want.fetchall())
    assert rows == Counter(plain(con.sql("select conv_id, turn, role, text from conversations").fetchall()))
