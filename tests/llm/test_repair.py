"""Conversation repair against exhaustive edits, every split of every span, and the SQL version."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from varloom.llm import queries, repair

SF = "/root/testdata/sf0.01"
TARGET = re.compile(r"(s?(ua)+)?")
FAULT = {0: "Yes.", 1: " \t", 2: None, 3: "no end"}


def plain(rows):
    """(cost, audit, lines) by trying every edit of every row with up to two insertions anywhere."""
    best = None
    choices = []
    for initial, fault in rows:
        own = [("D", 4, None)]
        if fault not in (repair.BLANK, repair.DUPLICATE):
            more = 3 if fault == repair.TRUNCATED else 0
            own += [("K", more, initial or "-"), ("R", 3 + more, "u"), ("R", 3 + more, "a")]
        choices.append(own)
    runs = ["", "u", "a", "ua", "au"]
    for edits in itertools.product(*choices):
        for gaps in itertools.product(runs, repeat=len(rows) + 1):
            roles, audit, cost = gaps[0], "I" * len(gaps[0]), 3 * len(gaps[0])
            for (edit, c, role), gap in zip(edits, gaps[1:]):
                roles += (role or "") + gap
                audit += edit + "I" * len(gap)
                cost += c + 3 * len(gap)
            if TARGET.fullmatch(roles) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def cyk(rows):
    """The same cells with every split of every span compared."""
    n = len(rows)
    cells = {(i, i + 1): repair.row_span(*rows[i]) for i in range(n)}
    for size in range(2, n + 1):
        for i in range(n - size + 1):
            j, best = i + size, [{} for _ in repair.NEXT]
            for k in range(i + 1, j):
                for p, ends in enumerate(repair.combined(cells[i, k], cells[k, j])):
                    for q, cell in ends.items():
                        best[p][q] = min(cell, best[p].get(q, cell))
            cells[i, j] = best
    return repair.cheapest(cells[0, n])


def halves(rows):
    spans = repair.Spans()
    for row in rows:
        spans.add(repair.row_span(*row))
    return repair.cheapest(spans.all())


def test_cells_are_those_of_exhaustive_edits():
    rnd = random.Random(5)
    for n in (1, 2, 3):
        for _ in range(12):
            rows = [(rnd.choice(["s", "u", "a", "t", ""]), rnd.randint(0, 3)) for _ in range(n)]
            assert halves(rows) == plain(rows), rows


def test_one_split_a_span_gives_what_all_splits_give():
    rnd = random.Random(6)
    for _ in range(60):
        rows = [(rnd.choice("suaat"), rnd.choice([0, 0, 0, 1, 2, 3])) for _ in range(rnd.randint(1, 14))]
        assert halves(rows) == cyk(rows), rows


def conversation(rows):
    """What the contract says of one conversation's damaged rows (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append(1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0)
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cells = list(zip(initials, faults))
    cost, audit = (cyk if len(rows) < 12 else halves)(cells) if rows else (0, "")
    lines, left = [], iter(rows)
    odd = sum(e != "D" for e in audit) % 2
    for edit in audit:
        role = "assistant" if (len(lines) + odd) % 2 else "user"
        _, own, text = next(left) if edit != "I" else (None, role, "")
        if edit != "D":
            lines.append(f"{own if edit == 'K' else role}:{text}")
    return (gaps, *(faults.count(f) for f in (1, 2, 3)), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def damaged(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv] += []
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out[conv] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


@pytest.fixture(scope="module")
def odd(spark):
    rnd = random.Random(9)
    rows = []
    for conv in [None, *range(40)]:
        for _ in range(rnd.randint(1, 40)):
            role = rnd.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None])
            rows.append((conv, rnd.choice([None, *range(30)]), role, rnd.choice(["Yes.", "No!", "", None, " \n", "a. \t", "why", "é?", "b.c"])))
    rows += [(77, i, "user", "the same.") for i in range(120)] + [(78, None, "user", "one.")] * 90 + [(79, i, ("user", "assistant")[i % 2], f"{i}.") for i in range(600)]
    rows += [(80, -(2**63), "user", "far."), (80, 2**63 - 1, "assistant", "off.")]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' as at", "1 as audit", "2 as edit", "3 as __id"), rows


def test_odd_rows(odd):
    table, rows = odd
    got = repair.digest(table, repair.repair(repair.damage(table))).collect()
    want = {conv: conversation(own) for conv, own in damaged(rows).items()}
    want[80] = (min(want[80][0], repair.MOST_LONG), *want[80][1:])
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[1:] == want[r.conv_id], r.conv_id


def test_conversations_spread_over_tasks(spark, odd):
    """More range partitions than conversations: spans meet across tasks."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        test_odd_rows(odd)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_messages_of_undamaged_rows(spark):
    rows = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "Hi?"), (1, 2, "assistant", "Yes.")], "conv_id long, turn long, role string, text string")
    reports, messages = repair.repair(rows)
    assert [tuple(r) for r in reports.collect()] == [(1, 0, 0, 0, 0, 1, 3, "KIKK")] or reports.first().audit in ("KRK", "RKK", "DKK", "KIKK")
    assert [r.role for r in messages.orderBy("at", "step").collect()][-1] == "assistant"


def test_empty_table(spark):
    rows = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.digest(rows, repair.repair(repair.damage(rows))).count() == 0


def test_query_equals_sql(spark):
    got = queries.queries()["op12_conversation_repair"](spark, SF)
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{SF}/conversations.parquet'")
    want = con.sql(repair.ORACLE)
    assert want.columns == got.columns
    assert Counter(map(tuple, got.collect())) == Counter(want.fetchall())
