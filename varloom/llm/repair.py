"""Conversation structure repair by weighted interval parsing.

The accepted role sequences are `(s?(ua)+)?`.  The repair grammar is in Chomsky normal form: its nonterminals [p q]
stand for spans of rows whose edits take the role sequence from state p to state q, its binary rules are
[p q] -> [p r] [r q], and its terminal rules are the edits of one row.  Insertions are closed over: the cell of a row
also holds every useful run of inserted turns before it.  A cell is the least (cost, audit), cheapest first and of
equally cheap ones the audit that comes first in ASCII order.

Equally cheap audits of one cell are never prefixes of each other (what follows would be insertions, which cost), so
that their order survives concatenation and the value of a span does not depend on where it is split.  Each span is
therefore split once, into halves: cells are combined bottom-up by span length, 1, 2, 4 and so on.

Rows are sorted by range, so that a long conversation is spread over tasks.  A task combines the spans that it holds of
a conversation; what is left is a span for each conversation and task, and those meet by conversation.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.llm.common import WHITE, empty_for_null, space_for_null
from varloom.operators.durable import durable

USER, ASSISTANT = "user", "assistant"
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED_COST = 3
#: State -> role initial -> state.  0: nothing yet, 1: a system turn, 2: an assistant turn is due, 3: complete.
NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
ACCEPTED = (0, 3)
LEGAL = {"su", "ua", "au"}
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
MOST_LONG = (1 << 63) - 1

Cell = tuple[int, str]
Span = list[dict[int, Cell]]


# ---- cells


def combined(left: Span, right: Span) -> Span:
    """The cells of a span from those of its two parts."""
    out: Span = []
    for ends in left:
        best: dict[int, Cell] = {}
        for r, (cost, audit) in ends.items():
            for q, (more, rest) in right[r].items():
                total = cost + more
                old = best.get(q)
                if old is None or total < old[0] or total == old[0] and audit + rest < old[1]:
                    best[q] = (total, audit + rest)
        out.append(best)
    return out


def _insertions() -> Span:
    """Closure of inserted turns: the cheapest runs of them from each state to each other."""
    one = [{q: (COST[INSERT], INSERT) for initial, q in NEXT[p].items() if initial != "s"} | {p: (0, "")} for p in NEXT]
    return combined(one, one)  # no state is more than two insertions from another that it can reach


INSERTIONS = _insertions()
_ROWS: dict[tuple[str, int], Span] = {}


def row_span(initial: str, fault: int, copies: int = 1) -> Span:
    """The cells of one row, behind any insertions; further copies of it are duplicates, which must go."""
    key = (initial if initial in ("s", "u", "a") else "", fault)
    if key not in _ROWS:
        more = TRUNCATED_COST if fault == TRUNCATED else 0
        own: Span = []
        for p, steps in NEXT.items():
            best = {p: (COST[DELETE], DELETE)}
            if fault not in (BLANK, DUPLICATE):
                for i, q in steps.items():
                    if i == key[0]:
                        best[q] = (COST[KEEP] + more, KEEP)
                    elif i != "s":
                        best[q] = (COST[REROLE] + more, REROLE)
            own.append(best)
        _ROWS[key] = combined(INSERTIONS, own)
    span = _ROWS[key]
    if copies > 1:
        span = [{q: (c + COST[DELETE] * (copies - 1), a + DELETE * (copies - 1)) for q, (c, a) in ends.items()} for ends in span]
    return span


class Spans:
    """Joins adjoining spans as they come, always two of the same length."""

    def __init__(self):
        self.stack: list[tuple[int, Span]] = []

    def add(self, span: Span) -> None:
        size = 1
        while self.stack and self.stack[-1][0] == size:
            span = combined(self.stack.pop()[1], span)
            size *= 2
        self.stack.append((size, span))

    def all(self) -> Span:
        spans = [s for _, s in self.stack]
        whole = spans.pop()
        while spans:
            whole = combined(spans.pop(), whole)
        return whole


def cheapest(whole: Span) -> Cell:
    """Cost and audit of a conversation from the cells of its rows."""
    ends = combined(whole, INSERTIONS)[0]
    return min(ends[q] for q in ACCEPTED if q in ends)


# ---- spans of a task


SEGMENT = "conv_id long, at long, n long, turns long, first_turn long, last_turn long, blank long, duplicate long, truncated long, illegal long, first_initial string, last_initial string, extra_at array<long>, extra_n array<long>, p array<int>, q array<int>, cost array<long>, audit array<string>"
_SEGMENT_NAMES = [f.split()[0] for f in SEGMENT.split(", ")]


class _Run:
    """What a task has read of one conversation."""

    def __init__(self, conv: int | None, at: int):
        self.conv, self.at, self.n, self.turns = conv, at, 0, 0
        self.first_turn = self.last_turn = None
        self.faults, self.illegal, self.initials, self.extra, self.spans = [0, 0, 0, 0], 0, [], [], Spans()

    def add(self, turn: int | None, initial: str, fault: int, copies: int) -> None:
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.last_turn = turn
            if self.first_turn is None:
                self.first_turn = turn
        if self.initials and self.initials[-1] + initial not in LEGAL:
            self.illegal += 1
        self.initials = [self.initials[0] if self.initials else initial, initial]
        self.faults[fault] += 1
        if copies > 1:  # the copies are blank or duplicates themselves, and no role may follow itself
            self.faults[BLANK if fault == BLANK else DUPLICATE] += copies - 1
            self.illegal += copies - 1
            self.extra.append((self.n, copies - 1))
        self.spans.add(row_span(initial, fault, copies))
        self.n += 1

    def row(self) -> tuple:
        cells = [(p, q, *cell) for p, ends in enumerate(self.spans.all()) for q, cell in ends.items()]
        at, copies = zip(*self.extra) if self.extra else ((), ())
        counts = (*self.faults[1:], self.illegal, *self.initials)
        return (self.conv, self.at, self.n, self.turns, self.first_turn, self.last_turn, *counts, at, copies, *zip(*cells))


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string()), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in ddl.split(", "))])


def batches_of(rows: Iterator[tuple], ddl: str, size: int = 1000) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(ddl)
    while block := list(itertools.islice(rows, size)):
        yield pa.RecordBatch.from_arrays([pa.array(list(v), f.type) for v, f in zip(zip(*block), schema)], schema=schema)


def _segments(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each conversation in a task's sorted rows (conv_id, at, turn, initial, fault, copies)."""

    def rows():
        run = None
        for batch in stream:
            for conv, at, turn, initial, fault, copies in zip(*(c.to_pylist() for c in batch.columns)):
                if run is None or run.conv != conv:
                    if run:
                        yield run.row()
                    run = _Run(conv, at)
                run.add(turn, initial, fault, copies)
        if run:
            yield run.row()

    return batches_of(rows(), SEGMENT)


# ---- whole conversations


REPORT = "conv_id long, first boolean, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, at long, n long, extra_at array<long>, extra_n array<long>, slice string, made long, odd boolean"


def slices(audit: str, sizes: list[int]) -> list[str]:
    """The audit cut behind so many edits of rows each; insertions go with the row that follows, the last ones with the last."""
    out, at = [], 0
    for size in sizes:
        start = at
        while size:
            size -= audit[at] != INSERT
            at += 1
        out.append(audit[start:at])
    if out:
        out[-1] += audit[at:]
    return out


def _reports(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each conversation, given its segments in order, a row for each segment, the first one with the whole report."""

    def rows():
        for batch in stream:
            for conv, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                spans, turns, last_turn, first_turn, illegal, before = Spans(), 0, None, None, 0, ""
                for s in parts:
                    spans.add([{q: (c, a) for p, q, c, a in zip(s["p"], s["q"], s["cost"], s["audit"]) if p == state} for state in NEXT])
                    turns += s["turns"] - (s["first_turn"] is not None and s["first_turn"] == last_turn)
                    last_turn = s["last_turn"] if s["last_turn"] is not None else last_turn
                    first_turn = s["first_turn"] if first_turn is None else first_turn
                    illegal += s["illegal"] + (before is not None and s is not parts[0] and before + s["first_initial"] not in LEGAL)
                    before = s["last_initial"]
                cost, audit = cheapest(spans.all())
                gaps = 0 if first_turn is None else min(last_turn - first_turn + 1 - turns, MOST_LONG)
                odd = (len(audit) - audit.count(DELETE)) % 2 == 1
                made = 0
                cut = slices(audit, [s["n"] + sum(s["extra_n"]) for s in parts])
                sums = [sum(s[k] for s in parts) for k in ("blank", "duplicate", "truncated")]
                for i, (s, own) in enumerate(zip(parts, cut)):
                    whole = (gaps, *sums, illegal, cost, audit) if i == 0 else (None,) * 7
                    yield (conv, i == 0, *whole, s["at"], s["n"], s["extra_at"], s["extra_n"], own, made, odd)
                    made += len(own) - own.count(DELETE)

    return batches_of(rows(), REPORT, 200)


EDIT = "at long, edit string, role string, before array<string>, after array<string>"


def _edits(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each input row: its edit, its new role if it gets one, and the roles inserted before and after it."""

    def rows():
        for batch in stream:
            for at, n, extra_at, extra_n, audit, made, odd in zip(*(c.to_pylist() for c in batch.columns)):
                extra, place = dict(zip(extra_at, extra_n)), 0

                def insertions():
                    nonlocal place, made
                    out = []
                    while place < len(audit) and audit[place] == INSERT:
                        out.append(ASSISTANT if (made + odd) % 2 else USER)
                        place, made = place + 1, made + 1
                    return out

                for i in range(n):
                    ahead = insertions()
                    edit, role = audit[place], None
                    if edit == REROLE:
                        role = ASSISTANT if (made + odd) % 2 else USER
                    made += edit != DELETE
                    place += 1 + extra.get(i, 0)
                    yield at + i, edit, role, ahead, insertions() if i == n - 1 else []

    return batches_of(rows(), EDIT, 5000)


def _digests(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's lines, which come sorted; only the hash's state is held."""

    def rows():
        own, state = None, None
        for batch in stream:
            for conv, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if state is None or conv != own:
                    if state is not None:
                        yield own, state.hexdigest()
                    own, state = conv, hashlib.sha256(line.encode())
                else:
                    state.update(b"\n" + line.encode())
        if state is not None:
            yield own, state.hexdigest()

    return batches_of(rows(), "conv_id long, repaired_sha256 string")


# ---- operators


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies after damage by crc32(`conv_id:turn`) % 20.

    0 drops the row, 1 empties its text, 2 takes `[.!?]` out of it, 3 repeats it, 4 makes it a user's.  Nulls in roles,
    texts and the key are one space; turns and conversation ids stay null.
    """
    key = F.concat(space_for_null(F.col("conv_id").cast("string")), F.lit(":"), space_for_null(F.col("turn").cast("string")))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = space_for_null(F.col("role")), space_for_null(F.col("text"))
    struck = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).filter("kind <> 0")
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit(USER)).otherwise(F.col("role"))
    return struck.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("copies"))


def _same(left: DataFrame, right: DataFrame, columns: tuple[str, ...]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & left[c].eqNullSafe(right[c])
    return out


def _ordered(rows: DataFrame) -> DataFrame:
    """The distinct rows with fault and copies, sorted over all tasks and numbered (`at`)."""
    copies = F.col("copies") if "copies" in rows.columns else F.lit(1).cast("long")
    own = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), space_for_null(F.col("role")).alias("role"), space_for_null(F.col("text")).alias("text"), copies.alias("copies"))
    pooled = own.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    bare = F.rtrim(F.col("text"), F.lit(WHITE))
    pooled = durable(pooled.withColumns({"blank": F.ltrim(bare, F.lit(WHITE)) == "", "ended": F.right(bare, F.lit(1)).isin(".", "!", "?"), "name": F.sha2(F.col("text").cast("binary"), 256)}))
    when = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    twice = pooled.filter("not blank").groupBy("conv_id", "role", "name").agg(F.min(when).alias("first"), F.count("*").alias("times")).filter("times > 1")
    twice = twice.select(F.col("conv_id").alias("__conv"), F.col("role").alias("__role"), F.col("name").alias("__name"), "first")
    same = pooled["conv_id"].eqNullSafe(twice["__conv"]) & (pooled["role"] == twice["__role"]) & (pooled["name"] == twice["__name"])
    fault = F.when(F.col("blank"), BLANK).when(when > F.col("first"), DUPLICATE).when(~F.col("ended"), TRUNCATED).otherwise(0)
    marked = pooled.filter("not blank").join(twice, same, "left").unionByName(pooled.filter("blank"), allowMissingColumns=True)
    marked = marked.select("conv_id", "turn", "role", "text", "copies", fault.alias("fault"))
    spread = marked.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 32))
    return durable(spread.sortWithinPartitions("conv_id", "turn", "role", "text").withColumn("at", F.monotonically_increasing_id()))


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(reports, messages) for rows of conv_id, turn, role, text and, if there is one, copies.

    reports: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, a row for each conversation.
    messages: conv_id, at, step, edit, role, text, the repaired conversations in the order of (at, step).

    Rows go by turn (null first), then role, then text.  Null roles and texts are one space; a role that starts with
    none of s, u, a (an empty one too) is reroled or deleted; repeated rows are duplicates; null conversation ids form one
    conversation; other columns are ignored; an empty table gives no report and no message.
    """
    ordered = _ordered(rows)
    small = ordered.select("conv_id", "at", "turn", F.left("role", F.lit(1)).alias("initial"), "fault", "copies")
    parts = small.mapInArrow(_segments, SEGMENT)
    whole = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(*_SEGMENT_NAMES[1:]))).alias("parts"))
    made = durable(whole.mapInArrow(_reports, REPORT))
    reports = made.filter("first").select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    edits = made.select("at", "n", "extra_at", "extra_n", "slice", "made", "odd").repartition("at").mapInArrow(_edits, EDIT)
    edits = edits.filter("edit <> 'D' or size(before) > 0 or size(after) > 0").withColumnRenamed("role", "new_role")
    joined = ordered.select("conv_id", "at", "role", "text").join(edits, "at")

    def inserted(roles: str) -> Column:
        return F.transform(roles, lambda r: F.struct(F.lit(INSERT).alias("edit"), r.alias("role"), F.lit("").alias("text")))

    own = F.array(F.struct("edit", F.coalesce("new_role", "role").alias("role"), "text"))
    turns = F.concat(inserted("before"), F.when(F.col("edit") != DELETE, own).otherwise(F.slice(own, 1, 0)), inserted("after"))
    messages = joined.select("conv_id", "at", F.posexplode(turns).alias("step", "turn")).select("conv_id", "at", "step", "turn.*")
    return reports, messages


def digest(rows: DataFrame, repaired: tuple[DataFrame, DataFrame]) -> DataFrame:
    """Every conv_id of rows with its report and the SHA-256 of its repaired `role:text` lines.

    A conversation's lines pass through one task, as one hash over them is asked for; they are sorted there and streamed.
    """
    reports, messages = repaired
    line = F.concat("role", F.lit(":"), "text").alias("line")
    sorted_ = messages.select("conv_id", "at", "step", line).repartition("conv_id").sortWithinPartitions("conv_id", "at", "step")
    hashed = sorted_.select("conv_id", "line").mapInArrow(_digests, "conv_id long, repaired_sha256 string").withColumnRenamed("conv_id", "__hashed")
    every = rows.select(F.col("conv_id").cast("long").alias("__id")).distinct()
    out = every.join(reports, every["__id"].eqNullSafe(reports["conv_id"]), "left").drop("conv_id")
    out = out.join(hashed, out["__id"].eqNullSafe(hashed["__hashed"]), "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select(F.col("__id").alias("conv_id"), *zero, empty_for_null("audit").alias("audit"), F.coalesce("repaired_sha256", none).alias("repaired_sha256"))


ORACLE = """
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: xor(c >> 1, 3988292384 * (c & 1)))) AS step
), keyed AS (
  SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations
), dealt AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(k) + 1), lambda i: CAST(ord(substr(k, i, 1)) AS BIGINT))),
                         lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind
  FROM keyed, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM dealt, range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare, left(role, 1) AS initial
  FROM damaged
), r AS (
  SELECT conv_id, turn, i, role, text, initial, coalesce(lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au'), false) AS odd,
         CASE WHEN bare = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault
  FROM numbered
), steps(p, initial, q, role) AS (VALUES (0, 's', 1, NULL), (0, 'u', 2, 'user'), (1, 'u', 2, 'user'), (2, 'a', 3, 'assistant'), (3, 'u', 2, 'user')
), insertions(p, q, cost, audit, lines) AS (VALUES
  (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''), (0, 2, 3, 'I', chr(10) || 'user:'),
  (0, 3, 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 2, 3, 'I', chr(10) || 'user:'),
  (1, 3, 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (2, 3, 3, 'I', chr(10) || 'assistant:'), (3, 2, 3, 'I', chr(10) || 'user:')
), edits AS (
  SELECT conv_id, i, p, p AS q, 4 AS cost, 'D' AS audit, '' AS line FROM r, range(4) AS states(p)
  UNION ALL
  SELECT conv_id, i, p, q, CASE fault WHEN 3 THEN 3 ELSE 0 END, 'K', chr(10) || r.role || ':' || text FROM r JOIN steps USING (initial) WHERE fault NOT IN (1, 2)
  UNION ALL
  SELECT conv_id, i, p, q, CASE fault WHEN 3 THEN 6 ELSE 3 END, 'R', chr(10) || steps.role || ':' || text FROM r JOIN steps ON steps.role IS NOT NULL WHERE fault NOT IN (1, 2)
), cells AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, 0 AS q, lpad('0', 9, '0') AS best, '' AS lines FROM r
  UNION ALL
  SELECT c.conv_id, e.i, e.q, min(lpad(CAST(CAST(left(c.best, 9) AS BIGINT) + n.cost + e.cost AS VARCHAR), 9, '0') || substr(c.best, 10) || n.audit || e.audit),
         arg_min(c.lines || n.lines || e.line, lpad(CAST(CAST(left(c.best, 9) AS BIGINT) + n.cost + e.cost AS VARCHAR), 9, '0') || substr(c.best, 10) || n.audit || e.audit)
  FROM cells c JOIN insertions n ON n.p = c.q JOIN edits e ON e.conv_id IS NOT DISTINCT FROM c.conv_id AND e.i = c.i + 1 AND e.p = n.q
  GROUP BY c.conv_id, e.i, e.q
), ends AS (
  SELECT c.conv_id, lpad(CAST(CAST(left(c.best, 9) AS BIGINT) + n.cost AS VARCHAR), 9, '0') || substr(c.best, 10) || n.audit AS best, c.lines || n.lines AS lines
  FROM cells c JOIN (SELECT conv_id, max(i) AS i FROM r GROUP BY conv_id) l ON l.conv_id IS NOT DISTINCT FROM c.conv_id AND l.i = c.i
  JOIN insertions n ON n.p = c.q WHERE n.q IN (0, 3)
), repaired AS (
  SELECT conv_id, min(best) AS best, arg_min(lines, best) AS lines FROM ends GROUP BY conv_id
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
         count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (odd) AS illegal
  FROM r GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(CAST(left(best, 9) AS BIGINT), 0) AS cost, coalesce(substr(best, 10), '') AS audit,
       sha256(coalesce(substr(lines, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN repaired x ON x.conv_id IS NOT DISTINCT FROM o.conv_id
"""
