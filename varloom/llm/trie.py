"""Prefix trie of conversations, from the common prefixes of sorted neighbours.

Conversations become sequences of turn names.  Sequences are sorted by range over all tasks; the lengths of the common
prefixes of neighbours (LCP) are the edges of a union-find structure.  Edges are taken in descending depth: joining two
components makes a branching node at that depth, or adds a child to the node that already stands there.  The chains
between branching nodes are the nodes with one child.

A task works on blocks of sorted sequences.  What hangs below the paths of a block's first and last sequence is settled
there; the two paths alone may go on in other blocks.  So a block's forest is contracted to these two sequences, with
what hangs at each of their depths (members, children, leaves, tokens), and the contracted sequences of all blocks go
through the same step again, until they are few enough for one block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.llm.common import empty_for_null, tasks_for, word_count
from varloom.operators.durable import durable

#: A block is closed once it has so many turns and so many sequences; bounds a task's memory.
BLOCK_TURNS, BLOCK_SEQUENCES = 200_000, 64
#: Contracted sequences that one last block takes.
LAST_BLOCK = 20_000
#: Characters of the ids of a class that one row holds.
IDS_CHARS = 50_000
NO_ENDS = hashlib.sha256(b"").hexdigest()

Part = tuple[int, int, int | None, int, int, int, str | None]  # depth, n, least, children, leaves, saved, ends
PART = "array<struct<depth:long,n:long,least:long,children:long,leaves:long,saved:long,ends:string>>"
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, name string, parent_name string"
OUT = f"{NODE}, keys array<string>, words array<long>, parts {PART}"
_PART = pa.list_(pa.struct([("depth", pa.int64()), ("n", pa.int64()), ("least", pa.int64()), ("children", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.string())]))
_OUT = pa.schema([(f.split()[0], pa.string() if f.endswith("string") else pa.int64()) for f in NODE.split(", ")] + [("keys", pa.list_(pa.string())), ("words", pa.list_(pa.int64())), ("parts", _PART)])


# ---- sequences


def turns_in_order(rows: DataFrame) -> DataFrame:
    """conv_id, turns (array of name, words), by turn (null first); rows of one turn go by their names.

    A turn's name is 128 bits of the SHA-256 of its role and text.  Rows without a conv_id belong to no conversation.
    """
    role, text = empty_for_null("role"), empty_for_null("text")
    name = F.left(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), F.lit(32))
    each = rows.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), name.alias("name"), word_count(text).alias("words"))
    sorted_ = F.array_sort(F.collect_list(F.struct("turn", "name", "words")))
    return each.groupBy("conv_id").agg(F.transform(sorted_, lambda t: F.struct(t["name"].alias("name"), t["words"].alias("words"))).alias("turns"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """Each conversation c behind the first h turns of conversation c - c % 20, its own first h left out; h = crc32(c) % 4."""
    most = 3
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    heads = turns.filter("conv_id % 20 = 0").select(F.col("conv_id").alias("__base"), F.slice("turns", 1, most).alias("head"))
    own = turns.withColumns({"h": h, "of": F.col("conv_id") - F.col("conv_id") % 20})
    both = own.join(heads, own["of"] == heads["__base"], "left")
    head = F.when(F.col("head").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("head", F.lit(1), F.col("h")))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return both.select("conv_id", F.concat(head, rest).alias("turns"))


# ---- members of a class of equal sequences


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    block: list[tuple] = []
    for row in rows:
        block.append(row)
        if len(block) == size:
            yield pa.RecordBatch.from_arrays([pa.array(list(v), f.type) for v, f in zip(zip(*block), schema)], schema=schema)
            block = []
    if block:
        yield pa.RecordBatch.from_arrays([pa.array(list(v), f.type) for v, f in zip(zip(*block), schema)], schema=schema)


_RUNS = pa.schema([("whole", pa.string()), ("least", pa.int64()), ("n", pa.int64()), ("ids", pa.string())])


def _runs(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins the sorted ids of a class into texts of bounded length."""

    def rows():
        of, ids, chars = None, [], 0
        for batch in stream:
            for whole, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if ids and (whole != of or chars > IDS_CHARS):
                    yield of, ids[0], len(ids), ",".join(map(str, ids))
                    ids, chars = [], 0
                of = whole
                ids.append(conv)
                chars += 20
        if ids:
            yield of, ids[0], len(ids), ",".join(map(str, ids))

    return _batches(rows(), _RUNS, 1000)


_CLASSES = pa.schema([("least", pa.int64()), ("n", pa.int64()), ("ends", pa.string())])


def _classes(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Smallest id, number and digest of the ids of each class, whose texts come sorted; only the hash's state is held."""

    def rows():
        of, least, n, state = None, None, 0, None
        for batch in stream:
            for whole, first, count, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if whole != of:
                    if state:
                        yield least, n, state.hexdigest()
                    of, least, n, state = whole, first, 0, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
                n += count
        if state:
            yield least, n, state.hexdigest()

    return _batches(rows(), _CLASSES, 5000)


def classes(sequences: DataFrame) -> DataFrame:
    """keys, words, parts of each distinct sequence, from conv_id, turns."""
    own = sequences.select("conv_id", F.sha2(F.array_join(F.col("turns.name"), "").cast("binary"), 256).alias("whole"))
    runs = own.select("whole", "conv_id").repartitionByRange("whole", "conv_id").sortWithinPartitions("whole", "conv_id").mapInArrow(_runs, "whole string, least long, n long, ids string")
    found = runs.repartition("whole").sortWithinPartitions("whole", "least").mapInArrow(_classes, "least long, n long, ends string")
    zero = F.lit(0).cast("long")
    part = F.struct(F.size("turns").cast("long").alias("depth"), "n", "least", zero.alias("children"), zero.alias("leaves"), zero.alias("saved"), "ends")
    both = sequences.join(found, sequences["conv_id"] == found["least"])
    return both.select(F.col("turns.name").alias("keys"), F.col("turns.words").alias("words"), F.array(part).alias("parts"))


# ---- forests


def common(a: list[str], b: list[str]) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def added(a: Part | None, b: Part) -> Part:
    """What hangs at a node, from two sources."""
    if a is None:
        return b
    least = b[2] if a[2] is None else a[2] if b[2] is None else min(a[2], b[2])
    return (a[0], a[1] + b[1], least, a[3] + b[3], a[4] + b[4], a[5] + b[5], a[6] or b[6])


def names(keys: list[str]) -> list[str]:
    """The name of every prefix, from the empty one on."""
    state = hashlib.sha256()
    out = [state.hexdigest()]
    for key in keys:
        state.update(key.encode())
        out.append(state.hexdigest())
    return out


class Forest:
    """The compact trie of a block of sorted, distinct sequences: a node for every sequence and every branching."""

    def __init__(self, sequences: list[list[str]]):
        m = len(sequences)
        self.depth = [len(s) for s in sequences]
        self.lo, self.hi = list(range(m)), list(range(m))
        self.children: list[list[int]] = [[] for _ in range(m)]
        self.parent = [-1] * m
        edges = [common(a, b) for a, b in zip(sequences, sequences[1:])]
        group, top = list(range(m)), list(range(m))

        def find(i: int) -> int:
            while group[i] != i:
                group[i] = group[group[i]]
                i = group[i]
            return i

        # deepest first; of equal ones from left to right, so that what is joined on the right is always deeper
        for e in sorted(range(m - 1), key=lambda e: -edges[e]):
            a, b, d = find(e), find(e + 1), edges[e]
            left, right = top[a], top[b]
            if self.depth[left] != d:
                node = len(self.depth)
                self.depth.append(d)
                self.lo.append(self.lo[left])
                self.hi.append(self.hi[left])
                self.children.append([left])
                self.parent.append(-1)
                self.parent[left] = node
            else:
                node = left
            self.children[node].append(right)
            self.parent[right] = node
            self.hi[node] = self.hi[right]
            group[b] = a
            top[a] = node


def settle(items: list[tuple[list[str], list[int], list[Part]]], last: bool, named: bool) -> tuple[list[list], list[tuple]]:
    """Nodes that a block settles, and the sequences to which it is contracted.

    items: keys, words, parts (what hangs at depths of the sequence), sorted by keys and distinct.  last: no other block
    goes on with these paths.  named: nodes carry their names, as nodes of earlier blocks may be their children.
    """
    forest, m = Forest([keys for keys, _, _ in items]), len(items)
    depth, lo, hi, children, parent = forest.depth, forest.lo, forest.hi, forest.children, forest.parent
    pending: list[dict[int, Part] | None] = [None] * len(depth)
    totals: list[tuple | None] = [None] * len(depth)  # n, least, leaves, saved and record of a settled component's top
    nodes: list[list] = []
    paths = ({}, {})
    path_names = None if last else (names(items[0][0]), names(items[-1][0]))
    for v in sorted(range(len(depth)), key=lambda v: -depth[v]):
        hanging: dict[int, Part] = {}
        if v < m:
            for part in items[v][2]:
                hanging[part[0]] = added(hanging.get(part[0]), part)
        for c in children[v]:
            if pending[c]:
                for d, part in pending[c].items():
                    hanging[d] = added(hanging.get(d), part)
                pending[c] = None
        shared = not last and (lo[v] == 0 or hi[v] == m - 1)
        side = 0 if lo[v] == 0 else 1
        below, count = [totals[c] for c in children[v]], len(children[v])
        own_names = names(items[lo[v]][0]) if named and not shared else None
        words, stop = items[lo[v]][1], depth[parent[v]] if parent[v] >= 0 else -1
        for d in range(depth[v], stop, -1):
            part = hanging.pop(d, None)
            if shared:
                for total in below:
                    if total is not None:
                        n, least, leaves, saved, record = total
                        part = added(part, (d, n, least, 1, leaves, saved, None))
                        nodes[record][9] = path_names[side][d]
                if part:
                    paths[side][d] = added(paths[side].get(d), part)
                below = []
                continue
            n = children_n = leaves = saved = 0
            least = ends = None
            if part:
                _, n, least, children_n, leaves, saved, ends = part
            for t in below:
                n += t[0]
                least = t[1] if least is None or t[1] < least else least
                leaves += t[2]
                saved += t[3]
            children_n += count
            if not children_n:
                leaves = 1
            if d:
                saved += (n - 1) * words[d - 1]
            for t in below:
                nodes[t[4]][2] = least
            nodes.append([least, d, None, n, children_n, leaves, saved, ends or NO_ENDS, own_names[d] if own_names else None, None])
            below, count = [(n, least, leaves, saved, len(nodes) - 1)], 1
        totals[v] = None if shared else below[0]
        pending[v] = hanging
    open_ = [] if last else [(*items[i][:2], list(paths[side].values())) for side, i in enumerate(sorted({0, m - 1}))]
    return nodes, open_


def _blocks(stream: Iterator[pa.RecordBatch], last: bool) -> Iterator[list]:
    block, turns = [], 0
    for batch in stream:
        for keys, words, parts in zip(*(c.to_pylist() for c in batch.columns)):
            block.append((keys, words, [tuple(p.values()) for p in parts]))
            turns += len(keys) + 1
            if not last and turns >= BLOCK_TURNS and len(block) >= BLOCK_SEQUENCES:
                yield block
                block, turns = [], 0
    if block:
        yield block


def _settled(last: bool, named: bool):
    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for block in _blocks(stream, last):
                nodes, open_ = settle(block, last, named)
                for node in nodes:
                    yield (*node, None, None, None)
                for keys, words, parts in open_:
                    yield (*(None,) * 10, keys, words, [dict(zip(("depth", "n", "least", "children", "leaves", "saved", "ends"), p)) for p in parts])

        return _batches(rows(), _OUT, 5000)

    return batches


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node.

    sequences: conv_id (each once), turns (array of name, words).  Turnless conversations are members of the root
    alone; equal sequences are one leaf; an empty table has no node, not even a root.  A conversation's names and word
    counts, not its texts, are in one row.
    """
    sequences = durable(sequences)
    items, named, found = classes(sequences).repartitionByRange("keys"), False, None
    while True:
        made = durable(items.sortWithinPartitions("keys").mapInArrow(_settled(False, named), OUT))
        nodes = made.filter("keys is null").select(*_OUT.names[:10])
        found = nodes if found is None else found.unionByName(nodes)
        open_, named = made.filter("keys is not null").select("keys", "words", "parts"), True
        count = open_.count()
        if count <= LAST_BLOCK:
            break
        items = open_.repartitionByRange(tasks_for(count, LAST_BLOCK), "keys")
    top = durable(open_.coalesce(1).sortWithinPartitions("keys").mapInArrow(_settled(True, True), OUT)).select(*_OUT.names[:10])
    found = found.unionByName(top)
    above = found.filter("name is not null").select(F.col("name").alias("__name"), F.col("conv_id").alias("__conv"))
    out = [c for c in _OUT.names[:8] if c != "parent_conv_id"]
    settled = found.filter("parent_name is null").select(*out, "parent_conv_id")
    below = found.filter("parent_name is not null").join(above, F.col("parent_name") == F.col("__name")).select(*out, F.col("__conv").alias("parent_conv_id"))
    return settled.unionByName(below).select(*_OUT.names[:8])


ORACLE = """
WITH crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: xor(c >> 1, 3988292384 * (c & 1)))) AS step
), ids AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
         xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(k) + 1), lambda i: CAST(ord(substr(k, i, 1)) AS BIGINT))),
                         lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1])), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS k FROM conversations WHERE conv_id IS NOT NULL), crc
), named AS (
  SELECT conv_id, turn, left(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 32) AS name,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words
  FROM conversations
), t AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, name) AS i FROM named
), rebuilt AS (
  SELECT ids.conv_id, 1 AS own, i, name, words FROM ids JOIN t ON t.conv_id = ids.conv_id AND i > h
  UNION ALL SELECT ids.conv_id, 0, i, name, words FROM ids JOIN t ON t.conv_id = base AND i <= h
), paths AS (
  SELECT conv_id, row_number() OVER w AS depth, string_agg(name, '') OVER w AS path, words FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY own, i)
  UNION ALL SELECT conv_id, 0, '', 0 FROM ids
), sized AS (
  SELECT *, max(depth) OVER (PARTITION BY conv_id) AS size FROM paths
), nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(words) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = size), '')) AS ends_sha256
  FROM sized GROUP BY path, depth
), bred AS (
  SELECT left(path, 32 * (depth - 1)) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
), counted AS (
  SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN bred USING (path)
), subtrees AS (
  SELECT left(path, 32 * d) AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM counted, range(depth + 1) AS up(d) GROUP BY ALL
)
SELECT c.conv_id, CAST(c.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, c.ends_sha256
FROM counted c JOIN subtrees USING (path) LEFT JOIN nodes p ON c.depth > 0 AND p.path = left(c.path, 32 * (c.depth - 1))
"""
