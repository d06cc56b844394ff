"""SimHash near-duplicates through the generalised pigeonhole principle.

Fingerprints are 64 majority bits of word-shingle hashes.  Distinct fingerprints are the nodes.  Their bits are
grouped so that correlated bits share a partition; if the partition thresholds t_i (from -1 on) satisfy
sum(t_i + 1) = tau + 1, two fingerprints within tau bits agree within t_i bits on some partition i.  For each
fingerprint a dynamic program chooses the thresholds with the fewest estimated candidates and probes: a crowded
value gets -1 (its partition is skipped), an empty neighbourhood more.  Probes meet the stored values in an
equi-join, whose condition verifies the full distance, so only true links come out.

Hot groups: equal fingerprints are one node.  Before probing, every stored value's bucket links its members to
a few leaders (stars, never all pairs), the links are contracted to components, and the join then yields only
links between different components.  Members of the largest component do not probe at all: any link that joins
it to another component is found from the other side.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varloom.llm.common import durable, empty_for_null, map_texts, settled, tasks_for
from varloom.llm.components import components

BITS = 64
#: The histogram of a partition covers its first 16 bits; a partition's further bits count as uniform.
HEAD = 16
#: Cost of one probe row, in candidate comparisons.
PROBE_COST = 30.0
#: Leaders of a bucket in the stars that settle crowded groups before probing.
LEADERS = 8
#: A bucket of a fingerprint's part is crowded beyond this many members and this many times the mean.
FULL, TIMES_MEAN = 2, 1
#: Rounds in which every text meets its nearest leader of another component, before candidates are listed.
LEADER_ROUNDS = 2
#: Memberships of bands that a task compares.
CROWD_ROWS = 500
#: Gives one side's column by name.
Side = Callable[[str], Column]
#: Shingles whose bits are counted at once, which bounds memory for very long texts.
AT_ONCE = 1 << 16
#: Odd multipliers that turn one shingle hash into further independent ones.
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)
#: Bands of five least shingle hashes: two texts of similarity s share none with probability (1 - s^5)^16, 0.2 % at 0.8.
BANDS, BAND_ROWS = 16, 5
LEAST = np.random.default_rng(5).integers(0, 1 << 63, BANDS * BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Bits of the filter that picks the texts to compare; its 16 MB are all that reaches the driver.
FILTER_BITS = 27
#: Shingle hashes that a task keeps while it compares pairs.
KEPT_SHINGLES = 2_000_000


def words_of(text: str) -> list[bytes]:
    """`[^\\x20\\x09-\\x0D]+` of the text with A-Z lower-cased (bytes.lower and bytes.split do just that)."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(words: list[bytes], size: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of every space-joined shingle, repeats included, in arrays of bounded length."""
    if not words:
        return
    if len(words) < size:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)], dtype=np.uint64)
        return
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(words) - size + 1, AT_ONCE):
        part = words[at : at + AT_ONCE + size - 1]
        joined = b" ".join(part)
        lengths = np.fromiter(map(len, part), np.int64, len(part)) + 1
        ends = np.cumsum(lengths)
        starts = (ends - lengths)[: len(part) - size + 1].tolist()
        stops = (ends[size - 1 :] - 1).tolist()
        yield np.array([digest(joined[a:b], 42) for a, b in zip(starts, stops)], dtype=np.uint64)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each bit, from the highest."""
    octets = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)


def pack(bits: np.ndarray) -> int:
    return int.from_bytes(np.packbits(bits).tobytes(), "big", signed=True)


def majority(parts: Iterator[np.ndarray]) -> int:
    total, n = np.zeros(BITS, np.int64), 0
    for hashes in parts:
        total += bit_counts(hashes)
        n += len(hashes)
    return pack(total * 2 > n) if n else 0


def mixed(hashes: np.ndarray, multiplier: int) -> np.ndarray:
    x = hashes * np.uint64(multiplier)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 4) -> DataFrame:
    """key, fp: the signed 64-bit fingerprint of every row (0 for texts without words)."""

    def work():
        return lambda texts: (None, [[majority(shingle_hashes(words_of(t), size)) for t in texts]])

    return map_texts(docs, (key,), text, {"fp": "long"}, work)


def distinct_shingles(words: list[bytes], size: int) -> np.ndarray:
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *shingle_hashes(words, size)]))


def band_values(shingles: np.ndarray) -> list[int]:
    """One value for each band, from the least of the shingles' hashes under BAND_ROWS multipliers."""
    least = np.full(len(LEAST), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 1 << 12):
        x = shingles[at : at + (1 << 12)] ^ (shingles[at : at + (1 << 12)] >> np.uint64(32))
        x = x[None, :] * LEAST[:, None]
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        least = np.minimum(least, x.min(axis=1))
    rows = least.reshape(BANDS, BAND_ROWS)
    return [xxhash.xxh64_intdigest(rows[i].tobytes(), i) - (1 << 63) for i in range(BANDS)]


def wide_fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", size: int = 5) -> DataFrame:
    """keep, fp, w0..w3, shingles, bands: fp from the distinct words, which moves little under scattered edits, 256
    majority bits of the distinct shingles of `size` words, which follow shingle similarity, a hash of the set of
    shingles, and the set's bands, which hold wherever in the text an edit lies.  Both find candidates."""

    def one(t: str) -> tuple:
        words = words_of(t)
        if not words:
            return (*(0,) * (2 + len(MIX)), [])
        single = np.unique(np.array([xxhash.xxh64_intdigest(w, 42) for w in set(words)], dtype=np.uint64))
        shingles = distinct_shingles(words, size)
        cut = [shingles[i : i + AT_ONCE] for i in range(0, len(shingles), AT_ONCE)]
        wide = (majority(mixed(h, m) for h in cut) for m in MIX)
        return (majority(iter([single])), *wide, xxhash.xxh64_intdigest(shingles.tobytes(), 1) - (1 << 63), band_values(shingles))

    names = ("fp", *(f"w{i}" for i in range(len(MIX))), "shingles")

    def work():
        return lambda texts: (None, list(zip(*map(one, texts))))

    return map_texts(docs, keep, text, dict.fromkeys(names, "long") | {"bands": "array<long>"}, work)


# ---- partitions, thresholds and probes


def unpacked(fp: np.ndarray) -> np.ndarray:
    """rows x 64 bits, column b being bit b (from the lowest)."""
    octets = fp.astype("<i8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(octets, axis=1, bitorder="little")


def bit_correlations(nodes: DataFrame) -> np.ndarray:
    """Absolute correlations of the 64 bits over all nodes, from co-occurrence counts summed in Spark."""

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            for at in range(0, len(batch), AT_ONCE):
                x = unpacked(batch["fp"].to_numpy()[at : at + AT_ONCE]).astype(np.float64)
                total += x.T @ x
                n += len(x)
        if n:
            yield pd.DataFrame({"cell": np.arange(BITS * BITS + 1), "n": np.append(total.ravel(), n).astype(np.int64)})

    rows = nodes.select("fp").mapInPandas(counts, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    if not len(rows):
        return np.zeros((BITS, BITS))
    flat = rows.sort_values("cell")["n"].to_numpy(np.float64)
    n, both = flat[-1], flat[:-1].reshape(BITS, BITS)
    mean = np.diag(both) / n
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    return np.abs((both / n - np.outer(mean, mean)) / np.outer(spread, spread))


def grouped_bits(correlation: np.ndarray, parts: int) -> list[list[int]]:
    """Bits by partition: each starts with the most correlated bit left and takes those closest to it."""
    left, out = list(range(BITS)), []
    for i in range(parts):
        width = len(left) // (parts - i)
        seed = max(left, key=lambda b: (correlation[b, left].sum(), -b))
        own = [seed]
        left.remove(seed)
        while len(own) < width:
            nearest = max(left, key=lambda b: (correlation[b, own].sum(), -b))
            own.append(nearest)
            left.remove(nearest)
        out.append(own)
    return out


def ball(width: int, radius: int) -> int:
    return sum(math.comb(width, r) for r in range(radius + 1))


def partition_count(n: int, tau: int) -> int:
    """Partitions with the least cost for n evenly spread fingerprints under even thresholds."""

    def cost(parts: int) -> float:
        width, budget = BITS // parts, tau + 1
        probes = sum(ball(width, budget // parts + (i < budget % parts) - 1) for i in range(parts))
        return probes * (PROBE_COST + n / 2**width)

    return min(range(2, min(tau + 1, 8) + 1), key=cost)


def values(bits: np.ndarray, own: list[int]) -> np.ndarray:
    return (bits[:, own].astype(np.int64) << np.arange(len(own))).sum(axis=1)


def value_column(fp: Column, own: list[int]) -> Column:
    out = F.lit(0).cast("long")
    for j, b in enumerate(own):
        out = out.bitwiseOR(F.shiftleft(F.shiftrightunsigned(fp, b).bitwiseAND(F.lit(1).cast("long")), j))
    return out


def ball_counts(histogram: np.ndarray, head: int, most: int) -> np.ndarray:
    """counts[t, v]: stored values at exactly t bits from head value v."""
    counts = np.zeros((most + 1, 1 << head))
    counts[0] = histogram
    for b in range(head):
        across = counts[:, np.arange(1 << head) ^ (1 << b)]
        counts[1:] += across[:-1]
    return counts


def threshold_costs(counts: np.ndarray, head_values: np.ndarray, width: int, most: int) -> np.ndarray:
    """costs[t + 1, row]: estimated candidates and probes of threshold t, from -1 to most."""
    rest = width - int(math.log2(counts.shape[1]))
    near = counts[:, head_values]
    costs = [np.zeros(len(head_values))]
    for t in range(most + 1):
        found = sum(near[j] * sum(math.comb(rest, s) for s in range(t - j + 1)) / 2**rest for j in range(t + 1))
        costs.append(found + PROBE_COST * ball(width, t))
    return np.array(costs)


def allocate(costs: list[np.ndarray], tau: int) -> np.ndarray:
    """rows x partitions: thresholds with sum(t + 1) = tau + 1 of the least total cost, by dynamic programming."""
    rows, budget = costs[0].shape[1], tau + 1
    best = np.full((budget + 1, rows), np.inf)
    best[0] = 0
    choices = []
    for own in costs:
        nxt, pick = np.full_like(best, np.inf), np.zeros((budget + 1, rows), np.int64)
        for total in range(budget + 1):
            for spent in range(min(total, len(own) - 1) + 1):
                cost = best[total - spent] + own[spent]
                lower = cost < nxt[total]
                nxt[total][lower] = cost[lower]
                pick[total][lower] = spent
        best = nxt
        choices.append(pick)
    out, total = np.zeros((rows, len(costs)), np.int64), np.full(rows, budget)
    for i in range(len(costs) - 1, -1, -1):
        spent = choices[i][total, np.arange(rows)]
        out[:, i] = spent - 1
        total -= spent
    return out


def masks(width: int, radius: int) -> np.ndarray:
    """All values with at most `radius` of `width` bits."""
    found = [np.zeros(1, np.int64)]
    for _ in range(radius):
        grown = (found[-1][:, None] | (1 << np.arange(width))[None, :]).ravel()
        found.append(np.setdiff1d(np.unique(grown), np.concatenate(found)))
    return np.concatenate(found)


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


class Pigeonhole:
    """Partitions of the bits, thresholds and probes for the fingerprints of nodes (node, fp)."""

    def __init__(self, nodes: DataFrame, tau: int, parts: int | None = None):
        self.tau = tau
        self.parts = parts = parts or partition_count(nodes.count(), tau)
        self.bits = bits = grouped_bits(bit_correlations(nodes), parts)
        self.widths = [len(b) for b in bits]
        self.heads = [min(HEAD, w) for w in self.widths]
        self.most = [min(tau, w) for w in self.widths]
        self.buckets = F.array(*(F.lit(i << 60).bitwiseOR(value_column(F.col("fp"), b)) for i, b in enumerate(bits)))
        # bounded histograms: at most parts x 65536 rows reach the driver
        head = F.explode(F.array(*(F.struct(F.lit(i).alias("part"), value_column(F.col("fp"), b[:h]).alias("value")) for i, (b, h) in enumerate(zip(bits, self.heads)))))
        counted = nodes.select(head.alias("x")).groupBy("x.part", "x.value").count().toPandas()
        counts = []
        for i, h in enumerate(self.heads):
            own = counted[counted["part"] == i]
            histogram = np.zeros(1 << h)
            histogram[own["value"].to_numpy(np.int64)] = own["count"]
            counts.append(ball_counts(histogram, h, self.most[i]).astype(np.float32))
        self.full = [FULL + TIMES_MEAN * c[0].mean() for c in counts]
        self.counts = nodes.sparkSession.sparkContext.broadcast(counts)

    def stored(self, nodes: DataFrame) -> DataFrame:
        return nodes.withColumn("bucket", F.explode(self.buckets))

    def probes(self, nodes: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
        """nodes (all long, with fp), a bucket to ask for each value within the node's thresholds, and `crowded` (1 or
        0).  The columns `extra` are filled where the bucket is crowded, else 0: most probes stay small."""
        counts, tau, parts, bits, widths, heads, most = self.counts, self.tau, self.parts, self.bits, self.widths, self.heads, self.most
        full, extra = self.full, list(extra)

        def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            known = counts.value
            for whole in batches:
                for at in range(0, len(whole), 4096):
                    batch = whole.iloc[at : at + 4096]
                    x = unpacked(batch["fp"].to_numpy())
                    costs = [threshold_costs(known[i], values(x, bits[i][: heads[i]]), widths[i], most[i]) for i in range(parts)]
                    thresholds = allocate(costs, tau)
                    for i in range(parts):
                        own = values(x, bits[i])
                        for t in range(most[i] + 1):
                            rows = np.flatnonzero(thresholds[:, i] == t)
                            if len(rows):
                                around = masks(widths[i], t)
                                for cut in range(0, len(rows), max(1, 500_000 // len(around))):
                                    some = rows[cut : cut + max(1, 500_000 // len(around))]
                                    bucket = (own[some][:, None] ^ around[None, :]) | (i << 60)
                                    bucket = bucket.ravel()
                                    crowded = known[i][0, bucket & ((1 << heads[i]) - 1)] > full[i]
                                    out = batch.iloc[np.repeat(some, len(around))].assign(bucket=bucket, crowded=crowded.astype(np.int64))
                                    out[extra] = out[extra].to_numpy() * crowded[:, None]
                                    yield out

        return nodes.mapInPandas(probe, ", ".join(f"{c} long" for c in (*nodes.columns, "bucket", "crowded")))


def largest(placed: DataFrame) -> Column:
    """Whether a row is in the largest component, whose members need not ask: the other side finds the link."""
    top = placed.groupBy("comp").count().filter("count > 1").orderBy(F.desc("count"), "comp").limit(1).collect()
    return (F.col("comp") == top[0]["comp"]) if top else F.lit(False)


def joined(placed: DataFrame, links: DataFrame) -> DataFrame:
    """placed with its components joined by links (a, b) between them."""
    named = components(links).select(F.col("node").alias("comp"), F.col("root").alias("__root"))
    out = placed.join(named, "comp", "left").withColumn("comp", F.coalesce("__root", "comp"))
    return out.select(*placed.columns)


def linked(nodes: DataFrame, tau: int, parts: int | None = None) -> DataFrame:
    """node, root for every node (node, unique, and fp); a link is at most tau differing bits."""
    hole = Pigeonhole(nodes, tau, parts)
    # stars: every bucket links its members to a few leaders, those with the least hashes
    held = hole.stored(nodes)
    chosen = [F.min_by(F.struct("node", "fp"), F.xxhash64("node", F.lit(k))) for k in range(LEADERS)]
    leaders = held.groupBy("bucket").agg(F.array_distinct(F.array(*chosen)).alias("leaders"), F.count("*").alias("n")).filter("n > 1").drop("n")
    led = F.filter("leaders", lambda y: (y["node"] != F.col("node")) & (distance(y["fp"], F.col("fp")) <= tau))
    edges = held.join(leaders, "bucket").select(F.col("node").alias("a"), F.explode(led).alias("y")).select("a", F.col("y.node").alias("b"))
    placed = durable(joined(nodes.withColumn("comp", F.col("node")), edges))
    probes = hole.probes(placed.filter(~largest(placed)))
    meets = (F.col("p.bucket") == F.col("s.bucket")) & (F.col("p.comp") != F.col("s.comp")) & (distance(F.col("p.fp"), F.col("s.fp")) <= tau)
    links = probes.alias("p").join(hole.stored(placed).hint("shuffle_hash").alias("s"), meets).select(F.col("p.comp").alias("a"), F.col("s.comp").alias("b")).distinct()
    return joined(placed, links).select("node", F.col("comp").alias("root"))


# ---- groups of similar sets


def short_bands() -> list[Column]:
    """The bands' values, shortened to 15 bits, four to a long."""
    lane = lambda i: F.coalesce(F.get("bands", F.lit(i)), F.lit(0)).bitwiseAND(F.lit(0x7FFF).cast("long"))
    return [reduce(Column.bitwiseOR, (F.shiftleft(lane(4 * j + k), 15 * k) for k in range(4))).alias(f"s{j}") for j in range(BANDS // 4)]


def in_one_band(a: Side, b: Side) -> Column:
    """Whether two texts have a short band in common: a lane of zeros in the exclusive or."""
    ones, tops = sum(1 << 15 * k for k in range(4)), sum(1 << 15 * k + 14 for k in range(4))

    def lane(j: int) -> Column:
        x = a(f"s{j}").bitwiseXOR(b(f"s{j}"))
        return (x - F.lit(ones)).bitwiseAND(F.bitwise_not(x)).bitwiseAND(F.lit(tops)) != 0

    return reduce(Column.__or__, (lane(j) for j in range(BANDS // 4)))


def apart(a: Side, b: Side) -> Column:
    """Differing bits of the wide fingerprints."""
    return sum((distance(a(f"w{i}"), b(f"w{i}")) for i in range(len(MIX))), F.lit(0))


def linked_sets(nodes: DataFrame, tau: int, far: int, far_alone: int, texts: Texts) -> DataFrame:
    """node, root for every node (node, fp, w0.., bands): links are pairs that `texts` confirms.

    Candidates meet in a bucket of the fingerprint (tau) or in a band, and differ in at most `far` of the wide bits;
    those that meet in no band, a small share of true links, in at most `far_alone`.  Rounds of leaders join what
    belongs together first, so that only pairs across components are left to compare.  They are compared by their
    sets inside the joins, which list true links alone: the pairs of a group that are none grow with its square.
    """
    wide = [f"w{i}" for i in range(len(MIX))]
    short = [f"s{j}" for j in range(BANDS // 4)]
    hole = Pigeonhole(nodes.select("node", "fp"), tau)
    banded = nodes.select("node", F.explode("bands").alias("bucket"))
    sizes = banded.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    shared = settled(banded.join(sizes.select("bucket"), "bucket"))
    tasks = tasks_for(shared.count())
    placed = nodes.select("node", "fp", *wide, *short_bands(), F.col("node").alias("comp"))

    def of(members: DataFrame) -> DataFrame:
        return members.join(placed.select("node", "comp", *wide), "node")

    def nearest(k: int) -> DataFrame:
        """a, b: every node and the nearest leader, of its buckets' leaders from other components."""
        columns = ["bucket", "node", "comp", *wide]
        members = of(shared).select(columns).coalesce(tasks).unionByName(hole.stored(placed).select(columns))
        me = F.struct("node", "comp", *wide)
        chosen = [F.min_by(me, F.xxhash64("node", F.lit(LEADERS * k + i))) for i in range(LEADERS // 2)]
        leaders = members.groupBy("bucket").agg(F.array_distinct(F.array(*chosen)).alias("leaders"), F.min("comp").alias("low"), F.max("comp").alias("high"))
        leaders = leaders.filter("low < high").drop("low", "high")
        met = F.transform(F.filter("leaders", lambda y: y["comp"] != F.col("comp")), lambda y: F.struct(apart(F.col, lambda c: y[c]).alias("far"), y["node"].alias("b")))
        rows = members.join(leaders, "bucket").select(F.col("node").alias("a"), F.array_min(met).alias("y")).filter(F.col("y.far") <= far)
        return rows.groupBy("a").agg(F.min("y").alias("y")).select("a", F.col("y.b").alias("b"))

    def between(found: DataFrame) -> DataFrame:
        """Links of nodes as links of their components."""
        comp = placed.select("node", "comp")
        both = found.join(comp.toDF("a", "ca"), "a").join(comp.toDF("b", "cb"), "b")
        return both.select(F.col("ca").alias("a"), F.col("cb").alias("b"))

    for k in range(LEADER_ROUNDS):
        placed = settled(joined(placed, between(texts.confirmed(nearest(k)))))

    asks = ~largest(placed)
    p, s = (lambda c: F.col(f"p.{c}")), (lambda c: F.col(f"s.{c}"))
    pair = [F.least(p("node"), s("node")).alias("a"), F.greatest(p("node"), s("node")).alias("b")]
    # probes are many, so they carry the wide bits only into crowded buckets
    lonely = (apart(p, s) <= far_alone) & ~in_one_band(p, s)
    meets = (p("bucket") == s("bucket")) & (p("comp") != s("comp")) & (distance(p("fp"), s("fp")) <= tau)
    # the probes that meet anyone, then whom they meet: only these take their sets into the join
    probes, stored = hole.probes(placed.filter(asks), (*wide, *short)).alias("p"), hole.stored(placed)
    hits = probes.join(stored.hint("shuffle_hash").alias("s"), meets & ((p("crowded") == 0) | lonely), "left_semi")
    asking = settled(hits.select("node", "bucket").distinct().join(placed, "node"))
    answering = settled(stored.alias("s").join(asking.alias("p"), meets & lonely, "left_semi"))
    # every pair of components once, from the side that asks
    first = (p("comp") != s("comp")) & (~s("asks") | (p("comp") < s("comp")))
    held = of(shared).withColumn("asks", asks)
    mixed = held.groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low < high").select("bucket")
    held = settled(held.join(mixed, "bucket"))
    near = (p("bucket") == s("bucket")) & first & (apart(p, s) <= far)
    # a bucket's rows are compared with many others, so a task takes few of them
    tasks = tasks_for(held.count() + asking.count() + answering.count(), CROWD_ROWS)
    sets = settled(texts.sets(reduce(DataFrame.unionByName, (x.select("node") for x in (held, asking, answering))).distinct()))

    def alike(left: DataFrame, right: DataFrame, meet: Column) -> DataFrame:
        met = left.join(sets, "node").alias("p").join(right.join(sets, "node").alias("s"), meet & texts.alike(p, s))
        return met.select(*pair).coalesce(tasks)

    def rows() -> DataFrame:
        return alike(asking, answering, meets & lonely).unionByName(alike(held.filter("asks"), held, near)).distinct()

    # no name holds the listed pairs, so that their shuffle files go before texts move
    return joined(placed, between(texts.confirmed(rows())).distinct()).select("node", F.col("comp").alias("root"))


def near_duplicates(docs: DataFrame, tau: int = 4, size: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, fingerprint (16 hex digits), component_id for every row.

    Rows are linked when their fingerprints differ in at most tau bits; component_id is the smallest key
    reachable.  Null texts count as empty; texts without words have fingerprint zero and link like any other;
    rows with equal texts share a node; null keys keep their rows and never become a component's id unless it
    has no other.  Other columns are ignored; an empty table gives an empty result.
    """
    rows = durable(fingerprints(docs, key, text, size).withColumnRenamed(key, "key"))
    distinct = durable(rows.groupBy("fp").agg(F.min("key").alias("least")))
    roots = linked(distinct.select(F.col("fp").alias("node"), "fp"), tau).withColumnRenamed("node", "fp")
    classes = durable(distinct.join(roots, "fp"))
    named = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = classes.join(named, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def text_hash(text: str = "text") -> Column:
    return F.xxhash64(empty_for_null(text))


class Texts:
    """The texts behind nodes, which are named by the hashes of their texts; only texts that are asked for move."""

    def __init__(self, docs: DataFrame, size: int, least: float, text: str = "text"):
        self.source = docs.select(text_hash(text).alias("node"), empty_for_null(text).alias("text"))
        self.size, self.least = size, least

    def of(self, nodes: DataFrame) -> DataFrame:
        """node, text: once for each of nodes.  A bit filter of bounded size picks them before the shuffle."""
        bit = F.col("node").bitwiseAND(F.lit((1 << FILTER_BITS) - 1)) + 1
        ends = nodes.select(bit.alias("bit"))
        maps = ends.groupBy(F.bitmap_bucket_number("bit").alias("at")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).toPandas()
        table = np.zeros((1 << FILTER_BITS) >> 3, np.uint8)
        for at, bits in zip(maps["at"], maps["bits"]):
            table[(at - 1) * 4096 : at * 4096] = np.frombuffer(bytes(bits), np.uint8)
        wanted = nodes.sparkSession.sparkContext.broadcast(table)

        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = wanted.value
            for batch in batches:
                bits = batch.column(0).to_numpy() & ((1 << FILTER_BITS) - 1)
                yield batch.filter(pa.array((known[bits >> 3] >> (bits & 7).astype(np.uint8)) & 1 == 1))

        return self.source.mapInArrow(pick, "node long, text string").groupBy("node").agg(F.first("text").alias("text"))

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose sets of shingles have the Jaccard similarity `least` or more."""
        pairs, size, least = settled(pairs), self.size, self.least

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known: dict[int, np.ndarray] = {}
            held = 0
            for batch in batches:
                good = []
                for ends in zip(*(batch.column(i) for i in range(4))):
                    sets = []
                    for node, text in zip(ends[:2], ends[2:]):
                        own = known.get(node.as_py())
                        if own is None:
                            own = distinct_shingles(words_of(text.as_py()), size)
                            held += len(own)
                            if held > KEPT_SHINGLES:
                                known, held = {}, len(own)
                            known[node.as_py()] = own
                        sets.append(own)
                    both = len(np.intersect1d(*sets, assume_unique=True))
                    good.append(both >= least * (len(sets[0]) + len(sets[1]) - both))
                yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

        texts = self.of(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
        both = pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b")
        return settled(both.select("a", "b", "ta", "tb").mapInArrow(compare, "a long, b long"))

    def sets(self, nodes: DataFrame) -> DataFrame:
        """node, shingles, lost: the lower halves of the hashes of a text's distinct shingles, and how many hashes share
        a half with another."""
        nodes, size = settled(nodes), self.size

        def halves(text: str) -> tuple[np.ndarray, int]:
            whole = distinct_shingles(words_of(text), size)
            own = np.unique(whole.astype(np.uint32)).view(np.int32)
            return own, len(whole) - len(own)

        def work():
            return lambda texts: (None, list(zip(*map(halves, texts))))

        return map_texts(self.of(nodes).join(nodes, "node", "left_semi"), ("node",), "text", {"shingles": "array<int>", "lost": "long"}, work)

    def alike(self, a: Side, b: Side) -> Column:
        """Whether two such sets are similar enough: never no where their hashes are, as what they may have in common in
        lost hashes is added; yes by halves that coincide is rare (one in 2^32)."""
        both = F.size(F.array_intersect(a("shingles"), b("shingles"))) + F.least(a("lost"), b("lost"))
        return both >= F.lit(self.least) * (F.size(a("shingles")) + a("lost") + F.size(b("shingles")) + b("lost") - both)


def similar_rows(docs: DataFrame, size: int = 5, least: float = 0.8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, hash (of the text), group for every row: texts are linked if their sets of shingles of `size` words have
    the Jaccard similarity `least` or more.

    Candidates come from the 64-bit fingerprint of distinct words and from bands of least hashes.  Two texts with
    similarity s differ in a share acos(2s / (1 + s)) / pi of the 256 wide bits: 39 +- 6 at 0.8 (48 +- 6 if they
    have five shingles), against 128 +- 8 for unrelated texts, so that candidates beyond 72 need no comparison, nor
    those beyond 60 that share no band.  Null texts count as empty and form one group with other texts without words;
    null and repeated keys keep a row each; other columns are ignored; an empty table gives an empty result.
    """
    wide = tuple(f"w{i}" for i in range(len(MIX)))
    hashed = docs.select(F.col(key).alias("key"), text_hash(text).alias("hash"), F.col(text).alias("text"))
    rows = settled(wide_fingerprints(hashed, ("key", "hash"), "text", size))
    firsts = (F.first(c).alias(c) for c in ("fp", *wide, "bands"))
    # a node is a set of shingles, named by one of its texts
    distinct = settled(rows.groupBy("shingles").agg(F.min("hash").alias("node"), *firsts))
    roots = linked_sets(distinct, tau=8, far=72, far_alone=60, texts=Texts(docs, size, least, text))
    classes = distinct.select("shingles", "node").join(roots, "node").select("shingles", F.col("root").alias("group"))
    return rows.select("key", "hash", "shingles").join(classes, "shingles").select(F.col("key").alias(key), "hash", "group")


def similar_documents(docs: DataFrame, size: int = 5, least: float = 0.8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, component_id: the groups of similar_rows, named by their smallest key."""
    rows = durable(similar_rows(docs, size, least, key=key, text=text))
    named = rows.groupBy("group").agg(F.min(key).alias("component_id"))
    return rows.join(named, "group").select(key, "component_id")
