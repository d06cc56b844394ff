"""Interval operators: range joins by bins, merged and split intervals, nearest features, chunks with halos.

Intervals are closed; null bounds mean the whole chromosome.  Spark has no range join, so both sides meet on
(chrom, bin) and the exact condition is checked behind the equi-join.  A point has one bin; an interval has one
row per bin it touches, and intervals of more than MANY_BINS bins go by a coarser level instead, so a
whole-chromosome interval does not explode into thousands of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varloom.operators.durable import durable

BIN = 100_000
#: Bins grow by this factor from level to level; an interval uses the first level where it has few bins.
FACTOR = 64
LEVELS = 4
MANY_BINS = 64


def _level(width):
    """The first level whose bins an interval of that width touches at most MANY_BINS + 1 of."""
    out = F.lit(LEVELS - 1)
    for level in range(LEVELS - 2, -1, -1):
        out = F.when(width / (BIN * FACTOR**level) <= MANY_BINS, level).otherwise(out)
    return out


def _size(level):
    return F.lit(BIN) * F.pow(F.lit(FACTOR), level).cast("long")


def _binned_intervals(regions: DataFrame, chrom: str, start: str, stop: str) -> DataFrame:
    """__chrom, __from, __to, __level, __bin of every interval; bounds sorted, nulls opened."""
    lo = F.coalesce(F.least(start, stop), F.lit(0)).cast("long")
    hi = F.when(F.col(start).isNull() | F.col(stop).isNull(), F.lit(1 << 40)).otherwise(F.greatest(start, stop)).cast("long")
    rows = regions.withColumn("__chrom", F.col(chrom).cast("string")).withColumn("__from", lo).withColumn("__to", hi)
    rows = rows.withColumn("__level", _level(F.col("__to") - F.col("__from")))
    size = _size(F.col("__level"))
    # the coarsest level is one bin for the whole chromosome
    first = F.when(F.col("__level") == LEVELS - 1, F.lit(0).cast("long")).otherwise(F.floor(F.col("__from") / size))
    last = F.when(F.col("__level") == LEVELS - 1, F.lit(0).cast("long")).otherwise(F.floor(F.col("__to") / size))
    return rows.withColumn("__bin", F.explode(F.sequence(first, last)))


def _levels(binned: DataFrame) -> list[int]:
    """The levels that the intervals use, at most LEVELS numbers; mostly one, and then points need one bin only."""
    return sorted(r[0] for r in binned.select("__level").distinct().collect()) or [0]


def _bin_at(pos, level: int):
    return F.lit(0).cast("long") if level == LEVELS - 1 else F.floor(pos / (BIN * FACTOR**level))


def _point_bins(pos, levels=range(LEVELS)):
    return F.array(*(F.struct(F.lit(n).alias("level"), _bin_at(pos, n).alias("bin")) for n in levels))


def range_join(points: DataFrame, regions: DataFrame, chrom: str = "chrom", pos: str = "pos", r_chrom: str = "chrom", r_start: str = "start", r_stop: str = "stop") -> DataFrame:
    """Every (point, region) pair with the point inside; region columns carry the prefix r_."""
    named = regions.select(*(F.col(c).alias(f"r_{c}") for c in regions.columns))
    binned = _binned_intervals(named, f"r_{r_chrom}", f"r_{r_start}", f"r_{r_stop}")
    at = points.withColumn("__p", F.explode(_point_bins(F.col(pos).cast("long"), _levels(binned))))
    on = (
        (at[chrom].cast("string") == binned["__chrom"]) & (F.col("__p.level") == F.col("__level")) & (F.col("__p.bin") == F.col("__bin"))
        & F.col(pos).between(F.col("__from"), F.col("__to"))
    )
    return at.join(binned, on).select(*points.columns, *named.columns)


def with_prefix_maximum(rows: DataFrame, by: list[str], order: list[str], **values: str) -> DataFrame:
    """The rows with, for each name and column of `values`, the column's maximum over the rows before in order, within
    `by`; null for the first.

    Rows are dealt to ranges; each range's maxima are a row of a small table, over which they are carried on, so that no
    task holds all rows of a key.  The result is checkpointed, as its ranges must stay as they are.
    """
    ranged = rows.repartitionByRange(*by, *order).withColumn("__range", F.spark_partition_id())
    ranged = durable(ranged)
    tops = ranged.groupBy(*by, "__range").agg(*(F.max(c).alias(f"__top_{n}") for n, c in values.items()))
    earlier = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    carried = tops.select(*(F.col(c).alias(f"__by_{c}") for c in by), F.col("__range").alias("__of"), *(F.max(f"__top_{n}").over(earlier).alias(f"__carried_{n}") for n in values))
    own = Window.partitionBy(*by, "__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.withColumns({f"__own_{n}": F.max(c).over(own) for n, c in values.items()})
    same = out["__range"] == carried["__of"]
    for c in by:
        same = same & out[c].eqNullSafe(carried[f"__by_{c}"])
    both = out.join(carried, same)
    return both.select(*rows.columns, *(F.greatest(f"__own_{n}", f"__carried_{n}").alias(n) for n in values))


def merge_intervals(regions: DataFrame, pad: int = 0) -> DataFrame:
    """chrom, start, stop of the union; overlapping and touching intervals become one.  Bounds are sorted.

    An interval opens an island where it starts behind the furthest stop before it, and belongs to the last island
    opened: both are maxima over the intervals before, carried from range to range.
    """
    lo, hi = F.least("start", "stop"), F.greatest("start", "stop")
    rows = regions.select("chrom", F.greatest(lo - pad, F.lit(0)).cast("long").alias("start"), (hi + pad).cast("long").alias("stop"))
    reached = with_prefix_maximum(rows.groupBy("chrom", "start").agg(F.max("stop").alias("stop")), ["chrom"], ["start"], before="stop")
    opened = reached.withColumn("opens", F.when(F.col("before").isNull() | (F.col("start") > F.col("before")), F.col("start")))
    placed = with_prefix_maximum(opened.drop("before"), ["chrom"], ["start"], last="opens")
    return placed.groupBy("chrom", F.coalesce("opens", "last").alias("start")).agg(F.max("stop").alias("stop"))


def in_regions(rows: DataFrame, regions: DataFrame, how: str = "left_semi", chrom: str = "chrom", start: str = "pos", stop: str | None = None) -> DataFrame:
    """Rows whose position (or span start..stop) meets any region, or with left_anti none."""
    binned = _binned_intervals(regions.select("chrom", "start", "stop"), "chrom", "start", "stop")
    if stop is None:
        rest, parts = rows.withColumn("__c", F.col(chrom).cast("string")), None
        levels = _levels(binned)
        for level in levels:
            one = rest.withColumn("__b", _bin_at(F.col(start).cast("long"), level))
            r = binned.filter(F.col("__level") == level)
            on = (one["__c"] == r["__chrom"]) & (one["__b"] == r["__bin"]) & F.col(start).between(F.col("__from"), F.col("__to"))
            if how == "left_semi":
                hit = one.join(r, on, "left_semi").drop("__b")
                parts = hit if parts is None else parts.unionByName(hit)
            if how == "left_anti" or level != levels[-1]:
                rest = one.join(r, on, "left_anti").drop("__b")
        return (rest if how == "left_anti" else parts).drop("__c")
    spans = durable(rows.withColumn("__id", F.monotonically_increasing_id()))  # both sides below must see the same ids
    own = _binned_intervals(spans.select("__id", F.col(chrom).alias("c"), F.col(start).alias("a"), F.col(stop).alias("b")), "c", "a", "b")
    # spans and regions meet on the finest common level: both sides are binned on every level of the other
    s = own.select("__id", F.col("__chrom").alias("sc"), F.col("a"), F.col("b"))
    s = s.distinct().withColumn("p", F.explode(F.array_distinct(F.flatten(F.array(_point_bins(F.col("a").cast("long")), _point_bins(F.col("b").cast("long")))))))
    r = binned
    on = (F.col("sc") == r["__chrom"]) & (F.col("p.level") == r["__level"]) & (F.col("p.bin") == r["__bin"]) & (F.col("a") <= r["__to"]) & (F.col("b") >= r["__from"])
    ends = s.join(r, on).select("__id")
    # a region inside a long span: its start is a point of the span
    points = regions.select(F.col("chrom").alias("pc"), F.least("start", "stop").cast("long").alias("pp")).filter("pp is not null")
    points = points.withColumn("p", F.explode(_point_bins(F.col("pp"))))
    inner = own.join(points, (own["__chrom"] == F.col("pc").cast("string")) & (own["__level"] == F.col("p.level")) & (own["__bin"] == F.col("p.bin")) & F.col("pp").between(own["__from"], own["__to"])).select("__id")
    hits = ends.unionByName(inner).distinct()
    return spans.join(hits, "__id", how).drop("__id")


def pad_merge_intervals(regions: DataFrame, pad: int) -> DataFrame:
    return merge_intervals(regions, pad)


def split_intervals(regions: DataFrame, chunks: int, pad: int = 0) -> DataFrame:
    """interval_id, chunk: merged intervals dealt in order into `chunks` runs of equal number; every original
    interval gets the chunk of the merged one that holds it."""
    merged = merge_intervals(regions, pad)
    ranked = position_rank(merged.withColumn("pos", F.col("start")))
    per = ranked.select("chrom", "total").distinct()  # a row for each chromosome
    before = per.withColumn("before", F.coalesce(F.sum("total").over(Window.orderBy("chrom").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    before = before.withColumn("all", F.sum("total").over(Window.partitionBy())).drop("total")
    chunk = F.floor((F.col("before") + F.col("rank") - 1) / F.ceil(F.col("all") / F.lit(chunks))) + 1
    ranked = ranked.join(F.broadcast(before), "chrom").select("chrom", "start", "stop", chunk.cast("int").alias("chunk"))
    points = regions.withColumn("__at", F.least("start", "stop"))
    return range_join(points, ranked, pos="__at").select("interval_id", F.col("r_chunk").alias("chunk"))


def gene_interval_join(variants: DataFrame, genes: DataFrame) -> DataFrame:
    return range_join(variants.select("variant_id", "chrom", "pos"), genes).select("variant_id", F.col("r_gene").alias("gene"))


def nearest_gene(variants: DataFrame, genes: DataFrame) -> DataFrame:
    """Nearest gene ending before and nearest starting after each position, with distances.

    An as-of join both ways: both tables in one ordered stream per chromosome, with running last values.  The
    stream is cut into bins of positions; a bin's carry comes from the per-bin last (first) gene of the bins
    before (after), which is a window over a few rows per chromosome.
    """
    v = variants.select(F.col("chrom"), F.col("pos").cast("long").alias("at"), F.col("variant_id"), F.lit(None).cast("string").alias("gene"))

    def one_way(edge: str, forward: bool) -> DataFrame:
        g = genes.select("chrom", F.col(edge).cast("long").alias("at"), F.lit(None).cast("long").alias("variant_id"), "gene")
        rows = v.unionByName(g).withColumn("bin", F.floor(F.col("at") / BIN))
        found = F.when(F.col("gene").isNotNull(), F.struct("at", "gene"))
        carry = rows.groupBy("chrom", "bin").agg((F.max if forward else F.min)(found).alias("edge"))
        side = Window.partitionBy("chrom").orderBy(F.asc("bin") if forward else F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)
        carry = carry.select("chrom", "bin", F.last("edge", True).over(side).alias("carried"))
        # a gene at the very position counts; it is ordered first
        order = Window.partitionBy("chrom", "bin").orderBy(F.asc("at") if forward else F.desc("at"), F.col("gene").isNull(), F.asc("gene") if forward else F.desc("gene")).rowsBetween(Window.unboundedPreceding, 0)
        near = F.coalesce(F.last(found, True).over(order), F.col("carried"))
        rows = rows.join(carry, ["chrom", "bin"]).withColumn("near", near).filter("variant_id is not null")
        name = "up" if forward else "down"
        return rows.select("variant_id", F.col("near.gene").alias(f"{name}_gene"), F.abs(F.col("at") - F.col("near.at")).alias(f"{name}_distance"))

    return one_way("stop", True).join(one_way("start", False), "variant_id")


def position_rank(variants: DataFrame, *ties: str) -> DataFrame:
    """The rows with rank (from 1) by chrom and pos and `total`, the rows of the chromosome.

    Rows are ranked within bins of positions; the rows of the bins before come from per-bin counts, so no task
    sorts a whole chromosome.
    """
    rows = variants.withColumn("__bin", F.floor(F.col("pos") / BIN))
    counts = rows.groupBy("chrom", "__bin").agg(F.count("*").alias("__n"))
    order = Window.partitionBy("chrom").orderBy("__bin")
    before = counts.select(
        "chrom", "__bin", F.coalesce(F.sum("__n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"), F.sum("__n").over(Window.partitionBy("chrom")).alias("total")
    )
    own = F.row_number().over(Window.partitionBy("chrom", "__bin").orderBy("pos", *ties))
    ranked = rows.withColumn("__own", own).join(before, ["chrom", "__bin"])
    return ranked.withColumn("rank", F.col("__before") + F.col("__own")).drop("__bin", "__own", "__before")


def chunk_with_halo(variants: DataFrame, per_chunk: int, halo: int) -> DataFrame:
    """variant_id, chrom, chunk, core: chunks of about per_chunk variants of a chromosome, each with all variants
    up to `halo` positions beyond its own first and last one."""
    chunks = F.ceil(F.col("total") / per_chunk)
    ranked = position_rank(variants.select("variant_id", "chrom", "pos"), "variant_id")
    rows = ranked.select("variant_id", "chrom", "pos", F.floor((F.col("rank") - 1) * chunks / F.col("total")).cast("int").alias("chunk"))
    bounds = rows.groupBy("chrom", "chunk").agg((F.min("pos") - halo).alias("start"), (F.max("pos") + halo).alias("stop"))
    joined = range_join(rows, bounds)
    return joined.select("variant_id", "chrom", F.col("r_chunk").alias("chunk"), (F.col("chunk") == F.col("r_chunk")).alias("core"))


def balanced_breaks(variants: DataFrame, chunks: int) -> DataFrame:
    """chrom, chunk, start, stop of chunks with equal marker counts; borders lie midway between neighbours."""
    rows = position_rank(variants.select("chrom", "pos")).withColumn("chunk", F.floor((F.col("rank") - 1) * chunks / F.col("total")).cast("int"))
    edges = rows.groupBy("chrom", "chunk").agg(F.min("pos").alias("first"), F.max("pos").alias("last"))
    order = Window.partitionBy("chrom").orderBy("chunk")
    middle = F.floor((F.lag("last").over(order) + F.col("first")) / 2)
    after = F.floor((F.col("last") + F.lead("first").over(order)) / 2)
    return edges.select("chrom", "chunk", F.coalesce(middle + 1, F.col("first")).alias("start"), F.coalesce(after, F.col("last")).alias("stop"))
