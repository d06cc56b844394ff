"""Best-fit-decreasing packing of token pieces into fixed sequences.

Pieces are cut and measured in Spark.  Best fit decreasing depends on the lengths alone, and equal lengths are
interchangeable, so the plan is made on the histogram of lengths (at most `capacity` rows, whatever the corpus):
lengths go downwards, and a segment tree over the remaining capacities finds the tightest open bins that still
take the length, in logarithmic time; all bins of that capacity are filled together.  The plan's ranges are
then read by every piece through its rank among the pieces of its length.  The result is exactly that of
best fit decreasing over all pieces of the corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from varloom.llm.common import durable, map_texts
from varloom.llm.tokens import dictionary

#: A length's pieces are ranked in this many parts, so that one common length does not meet in one task.
SALTS = 64


class CapacityTree:
    """Segment tree over capacities 0..capacity: which of them have open bins."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = np.zeros(2 * self.size, dtype=bool)

    def set(self, at: int, value: bool) -> None:
        at += self.size
        self.open[at] = value
        while at > 1:
            at //= 2
            self.open[at] = self.open[2 * at] or self.open[2 * at + 1]

    def tightest(self, least: int) -> int:
        """The smallest capacity >= least with an open bin, or -1."""
        at = least + self.size
        if self.open[at]:
            return least
        while at > 1:
            if at % 2 == 0 and self.open[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.size
            at //= 2
        return -1


@dataclass
class Plan:
    """Ranges of ranks, sorted by (length, first): rank r goes to bin + (r - first) // per at offset + length * ((r - first) % per)."""

    length: np.ndarray
    first: np.ndarray
    per: np.ndarray
    bin: np.ndarray
    offset: np.ndarray
    bins: int


def best_fit_decreasing(histogram: np.ndarray, capacity: int) -> Plan:
    """The plan for histogram[length] pieces of each length up to capacity."""
    tree = CapacityTree(capacity)
    open_: dict[int, list[tuple[int, int]]] = {}  # capacity left -> ranges of bins (start, number)
    ranges, bins = [], 0

    def put(left: int, start: int, number: int) -> None:
        if number and left:
            open_.setdefault(left, []).append((start, number))
            tree.set(left, True)

    for length in range(capacity, 0, -1):
        rest, rank = int(histogram[length]), 0
        while rest:
            left = tree.tightest(length)
            if left < 0:  # new bins, as many as the rest needs
                per = capacity // length
                left, start, number = capacity, bins, -(-rest // per)
                bins += number
            else:
                start, number = open_[left].pop()
                if not open_[left]:
                    tree.set(left, False)
                per = left // length
            full, some = min(number, rest // per), 0
            if full < number and rest - full * per:
                some = rest - full * per
            ranges.append((length, rank, per, start, capacity - left))
            put(left - per * length, start, full)
            if some:
                put(left - some * length, start + full, 1)
            put(left, start + full + bool(some), number - full - bool(some))
            rank += full * per + some
            rest -= full * per + some
    columns = np.array(sorted(ranges), dtype=np.int64).reshape(-1, 5).T
    return Plan(*columns, bins=bins)


def place(plan: Plan, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of pieces by length and rank."""
    shift = 1 << 44
    at = np.searchsorted(plan.length * shift + plan.first, length * shift + rank, side="right") - 1
    within = rank - plan.first[at]
    return plan.bin[at] + within // plan.per[at], plan.offset[at] + length * (within % plan.per[at])


def pieces(docs: DataFrame, capacity: int, vocabulary: str, end_id: int, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """keep, piece, start, length, ids_crc32: every document's ids and the end id, cut only where longer."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def work():
        known = dictionary(vocabulary, ids=True)

        def block(texts: list[str]):
            rows = []
            for i, text in enumerate(texts):
                data = known.concatenated(text) + end
                for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    rows.append((i, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            index, *values = zip(*rows)
            return np.array(index), values

        return block

    made = {"piece": "int", "start": "long", "length": "long", "ids_crc32": "long"}
    return map_texts(docs, keep, text, made, work)


def pack(
    docs: DataFrame, capacity: int = 4096, vocabulary: str = "word_bpe_49k.json", end_id: int = 1, keep: tuple[str, ...] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """keep, piece, start, length, ids_crc32, sequence_id, offset for every piece of every document.

    Null texts count as empty and still hold the end id; null and repeated keys keep their rows; ties between
    pieces of equal length are broken by the hash of their row; an empty table gives no piece.  Columns of docs
    that are not in `keep` are ignored.
    """
    cut = pieces(docs, capacity, vocabulary, end_id, keep, text)
    salt = F.pmod(F.xxhash64(*keep, "piece", "ids_crc32"), F.lit(SALTS)).cast("int")
    cut = durable(cut.withColumn("salt", salt))
    counts = cut.groupBy("length", "salt").count().toPandas()  # at most capacity x SALTS rows
    number = np.zeros((capacity + 1, SALTS), dtype=np.int64)
    number[counts["length"].to_numpy(np.int64), counts["salt"].to_numpy(np.int64)] = counts["count"]
    before = np.cumsum(number, axis=1) - number
    plan = best_fit_decreasing(number.sum(axis=1), capacity)
    shared = docs.sparkSession.sparkContext.broadcast((plan, before))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, ahead = shared.value
        for batch in batches:
            length, salts, ranks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "salt", "rank"))
            bins, offset = place(own, length, ranks - 1 + ahead[length, salts])
            made = [pa.array(bins, pa.int64()), pa.array(offset, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *made], names=[*batch.schema.names[:-2], "sequence_id", "offset"])

    order = Window.partitionBy("length", "salt").orderBy(*keep, "piece", "ids_crc32")
    ranked = cut.withColumn("rank", F.row_number().over(order))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.drop("salt").schema)
    return ranked.mapInArrow(placed, f"{schema}, sequence_id long, offset long")
