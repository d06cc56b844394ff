"""Packed genotype files (.bed, marker by marker) as a Spark data source that reads them in byte ranges."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from varloom.shipping import ship

# The first bytes of a marker-by-marker file, and the dosage of each two-bit code (-1: missing).
MAGIC = b"\x6c\x1b\x01"
DOSAGE = np.array([0, -1, 1, 2], dtype=np.int32)
#: Genotypes that a task decodes at once.
CELLS = 4_000_000


@dataclass
class Records(InputPartition):
    path: str
    start: int
    stop: int


def _files(path: str) -> tuple[fs.FileSystem, list[fs.FileInfo]]:
    """The file itself, or the .bed files of a folder by name."""
    system, inner = fs.FileSystem.from_uri(path)
    info = system.get_file_info(inner)
    if info.type != fs.FileType.Directory:
        return system, [info]
    return system, sorted((x for x in system.get_file_info(fs.FileSelector(inner)) if x.path.endswith(".bed")), key=lambda x: x.path)


class PackedReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.samples = options["path"], int(options["samples"])
        self.width = -(-self.samples // 4)
        self.split = int(options.get("split_bytes", 64 << 20))
        self.first, self.last = int(options.get("first", 0)), int(options.get("last", 1 << 62))

    def partitions(self) -> list[Records]:
        """Ranges of whole records of at most split_bytes; a file whose size does not fit the samples is an error."""
        out: list[Records] = []
        step = max(1, self.split // max(1, self.width))
        for info in _files(self.path)[1]:
            body = info.size - len(MAGIC)
            if body < 0 or not self.width or body % self.width:
                raise ValueError(f"{info.path}: {info.size} bytes do not hold records of {self.samples} samples")
            stop = min(self.last + 1, body // self.width)
            out += [Records(info.path, at, min(at + step, stop)) for at in range(max(0, self.first), stop, step)]
        return out

    def read(self, part: Records | None):
        if part is None:  # no range at all
            return
        system, _ = fs.FileSystem.from_uri(self.path)
        block = max(1, CELLS // self.samples)
        name = part.path.rsplit("/", 1)[-1]
        with system.open_input_file(part.path) as file:
            if file.read_at(len(MAGIC), 0) != MAGIC:
                raise ValueError(f"{part.path} is no marker-by-marker .bed file")
            for at in range(part.start, part.stop, block):
                count = min(block, part.stop - at)
                raw = np.frombuffer(file.read_at(count * self.width, len(MAGIC) + at * self.width), np.uint8).reshape(count, self.width)
                codes = (raw[:, :, None] >> np.array([0, 2, 4, 6], np.uint8)) & 3
                dosage = DOSAGE[codes.reshape(count, -1)[:, : self.samples]].ravel()
                ends = np.arange(count + 1, dtype=np.int32) * self.samples
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(dosage, mask=dosage < 0))
                yield pa.RecordBatch.from_arrays([pa.array([name] * count), pa.array(np.arange(at, at + count)), lists], names=["file", "record", "dosages"])


class PackedBed(DataSource):
    """file, record, dosages of one .bed file or of a folder of them.

    Options: samples (how many each record holds), first and last (records wanted of each file: others are never
    read), split_bytes.
    """

    @classmethod
    def name(cls) -> str:
        return "packed_bed"

    def schema(self) -> str:
        return "file string, record long, dosages array<int>"

    def reader(self, schema) -> PackedReader:
        return PackedReader(self.options)


def scan_bed(spark: SparkSession, path: str, samples: int, first: int = 0, last: int | None = None, split_bytes: int = 64 << 20) -> DataFrame:
    """file (its base name), record (from 0 in each file) and dosages (an array in sample order, null for missing).

    Records hold four samples a byte, from the low end: 00 is 0, 10 is 1, 11 is 2 and 01 missing.  Tasks read ranges of
    records through the file's own file system, so one large file is read by many; only records first to last are
    touched.  Files without records give no rows; a wrong header or size fails.
    """
    ship(spark)
    spark.dataSource.register(PackedBed)
    reader = spark.read.format("packed_bed").option("samples", samples).option("first", first).option("split_bytes", split_bytes)
    return (reader if last is None else reader.option("last", last)).load(path)
