"""Media columns by signature sniffing.

Aho-Corasick finds magic bytes anywhere in a stored blob; a validator for each format confirms its structure and
lengths.  What is confirmed at the start corrects the declared type; what is confirmed further on is embedded
media and is carved out by offset and length.  Payloads are stored as 8-bit mono samples in a RIFF/WAVE container.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.llm.common import ARROW, map_texts

RATE = 8000
UNIT = 64
#: Blobs looked at together; bounds memory.
AT_ONCE = 256


def wave(payload: bytes) -> bytes:
    """An 8-bit mono PCM container; its lengths are 32-bit, so payloads stay under 4 GB."""
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(payload), b"WAVE", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8, b"data", len(payload))
    return head + payload


# ---- validators: length of the confirmed object at an offset, 0 if it isn't one


def wave_length(b: bytes, at: int) -> int:
    if b[at + 8 : at + 12] != b"WAVE" or len(b) < at + 44:
        return 0
    total = 8 + int.from_bytes(b[at + 4 : at + 8], "little")
    if at + total > len(b):
        return 0
    pos, kinds = at + 12, set()
    while pos + 8 <= at + total:
        size = int.from_bytes(b[pos + 4 : pos + 8], "little")
        if pos + 8 + size > at + total:
            return 0
        kinds.add(b[pos : pos + 4])
        pos += 8 + size + (size & 1)
    return total if {b"fmt ", b"data"} <= kinds else 0


def png_length(b: bytes, at: int) -> int:
    pos, first = at + 8, True
    while pos + 12 <= len(b):
        size, kind = int.from_bytes(b[pos : pos + 4], "big"), b[pos + 4 : pos + 8]
        end = pos + 12 + size
        if end > len(b) or (first and kind != b"IHDR"):
            return 0
        if zlib.crc32(b[pos + 4 : end - 4]) != int.from_bytes(b[end - 4 : end], "big"):
            return 0
        if kind == b"IEND":
            return end - at
        pos, first = end, False
    return 0


def gif_length(b: bytes, at: int) -> int:
    if len(b) < at + 14:
        return 0
    flags = b[at + 10]
    pos = at + 13 + (3 << ((flags & 7) + 1) if flags & 128 else 0)
    while pos < len(b):
        if b[pos] == 0x3B:
            return pos + 1 - at
        if b[pos] == 0x21:
            pos += 2
        elif b[pos] == 0x2C and pos + 10 <= len(b):
            local = b[pos + 9]
            pos += 11 + (3 << ((local & 7) + 1) if local & 128 else 0)
        else:
            return 0
        while pos < len(b) and b[pos]:
            pos += 1 + b[pos]
        pos += 1
    return 0


def jpeg_length(b: bytes, at: int) -> int:
    pos = at + 2
    while pos + 4 <= len(b) and b[pos] == 0xFF:
        marker, size = b[pos + 1], int.from_bytes(b[pos + 2 : pos + 4], "big")
        if size < 2 or pos + 2 + size > len(b):
            return 0
        pos += 2 + size
        if marker == 0xDA:
            end = b.find(b"\xff\xd9", pos)
            return end + 2 - at if end >= 0 else 0
    return 0


def bmp_length(b: bytes, at: int) -> int:
    if len(b) < at + 54:
        return 0
    total, zero, offset, head = struct.unpack_from("<IIII", b, at + 2)
    return total if zero == 0 and head in (12, 40, 108, 124) and 26 <= offset <= total and at + total <= len(b) else 0


# Magic bytes, media type and validator.
FORMATS = {
    b"RIFF": ("audio/wav", wave_length),
    b"\x89PNG\r\n\x1a\n": ("image/png", png_length),
    b"GIF87a": ("image/gif", gif_length),
    b"GIF89a": ("image/gif", gif_length),
    b"\xff\xd8\xff": ("image/jpeg", jpeg_length),
    b"BM": ("image/bmp", bmp_length),
}


CARVED = {"ordinal": "long", "media_type": "string", "offset": "long", "length": "long", "media": "binary"}


@cache
def magic() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for signature in FORMATS:
        found.add_word(signature.decode("latin-1"), signature)
    found.make_automaton()
    return found


def sniff(stored: bytes) -> list[tuple[str, int, int]]:
    """(type, offset, length) of all confirmed media: the object at the start, if any, and those carved behind it.

    An object inside another one that was found behind the start is not listed again.
    """
    out, covered = [], 0
    for end, signature in magic().iter(stored.decode("latin-1")):
        at = end + 1 - len(signature)
        if at and at < covered:
            continue
        kind, length = FORMATS[signature]
        size = length(stored, at)
        if size:
            out.append((kind, at, size))
            if at:
                covered = at + size
    return out


def read_payload(stored: bytes, kind: str) -> bytes:
    """The samples of a stored object of a sniffed type (all bytes of an unknown one)."""
    if kind != "audio/wav":
        return stored
    pos = 12
    while stored[pos : pos + 4] != b"data":
        size = int.from_bytes(stored[pos + 4 : pos + 8], "little")
        pos += 8 + size + (size & 1)
    return stored[pos + 8 : pos + 8 + int.from_bytes(stored[pos + 4 : pos + 8], "little")]


def feature_of(kind: str, payload: bytes, embedded: list[tuple[str, int, int]]) -> str:
    """Type, samples, mean level, crossings of the middle level and embedded media."""
    x = np.frombuffer(payload, dtype=np.uint8)
    crossings = int(np.count_nonzero(np.diff(x >= 128)))
    carved = ";".join(f"{k}@{at}+{n}" for k, at, n in embedded)
    return f"{kind}|{len(x)}|{int(x.sum(dtype=np.int64)) * 1000 // max(1, len(x))}|{crossings}|{carved}"


def store(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_bytes, declared, media: every whole text, padded with zero bytes to a positive multiple of 64.

    Null texts count as empty; rows with null or repeated keys stay, and an empty table gives an empty result.
    """

    def block(texts: list[str]):
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        padded = [r + bytes(max(UNIT, -(-len(r) // UNIT) * UNIT) - len(r)) for r in raw]
        return None, [[len(r) for r in raw], ["text/plain"] * len(raw), [wave(p) for p in padded]]

    return map_texts(docs, (key,), text, {"n_bytes": "long", "declared": "string", "media": "binary"}, lambda: block)


def inspect(media: DataFrame, key: str = "doc_id", declared: str = "declared", blob: str = "media") -> DataFrame:
    """key, media_type, corrected, payload digests, media digests and feature of stored blobs.

    A blob whose start is no confirmed format keeps its declared type.  Null blobs count as empty.  Other
    columns are ignored; rows with null or repeated keys stay; an empty table gives an empty result.
    """

    def look(told: str, stored: bytes) -> tuple:
        found = sniff(stored)
        whole = next((x for x in found if x[1] == 0), None)
        kind = whole[0] if whole else told
        payload = read_payload(stored, kind) if whole else stored
        return (
            kind, kind != told, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(stored),
            hashlib.sha256(stored).hexdigest(), feature_of(kind, payload, [x for x in found if x[1]]),
        )

    made = {"media_type": "string", "corrected": "boolean", "payload_bytes": "long", "payload_sha256": "string", "tail_crc32": "long", "media_bytes": "long", "media_sha256": "string", "feature": "string"}

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for at in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(at, AT_ONCE)
                values = list(zip(*(look(told.as_py(), stored.as_py()) for told, stored in zip(part.column(2), part.column(3)))))
                arrays = [pa.array(v, ARROW[k]) for v, k in zip(values, made.values())]
                yield pa.RecordBatch.from_arrays([*part.columns[:2], *arrays], names=["key", "n", *made])

    kind = media.schema[key].dataType.simpleString()
    n = F.col("n_bytes") if "n_bytes" in media.columns else F.octet_length(blob).cast("long")
    rows = media.select(F.col(key).alias("key"), n.alias("n"), F.coalesce(F.col(declared), F.lit("")).alias("declared"), F.coalesce(F.col(blob), F.lit(b"")).alias("media"))
    schema = ", ".join([f"key {kind}", "n long", *(f"{n} {k}" for n, k in made.items())])
    return rows.mapInArrow(batches, schema).withColumnsRenamed({"key": key, "n": "n_bytes"})


def carve(media: DataFrame, key: str = "doc_id", blob: str = "media") -> DataFrame:
    """key, ordinal (from 0), media_type, offset, length, media: the bytes of each object embedded behind a blob's start.

    Null and empty blobs give no rows; blobs that repeat a key, or have none, each give their own.  Objects inside an
    embedded one come out by carving the result again.
    """
    kind = media.schema[key].dataType

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for at in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(at, AT_ONCE)
                source, rows = [], []
                for i, stored in enumerate(part.column(1)):
                    b = stored.as_py()
                    inside = [x for x in sniff(b) if x[1]]
                    source += [i] * len(inside)
                    rows += [(n, k, start, size, b[start : start + size]) for n, (k, start, size) in enumerate(inside)]
                keys = part.column(0).take(pa.array(source, pa.int64()))
                values = list(zip(*rows)) or [()] * len(CARVED)
                arrays = [pa.array(v, ARROW[t]) for v, t in zip(values, CARVED.values())]
                yield pa.RecordBatch.from_arrays([keys, *arrays], names=["key", *CARVED])

    rows = media.filter(F.col(blob).isNotNull()).select(F.col(key).alias("key"), F.col(blob).alias("media"))
    schema = ", ".join([f"key {kind.simpleString()}", *(f"{n} {t}" for n, t in CARVED.items())])
    return rows.mapInArrow(batches, schema).withColumnRenamed("key", key)
