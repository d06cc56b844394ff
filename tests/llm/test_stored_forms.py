"""Stored media against plain readings, carved bytes, and a ledger kept in a folder."""

import hashlib
import io
import wave
import zlib

from pyspark.sql import functions as F

from varloom.llm import media, secrets

TEXTS = [(1, ""), (2, None), (3, "a" * 64), (4, "a" * 65), (5, "é漢 BM RIFF \U0001f600" * 40), (6, "x" * 200_000), (6, "again"), (None, "no key")]


def test_stored_form_and_feature(spark):
    docs = spark.createDataFrame([(k, t, "other", 7) for k, t in TEXTS], "doc_id long, text string, declared string, media int")
    rows = media.inspect(media.store(docs)).collect()
    got = sorted((str(r.doc_id), r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.media_bytes, r.media_sha256, r.feature) for r in rows)
    want = []
    for key, text in TEXTS:
        raw = (text or "").encode()
        payload = raw + bytes(-len(raw) % 64 if raw else 64)
        out = io.BytesIO()
        with wave.open(out, "wb") as w:
            w.setnchannels(1), w.setsampwidth(1), w.setframerate(8000), w.writeframes(payload)
        stored = out.getvalue()
        high = [b >= 128 for b in payload]
        crossings = sum(a != b for a, b in zip(high, high[1:]))
        feature = f"audio/wav|{len(payload)}|{sum(payload) * 1000 // len(payload)}|{crossings}|"
        digest = hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(stored), hashlib.sha256(stored).hexdigest()
        want.append((str(key), len(raw), len(payload), *digest, feature))
    assert got == sorted(want)
    assert {r.media_type for r in rows} == {"audio/wav"} and all(r.corrected for r in rows)


def test_carved_bytes(spark):
    gif = b"GIF89a\x01\x00\x01\x00\x00\x00\x00\x2c\x00\x00\x00\x00\x01\x00\x01\x00\x00\x02\x02D\x01\x00\x3b"
    sound = media.wave(b"\x80" * 64)
    blobs = [(1, b"text " + gif + b" BM " + sound + b" RIFF"), (1, sound), (2, b""), (None, b"\x00" + sound), (3, None), (4, sound + gif)]
    made = media.carve(spark.createDataFrame([(k, b, "x") for k, b in blobs], "doc_id long, media binary, offset string"))
    got = sorted((str(r.doc_id), r.ordinal, r.media_type, r.offset, r.length, bytes(r.media)) for r in made.collect())
    assert got == sorted(
        [
            ("1", 0, "image/gif", 5, len(gif), gif),
            ("1", 1, "audio/wav", 5 + len(gif) + 4, len(sound), sound),
            ("None", 0, "audio/wav", 1, len(sound), sound),
            ("4", 0, "image/gif", len(sound), len(gif), gif),
        ]
    )
    assert media.carve(made.limit(0)).count() == 0


def test_ledger_in_a_folder(spark, tmp_path):
    folder = str(tmp_path / "ledger")
    key = "password = hunter2hunter2"
    first = spark.createDataFrame([(1, key, "a"), (2, "clean", "b"), (3, None, "c")], "doc_id long, text string, spans string")
    more = first.unionByName(spark.createDataFrame([(4, key, "d"), (5, "AKIA" + "Q" * 16, "e"), (None, key, "f")], first.schema))
    for docs, contents in ((first, 3), (more, 4), (more, 4)):
        got = secrets.scan_with_folder(docs, folder)
        want = secrets.scan_paths(docs)
        plain = lambda df: sorted((str(r.doc_id), str(r.text), str(r.spans)) for r in df.collect())
        assert plain(got) == plain(want)
        ledger = spark.read.parquet(folder)
        assert ledger.count() == contents * len(secrets.RULES) and ledger.select("blob").distinct().count() == contents
    assert secrets.scan_with_folder(more.filter(F.lit(False)), folder).count() == 0
