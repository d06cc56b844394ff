"""Byte-level BPE against the library of the vocabulary's format, and the rank queue by itself."""

import hashlib
import random
import struct
from collections import Counter

import public_tokenizers
import pytest
import tiktoken

from varloom.llm import bpe, queries

SF = "/root/testdata/sf0.001"
ALPHABET = ["a", "aa", "ab", "é", "の", "😀", " ", "\n", "1", "''", "'s", "\x1c", "İ", "ا", "-", "=", "==", "\x85", "\x00", "<|endoftext|>", "\U0001b127", "\U000323e7"]


@pytest.fixture(scope="module")
def known():
    return bpe.Encoder(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def library(known):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known.ranks, special_tokens={})


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def test_random_and_long_texts(known, library):
    rnd = random.Random(7)
    texts = ["".join(rnd.choices(ALPHABET[: rnd.randint(1, len(ALPHABET))], k=rnd.randint(0, 300))) for _ in range(500)]
    texts += ["", " ", "a" * 100_000, "ab" * 50_000, "=-" * 3000, "x" * 99_999 + "é", "".join(rnd.choices("abcde", k=100_000)), "z" * 70 + " " + "z" * 70]
    assert known.block(texts) == [packed(library.encode_ordinary(t)) for t in texts]
    assert known.block(texts) == [packed(library.encode_ordinary(t)) for t in texts]  # now from the dictionary


def test_a_lower_rank_that_opens_amid_a_bucket():
    """Ranks that no training gives: a merge opens one of lower rank beside it, which goes before the bucket's rest."""
    ranks = {bytes([b]): b + 10 for b in range(256)} | {b"ab": 9, b"abc": 5, b"abca": 4, b"bca": 8}
    own = bpe.Encoder.__new__(bpe.Encoder)
    own.ranks, own.longest, own.queue = ranks, 4, bpe.RankQueue(300)
    own.single = bpe.np.array([ranks[bytes([b])] for b in range(256)])
    own.double = bpe.np.array([ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)])

    def plain(piece):
        parts = [bytes([b]) for b in piece]
        while True:
            open_ = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not open_:
                return packed([ranks[p] for p in parts])
            i = min(open_)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    pieces = [b"abcabc", b"abcab", b"ababcabcaab", b"bcabca", b"a", b"abab"]
    assert own.merged(pieces) == [plain(p) for p in pieces]


def test_queue_gives_ranks_in_order():
    queue, rnd = bpe.RankQueue(70_000), random.Random(3)
    ranks = rnd.sample(range(70_000), 2000)
    for r in ranks:
        queue.open(r, [r])
    got = []
    while (r := queue.first()) >= 0:
        got += queue.close(r)
    assert got == sorted(ranks)


def test_round_trip(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(None, "a\x1cb"), (5, None), (5, None), (6, ""), (7, "é" * 3000), (7, "日本語 <|endoftext|>")], docs.schema)
    docs = docs.unionByName(odd).selectExpr("*", "'x' as ids", "1 as decoded", "2 as n_tokens", "3 as c0")
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    want = Counter()
    for i, text in rows:
        ids = library.encode_ordinary(text)
        want[(i, len(ids), hashlib.sha256(packed(ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest())] += 1
    assert Counter(map(tuple, bpe.round_trip(docs).collect())) == want
    assert bpe.round_trip(docs.limit(0)).count() == 0


def test_decode_nulls(spark):
    rows = spark.createDataFrame([(1, None), (2, b""), (3, packed([0, 1]))], "made long, ids binary")
    got = {r.made: r.decoded for r in bpe.decode(rows).collect()}
    assert got[1] is None and got[2] == b"" and len(got[3]) == 2


def test_query(spark):
    assert queries.queries()["op11_byte_bpe"](spark, SF).count() == 200
