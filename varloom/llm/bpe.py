"""Byte-level BPE: whole texts to ids, and ids back to bytes.

Texts are cut by the vocabulary's pattern.  The distinct pre-tokens of a block of texts that the task has not met
lately are laid into one linked list, with breaks between them, and merged by a rank queue: one bucket for every merge
rank holds the places where that merge is open, and a bitmap of several levels says which buckets hold any, so that
the next rank is a find-first-set on each level.  A place whose pair has changed since it was put there is stale and
skipped.  A pre-token of n bytes makes fewer than 3 n entries, so one that is very long (a text without a break) costs
no more a byte than a short one.
"""

from __future__ import annotations

import base64
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.llm.common import map_texts
from varloom.llm.tokens import Recent

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Pre-tokens that a worker remembers (twice as many at most), and the longest of them in characters; bounds its memory.
DICTIONARY_ENTRIES, LONGEST_KEPT = 180_000, 48

# The pattern for texts of Latin-1 characters alone, for which the standard library's engine is three times as fast.
_LETTER, _DIGIT, _SPACE = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
LATIN_1 = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_DIGIT}]+| ?[^{_SPACE}{_LETTER}{_DIGIT}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
#: Blocks with letters and digits that came with Unicode 16, which the vocabulary's own library follows.
UNICODE_16 = """1c89-1c8a a7cb-a7cd a7da-a7dc 105c0-105f3 10d40-10d8f 10ec2-10ec4 11380-113e2 116d0-116e3 11bc0-11bf9
13460-143fa 16100-16139 16d40-16d79 18cff-18cff 1ccf0-1ccf9 1e5d0-1e5ff"""


def split_pattern(pattern: str) -> regex.Pattern:
    """The pattern, with letters and digits of Unicode 16: those that only the regex library knows count as neither."""
    known = [tuple(int(x, 16) for x in span.split("-")) for span in UNICODE_16.split()]
    of = regex.compile(r"[\p{L}\p{N}]").match
    later = [c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) == "Cn" and of(c) and not any(a <= ord(c) <= b for a, b in known)]
    if not later:
        return regex.compile(pattern)
    firsts = [c for i, c in enumerate(later) if not i or ord(c) != ord(later[i - 1]) + 1]
    lasts = [c for i, c in enumerate(later) if i + 1 == len(later) or ord(c) != ord(later[i + 1]) - 1]
    none = f"[{''.join(f'{a}-{b}' for a, b in zip(firsts, lasts))}]"
    pattern = pattern.replace(r"[^\s\p{L}\p{N}]", f"[[^\\s\\p{{L}}\\p{{N}}]||{none}]").replace(r"\p{L}+", f"[\\p{{L}}--{none}]+").replace(r"\p{N}+", f"[\\p{{N}}--{none}]+")
    return regex.compile(pattern, regex.V1)


class RankQueue:
    """Open merges by rank: buckets of places, and a bitmap of the buckets that hold any.

    The lowest level has a bit for every rank, each further level a bit for every word of the one below, up to one word.
    """

    SHIFT = 8
    WORD = 1 << SHIFT

    def __init__(self, ranks: int):
        self.buckets: dict[int, list[int]] = {}
        self.levels = []
        while not self.levels or ranks > 1:
            ranks = -(-ranks // self.WORD)
            self.levels.append([0] * ranks)

    def open(self, rank: int, places: list[int]) -> None:
        """A bucket for a rank that has none."""
        self.buckets[rank] = places
        at = rank
        for words in self.levels:
            word = at >> self.SHIFT
            before = words[word]
            words[word] = before | 1 << (at & self.WORD - 1)
            if before:
                break
            at = word

    def first(self) -> int:
        """The lowest rank with a bucket, or -1."""
        if not self.levels[-1][0]:
            return -1
        at = 0
        for words in reversed(self.levels):
            word = words[at]
            at = at << self.SHIFT | (word & -word).bit_length() - 1
        return at

    def close(self, rank: int) -> list[int]:
        """Takes a rank's whole bucket out."""
        at = rank
        for words in self.levels:
            word = at >> self.SHIFT
            words[word] &= ~(1 << (at & self.WORD - 1))
            if words[word]:
                break
            at = word
        return self.buckets.pop(rank)


class Encoder:
    """The vocabulary's ranks, a queue for them and the pre-tokens met lately."""

    def __init__(self, vocabulary: str):
        with open(public_tokenizers.path(vocabulary), "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.longest = max(map(len, self.ranks))
        self.queue = RankQueue(max(self.ranks.values()) + 1)
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)])
        self.double = np.array([self.ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)])
        self.known = Recent(DICTIONARY_ENTRIES)

    @cached_property
    def general(self) -> regex.Pattern:
        return split_pattern(public_tokenizers.PATTERN)

    def split(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.general.findall(text)
        return LATIN_1.findall(text)

    def merged(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pre-tokens (little-endian, 32 bits): the lowest rank merges first, of equal ones the leftmost.

        A break, a byte of its own, stands before each pre-token and after the last.
        """
        ranks, queue, longest = self.ranks, self.queue, self.longest
        buckets, known = queue.buckets.get, ranks.get
        data = b"\0" + b"\0".join(pieces) + b"\0"
        n = len(data)
        breaks = np.concatenate([[0], np.cumsum([len(p) + 1 for p in pieces])])
        codes = np.frombuffer(data, np.uint8).astype(np.int64)
        pairs = np.append(self.double[codes[:-1] * 256 + codes[1:]], -1)
        pairs[breaks] = pairs[breaks[1:] - 1] = -1
        open_ = np.flatnonzero(pairs >= 0)
        open_ = open_[np.argsort(pairs[open_], kind="stable")]
        found, starts = np.unique(pairs[open_], return_index=True)
        for rank, places in zip(found.tolist(), np.split(open_, starts[1:])):
            queue.open(rank, places.tolist())
        ids = self.single[codes]
        ids[breaks] = -1
        ids, pair = ids.tolist(), pairs.tolist()  # id of the token that starts at a place (-1: none), rank of its merge with the next
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        broken = bytearray(n)
        for b in breaks.tolist():
            broken[b] = 1
        while (rank := queue.first()) >= 0:
            places = queue.close(rank)
            places.sort()
            for k, at in enumerate(places):
                if pair[at] != rank:
                    continue
                lowest = rank
                gone = after[at]
                end = after[at] = after[gone]
                before[end] = at
                ids[at], ids[gone] = rank, -1
                pair[gone] = pair[at] = -1
                if not broken[end] and (stop := after[end]) - at <= longest and (new := known(data[at:stop])) is not None:
                    pair[at] = new
                    if (bucket := buckets(new)) is not None:
                        bucket.append(at)
                    else:
                        queue.open(new, [at])
                    if new < lowest:
                        lowest = new
                left = before[at]
                if not broken[left]:
                    pair[left] = -1
                    if end - left <= longest and (new := known(data[left:end])) is not None:
                        pair[left] = new
                        if (bucket := buckets(new)) is not None:
                            bucket.append(left)
                        else:
                            queue.open(new, [left])
                        if new < lowest:
                            lowest = new
                if lowest < rank:  # a merge that comes before the rest of this bucket has opened
                    if k + 1 < len(places):
                        queue.open(rank, places[k + 1 :])
                    break
        ids = np.array(ids)
        kept = ids >= 0
        at = 4 * np.cumsum(kept)[breaks]
        out = ids[kept].astype("<u4").tobytes()
        return [out[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]

    def block(self, texts: list[str]) -> list[bytes]:
        """Ids of texts, as little-endian unsigned 32-bit integers."""
        cut = [self.split(text) for text in texts]
        known, own, new = self.known, {}, []
        young = known.young.get
        for token in set(chain.from_iterable(cut)):
            ids = young(token) or known.get(token)
            if ids is None:
                whole = self.ranks.get(token.encode())
                if whole is None:
                    new.append(token)
                    continue
                ids = whole.to_bytes(4, "little")
                known.put(token, ids)
            own[token] = ids
        if new:
            for token, ids in zip(new, self.merged([token.encode() for token in new])):
                own[token] = ids
                if len(token) <= LONGEST_KEPT:
                    known.put(token, ids)
        return [b"".join(map(own.__getitem__, tokens)) for tokens in cut]


_ENCODERS: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    """The Python worker's encoder; tasks that follow in the same worker go on using it."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = Encoder(vocabulary)
    return _ENCODERS[vocabulary]


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """keep, ids: every row's ids, as little-endian unsigned 32-bit integers in one binary value.

    Null texts count as empty and have no ids (an empty value); null and repeated keys keep a row each; columns that
    are not in `keep` are ignored, whatever their names; an empty table gives an empty result.  Strings that name
    special tokens are ordinary text.
    """

    def work():
        known = encoder(vocabulary)
        return lambda texts: (None, [known.block(texts)])

    return map_texts(docs, keep, text, {"ids": "binary"}, work)


def decode(rows: DataFrame, vocabulary: str = VOCABULARY, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """The rows with the bytes of their ids, as UTF-8 if the ids are of a whole text.

    Null ids give null, no ids an empty value; an id that the vocabulary lacks fails the job.
    """
    place = rows.columns.index(ids)
    path = public_tokenizers.path(vocabulary)

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with open(path, "rb") as lines:
            tokens = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
        for batch in stream:
            made = [None if v is None else b"".join(map(tokens.__getitem__, np.frombuffer(v, "<u4").tolist())) for v in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], names=[*names, "made"])

    names = [f"c{i}" for i in range(len(rows.columns))]  # names of our own inside, as columns may share theirs
    own = rows.toDF(*names)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in own.schema)
    return own.mapInArrow(batches, f"{fields}, made binary").toDF(*rows.columns, into)


def round_trip(docs: DataFrame, vocabulary: str = VOCABULARY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256 of every row: its text encoded, and the ids decoded again."""
    coded = encode(docs, vocabulary, (key,), text)
    coded = coded.select(key, "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"))
    return decode(coded, vocabulary).select(key, "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
