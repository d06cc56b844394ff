"""Token counts: each distinct pre-token is cut into pieces once, and documents add up frequencies.

A document becomes a table of (run, frequency), runs being bounded by ASCII white space.  Runs that the task has
not met before are split into the tokenizer's pre-tokens, and pre-tokens not met before are cut into pieces; the
piece counts are then joined to the frequencies and summed, so no document's ids exist.

The tokenizer drops white space and never joins pieces across it, and its normaliser works within a run (NFC,
single-character lower case), so counts of the runs add up to the count of the text.  Runs of ASCII and Latin-1
letters without a special token, nearly all, are split by the tokenizer's own rule here, where lower case and
letters are beyond doubt; any other run goes through the whole tokenizer, special tokens included.

The join is made inside the task instead of by a shuffle: nearly every document brings hundreds of distinct
pre-tokens, and shuffling a row for each of them would move several times the input.
"""

from __future__ import annotations

import re
import struct
from collections import Counter

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from varloom.llm.common import empty_for_null, map_texts

#: A task's dictionaries forget what was not used among this many last entries; that bounds their memory.
DICTIONARY_ENTRIES = 150_000
#: Longer runs (in bytes) are tokenised but not kept.
LONGEST_KEPT = 64
LATIN = "a-z\u00e0-\u00f6\u00f8-\u00ff"
LATIN_1 = re.compile("[\\x00-\\xff]+")
PLAIN = re.compile(f"[\x21-\x7e{LATIN}\u00c0-\u00d6\u00d8-\u00de]+")
#: The tokenizer's rule for pre-tokens, for lower-cased plain runs.
PRE_TOKENS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LATIN}]+|[0-9]|[^{LATIN}0-9]+")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where it is one, else the next from 256 on."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(rest)) for b in range(256)]


class Recent:
    """A dictionary of bounded size: two generations, of which the older is dropped when the younger is full."""

    def __init__(self, entries: int):
        self.entries, self.young, self.old = entries, {}, {}

    def get(self, key):
        value = self.young.get(key)
        if value is None:
            value = self.old.get(key)
            if value is not None:
                self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self.young) >= self.entries:
            self.old, self.young = self.young, {}
        self.young[key] = value


class PieceDictionary:
    """Distinct run -> its pieces (as little-endian unsigned 32-bit ids) or their number."""

    def __init__(self, vocabulary: str, ids: bool):
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.ids = ids
        self.runs, self.pieces = Recent(DICTIONARY_ENTRIES), Recent(DICTIONARY_ENTRIES)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.characters = byte_characters()

    def value(self, ids: list[int]):
        return struct.pack(f"<{len(ids)}I", *ids) if self.ids else len(ids)

    def of_piece(self, token: str):
        found = self.pieces.get(token)
        if found is None:
            mapped = token if token.isascii() else "".join([self.characters[b] for b in token.encode()])
            found = self.value([t.id for t in self.tokenizer.model.tokenize(mapped)])
            self.pieces.put(token, found)
        return found

    def of_new_run(self, run: str):
        """A run that is in no dictionary: split into pre-tokens if it is plain, else tokenised as a whole."""
        core, tail = (run[:-1], run[-1]) if run[-1] in ".," else (run, "")
        if core.isalpha() and (core.isascii() or LATIN_1.fullmatch(core)):
            parts = [self.of_piece(core.lower())] + ([self.of_piece(tail)] if tail else [])
        elif PLAIN.fullmatch(run) and not any(s in run for s in self.specials):
            parts = [self.of_piece(t) for t in PRE_TOKENS.findall(run.lower())]
        else:
            return self.value(self.tokenizer.encode(run, add_special_tokens=False).ids)
        return parts[0] if len(parts) == 1 else b"".join(parts) if self.ids else sum(parts)

    def of_run(self, run: bytes):
        if len(run) > LONGEST_KEPT:
            return self.value(self.tokenizer.encode(run.decode(), add_special_tokens=False).ids)
        value = self.runs.get(run)
        if value is None:
            value = self.of_new_run(run.decode())
            self.runs.put(run, value)
        return value

    def count(self, text: str) -> int:
        """Tokens of a text: frequencies of its runs, joined to their piece counts and summed."""
        frequencies = Counter(text.encode().split())
        known = self.runs.young.get
        return sum([n * (known(run) or self.of_run(run)) for run, n in frequencies.items()])

    def concatenated(self, text: str) -> bytes:
        """Ids of a text."""
        known = self.runs.young.get
        return b"".join([known(run) or self.of_run(run) for run in text.encode().split()])


_DICTIONARIES: dict[tuple[str, bool], PieceDictionary] = {}


def dictionary(vocabulary: str, ids: bool = False) -> PieceDictionary:
    """The Python worker's dictionary; tasks that follow in the same worker go on using it."""
    key = (vocabulary, ids)
    if key not in _DICTIONARIES:
        _DICTIONARIES[key] = PieceDictionary(vocabulary, ids)
    return _DICTIONARIES[key]


def count_tokens(
    docs: DataFrame, vocabulary: str = "word_bpe_49k.json", limit: int = 2048, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """key, n_bytes, n_tokens, over_limit for every row.

    Null texts count as empty (0 bytes, 0 tokens); null or repeated keys keep a row each; other columns are
    ignored, whatever their names.  An empty table gives an empty result.
    """

    def work():
        known = dictionary(vocabulary)
        return lambda texts: (None, [list(map(known.count, texts))])

    counted = map_texts(docs.withColumn("__n", F.octet_length(empty_for_null(text)).cast("long")), (key, "__n"), text, {"n_tokens": "long"}, work)
    return counted.select(key, F.col("__n").alias("n_bytes"), "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
