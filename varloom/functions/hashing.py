"""Seeded hashes that other engines can compute too."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Hash values lie below this bound.
BOUND = 1 << 60


def seeded(c: Column, seed: int) -> Column:
    """The first 15 hex digits of the MD5 of `value:seed`, as a long."""
    return F.conv(F.substring(F.md5(F.concat(c.cast("string"), F.lit(f":{seed}"))), 1, 15), 16, 10).cast("long")
