"""Repeatable pseudo-random order from row keys.

The order is the hex MD5 of ``seed:key``; it depends on nothing but the key, so
a lost executor, another partition count or another engine gives the same order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskframe.functions.expr import col

FINGERPRINT_MODULUS = 2**61 - 1


def hash_order(seed: int | str, key: str | Sequence[str]) -> Column:
    keys = [key] if isinstance(key, str) else list(key)
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(col(k).cast("string"), F.lit("")) for k in keys]))


def hash_number(text: Column) -> Column:
    """First 32 bits of the MD5 as a whole number."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def unit_draw(text: Column) -> Column:
    """A number in [0, 1) drawn from the text."""
    return hash_number(text) / F.lit(float(2**32))
