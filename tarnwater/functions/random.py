"""Random numbers that are a pure function of (seed, key).

A generator that depends on the partition and row order gives other numbers when a lost task runs again on rows in
another order. A keyed hash gives the same number on every attempt, in every layout and in every engine.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_DIGITS = 8
SPAN = 16**HEX_DIGITS


def _word(digest: Column, index: int) -> Column:
    part = F.substring(digest, 1 + HEX_DIGITS * index, HEX_DIGITS)
    return F.conv(part, 16, 10).cast("bigint")


def keyed_digest(seed: int, *keys: Column | str) -> Column:
    """Hex digest of the seed and the key columns."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in keys]))


def keyed_uniform(seed: int, *keys: Column | str) -> Column:
    """Uniform number in [0, 1) for the key."""
    return _word(keyed_digest(seed, *keys), 0) / F.lit(float(SPAN))


def keyed_below(seed: int, share: float, *keys: Column | str) -> Column:
    """``keyed_uniform(...) < share`` by comparing the hex digits, without turning them into a number."""
    return keyed_digest(seed, *keys) < F.lit(share_limit(share))


def share_limit(share: float) -> str:
    """Hex digits that a digest stays below with the given probability."""
    limit = math.ceil(min(max(share, 0.0), 1.0) * SPAN)
    return "g" if limit >= SPAN else f"{limit:0{HEX_DIGITS}x}"


def keyed_normal(seed: int, *keys: Column | str) -> Column:
    """Standard normal number for the key (two uniform words, polar form)."""
    digest = keyed_digest(seed, *keys)
    radius = F.sqrt(-2.0 * F.log((_word(digest, 0) + 1) / F.lit(float(SPAN))))
    return radius * F.cos(2.0 * math.pi * _word(digest, 1) / F.lit(float(SPAN)))
