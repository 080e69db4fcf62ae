"""Bit operations on integer columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def parity(value: Column, mask: int | Column) -> Column:
    """Parity (0 or 1) of the bits of ``value`` selected by ``mask``."""
    masked = value.bitwiseAND(mask if isinstance(mask, Column) else F.lit(mask))
    return F.bit_count(masked) % 2


def inverse_permutation(table: Sequence[int]) -> list[int]:
    """Table that undoes a permutation given as value-per-position."""
    inverse = [0] * len(table)
    for position, value in enumerate(table):
        inverse[value] = position
    return inverse


def nibble_lookup(byte: Column, table: Sequence[int]) -> Column:
    """Replace both four-bit halves of a byte by their entry in a 16-entry table."""
    entries = F.array(*[F.lit(int(v)) for v in table])
    high = F.get(entries, F.shiftright(byte, 4).bitwiseAND(F.lit(15)).cast("int"))
    low = F.get(entries, byte.bitwiseAND(F.lit(15)).cast("int"))
    return F.shiftleft(high, 4).bitwiseOR(low)


def binary_text(value: Column, width: int) -> Column:
    """Binary digits, left padded with zeros to ``width``; longer numbers keep all their digits."""
    digits = F.bin(value)
    return F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)
