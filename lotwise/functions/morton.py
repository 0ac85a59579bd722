"""Cells of a grid as one number: the bits of both places in turn, so that the cell four times as
large is the number without its last two bits."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Steps that pull 31 bits apart to every second place: shift, and the bits that stay.
STEPS = [
    (16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
    (2, 0x3333333333333333), (1, 0x5555555555555555),
]
EVERY_SECOND, LAST_31 = STEPS[-1][1], (1 << 31) - 1


def _apart(place: Column) -> Column:
    bits = place.cast("bigint").bitwiseAND(F.lit(LAST_31))
    for shift, mask in STEPS:
        bits = bits.bitwiseOR(F.shiftleft(bits, shift)).bitwiseAND(F.lit(mask))
    return bits


def _together(bits: Column) -> Column:
    place = bits.bitwiseAND(F.lit(EVERY_SECOND))
    for (shift, _), mask in zip(STEPS[::-1], [m for _, m in STEPS[-2::-1]] + [LAST_31]):
        place = place.bitwiseOR(F.shiftright(place, shift)).bitwiseAND(F.lit(mask))
    return place


def morton_key(x: Column, y: Column) -> Column:
    """The number of a cell; both places from 0 to 2^31 - 1."""
    return _apart(x).bitwiseOR(F.shiftleft(_apart(y), 1))


def cell_of(key: Column) -> tuple[Column, Column]:
    return _together(key), _together(F.shiftright(key, 1))


def coarser(key: Column, levels: Column | int) -> Column:
    """The cell that holds this one, so many times twice as wide."""
    return F.shiftright(key, 2 * levels) if isinstance(levels, int) else F.call_function("shiftright", key, 2 * levels)
