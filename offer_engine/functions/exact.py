"""Sums of doubles that do not depend on the order of the rows.

A value is split without error into LIMBS whole numbers of WIDTH bits, each a multiple of one power
of two from 2 ** LOW on. Whole numbers add exactly in any order and can be merged over groups and
windows; only the end result is rounded. Up to 2 ** 39 values can be added.

Values of 2 ** 64 and more, infinities and NaN add up beside them as doubles: an infinity or NaN
stays what it is, and finite values so large are as exact as a plain sum. Digits of a value below
2 ** -80 are cut off, value by value. The sum of no values is null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

LOW, WIDTH, LIMBS = -80, 24, 6
_UNITS = [2.0 ** (LOW + WIDTH * k) for k in range(LIMBS)]
_NAMES = [f"l{k}" for k in range(LIMBS)]
_REST = "rest"
FIELDS = (*_NAMES, _REST)


def limbs(value: Column) -> dict[str, Column]:
    """The numbers a value is split into, by field; all null for null."""
    x = value.cast("double")
    plain = F.abs(x) < 2.0 ** (LOW + WIDTH * LIMBS)  # false for NaN, which Spark has above all
    digits = {
        name: F.when(plain, (x * (1 / unit) % 2.0**WIDTH).cast("bigint")).when(x.isNotNull(), F.lit(0).cast("bigint"))
        for name, unit in zip(_NAMES, _UNITS, strict=True)
    }
    return digits | {_REST: F.when(~plain, x)}


def _sum(value: Column, over: WindowSpec | None) -> Column:
    return F.sum(value) if over is None else F.sum(value).over(over)


def sum_of(value: Column, over: WindowSpec | None = None) -> Column:
    """The parts of a sum over a group, or over a window."""
    return F.struct(*[_sum(part, over).alias(name) for name, part in limbs(value).items()])


def merged(parts: Column, over: WindowSpec | None = None) -> Column:
    """The parts of a sum of sums."""
    return F.struct(*[_sum(parts.getField(name), over).alias(name) for name in FIELDS])


def from_limbs(part) -> Column:
    """The sum from its parts, given by a function from field to column."""
    total = part(_NAMES[0]).cast("double") * _UNITS[0]
    for name, unit in zip(_NAMES[1:], _UNITS[1:], strict=True):
        total = total + part(name) * F.lit(unit)
    return total + F.coalesce(part(_REST), F.lit(0.0))


def total(parts: Column) -> Column:
    """The sum as a double, from its parts."""
    return from_limbs(parts.getField)


def exact_sum(value: Column, over: WindowSpec | None = None) -> Column:
    """The sum of a group or window as a double."""
    parts = {name: _sum(part, over) for name, part in limbs(value).items()}
    return from_limbs(parts.__getitem__)
