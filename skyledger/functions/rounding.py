"""Means rounded half-up to two decimals, independent of the summation order.

Double sums depend on the order in which partitions arrive, and an exact ``.xx5`` mean can land on
either side. So each value is counted in whole units of 0.0001 and what is left of it in units of
1e-9, the nearest number of them, and both are summed as longs: primitive arithmetic inside code
generation, several times faster than a decimal average, and exact for values with up to nine
decimals (and fifteen digits). The sum of units is kept in two longs, of the high and the low bits, so that no group
overflows. Only a group with a NaN, an infinity or a value beyond 9e14 falls back to the double mean.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

UNITS_PER_ONE = 10_000
NANOS_PER_ONE = 1_000_000_000
_NANOS_PER_UNIT = NANOS_PER_ONE // UNITS_PER_ONE
_NANOS_PER_CENT = NANOS_PER_ONE // 100
_LOW_BITS = 31


def whole_units(value: Column) -> Column:
    """``value`` in the nearest whole number of units, NULL where a long cannot hold it."""
    return F.rint(value * F.lit(float(UNITS_PER_ONE))).try_cast("bigint")


def left_nanos(value: Column, units: Column) -> Column:
    """What the whole units leave of ``value``, in the nearest whole number of 1e-9."""
    left = value - units / F.lit(float(UNITS_PER_ONE))
    return F.rint(left * F.lit(float(NANOS_PER_ONE))).cast("bigint")


def round_2(value: Column) -> Column:
    """Half away from zero on the shortest decimal text of the double: 2.675 gives 2.68."""
    return F.round(value, 2)


def high_bits(units: Column) -> Column:
    return F.shiftright(units, _LOW_BITS)


def low_bits(units: Column) -> Column:
    """What ``high_bits`` leaves, never negative."""
    return units.bitwiseAND(F.lit((1 << _LOW_BITS) - 1).cast("bigint"))


def mean_2(high: str, low: str, nanos: str, unit_rows: str, total: str, rows: str) -> Column:
    """Mean of a group, rounded; the arguments name its columns.

    ``high``, ``low`` and ``unit_rows``: sums and count of the values in units; ``nanos``: sum of what
    the units leave; ``total`` and ``rows``: sum and count of all values as doubles.
    """
    # Once per group, so it may be interpreted: as generated code it would make methods too large.
    # Integer division truncates towards zero, so half a cent is added away from zero first.
    count = f"cast({rows} as decimal(20, 0))"
    cents = F.expr(
        f"aggregate(array(cast({low} as decimal(38, 0))),"
        f" cast(cast({high} as decimal(20, 0)) * {1 << _LOW_BITS}L as decimal(38, 0)), (h, l) -> cast(h + l as decimal(38, 0)),"
        f" u -> element_at(transform(array(cast(u * {_NANOS_PER_UNIT} + coalesce({nanos}, 0L) as decimal(38, 0))),"
        f" t -> (2 * t + if(t < 0, -1, 1) * {_NANOS_PER_CENT} * {count}) div"
        f" ({2 * _NANOS_PER_CENT} * {count})), 1))"
    )
    exact = cents / F.lit(100.0)
    # Fifteen significant digits bring a decimal tie back before it is rounded.
    fifteen_digits = F.format_string("%.14e", F.col(total) / F.col(rows)).try_cast("double")
    is_exact = (F.col(rows) > 0) & (F.col(unit_rows) == F.col(rows))
    return F.when(is_exact, exact).when(F.col(rows) > 0, round_2(fifteen_digits))
