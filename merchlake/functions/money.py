"""Amounts from double columns, summed exactly and rounded once, at the end.

A double sum depends on the order of its rows, and casting every row to a decimal costs about ten
times the sum itself. Each amount is split into whole units and 10^-8 parts, which are summed as plain
64-bit integers (the units in a high and a low half): exact to 8 digits in any order, and safe from
overflow up to 9 * 10**10 rows per group, beyond which the job fails rather than errs. It also fails on single
amounts from 9 * 10**18 on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_LOW_BITS = 20
_PARTS = 10**8
# Doubles from here on have no 64-bit integer.
_LIMIT = 9.0e18


def known(amount: Column) -> Column:
    """The amount; NaN counts as missing. An amount that can't be summed, as an infinite one, fails the job."""
    beyond = F.raise_error(F.concat(F.lit("an amount can't be summed: "), amount.cast("string"))).cast("double")
    return F.when(F.abs(amount) < _LIMIT, amount).when(amount.isNull() | F.isnan(amount), F.lit(None)).otherwise(beyond)


def counted(amount: Column) -> Column:
    """Aggregate: rows that have an amount."""
    return F.count(known(amount))


def exact(amount: Column) -> Column:
    """Aggregate: the unrounded sum as decimal(38,8); NULL over no amounts."""
    value = known(amount)
    units = F.floor(value)
    parts = F.rint((value - units) * _PARTS).cast("bigint")

    def summed(column: Column) -> Column:
        return F.sum(column).cast("decimal(20,0)")

    high = summed(F.shiftright(units, _LOW_BITS)) * F.lit(1 << _LOW_BITS).cast("decimal(7,0)")
    low = summed(units.bitwiseAND(F.lit((1 << _LOW_BITS) - 1)))
    fraction = summed(parts) * F.lit("0.00000001").cast("decimal(8,8)")
    return (high + low + fraction).cast("decimal(38,8)")


def rounded(sum_of: Column) -> Column:
    """An exact sum to the cent, as double; 0.0 over no rows."""
    return F.coalesce(F.round(sum_of, 2).cast("double"), F.lit(0.0))


def total(amount: Column) -> Column:
    """Aggregate: the sum of an amount to the cent, as double; 0.0 over no rows."""
    return rounded(exact(amount))


def to_cent(amount: Column) -> Column:
    """One amount rounded to the cent, ties to even, in plain double arithmetic."""
    return F.rint(amount * 100) / 100


def per_unit(amount: Column, quantity: Column) -> Column:
    """Amount per unit to the cent, ties away from zero; NULL for no units."""
    quotient = F.try_divide(known(amount), quantity)
    return F.round(quotient.cast("decimal(38,10)"), 2).cast("double")


def average(sum_of: Column, rows: Column) -> Column:
    """A sum, not rounded before, divided by a row count, to the cent; 0.0 over no rows."""
    return F.coalesce(per_unit(sum_of.cast("double"), rows), F.lit(0.0))
