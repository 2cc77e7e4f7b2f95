"""Exact sums of amounts held as doubles with a known number of decimals.

Such amounts are added up as whole units (cents for two decimals): the sum does
not depend on row order, and whole numbers add several times faster than decimals
made from doubles.  The caller says how many decimals a column has; a value with
more raises an error instead of being rounded.  Without a number of decimals a
sum is a plain sum of doubles.  A sum beyond 9.2e18 units raises an overflow error
under Spark's default ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(amount: str | Column) -> Column:
    return F.col(amount) if isinstance(amount, str) else amount


def units(amount: str | Column, places: int | None = 2) -> Column:
    """The amount in whole units of its last decimal; without ``places`` as it is."""
    value = _column(amount)
    if places is None:
        return value.cast("double")
    scaled = value * 10**places
    whole = F.rint(scaled)
    # A double next to a decimal is off by a few parts in 2^53 of its size.
    fits = F.abs(scaled - whole) <= F.greatest(F.lit(1.0), F.abs(scaled)) * 1e-9
    error = F.raise_error(F.concat(F.lit(f"more than {places} decimals: "), value.cast("string")))
    return F.when(value.isNull() | fits, whole.cast("bigint")).otherwise(error.cast("bigint"))


def cents(amount: str | Column) -> Column:
    return units(amount, 2)


def total(amount: str | Column, places: int | None = 2) -> Column:
    """Sum in whole units, which can be summed again; exact where ``places`` is given."""
    return F.sum(units(amount, places))


def as_amount(summed: str | Column, places: int | None = 2) -> Column:
    """Whole units as a double: the one nearest to the exact amount."""
    if places is None:
        return _column(summed).cast("double")
    return (_column(summed).cast("decimal(20,0)") / 10**places).cast("double")


def discounted(price: str | Column, percent: float) -> Column:
    """The price less ``percent`` percent, computed in decimals."""
    keep = F.lit(str(100 - percent)).cast("decimal(9,4)") / F.lit(100)
    return (_column(price).cast("decimal(18,2)") * keep).cast("double")
