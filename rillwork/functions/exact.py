"""Sums of doubles that are exact until one rounding at the end, in any order of rows.

A double is a whole number times a power of two.  With the largest and smallest
sizes of a column known, every value is cut into a few whole *limbs* of 24 bits, at
the same places for all rows.  Limbs add up as whole numbers, so totals may be
taken in any order, in parts, or running, and added again; no bit is lost before
the limbs of a total are put together and rounded to the nearest double.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil, frexp
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillwork.functions.money import as_amount, units

#: Bits of a limb.  Sums of up to 2 ** 39 limbs fit into a long.
LIMB = 24
#: Limbs that are rounded together: the first is not zero, so they hold more bits than a double.
HEAD = 4
#: Bits of the smallest positive double.
LEAST_BIT = -1074


class Scale(NamedTuple):
    """All finite values are below ``2 ** top`` and multiples of the last limb's unit.

    ``odd`` says whether there are values that are not finite.
    """

    top: int
    limbs: int
    odd: bool


def scale_of(df: DataFrame, value: Column) -> Scale:
    """The scale that fits all values; reads the column once."""
    size = F.abs(value.cast("double"))
    finite = size < F.lit(float("inf"))
    low, high, odd = df.agg(
        F.min(F.when(finite & (size > 0), size)), F.max(F.when(finite, size)), F.count_if(~finite)
    ).first()
    if low is None:
        return Scale(0, 1, bool(odd))
    top, least = frexp(high)[1], max(frexp(low)[1] - 53, LEAST_BIT)
    return Scale(top, ceil((top - least) / LIMB), bool(odd))


def _times_power(value: Column, power: int) -> Column:
    half = power // 2
    return value * F.lit(2.0**half) * F.lit(2.0 ** (power - half))


def limbs(value: Column, scale: Scale) -> list[Column]:
    """Whole numbers whose sums make up the sum of the values; null for null."""
    value = value.cast("double")
    finite = F.when(F.abs(value) < F.lit(float("inf")), value)
    parts = []
    for i in range(1, scale.limbs + 1):
        shifted = _times_power(finite, LIMB * i - scale.top)
        # A number that is larger ends above this limb; one that is smaller begins below it.
        limb = F.when(F.abs(shifted) < 2.0**80, shifted % F.lit(2.0**LIMB)).otherwise(0.0)
        parts.append(F.when(value.isNotNull(), F.coalesce(limb, F.lit(0.0))).cast("bigint"))
    return parts + ([F.when(finite.isNull(), value)] if scale.odd else [])


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _carried(sums: Column) -> Column:
    """Limbs from the last to the first, with carries moved up: all but the topmost are in [0, 2 ** LIMB)."""
    zero = F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("done"))

    def step(state: Column, limb: Column) -> Column:
        whole = state["carry"] + limb
        digit = whole.bitwiseAND(F.lit((1 << LIMB) - 1).cast("bigint"))
        return F.struct(
            F.shiftright(whole, LIMB).alias("carry"), F.concat(state["done"], F.array(digit)).alias("done")
        )

    return F.aggregate(sums, zero, step, lambda s: F.concat(s["done"], F.array(s["carry"])))


def rounded(sums: list[Column], scale: Scale) -> Column:
    """The double nearest to the sum, from the sums of its limbs; null if there was no value.

    As in plain sums, infinite values and NaN decide the result.  Totals below
    2 ** -1022 may be rounded twice.
    """
    whole, others = sums[: scale.limbs], sums[scale.limbs :]
    powers = [scale.top - LIMB * i - 1 for i in range(scale.limbs + 1)]
    halves = [F.array(*[F.lit(2.0 ** f(p)) for p in powers]) for f in (lambda p: p // 2, lambda p: p - p // 2)]

    def join(digits: Column) -> Column:
        """Limbs without a sign, the topmost first, as a double."""
        first = F.array_position(F.transform(digits, lambda d: d != 0), F.lit(True)).cast("int")
        head = F.slice(digits, first, F.lit(HEAD))
        rest = F.exists(F.slice(digits, first + HEAD, F.lit(scale.limbs + 1)), lambda d: d != 0)
        zero = F.lit(0).cast("decimal(38,0)")
        number = F.aggregate(head, zero, lambda a, d: (a * F.lit(1 << LIMB) + d).cast("decimal(38,0)"))
        # One more bit says whether anything follows, so that ties are rounded rightly.
        number = (number * 2 + rest.cast("int")).cast("decimal(38,0)").cast("double")
        last = F.least(first + HEAD - 1, F.lit(scale.limbs + 1))
        value = number * F.element_at(halves[0], last) * F.element_at(halves[1], last)
        return F.when(first == 0, 0.0).otherwise(value)

    def signed(all_sums: Column) -> Column:
        negative = F.element_at(_carried(all_sums), -1) < 0
        plain = F.transform(all_sums, lambda s: F.when(negative, -s).otherwise(s))
        size = _let(F.reverse(_carried(plain)), join)
        return F.when(negative, -size).otherwise(size)

    # Longs run from the last limb to the first here.
    total = F.when(whole[0].isNotNull(), _let(F.array(*[F.coalesce(w, F.lit(0)) for w in reversed(whole)]), signed))
    return F.coalesce(*others, total) if others else total


class Sums(NamedTuple):
    """Columns to add up, and what makes a double of their totals."""

    parts: list[Column]
    join: Callable[[list[Column]], Column]

    def by(self, add: Callable[[Column], Column]) -> Column:
        """The amount, where ``add`` turns a column into its total, as an aggregate does."""
        return self.join([add(p) for p in self.parts])


def sums(df: DataFrame, amount: str | Column, places: int | None) -> Sums:
    """How to add up an amount exactly: as whole units of ``places`` decimals, or without them as limbs.

    Limbs need the column's scale, for which ``df`` is read once here.
    """
    value = F.col(amount) if isinstance(amount, str) else amount
    if places is not None:
        return Sums([units(value, places)], lambda totals: as_amount(totals[0], places))
    scale = scale_of(df, value)
    return Sums(limbs(value, scale), lambda totals: rounded(totals, scale))
