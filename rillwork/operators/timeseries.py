"""Windows over ordered events of a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillwork.functions.exact import sums
from rillwork.functions.times import seconds
from rillwork.operators.ordered import (
    cut,
    near,
    near_sliced,
    running,
    split_hot,
)


def readable(df: DataFrame, value: str) -> DataFrame:
    """Text values as doubles, rows without a readable one removed."""
    return df.withColumn(value, F.expr(f"try_cast(`{value}` AS DOUBLE)")).filter(F.col(value).isNotNull())


def moving_average(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    size: int,
    group_rows: int | None = None,
) -> DataFrame:
    """Mean of each row and the ``size - 1`` before it, rounded to 2 places, sorted.

    Rows with fewer predecessors are left out, and so are null values.
    """
    if size < 1:
        raise ValueError("size must be at least 1")

    def compute(rows, window):
        frame = window.rowsBetween(1 - size, Window.currentRow)
        full = F.count(key).over(frame) == size
        mean = F.round(F.when(full, F.avg(value).over(frame)), 2)
        return rows.withColumn("moving_average", mean)

    part = split_hot(df.filter(F.col(value).isNotNull()), [key], group_rows)
    # One range shuffle on the key serves the window and the final order.
    ranged = part.rest.repartitionByRange(key)
    out = compute(ranged, Window.partitionBy(key).orderBy(*order))
    if part.hot is not None:
        sliced = cut(part, [key], order)
        out = out.unionByName(near_sliced(sliced, [key], order, max(size - 1, 1), compute).drop("_slice"))
    return out.filter(F.col("moving_average").isNotNull()).orderBy(key, *order)


def moving_average_with(
    averages: DataFrame, info: DataFrame, key: str, info_key: str, columns: Sequence[str]
) -> DataFrame:
    """Moving averages with the given columns of the key's row in ``info``."""
    joined = averages.join(info, averages[key] == info[info_key])
    return joined.select(*[averages[c] for c in averages.columns], *[info[c] for c in columns])


def centred_average(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    group_rows: int | None = None,
    places: int | None = None,
) -> DataFrame:
    """Exact sum of each row with its two neighbours, their count and mean."""
    amount = sums(df, value, places)

    def compute(rows, window):
        frame = window.rowsBetween(-1, 1)
        total = amount.by(lambda part: F.sum(part).over(frame))
        count = F.count(value).over(frame)
        return rows.withColumns(
            {"frame_total": total, "frame_rows": count, "centred_average": F.try_divide(total, count)}
        )

    return near(df, keys, order, 1, compute, group_rows)


def lag_lead(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    offset: int,
    group_rows: int | None = None,
) -> DataFrame:
    """The value ``offset`` rows earlier and later within the key."""

    def compute(rows, window):
        return rows.withColumns(
            {
                "previous": F.lag(value, offset).over(window),
                "ahead": F.lead(value, offset).over(window),
            }
        )

    return near(df, keys, order, offset, compute, group_rows)


def cumulative_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    group_rows: int | None = None,
    places: int | None = None,
) -> DataFrame:
    """Exact running sum within the key; reads ``df`` once more unless the number of decimals is given.

    Totals of earlier slices are added as whole limbs, so the result has the same
    bits however the rows are cut and ordered on the way.
    """
    amount = sums(df, value, places)
    names = [f"_sum_{i}" for i in range(len(amount.parts))]
    summed = running(df, keys, order, dict(zip(names, amount.parts)), group_rows=group_rows)
    return summed.withColumn("cumulative_sum", amount.join([F.col(n) for n in names])).drop(*names)


def event_gaps(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], group_rows: int | None = None
) -> DataFrame:
    """Whole seconds since the key's previous event, null for its first; time is ``order[0]``."""

    def compute(rows, window):
        here = seconds(order[0])
        return rows.withColumn("gap_seconds", here - F.lag(here).over(window))

    return near(df, keys, order, 1, compute, group_rows)


def dwell(
    df: DataFrame, user: str, order: Sequence[str], group_rows: int | None = None
) -> DataFrame:
    """Whole seconds until the user's next event of the same day, 0 for the day's last."""

    def compute(rows, window):
        here = seconds(order[0])
        following = F.lead(here).over(window)
        return rows.withColumn("dwell_seconds", F.coalesce(following, here) - here)

    dated = df.withColumn("day", F.to_date(order[0]))
    return near(dated, [user, "day"], order, 1, compute, group_rows)
