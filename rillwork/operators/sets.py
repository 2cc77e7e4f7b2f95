"""Set operations with exact treatment of duplicates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame

from rillwork.operators.ordered import lookup


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, matched by column name, duplicates kept."""
    return reduce(DataFrame.unionByName, frames)


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    return union_all(frames).distinct()


def common(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows found on both sides; duplicates go before anything is compared."""
    return left.distinct().intersect(right.distinct())


def minus_all_copies(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left rows not found on the right, with their duplicates; null equals null."""
    return lookup(left, right.distinct(), left.columns, "left_anti")
