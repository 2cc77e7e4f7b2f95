"""Aggregates of keyed rows; all combine on the map side before they shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillwork.functions.exact import sums


def mean_by(
    df: DataFrame, keys: Sequence[str], amount: str, name: str = "mean", places: int | None = None
) -> DataFrame:
    """Mean per key, from an exact sum; reads ``df`` once more unless the number of decimals is given."""
    mean = sums(df, amount, places).by(F.sum) / F.count(amount)
    return df.groupBy(*keys).agg(mean.alias(name))


def sum_by(
    df: DataFrame, keys: Sequence[str], amount: str, name: str = "total", places: int | None = None
) -> DataFrame:
    """Exact sum per key; reads ``df`` once more unless the number of decimals is given."""
    return df.groupBy(*keys).agg(sums(df, amount, places).by(F.sum).alias(name))


def count_by(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def sum_and_count(df: DataFrame, amount: str, places: int | None = None) -> DataFrame:
    return df.agg(sums(df, amount, places).by(F.sum).alias("total"), F.count(amount).alias("n"))


def last_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """The value of each key's last row in the given order."""
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(value))


def _highest(name: str, amount: str, zero: tuple[str, float]) -> tuple[Column, Column]:
    """Name and amount of the highest row, or the zero record unless one exceeds it.

    Equal amounts are decided by the greater name.
    """
    top = F.max(F.struct(F.col(amount).alias("a"), F.col(name).alias("n")))
    above = top["a"] > F.lit(zero[1])
    return (
        F.when(above, top["n"]).otherwise(F.lit(zero[0])).alias(name),
        F.when(above, top["a"]).otherwise(F.lit(zero[1])).alias(amount),
    )


def fold_highest(
    df: DataFrame, name: str, amount: str, keys: Sequence[str] = (), zero: tuple[str, float] = ("none", 0.0)
) -> DataFrame:
    """The record with the highest amount, overall or per key, starting from a zero record."""
    return df.groupBy(*keys).agg(*_highest(name, amount, zero))


def share_of_total(df: DataFrame, keys: Sequence[str], counted: str) -> DataFrame:
    """Count per key with its percentage of the whole, in one plan.

    The whole is a scalar subquery over the counts, so no row is moved for it
    and nothing passes through the driver.
    """
    counts = df.groupBy(*keys).agg(F.count(counted).alias("n"))
    whole = counts.agg(F.sum("n").alias("whole")).scalar()
    share = F.try_divide(F.col("n").cast("double"), whole.cast("double")) * 100
    return counts.withColumn("percentage", share)


def fill_with_mean(df: DataFrame, amount: str, places: int | None = None) -> DataFrame:
    """Null amounts replaced by the mean of the others."""
    mean = df.agg((sums(df, amount, places).by(F.sum) / F.count(amount)).alias("mean")).scalar()
    return df.withColumn(amount, F.coalesce(F.col(amount), mean))


def parity_totals(df: DataFrame, number: str) -> DataFrame:
    """Count and sum of even and odd numbers."""
    parity = F.when(F.col(number) % 2 == 0, "even").otherwise("odd").alias("parity")
    return df.groupBy(parity).agg(
        F.count(number).alias("n"), F.sum(F.col(number).cast("bigint")).alias("total")
    )


def word_counts(df: DataFrame, words: Column) -> DataFrame:
    return df.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("word").alias("n"))


def word_counts_by_partition(df: DataFrame, spread: Column, partitions: int, words: Column) -> DataFrame:
    """Words counted inside each of ``partitions`` parts of the rows, with the part's index.

    ``spread`` is a whole number; its remainder is the row's part.  The part is a
    column, so texts stay where they are and only counts are shuffled.
    """
    part = F.pmod(spread, F.lit(partitions)).cast("int")
    tagged = df.select(part.alias("part"), F.explode(words).alias("word"))
    return tagged.groupBy("part", "word").agg(F.count(F.lit(1)).alias("n"))
