"""Pivot, unpivot, explode and JSON flattening."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillwork.operators.aggregates import sum_by


def pivot_total(
    df: DataFrame,
    row: str,
    column: str,
    amount: str,
    values: Sequence[str] | None = None,
    places: int | None = None,
) -> DataFrame:
    """One column per value with its total; values not listed are looked up first.

    The amounts are added up exactly per row and value before they are turned, so
    that one total at most meets in each cell.
    """
    totals = sum_by(df, [row, column], amount, "_sum", places)
    turned = totals.groupBy(row).pivot(column, list(values) if values is not None else None)
    return turned.agg(F.sum("_sum"))


def unpivot(
    df: DataFrame, row: str, labels: Mapping[str, str], label_name: str, value_name: str
) -> DataFrame:
    """Columns back to rows, each under its label, rows without a value removed."""
    pairs = ", ".join(f"'{label}', `{column}`" for column, label in labels.items())
    stacked = df.select(
        row, F.expr(f"stack({len(labels)}, {pairs}) as (`{label_name}`, `{value_name}`)")
    )
    return stacked.dropna("any")


def explode_array(
    df: DataFrame, keep: Sequence[str], array: str, name: str, outer: bool = False, position: bool = False
) -> DataFrame:
    """One row per element; with ``outer`` also one for a null or empty array."""
    if position:
        generate = F.posexplode_outer(array) if outer else F.posexplode(array)
        return df.select(*keep, generate.alias("pos", name))
    generate = F.explode_outer(array) if outer else F.explode(array)
    return df.select(*keep, generate.alias(name))


def explode_map(
    df: DataFrame, keep: Sequence[str], column: str, outer: bool = False, position: bool = False
) -> DataFrame:
    """One row per entry as ``key`` and ``value``; with ``outer`` also one for a null or empty map."""
    if position:
        generate = F.posexplode_outer(column) if outer else F.posexplode(column)
        return df.select(*keep, generate.alias("pos", "key", "value"))
    generate = F.explode_outer(column) if outer else F.explode(column)
    return df.select(*keep, generate.alias("key", "value"))


def flatten_envelope(df: DataFrame, keep: Sequence[str], document: str | Column, entry: str) -> DataFrame:
    """JSON ``{"recordsTotal": n, "data": [..]}`` to one row per entry, numbered from 1.

    ``entry`` is the DDL of one entry's fields.
    """
    column = F.col(document) if isinstance(document, str) else document
    parsed = F.from_json(column, f"recordsTotal bigint, data array<struct<{entry}>>")
    return (
        df.select(*keep, parsed.alias("_doc"))
        .select(*keep, F.col("_doc.recordsTotal").alias("records_total"), F.posexplode("_doc.data"))
        .select(*keep, "records_total", (F.col("pos") + 1).alias("ordinal"), "col.*")
    )
