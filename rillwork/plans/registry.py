"""Named queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


class Tables:
    """The tables of one folder as attributes, looked up once, when first used."""

    def __init__(self, spark: SparkSession, folder: str):
        # Days and seconds of the tables' zone-less times must not depend on the machine.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.folder = folder

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        frame = self.spark.read.parquet(self.path(name))
        setattr(self, name, frame)
        return frame


class Query(NamedTuple):
    run: Callable[[Tables], DataFrame]
    sql: str | None


REGISTERED: dict[str, Query] = {}


def query(sql: str | None = None):
    """Register a function of ``Tables`` under its own name."""

    def register(function: Callable[[Tables], DataFrame]):
        if function.__name__ in REGISTERED:
            raise ValueError(f"{function.__name__} is registered twice")
        REGISTERED[function.__name__] = Query(function, sql)
        return function

    return register


def money(column: str) -> str:
    """SQL for an exact sum of amounts."""
    return f"CAST(SUM(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)"
