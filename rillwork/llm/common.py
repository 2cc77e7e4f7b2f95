"""What the corpus operators share: intermediate tables, words, and work per row in Python."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from rillwork.session import shared_path

#: Rows that a Python task takes out of an Arrow batch at a time.
SLICE_ROWS = 256
#: Rows that Spark sends to Python at a time, where the session leaves that at its default of 10,000: texts are long.
BATCH_ROWS, BATCH_CONF, DEFAULT_ROWS = 500, "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"
#: The characters between words, U+0020 and U+0009 to U+000D, as a Java regular expression.
WORD = r"[^\x20\x09-\x0D]+"


#: Paths written in the open scratch scopes, innermost last.
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scratch scopes", default=())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the tables that ``saved`` writes inside, but for those that outlive the scope.

    What is used after the scope must not read the others, not even lazily.
    """
    made: list[str] = []
    token = _scopes.set((*_scopes.get(), made))
    try:
        yield
    finally:
        _scopes.reset(token)
        for path in made:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def saved(df: DataFrame, purpose: str, outlives: bool = False) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it from there.

    Cuts lineage, survives lost executors, and lets later scans read only the
    columns they need.  A table that ``outlives`` its scratch scope belongs to the
    scope around that one, if any.
    """
    path = shared_path(df.sparkSession, purpose)
    scopes = _scopes.get()[:-1] if outlives else _scopes.get()
    if scopes:
        scopes[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Lower the session's rows per Arrow batch, unless the user has chosen a number."""
    if spark.conf.get(BATCH_CONF, DEFAULT_ROWS) == DEFAULT_ROWS:
        spark.conf.set(BATCH_CONF, str(BATCH_ROWS))


def words(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text: ``bytes.split`` cuts at U+0020 and U+0009 to U+000D, nothing else."""
    return (text or b"").split()


def _values(batch: pa.RecordBatch, name: str) -> list:
    """A column, or a field of a struct column without nulls, as Python values; strings as UTF-8 bytes."""
    outer, _, field = name.partition(".")
    column = batch.column(outer)
    column = column.field(field) if field else column
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        column = column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary())
    return column.to_pylist()


def add_columns(
    df: DataFrame,
    inputs: Sequence[str],
    fields: Sequence[tuple[str, T.DataType]],
    make: Callable[[], Callable[..., tuple]],
    drop: Sequence[str] = (),
) -> DataFrame:
    """Add columns worked out in Python from single rows; other columns pass through but for ``drop``.

    ``make()`` runs once per task and returns a function of the input values that
    returns one value per new field.  Strings arrive as UTF-8 bytes.  An input may
    be a field ``outer.inner`` of a struct column that has no nulls.  A column of
    ``df`` that has a new field's name is replaced; the inputs are read before.
    Every column is sent to Python once and sent back only if it stays.  Only
    ``SLICE_ROWS`` rows are held as Python values at a time.
    """
    small_batches(df.sparkSession)
    names = [n for n, _ in fields]
    gone = {n.lower() for n in [*names, *drop]}
    rest = [c for c in df.columns if c.lower() not in gone]
    inner = {n: n if n.partition(".")[0] in rest else f"_in_{i}" for i, n in enumerate(inputs)}
    shown = df.select(
        *[F.col(f"`{c}`") for c in rest], *[F.col(n).alias(i) for n, i in inner.items() if i != n]
    )
    schema = T.StructType([shown.schema[c] for c in rest] + [T.StructField(n, t) for n, t in fields])
    types = [to_arrow_type(t) for _, t in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = make()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                piece = batch.slice(start, SLICE_ROWS)
                made = list(zip(*[row(*v) for v in zip(*[_values(piece, i) for i in inner.values()])]))
                yield pa.RecordBatch.from_arrays(
                    [*[piece.column(c) for c in rest], *[pa.array(v, t) for v, t in zip(made, types)]],
                    names=[*rest, *names],
                )

    return shown.mapInArrow(run, schema)
