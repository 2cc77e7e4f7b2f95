"""Loads that happen once, partitioned tables without small files, samples in one pass."""

import glob

import pytest
from pyspark.sql import functions as F

from rillwork import session
from rillwork.operators import ordering
from rillwork.sources import tables


@pytest.fixture
def database(spark):
    name = "t_" + session.shared_path(spark, "db").rsplit("-", 1)[-1]
    tables.make_database(spark, name, session.shared_path(spark, name))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture
def berths(spark, database):
    table = f"{database}.berths"
    tables.quoted_csv_table(spark, table, "id INT, place STRING")
    return table


def put(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(f"{line}\n" for line in lines))


def test_files_are_loaded_once(spark, rows, tmp_path, berths):
    source = tmp_path / "in put"
    put(source, "1.csv", "1,'quay, west'", "1,'quay, west'", "2,pier")
    for _ in range(2):
        tables.load_csv(spark, str(source), berths)
        assert rows(spark.table(berths)) == [(1, "quay, west"), (1, "quay, west"), (2, "pier")]
    put(source, "2.csv", "3,'dock'")
    tables.load_csv(spark, str(source), berths)
    assert spark.table(berths).count() == 4
    # The same name with other lines is another file.
    put(source, "2.csv", "3,'dock'", "4,'slip'")
    tables.load_csv(spark, str(source / "2.csv"), berths)
    assert spark.table(berths).count() == 6


@pytest.mark.parametrize("stop", ["staged half", "staged", "moved half", "moved"])
def test_a_stopped_load_is_finished(spark, rows, tmp_path, berths, stop, monkeypatch):
    source = tmp_path / "in"
    for i in range(4):
        put(source, f"{i}.csv", *[f"{i * 10 + k},'x'" for k in range(5)])
    load = tables.stage_csv(spark, str(source), berths)
    folder, system, paths = tables._hidden(spark, berths)
    staged = f"{folder}/_staged/{load}/rows"
    parts = [s.getPath() for s in system.listStatus(paths(staged)) if s.getPath().getName().startswith("part-")]
    assert len(parts) > 1 and spark.table(berths).count() == 0
    if stop == "staged half":
        system.delete(paths(f"{staged}/_SUCCESS"), False)
        system.delete(parts[0], False)
    for part in {"moved half": parts[:1], "moved": parts}.get(stop, []):
        system.rename(part, paths(f"{folder}/load-{load}-{part.getName()}"))
    for _ in range(2):
        tables.load_csv(spark, str(source), berths)
        assert rows(spark.table(berths).select("id")) == sorted(((i * 10 + k,) for i in range(4) for k in range(5)), key=str)
    assert not system.exists(paths(staged))


def test_partitions_have_few_files(spark, database):
    """One value has a third of the rows, others and null share the rest; 8 tasks have them all."""
    p = F.when(F.col("id") % 3 == 0, 0).otherwise(F.nullif(F.col("id") % 41, F.lit(5)))
    df = spark.range(0, 30_000, 1, 8).select("id", p.alias("p"))
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        tables.save_table(df, f"{database}.parts", ["p"], file_rows=1000)
    finally:
        spark.conf.unset(coalesce)
    folder = tables._hidden(spark, f"{database}.parts")[0].removeprefix("file:")
    files = {f.rsplit("/", 1)[-1]: glob.glob(f"{f}/*.parquet") for f in glob.glob(f"{folder}/p=*")}
    sizes = {f"p={'__HIVE_DEFAULT_PARTITION__' if r.p is None else r.p}": r["count"] for r in df.groupBy("p").count().collect()}
    assert set(files) == set(sizes) and all(len(v) <= -(-sizes[f] // 1000) for f, v in files.items())
    # Several of four tasks share the large partition.
    assert 2 <= len(files["p=0"]) <= 4 and all(spark.read.parquet(v).count() < 8000 for v in files["p=0"])
    assert spark.table(f"{database}.parts").count() == 30_000


@pytest.mark.parametrize("n", [0, 1, 50, 2999, 3000, 5000])
def test_samples_are_the_smallest_hashes(spark, monkeypatch, n):
    df = spark.range(3000).withColumnRenamed("id", "k")
    want = {r.k for r in df.orderBy(ordering._draw(F.col("k"), 4), "k").limit(n).collect()}
    assert {r.k for r in ordering.sample_exact(df, "k", n, 4).collect()} == want
    if n == 50:
        # A bound that keeps too few rows.
        monkeypatch.setattr(ordering, "sqrt", lambda n: -14.99)
        assert {r.k for r in ordering.sample_exact(df, "k", n, 4).collect()} == want
