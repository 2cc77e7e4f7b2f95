"""Round trips through files and catalog tables in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillwork.functions.text import lines
from rillwork.operators.sets import union_all
from rillwork.plans.registry import TABLES, Tables, query
from rillwork.session import shared_path
from rillwork.sources import files, tables


def _database(t: Tables) -> str:
    """A fresh database with its tables in the shared folder."""
    name = f"rillwork_{uuid.uuid4().hex}"
    tables.make_database(t.spark, name, shared_path(t.spark, name))
    return name


@query("SELECT * FROM supplier")
def csv_roundtrip(t: Tables) -> DataFrame:
    path = shared_path(t.spark, "csv")
    files.write_csv(t.supplier, path)
    return files.read_csv(t.spark, path, t.supplier.schema)


@query("SELECT * FROM customer")
def json_lines_roundtrip(t: Tables) -> DataFrame:
    path = shared_path(t.spark, "json")
    files.write_json(t.customer, path)
    return files.read_json(t.spark, path, t.customer.schema)


@query("SELECT * FROM customer")
def json_multiline_roundtrip(t: Tables) -> DataFrame:
    path = shared_path(t.spark, "documents")
    files.write_json_documents(t.customer, path, "c_custkey")
    return files.read_json(t.spark, path, t.customer.schema, documents=True)


@query(
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id, unnest(string_split(text, chr(10))) AS line FROM documents"""
)
def text_roundtrip(t: Tables) -> DataFrame:
    """Lines of the texts as tab-separated text files."""
    path = shared_path(t.spark, "text")
    rows = t.documents.select("doc_id", F.explode(lines("text")).alias("line"))
    text = F.concat_ws("\t", F.col("doc_id").cast("string"), "line").alias("value")
    files.write_lines(rows.select(text), path, "value")
    return files.read_fields(t.spark, path, ["doc_id", "line"])


def _named(df: DataFrame, key: str, name: str, flag: str) -> DataFrame:
    return df.select(F.col(key).alias("id"), F.col(name).alias("name"), (F.col(flag) > 0).alias("active"))


@query(
    """SELECT c_custkey AS id, c_name AS name, c_acctbal > 0 AS active FROM customer
    UNION SELECT s_suppkey, s_name, s_acctbal > 0 FROM supplier"""
)
def table_union_distinct(t: Tables) -> DataFrame:
    """Customers, suppliers and customers again as tables of one layout, united without duplicates."""
    db = _database(t)
    customers = _named(t.customer, "c_custkey", "c_name", "c_acctbal")
    tables.save_table(customers, f"{db}.table1")
    tables.save_table(_named(t.supplier, "s_suppkey", "s_name", "s_acctbal"), f"{db}.table2")
    tables.copy_table(t.spark, f"{db}.table1", f"{db}.table3")
    return tables.union_tables(t.spark, [f"{db}.table{i}" for i in (1, 2, 3)], f"{db}.united")


@query("SELECT * FROM customer")
def table_copy(t: Tables) -> DataFrame:
    db = _database(t)
    tables.save_table(t.customer, f"{db}.source")
    return tables.copy_table(t.spark, f"{db}.source", f"{db}.copy")


@query("SELECT * FROM orders")
def partitioned_table(t: Tables) -> DataFrame:
    return tables.save_table(t.orders, f"{_database(t)}.orders", ["o_orderstatus"])


@query("SELECT o_orderkey AS id FROM orders")
def external_table_ints(t: Tables) -> DataFrame:
    """A table over Parquet files written before it."""
    path = shared_path(t.spark, "ints")
    files.write_parquet(t.orders.select(F.col("o_orderkey").alias("id")), path)
    return tables.external_parquet(t.spark, f"{_database(t)}.ints", "id BIGINT", path)


@query("SELECT s_suppkey AS id, concat(s_name, ', ', s_nationkey) AS name, s_nationkey AS nation FROM supplier")
def quoted_csv_table(t: Tables) -> DataFrame:
    """Fields with commas inside single quotes, loaded into a table."""
    path = shared_path(t.spark, "quoted")
    name = F.concat_ws(", ", "s_name", F.col("s_nationkey").cast("string")).alias("name")
    rows = t.supplier.select(F.col("s_suppkey").alias("id"), name, F.col("s_nationkey").alias("nation"))
    rows.write.options(quote="'", quoteAll=True).csv(path)
    table = f"{_database(t)}.people"
    tables.quoted_csv_table(t.spark, table, "id BIGINT, name STRING, nation INT")
    tables.load_csv(t.spark, path, table)
    return t.spark.table(table)


@query(" UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS n FROM {name}" for name in TABLES))
def list_tables(t: Tables) -> DataFrame:
    """Tables in a database over the given files, with their sizes."""
    db = _database(t)
    for name in TABLES:
        schema = getattr(t, name).schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        tables.external_parquet(t.spark, f"{db}.{name}", columns, t.path(name))
    listed = tables.table_names(t.spark, db).withColumnRenamed("tableName", "table_name")
    sizes = [
        t.spark.table(f"{db}.{name}").agg(F.count(F.lit(1)).alias("n")).withColumn("table_name", F.lit(name))
        for name in TABLES
    ]
    return listed.join(union_all(sizes), "table_name")
