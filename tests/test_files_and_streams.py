"""Files, tables and streams, each in a folder of its own."""

import json

import pytest
from pyspark.sql import functions as F

from rillwork import session
from rillwork.functions import messages
from rillwork.sources import files, tables
from rillwork.streaming import jobs

EMPLOYEES = "name string, salary double, dob date, active boolean"


def test_csv_with_and_without_schema(spark, rows, tmp_path):
    path = tmp_path / "people.csv"
    path.write_text("name,salary,dob,active\nann1,2000.00,1991-06-15,true\nann2,2001.00,1991-06-16,false\n")
    typed = files.read_csv(spark, str(path), EMPLOYEES)
    assert typed.dtypes == files.read_csv(spark, str(path)).dtypes
    assert typed.filter("active").count() == 1
    out = str(tmp_path / "out")
    files.write_csv(typed, out, one_file=True)
    assert len(list((tmp_path / "out").glob("part-*.csv"))) == 1
    assert rows(files.read_csv(spark, out, EMPLOYEES)) == rows(typed)
    files.write_csv(typed, out, mode="overwrite")
    assert files.read_csv(spark, out, EMPLOYEES).count() == 2


def test_json_documents(spark, rows, tmp_path):
    df = spark.range(1000).select("id", F.concat(F.lit("é "), "id").alias("t"))
    path = str(tmp_path / "docs")
    files.write_json_documents(df, path, "id", records_per_file=100)
    parts = list((tmp_path / "docs").glob("part-*"))
    assert len(parts) == 10
    assert all(isinstance(json.loads(p.read_text()), list) for p in parts)
    assert rows(files.read_json(spark, path, "id bigint, t string", documents=True)) == rows(df)


def test_multi_line_json_array(spark, tmp_path):
    (tmp_path / "zip.json").write_text('[{\n "City": "A",\n "Zipcode": 704\n}, {\n "City": "B",\n "Zipcode": 705\n}]')
    assert files.read_json(spark, str(tmp_path / "zip.json"), documents=True).count() == 2


def test_tab_separated_text(spark, rows, tmp_path):
    (tmp_path / "t.txt").write_text("2018-01-01T11:00:00Z\tu1\n2018-01-01T11:30:00Z\tu2\nonly\n")
    df = files.read_fields(spark, str(tmp_path / "t.txt"), ["at", "user"])
    assert rows(df) == [("2018-01-01T11:00:00Z", "u1"), ("2018-01-01T11:30:00Z", "u2"), ("only", None)]


@pytest.fixture
def database(spark):
    name = "t_" + session.shared_path(spark, "db").rsplit("-", 1)[-1]
    tables.make_database(spark, name, session.shared_path(spark, name))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_quoted_csv_table(spark, rows, tmp_path, database):
    (tmp_path / "bays.csv").write_text("7,'north, upper',12,'open'\n8,'south, lower',40,'shut'\n")
    table = f"{database}.bays"
    tables.quoted_csv_table(spark, table, "bay INT, place STRING, seats INT, state STRING")
    tables.load_csv(spark, str(tmp_path / "bays.csv"), table)
    assert rows(spark.table(table)) == [(7, "north, upper", 12, "open"), (8, "south, lower", 40, "shut")]
    copy = tables.save_table(spark.table(table), f"{database}.by_state", ["state"])
    open_ones = copy.filter("state = 'open'")
    assert rows(open_ones.select("bay", "seats")) == [(7, 12)]
    assert "PartitionFilters: [isnotnull(state" in open_ones._jdf.queryExecution().executedPlan().toString()
    spark.range(1).createOrReplaceTempView("passing")
    assert rows(tables.table_names(spark, database)) == [("bays",), ("by_state",)]


def test_union_tables_and_external_table(spark, tmp_path, database):
    for i in (1, 2, 3):
        df = spark.createDataFrame([(f"n{i % 2}", float(i % 2))], "name string, salary double")
        tables.save_table(df, f"{database}.t{i}")
    united = tables.union_tables(spark, [f"{database}.t{i}" for i in (1, 2, 3)], f"{database}.u")
    assert united.count() == 2
    files.write_parquet(spark.range(1, 20), str(tmp_path / "ints"))
    ints = tables.external_parquet(spark, f"{database}.ints", "id BIGINT", str(tmp_path / "ints"))
    assert ints.count() == 19
    assert tables.copy_table(spark, f"{database}.ints", f"{database}.copy").count() == 19


class StubSession:
    """Just enough of a session to ask where shared data goes."""

    def __init__(self, master, setting=None):
        self.master, self.folder = master, None
        self.conf, self.sparkContext = self, self
        self.setting = setting

    def get(self, key, default):
        return self.setting or default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shared_folder_comes_from_the_session():
    named = StubSession("yarn", "hdfs:///shared/")
    assert session.shared_path(named, "x").startswith("hdfs:///shared/x-")
    assert named.folder == "hdfs:///shared/"
    with pytest.raises(ValueError):
        session.shared_root(StubSession("yarn"))
    local = StubSession("local[2]")
    assert session.shared_root(local) == session.shared_root(local) == local.folder


PERSON = "id int, firstname string, salary int"


def put(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    hidden = folder / f".{name}"
    hidden.write_text("".join(line + "\n" for line in lines))
    hidden.rename(folder / name)


def test_json_stream_to_files_goes_on_after_restart(spark, rows, tmp_path):
    source = tmp_path / "in"
    put(source, "1.json", '{"id":1,"firstname":"James ","salary":3000}', "{broken")

    def run():
        df = jobs.stream_files(spark, str(source), PERSON)
        jobs.finish(jobs.append_files(df, str(tmp_path / "out"), str(tmp_path / "cp"), drain=True))
        return rows(spark.read.parquet(str(tmp_path / "out")))

    assert run() == [(1, "James ", 3000), (None, None, None)]
    put(source, "2.json", '{"id":6,"firstname":"Jenou","salary":900}', '{"id":6,"firstname":"Jenou","salary":900}')
    assert run().count((6, "Jenou", 900)) == 2
    assert len(run()) == 4


@pytest.mark.parametrize("sink", ["complete", "update"])
def test_counts_over_several_batches(spark, rows, tmp_path, sink):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        df = jobs.stream_files(spark, str(source), "Zipcode string", maxFilesPerTrigger="1")
        counted = jobs.counts(df, ["Zipcode"])
        if sink == "complete":
            query = jobs.replace_each_batch(counted, out, checkpoint, drain=True)
        else:
            query = jobs.upsert_each_batch(counted, out, ["Zipcode"], checkpoint, drain=True)
        jobs.finish(query)
        return rows(jobs.last_version(spark, out))

    put(source, "1.json", '{"Zipcode":"704"}', '{"Zipcode":"704"}', '{"Zipcode":"709"}')
    put(source, "2.json", '{"Zipcode":"704"}')
    assert run() == [("704", 3), ("709", 1)]
    put(source, "3.json", '{"Zipcode":"708"}', '{"Zipcode":"709"}')
    assert run() == [("704", 3), ("708", 1), ("709", 2)]


def test_console(spark, tmp_path, capfd):
    put(tmp_path / "in", "1.json", '{"id":1,"firstname":"James","salary":3000}')
    df = jobs.stream_files(spark, str(tmp_path / "in"), PERSON)
    jobs.finish(jobs.show_on_console(df, str(tmp_path / "cp"), drain=True))


def test_sql_over_frames(spark, rows):
    df = tables.sql_over("SELECT a.id FROM {a} a JOIN {b} b ON a.id = b.id", a=spark.range(5), b=spark.range(3, 9))
    assert rows(df) == [(3,), (4,)]


def test_envelope_round_trip(spark, rows):
    df = spark.createDataFrame([("iphone", "2007"), ("iphone 3G", "2008")], "k string, v string")
    sent = messages.to_envelope(df, F.col("k"), F.col("v"), "t", F.lit(1), F.current_timestamp())
    want = spark.createDataFrame([], messages.ENVELOPE)
    assert sent.dtypes == want.dtypes
    assert rows(messages.text_of(sent, "topic")) == [("iphone", "2007", "t"), ("iphone 3G", "2008", "t")]


def test_codecs(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string")
    sent = df.select(messages.encode(F.struct("*"), "json").alias("value"))
    assert sent.dtypes == [("value", "binary")]
    assert rows(jobs.redecode(sent, "json", "id int, name string")) == [(1, "a"), (2, None)]
    again = jobs.reencode(sent, "id int, name string", "json")
    assert rows(messages.decode_json(again, "id int, name string")) == [(1, "a"), (2, None)]
    with pytest.raises(ValueError):
        messages.encode(F.struct(F.lit(1)), "xml")
