from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from triagegrid import session
from triagegrid.analog import Tables
from triagegrid.model import TABLES, conform
from triagegrid.sources import history, readers, sinks


def test_csv_short_and_long_lines(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('made by hand\nid,name,"the note"\n1,a,x\n2,b\n3,c,x,y\n4,"d,1","say ""hi"""\n\n5\n6,,\n7,e,,\n')
    got = readers.csv_all_text(spark, str(path), skip_rows=1, names={"name": "label"})
    assert got.columns == ["id", "label", "the note"]
    assert all(kind == "string" for _, kind in got.dtypes)
    assert rows_of(got) == [
        ("1", "a", "x"), ("2", "b", None), ("4", "d,1", 'say "hi"'), ("5", None, None), ("6", None, None),
    ]


def test_csv_heads_are_dropped_by_place(spark, tmp_path):
    (tmp_path / "a.csv").write_text("made 1 Jan\nid,name\n1,a\nid,name\nmade 1 Jan\n")
    (tmp_path / "b.csv").write_text("made 2 Jan\nid,name\n2,b\n")
    got = rows_of(readers.csv_all_text(spark, str(tmp_path), skip_rows=1))
    assert got == [("1", "a"), ("2", "b"), ("id", "name"), ("made 1 Jan", None)]


def test_csv_separator_and_given_fields(spark, tmp_path):
    path = tmp_path / "in.txt"
    path.write_text("1|x\n2|y|z\n")
    assert rows_of(readers.csv_all_text(spark, str(path), sep="|", fields=["a", "b"])) == [("1", "x")]


def test_rename_applies_to_empty_frames(spark):
    df = spark.createDataFrame([], "a INT, b INT")
    assert readers.rename(df, {"a": "x", "zz": "y"}).columns == ["x", "b"]


def test_query_with_parameters(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k INT, v STRING")
    got = readers.query(spark, "SELECT k, v FROM {t} WHERE k >= :low", {"t": df}, {"low": 2}, {"v": "value"})
    assert got.columns == ["k", "value"] and rows_of(got) == [(2, "b")]


def test_jdbc_options():
    options = readers.jdbc_ranges("jdbc:x", "tickets", "ticketid", 0, 100, 8)
    assert options["numPartitions"] == "8" and options["partitionColumn"] == "ticketid" and options["upperBound"] == "100"


def test_csv_sink_writes_blanks_for_nulls(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ('say "hi"', "b,c")], "x STRING, y STRING").coalesce(1)
    target = sinks.write_csv(df, str(tmp_path), "20211210")
    assert target.endswith("report_date=20211210")
    lines = [r.value for r in spark.read.text(target).collect()]
    assert lines == ["x,y", "a,", '"say ""hi""","b,c"']


def test_append_table_checks_names(spark):
    table = f"history_{session.uuid.uuid4().hex}"
    one = spark.createDataFrame([(1, "a")], "k INT, v STRING")
    try:
        sinks.append_table(one, table)
        sinks.append_table(spark.createDataFrame([("b", 2)], "v STRING, k INT"), table)
        sinks.append_table(spark.createDataFrame([(3,)], "k INT"), table)
        assert rows_of(spark.table(table)) == [(1, "a"), (2, "b"), (3, None)]
        with pytest.raises(ValueError, match="no columns"):
            sinks.append_table(spark.createDataFrame([(1,)], "other INT"), table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_snapshot_rerun_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "history")
    df = spark.createDataFrame([("TT-1", "x")], "`Ticket ID` STRING, Area STRING")
    for day in ("2021-12-09", "2021-12-10", "2021-12-10"):
        sinks.write_snapshot(df, path, day)
    got = spark.read.parquet(path)
    assert rows_of(got.selectExpr("ticket_id", "area", "CAST(asof AS STRING)")) == [
        ("TT-1", "x", "2021-12-09"), ("TT-1", "x", "2021-12-10"),
    ]
    sinks.write_snapshot(df.limit(0), path, "2021-12-10")
    assert rows_of(spark.read.parquet(path).selectExpr("CAST(asof AS STRING)")) == [("2021-12-09",)]


def test_a_failing_write_leaves_the_day(spark, tmp_path):
    path = str(tmp_path / "history")
    df = spark.createDataFrame([("TT-1", "x")], "`Ticket ID` STRING, Area STRING")
    sinks.write_snapshot(df, path, "2021-12-09")
    bad = df.withColumn("Area", F.raise_error(F.concat(F.lit("no area for "), "Ticket ID")).cast("string"))
    with pytest.raises(Exception, match="no area for TT-1"):
        sinks.write_snapshot(bad, path, "2021-12-09")
    held = spark.read.parquet(path)
    assert rows_of(held.select("ticket_id", "area")) == [("TT-1", "x")]
    # A day that is made from the history itself.
    sinks.write_snapshot(held.selectExpr("concat(ticket_id, 'b') AS `Ticket ID`", "area AS Area"), path, "2021-12-09")
    assert rows_of(spark.read.parquet(path).select("ticket_id", "area")) == [("TT-1b", "x")]
    assert [n for n in os.listdir(path) if n.startswith("_old")] == []


def test_history_of_changes_gives_every_day(spark, tmp_path):
    path = str(tmp_path / "changes")
    tables = {
        "1": [("a", 1), ("b", 2), ("b", 2), (None, None)], "3": [("a", 1), ("b", 2), ("c", 3)], "4": [], "2": [("a", 5), ("b", 2), ("b", 2), ("b", 2)],
    }
    write = lambda day, rows: history.write_day(spark.createDataFrame(rows, "k STRING, v INT"), path, day)
    for day, rows in tables.items():
        write(day, rows)
    tables["3"] = [("x", 9)]
    write("3", tables["3"])
    for day, rows in tables.items():
        assert rows_of(history.as_of(spark, path, day)) == sorted(rows, key=repr), day
        before = sorted(os.listdir(path))
        write(day, rows)
        assert [n for n in sorted(os.listdir(path)) if not n.startswith("_")] == [n for n in before if not n.startswith("_")]
        assert rows_of(history.as_of(spark, path, day)) == sorted(rows, key=repr)
    assert rows_of(history.as_of(spark, path, "9")) == [] and rows_of(history.as_of(spark, path, "0")) == []
    assert history.days(spark, path) == ["1", "2", "3", "4"]
    stored = spark.read.parquet(path).where("asof = 1")
    assert stored.count() == 3
    with pytest.raises(ValueError, match="history itself"):
        history.write_day(spark.range(1).withColumnRenamed("id", "asof"), path, "5")


def test_a_task_of_a_history_takes_one_partition(spark, tmp_path):
    """What a task holds is bounded by the number of shuffle partitions, not by the cores, for a day, its changes and the day after."""
    path, rows = str(tmp_path / "changes"), spark.range(5000).selectExpr("concat('r', id) AS r", "id % 6 AS k")
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        for day, part in (("1", rows), ("3", rows.where("k % 2 = 0")), ("2", rows.where("k % 3 = 0"))):
            history.write_day(part, path, day)
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    for day in "123":
        assert sum(n.endswith(".parquet") for n in os.listdir(f"{path}/asof={day}")) == 40
    assert rows_of(history.as_of(spark, path, "3")) == rows_of(rows.where("k % 2 = 0"))


def test_rows_are_counted_while_they_are_written(spark, tmp_path):
    rows = spark.range(30).repartition(3)
    paths, counts = sinks.write_counted({"one": rows, "none": rows.where("id < 0"), "table": spark.createDataFrame([(1,)], "a INT")}, str(tmp_path))
    assert counts == {"one": 30, "none": 0, "table": 1}
    assert rows_of(sinks.counts_frame(spark, counts)) == [("none", 0), ("one", 30), ("table", 1)]


def test_report_datasets(spark, tmp_path):
    paths = sinks.write_report({"one": spark.range(3), "two": spark.range(2)}, str(tmp_path))
    assert spark.read.parquet(paths["one"]).count() == 3 and paths["two"].endswith("two")


def test_shared_dir_follows_the_session(spark):
    class Context:
        master = "spark://cluster:7077"

        def __init__(self):
            self.dir = None

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, path):
            self.dir = path

    class Session:
        def __init__(self, named):
            self.sparkContext = Context()
            self.conf = {session.CHECKPOINT_KEY: named} if named else {}

    named = Session("/shared/x")
    assert session.shared_dir(named) == "/shared/x" and named.sparkContext.dir == "/shared/x"
    with pytest.raises(RuntimeError, match="shared by all executors"):
        session.shared_dir(Session(None))
    assert session.shared_dir(spark)


def test_analog_tables_have_the_canonical_columns(spark):
    tables = Tables(spark, "/root/testdata/sf0.001")
    for name, schema in TABLES.items():
        assert set(tables[name].columns) == set(schema.names), name
        assert conform(tables[name], name).columns == schema.names
