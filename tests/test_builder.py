from __future__ import annotations

import operator
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from triagegrid.operators import edits
from triagegrid.operators.builder import TableQuery, TicketFrame, listed
from triagegrid.operators.predicates import literal
from triagegrid.operators.range_join import ROWS, Buckets, bucketed, range_join


@pytest.fixture
def query(spark):
    people = spark.createDataFrame(
        [(1, "a", 10), (2, "b", 20), (3, "a", 30), (4, None, 40)], "id INT, team STRING, score INT"
    )
    teams = spark.createDataFrame([("a", "Alpha", 15), ("b", "Beta", 100)], "code STRING, label STRING, least INT")
    return TableQuery(spark, {"people": people, "teams": teams})


def test_no_clauses_gives_the_table(query):
    assert query.table("people").get().count() == 4


def test_and_binds_tighter_than_or(query):
    q = query.table("people").select("id").where(["team", "b"]).orWhere(["team", "a"]).where(["score", ">", 20])
    assert rows_of(q.get()) == [(2,), (3,)]


def test_group_changes_precedence(query):
    q = query.table("people").select(["id"])
    q.groupWhere("open")
    q.where(["team", "b"])
    q.groupWhere("close")
    q.orWhere(["team", "a"]).where(["score", ">", 10])
    assert rows_of(q.get()) == [(2,), (3,)]


def test_group_in_the_middle(query):
    q = query.table("people").select(["id"]).where(["score", ">", 10])
    q.groupWhere("open")
    q.where(["team", "a"])
    q.groupWhere("close")
    q.orWhere(["team", "IS", "NULL"])
    assert rows_of(q.get()) == [(3,), (4,)]


def test_open_group_must_close(query):
    q = query.table("people")
    q.groupWhere("open")
    with pytest.raises(ValueError, match="not closed"):
        q.where(["team", "a"]).get()


def test_between_like_and_null(query):
    assert rows_of(query.table("people").select("id").where(["score", 10, 20], between=True).get()) == [(1,), (2,)]
    assert rows_of(query.table("people").select("id").where(["team", "like", "%a%"]).get()) == [(1,), (3,)]
    assert rows_of(query.table("people").select("id").where(["team", "NULL"]).get()) == []
    for parts in (["x"], ["a", "=", 1, 2]):
        with pytest.raises(ValueError, match="two or three"):
            query.table("people").where(parts)
    with pytest.raises(ValueError, match="unknown comparison"):
        query.table("people").where(["id", "~", 1])


def test_joins(query):
    q = query.table("people").join("teams", ["team", "code"], "LEFT").select(["id", "label"])
    assert rows_of(q.get()) == [(1, "Alpha"), (2, "Beta"), (3, "Alpha"), (4, None)]
    q = query.table("people").join("teams", [["team", "code"], ["score", ">=", "least"]]).select("id")
    assert rows_of(q.get()) == [(3,)]


def test_joins_without_equality(query):
    q = query.table("people").join("teams", ["score", ">", "least"]).select(["id", "code"])
    text = q.get()._jdf.queryExecution().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text
    q = query.table("people").join("teams", ["score", ">", "least"]).select(["id", "code"])
    assert rows_of(q.get()) == [(2, "a"), (3, "a"), (4, "a")]
    q = query.table("people").join("teams", ["score", ">", "least"], "LEFT").select(["id", "code"])
    assert rows_of(q.get()) == [(1, None), (2, "a"), (3, "a"), (4, "a")]
    with pytest.raises(ValueError, match="all_pairs asks"):
        query.table("people").join("teams", ["team", "<>", "code"])
    q = query.table("people").join("teams", ["team", "<>", "code"], all_pairs=True).select(["id", "code"])
    assert rows_of(q.get()) == [(1, "b"), (2, "a"), (3, "b")]
    with pytest.raises(ValueError, match="a join condition is"):
        query.table("people").join("teams", ["team", "~", "code"])


def test_names_that_several_tables_share(spark):
    people = spark.createDataFrame([(1, "a", 7), (2, "b", 8), (3, "a", None)], "id INT, name STRING, boss INT")
    bosses = spark.createDataFrame([(7, "x"), (8, "y"), (9, "z")], "id INT, name STRING")
    q = TableQuery(spark, {"people": people, "bosses": bosses})
    got = q.table("people").join("bosses", ["boss", "id"], "LEFT").where(["people.id", "<", 3])
    got = got.select(["people.id", "bosses.name AS boss", "people.name"]).orderBy(["bosses.name", "people.id"], "DESC").get()
    assert [tuple(r) for r in got.collect()] == [(2, "y", "b"), (1, "x", "a")]
    q.table("people").join("bosses", ["people.boss", "bosses.id"]).groupBy("bosses.name").orderBy("bosses.name")
    assert [tuple(r) for r in q.select(["bosses.name", "count(people.id) AS n"]).get().collect()] == [("x", 1), ("y", 1)]
    q.table("people").join("bosses", ["id", "id"], "LEFT").select("people.id, bosses.id AS other")
    assert rows_of(q.get()) == [(1, None), (2, None), (3, None)]
    assert q.table("people").join("bosses", ["boss", "id"]).get().columns == ["id", "name", "boss", "id", "name"]
    assert [r.id for r in q.table("people").where(["people.id", 2]).get().collect()] == [2]


def test_group_order_limit(query):
    q = query.table("people").select(["team", "count(*) AS n", "sum(score) AS s"]).groupBy("team").orderBy("team", "desc")
    assert [tuple(r) for r in q.get().collect()] == [(None, 1, 40), ("b", 1, 20), ("a", 2, 40)]
    q = query.table("people").select("id").orderBy(["score"]).limit(2, 1)
    assert [r.id for r in q.get().collect()] == [2, 3]


def test_texts_with_several_names(query):
    assert listed("team, concat_ws(',', team, 'x') AS t, count(*) AS n") == ["team", "concat_ws(',', team, 'x') AS t", "count(*) AS n"]
    q = query.table("people").select("team, id").orderBy("team, id", "desc")
    assert [tuple(r) for r in q.get().collect()] == [(None, 4), ("b", 2), ("a", 3), ("a", 1)]
    q = query.table("people").select("team, id, count(*) AS n").groupBy("team, id").orderBy("id, team")
    assert [tuple(r) for r in q.get().collect()] == [("a", 1, 1), ("b", 2, 1), ("a", 3, 1), (None, 4, 1)]


OPERATORS = {"<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "left_semi", "left_anti"])
@pytest.mark.parametrize("ops", [["<"], [">="], [">=", "<"], [">", "<="], ["<", "<="]])
def test_range_joins_equal_all_pairs_tested(spark, how, ops):
    rng = random.Random(len(ops) + len(how))
    left = [(i, rng.choice([None, 5, 5, 5, rng.randint(0, 50)])) for i in range(60)]
    right = [(j, rng.choice([None, rng.randint(0, 45)]), rng.choice([None, rng.randint(10, 60)])) for j in range(40)]
    a, b = spark.createDataFrame(left, "i INT, v INT"), spark.createDataFrame(right, "j INT, p INT, q INT")
    names = ["p", "q"][: len(ops)]
    ranges = [(a["v"], op, b[n]) for op, n in zip(ops, names)]

    def meet(x, y):
        return all(x[1] is not None and y[1 + k] is not None and OPERATORS[op](x[1], y[1 + k]) for k, op in enumerate(ops)) and x[0] != y[0]

    pairs = [(x, y) for x in left for y in right if meet(x, y)]
    alone = [x for x in left if not any(x == p[0] for p in pairs)]
    lonely = [y for y in right if not any(y == p[1] for p in pairs)]
    want = {"left_semi": [x for x in left if x not in alone], "left_anti": alone}.get(how) or [(*x, *y) for x, y in pairs]
    want += [(*x, None, None, None) for x in alone] if how in ("left", "full") else []
    want += [(None, None, *y) for y in lonely] if how in ("right", "full") else []
    out = range_join(a, b, ranges, how, [a["i"] != b["j"]])
    assert rows_of(out) == sorted(want, key=repr)


def test_tests_of_a_range_join_grow_with_its_rows(spark):
    """Half of the left rows are one value, the others lie in two blocks; most ranges are in the gap, beyond the ends or beside the hot value."""
    n = 40_000
    v = F.when(F.col("id") % 2 == 0, 5.5).when(F.col("id") % 4 == 1, F.col("id") / n).otherwise(100 + F.col("id") / n)
    a = spark.range(n).select("id", v.alias("v"))
    b = spark.range(n).select(F.col("id").alias("j"), F.when(F.col("id") % 2 == 0, F.col("id") / 100 - 150).otherwise(5.6 + F.col("id") / n).alias("p"))
    b = b.withColumn("q", F.col("p") + 0.01)
    ranges = [(a["v"], ">=", b["p"]), (a["v"], "<", b["q"])]
    placed, reached = bucketed(a, b, ranges)
    of = reached.groupBy("__of").count()
    tests = placed.groupBy("__bucket").count().withColumnRenamed("count", "n").join(of, F.col("__bucket") == F.col("__of")).agg(F.sum(F.col("n") * F.col("count"))).first()[0]
    got = range_join(a, b, ranges).select("id", "j")
    every = a.hint("broadcast").join(b, (a["v"] >= b["p"]) & (a["v"] < b["q"])).select("id", "j")
    assert got.exceptAll(every).isEmpty() and every.exceptAll(got).isEmpty() and got.count() > n // 2
    assert reached.count() < n // 10 and tests <= got.count() + 2 * ROWS * reached.select("j").distinct().count()


def test_a_hot_value_has_a_bucket_of_its_own(spark):
    df = spark.range(8000).select(F.when(F.col("id") < 4000, 7.0).otherwise(F.col("id") / 1000).alias("v"))
    made = Buckets(df, F.col("v"), 4, 500)
    at = made.lows.index(7.0)
    assert made.highs[at] == 7.0 and made.lows == sorted(made.lows) and len(made) >= 8 and made.highs[at + 1] > made.lows[at + 1] > 7.0


def test_buckets_of_texts_and_empty_sides(spark):
    a = spark.createDataFrame([("b",), ("d",), (None,)], "v STRING")
    b = spark.createDataFrame([("a", "c"), ("c", "e")], "p STRING, q STRING")
    ranges = [(a["v"], ">=", b["p"]), (a["v"], "<", b["q"])]
    assert rows_of(range_join(a, b, ranges)) == [("b", "a", "c"), ("d", "c", "e")]
    assert range_join(a.where("false"), b, ranges).count() == 0 and range_join(a, b.where("false"), ranges, "left").count() == 3


def test_edits_make_new_versions(query):
    first = query.tables["people"]
    query.table("people").insert({"id": 9, "score": 5})
    query.table("people").where(["team", "a"]).update({"team": "z", "score": "NULL"})
    query.table("people").where(["score", ">=", 40]).delete()
    assert rows_of(query.tables["people"]) == [(1, "z", None), (2, "b", 20), (3, "z", None), (9, None, 5)]
    assert first.count() == 4
    query.table("people").delete()
    assert query.tables["people"].count() == 0


def test_unknown_column_is_an_error(query):
    with pytest.raises(ValueError, match="no such columns"):
        query.table("people").insert({"nope": 1})


def test_literal_kinds(spark):
    row = spark.range(1).select(
        literal(1).alias("i"), literal("NULL").alias("n"), literal(datetime(2021, 2, 3, 4)).alias("d"), literal("x").alias("s")
    ).first()
    assert tuple(row) == (1, None, date(2021, 2, 3), "x")


def test_insert_columns_shift(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a INT, b INT, c INT")
    got = edits.insert_columns(df, [(2, "x", F.lit("")), (1, "y", F.lit("")), (4, "z", F.lit(""))])
    assert got.columns == ["a", "y", "b", "x", "z", "c"]


def test_frame_chain(spark):
    df = spark.createDataFrame([(2, "b", None), (1, "a", "x"), (1, "c", "y")], "k INT, v STRING, w STRING")
    frame = TicketFrame(spark, df).setColsToRename({"w": "note"}).renameCols().fillNulls("note", "-")
    assert frame.select(["k", "note"]).columns == ["k", "note"]
    assert rows_of(frame.duplicates(["k"], ["v"])) == [(1, "c", "y")]
    frame.updateCell("v", "a", "note", "seen").dropDuplicates(["k"], ["v"]).reindex(["k"])
    assert [tuple(r) for r in frame.df.orderBy("index").collect()] == [(0, 1, "a", "seen"), (1, 2, "b", "-")]
