"""Dedup, duplicates, sorts, row numbers and deltas against pandas or worked examples."""

from __future__ import annotations

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from triagegrid.operators import dedupe as D
from triagegrid.operators.order_index import PART, OrderIndex


def sample(seed, n=60):
    rng = random.Random(seed)
    return [(rng.randint(1, 8), rng.choice("ab"), rng.randint(1, 6)) for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("keep", ["first", "last"])
def test_keep_and_removed_equal_pandas(spark, seed, keep):
    rows = sample(seed)
    pdf = pd.DataFrame(rows, columns=["k", "s", "v"]).sort_values(["s", "v"]).reset_index(drop=True)
    kept = pdf.drop_duplicates(subset=["k"], keep=keep)
    df = spark.createDataFrame(rows, "k INT, s STRING, v INT")
    assert rows_of(D.keep_one(df, ["k"], ["s", "v"], keep)) == sorted(map(tuple, kept.to_numpy().tolist()), key=repr)
    both = pd.concat([pdf, kept]).reset_index(drop=True)
    once = [i[0] for i in both.groupby(list(both.columns)).groups.values() if len(i) == 1]
    expected = sorted(map(tuple, both.loc[once].to_numpy().tolist()), key=repr)
    assert rows_of(D.removed_rows(df, ["k"], ["s", "v"], keep)) == expected


def test_keep_one_orders_nulls_last_and_groups_null_keys(spark):
    df = spark.createDataFrame([("a", None), ("a", 2), (None, 1), (None, 3)], "k STRING, v INT")
    assert rows_of(D.keep_one(df, ["k"], ["v"])) == [("a", 2), (None, 1)]
    assert rows_of(D.keep_one(df, ["k"], ["v"], "last")) == [("a", None), (None, 3)]


def test_whole_row_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k INT, v STRING")
    assert rows_of(D.keep_one(df, [], [])) == [(1, "a"), (2, "b")]
    assert rows_of(D.removed_rows(df, [], [])) == [(1, "a")]


def test_worst_per_key(spark):
    rows = [
        ("s1", "Minor", 10.0, "w3"), ("s1", "Critical", 20.0, "w2"), ("s1", "Critical", None, "w1"),
        ("s2", "Odd", 4.0, "w5"), ("s2", "Low", 6.0, "w6"), (None, "Critical", 1.0, "w7"), ("s3", None, None, "w8"),
    ]
    df = spark.createDataFrame(rows, "site STRING, sev STRING, hours DOUBLE, wo STRING")
    got = rows_of(D.worst_per_key(df, "site", "sev", "hours", "wo"))
    assert got == [("s1", "Critical", 15.0, "w1"), ("s2", "Low", 5.0, "w6"), ("s3", None, None, "w8")]


def test_row_index_is_dense_over_partitions(spark):
    df = spark.range(5000).repartition(7).withColumn("v", F.pmod(F.col("id") * 7919, F.lit(5003)))
    got = D.row_index(df, [F.col("v").asc()], "n").orderBy("n").collect()
    assert [r.n for r in got] == list(range(5000))
    assert [r.v for r in got] == sorted(r.v for r in got)
    empty = D.row_index(df.where("false"), [F.col("v").asc()], "n")
    assert empty.collect() == [] and empty.columns == ["n", "id", "v"]


def test_sorts(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "x STRING")
    assert [r.x for r in D.sort_rows(df, "x").collect()] == ["a", "b", None]
    assert [r.x for r in D.sort_rows(df, ["x"], "desc").collect()] == [None, "b", "a"]
    with pytest.raises(ValueError, match="ASC or DESC"):
        D.sort_rows(df, "x", "UP")
    levels = spark.createDataFrame([("Low",), ("odd",), ("High",), (None,)], "x STRING")
    up = D.sort_by_category(levels, "x", ["High", "Low"])
    down = D.sort_by_category(levels, "x", ["High", "Low"], ascending=False)
    assert [r.x for r in up.collect()] == ["High", "Low", None, None]
    assert [r.x for r in down.collect()] == ["Low", "High", None, None]


def test_stack_and_delta(spark):
    one = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "k INT, v STRING")
    two = spark.createDataFrame([("c", 3), ("a", 1)], "v STRING, k INT")
    assert rows_of(D.delta(one, two)) == [(3, "c")]
    third = spark.createDataFrame([(9,)], "k INT")
    assert rows_of(D.stack([one, third])) == [(1, "a"), (2, "b"), (2, "b"), (9, None)]


def test_offset(spark):
    df = D.sort_rows(spark.range(10), "id")
    assert [r.id for r in D.first_rows(df, 3, 4).collect()] == [4, 5, 6]


def test_deep_pages_come_in_order_from_the_index(spark, monkeypatch):
    df = spark.range(3000).repartition(5).withColumn("v", F.pmod(F.col("id"), F.lit(40)))
    want = [tuple(r) for r in D.sort_rows(df, "v", "DESC").collect()]
    monkeypatch.setattr(D, "TASK_ROWS", 10)
    for limit, offset in ((700, 0), (1200, 333), (9000, 2990), (0, 20), (5, 4000)):
        got = D.first_rows(df, limit, offset, D.sort_keys("v", "DESC"))
        assert [tuple(r) for r in got.collect()] == want[offset : offset + limit]
    assert D.first_rows(df, 100).count() == 100 and D.first_rows(df.where("false"), 100).count() == 0


def test_slices_read_only_their_ranges(spark):
    index = OrderIndex(spark.range(8000).repartition(8), [F.col("id")], ranges=8)
    assert len(index.parts) > 4 and len(index) == 8000
    page = index.slice(10, index.starts[2] + 1)
    assert [r.id for r in page.collect()] == list(range(index.starts[2] + 1, index.starts[2] + 11))
    text = page._jdf.queryExecution().toString()
    assert f"{PART}" in text and "PartitionFilters: [isnotnull(__part" in text and "SinglePartition" not in text
    with pytest.raises(ValueError, match="already there"):
        OrderIndex(spark.range(3).withColumn(PART, F.lit(1)), [])


def test_copies_of_one_row_spread_over_ranges(spark):
    df = spark.range(0, 20_000, 1, 8).select(F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id")).alias("k"))
    index = OrderIndex(df, [F.col("k")], ranges=8)
    sizes = [b - a for a, b in zip(index.starts, index.starts[1:])]
    assert max(sizes) < 8000
    assert [r.n for r in index.numbered("n").orderBy("n").collect()] == list(range(20_000))
