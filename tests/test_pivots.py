"""Pivots and summaries against pandas on random rows with nulls in keys and values."""

from __future__ import annotations

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from triagegrid.operators import grids
from triagegrid.operators import pivots as P

SCHEMA = "area STRING, kind STRING, tech STRING, ticket STRING, hours DOUBLE"


def sample(seed, n=80):
    rng = random.Random(seed)

    def pick(values):
        return rng.choice([*values, None])

    return [
        (pick(["MM", "NL", "SL"]), pick(["SA", "PSA"]), pick(["2G", "3G", "5G"]), pick(["a", "b", "c"]),
         rng.choice([None, float(rng.randint(-50, 500)) / 4]))
        for _ in range(n)
    ]


def by_pandas(rows, index, column, value, how):
    pdf = pd.DataFrame(rows, columns=["area", "kind", "tech", "ticket", "hours"])
    table = pdf.pivot_table(index=index, columns=column, values=value, aggfunc=how, margins=True)
    cells = {}
    for key, row in table.iterrows():
        key = key if isinstance(key, tuple) else (key,)
        for name, v in row.items():
            cells[(*key, name)] = None if pd.isna(v) else float(v)
    return cells


def by_spark(df, index):
    cells = {}
    for row in df.collect():
        for name in df.columns:
            if name not in index:
                v = row[name]
                cells[(*(row[i] for i in index), name)] = None if v is None else float(v)
    return cells


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize(("value", "how"), [("ticket", "count"), ("hours", "mean")])
@pytest.mark.parametrize("index", [["area"], ["area", "kind"]])
def test_pivot_equals_pandas(spark, seed, value, how, index):
    rows = sample(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    ours = by_spark(P.pivot_with_total(df, index, "tech", value, how, ["2G", "3G", "5G"]), index)
    theirs = by_pandas(rows, index, "tech", value, how)
    for key in theirs.keys() | ours.keys():
        left, right = ours.get(key), theirs.get(key)
        if left is None or right is None:
            # A cell whose rows hold no value at all: a blank in one, a zero in the other.
            assert (left or 0) == (right or 0), key
        else:
            assert left == pytest.approx(right), key


def test_total_covers_hidden_columns(spark):
    rows = [("MM", "SA", "2G", "a", 1.0), ("MM", "SA", "Other", "b", 1.0), ("MM", "SA", None, "c", 1.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    table = P.pivot_with_total(df, ["area"], "tech", "ticket", "count", ["2G"])
    assert rows_of(table) == [("All", 1, 2), ("MM", 1, 2)]


def test_total_of_means_is_the_mean_of_rows(spark):
    rows = [("MM", None, None, None, 1.0), ("MM", None, None, None, 3.0), ("NL", None, None, None, 10.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(P.mean_with_total(df, "area", "hours")) == [("All", 14 / 3), ("MM", 2.0), ("NL", 10.0)]


def test_row_totals_equal_the_body(spark):
    df = spark.createDataFrame(sample(9, 300), SCHEMA)
    for row in P.pivot_with_total(df, ["area"], "tech", "ticket", "count").collect():
        assert row["All"] == sum(row[c] or 0 for c in ("2G", "3G", "5G"))


def test_empty_input(spark):
    df = spark.createDataFrame([], SCHEMA)
    table = P.pivot_with_total(df, ["area"], "tech", "ticket", "count", ["2G"])
    assert table.collect() == []
    grid = grids.dense_grid(table, ["area"], [["MM", "NL"]], ["2G"], total_column="TOTAL")
    assert [tuple(r) for r in grid.collect()] == [("MM", None, None), ("NL", None, None), ("TOTAL", None, None)]


def test_dense_grid_keeps_report_order(spark):
    df = spark.createDataFrame(sample(3), SCHEMA)
    table = P.pivot_with_total(df, ["area"], "tech", "ticket", "count", ["2G", "3G", "5G"])
    grid = grids.dense_grid(table, ["area"], [["SL", "ZZ", "MM"]], ["5G", "WIFI", "2G"], total_column="TOTAL")
    assert grid.columns == ["area", "5G", "WIFI", "2G", "TOTAL"]
    rows = grid.collect()
    assert [r.area for r in rows] == ["SL", "ZZ", "MM", "TOTAL"]
    assert tuple(rows[1])[1:] == (None, None, None, None)
    assert all(r.WIFI is None for r in rows)


def test_two_level_grids_agree(spark):
    df = spark.createDataFrame(sample(5, 200), SCHEMA)
    table = P.pivot_with_total(df, ["area", "kind"], "tech", "ticket", "count", ["2G", "3G", "5G"])
    fixed = grids.dense_grid(table, ["area", "kind"], [["MM", "NL", "SL"], ["SA", "PSA"]], ["2G", "3G"], "TOTAL", None)
    axis = P.distinct_axis(df, "area")
    found = grids.dense_grid_over(axis, table, ["area", "kind"], ["2G", "3G"], ["SA", "PSA"], "TOTAL", None)
    assert [tuple(r) for r in fixed.collect()] == [tuple(r) for r in found.collect()]
    keyed = df.where(F.col("tech").isNotNull())
    measures = [
        P.Measure("2G", "count", F.col("ticket"), F.col("tech") == "2G"),
        P.Measure("3G", "count", F.col("ticket"), F.col("tech") == "3G"),
        P.Measure("TOTAL", "count", F.col("ticket")),
    ]
    laid = P.with_inner_rows(keyed, "area", "kind", ["SA", "PSA"], measures)
    assert [tuple(r) for r in laid.collect()] == [tuple(r) for r in fixed.collect()]


def test_inner_rows_show_a_value_without_inner_label(spark):
    df = spark.createDataFrame([("MM", None, "2G", "a", 1.0), ("NL", "SA", "2G", "a", 1.0)], SCHEMA)
    measures = [P.Measure("n", "count", F.col("ticket"))]
    got = P.with_inner_rows(df, "area", "kind", ["SA", "PSA"], measures, exclude=["ZZ"])
    assert [tuple(r) for r in got.collect()] == [
        ("MM", "SA", None), ("MM", "PSA", None), ("NL", "SA", 1), ("NL", "PSA", None),
    ]


def test_axis_values(spark):
    df = spark.createDataFrame([("b",), ("a",), ("",), (None,), ("a",), ("NOC",)], "v STRING")
    assert P.axis_values(df, "v", exclude=["NOC"]) == ["a", "b"]
    with pytest.raises(ValueError, match="more than 1"):
        P.axis_values(df, "v", most=1)


def test_group_mean_and_row_counts(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", None), (None, 5.0)], "k STRING, v DOUBLE")
    assert rows_of(P.group_mean(df, "k", "v")) == [("a", 1.5)]
    assert rows_of(P.row_counts({"x": df, "none": df.where("false")})) == [("none", 0), ("x", 4)]


@pytest.mark.parametrize("seed", range(3))
def test_a_lattice_gives_what_the_detail_gives(spark, seed):
    df = spark.createDataFrame(sample(seed, 200), SCHEMA)
    cells = P.lattice(df, ["area", "kind", "tech"], ["ticket"], ["hours"])
    assert cells.frame.count() == df.select("area", "kind", "tech").distinct().count() < 200
    fast = F.col("tech") == "5G"
    measures = [P.Measure("n", "count", "ticket"), P.Measure("n5", "count", "ticket", fast), P.Measure("h", "mean", "hours"), P.Measure("h5", "mean", "hours", fast)]
    for make in (
        lambda x: P.with_total(x, ["area"], measures),
        lambda x: P.with_total(x, ["area", "kind"], measures, require=["tech"]),
        lambda x: P.with_inner_rows(x, "area", "kind", ["SA", "PSA"], measures, exclude=["NL"]),
        lambda x: P.pivot_with_total(x, ["area"], "tech", "ticket", "count"),
        lambda x: P.pivot_with_total(x, ["area", "kind"], "tech", "hours", "mean", ["2G", "9G"]),
        lambda x: P.distinct_axis(x, "kind"),
    ):
        ours, theirs = rows_of(make(cells)), rows_of(make(df))
        assert len(ours) == len(theirs)
        for a, b in zip(ours, theirs):
            assert all(x == y or x == pytest.approx(y) for x, y in zip(a, b)), (a, b)
    none = cells.where(F.lit(False))
    assert P.with_total(none, ["area"], measures).collect() == [] and P.axis_values(none, "tech") == []
    with pytest.raises(ValueError, match="no mean of ticket"):
        P.with_total(cells, ["area"], [P.Measure("x", "mean", "ticket")])


@pytest.mark.parametrize(("value", "how"), [("ticket", "count"), ("hours", "mean")])
def test_pages_side_by_side_are_the_pivot(spark, value, how):
    df = spark.createDataFrame(sample(6, 150), SCHEMA)
    whole = P.pivot_with_total(df, ["area", "kind"], "tech", value, how)
    paged = P.paged_pivot(df, ["area", "kind"], "tech", value, how, page_columns=2)
    labels = [v for n in range(paged.pages) for v in paged.labels(n)]
    assert labels == P.axis_values(df, "tech") and paged.pages == -(-len(labels) // 2) > 1
    cells = {}
    for n in range(paged.pages):
        page = paged.page(n)
        assert page.columns == ["area", "kind", *labels[2 * n : 2 * n + 2], "All"]
        for key, v in by_spark(page, ["area", "kind"]).items():
            assert key not in cells or key[-1] == "All" and cells[key] == v
            cells[key] = v
    want = by_spark(whole, ["area", "kind"])
    assert cells.keys() == want.keys() and all(cells[k] == want[k] or cells[k] == pytest.approx(want[k]) for k in want)


def test_an_axis_of_many_values_gives_pages(spark):
    df = spark.range(40_000).select((F.col("id") % 3).alias("r"), (F.col("id") % 20_000).cast("string").alias("c"))
    paged = P.paged_pivot(df, ["r"], "c", "c", "count", page_columns=500)
    assert paged.pages == 40 and len(paged.labels(39)) == 500
    page = paged.page(7)
    assert page.count() == 4 and len(page.columns) == 502
    total = next(r for r in page.collect() if r.r == "All")
    assert total["All"] == 40_000 and {total[c] for c in paged.labels(7)} == {2}
    assert P.paged_pivot(df.where("false"), ["r"], "c", "c", "count").pages == 0
