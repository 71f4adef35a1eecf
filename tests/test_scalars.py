from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from triagegrid.functions import classify as C
from triagegrid.functions import fixed
from triagegrid.functions import scalars as S


def values(spark, rows, schema, *exprs):
    """Rows in their given order through the expressions."""
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"n INT, {schema}")
    return [tuple(r) for r in df.orderBy("n").select(*exprs).collect()]


def column(spark, items, kind, expr):
    return [r[0] for r in values(spark, [(i,) for i in items], f"x {kind}", expr)]


def test_strip_text_makes_empty_missing(spark):
    got = column(spark, ["BusinessStatusNew", "BusinessStatus", None, "plain"], "STRING", S.strip_text("x", "BusinessStatus"))
    assert got == ["New", None, None, "plain"]


def test_braced_value(spark):
    got = column(spark, ['{"group":"77"}', '{"group":"a}b"}', None], "STRING", S.braced_value("x"))
    assert got == ["77", "a}b", None]


def test_first_item_with(spark):
    items = ["ab;FFS_1;xFFS", "FFS", "a;b", None, ";FFS;", "FF;S"]
    assert column(spark, items, "STRING", S.first_item_with("x", "FFS")) == ["FFS_1", "FFS", None, None, "FFS", None]


def test_local_time_and_texts(spark):
    at = datetime(2021, 12, 9, 16, 30, 5, 999000)
    text, month, cut = values(
        spark, [(at,)], "x TIMESTAMP", S.local_text("x"), S.month_name_text(S.local_time("x")), S.whole_second("x")
    )[0]
    assert (text, month, cut) == ("2021-12-10 00:30:05", "10-DEC-2021 00:30:05", at.replace(microsecond=0))


def test_map_values_keeps_the_rest(spark):
    got = column(spark, ["FDLTE", "TDLTE", "3G", None], "STRING", C.technology_label("x"))
    assert got == ["FD-LTE", "TD-LTE", "3G", None]
    got = column(spark, ["isYes", "isNo", "other", None], "STRING", C.affecting_type("x"))
    assert got == ["SA", "PSA", None, None]


def test_parse_time(spark):
    assert column(spark, ["bad", None], "STRING", S.parse_time("x", lenient=True)) == [None, None]
    with pytest.raises(Exception, match="CANNOT_PARSE|could not be parsed"):
        column(spark, ["bad"], "STRING", S.parse_time("x"))


@settings(max_examples=20, deadline=None)
@given(st.lists(st.integers(-200_000, 200_000), min_size=1, max_size=20))
def test_duration_text_equals_timedelta(spark, minutes):
    def expected(m):
        span = timedelta(minutes=m)
        return f"{span.days} days {span.seconds // 3600:02d}:{span.seconds // 60 % 60:02d}"

    assert column(spark, minutes, "BIGINT", S.duration_text(F.col("x"))) == [expected(m) for m in minutes]


AS_OF = datetime(2021, 12, 10, 12, 0, 0)


@pytest.mark.parametrize(
    ("span", "hours", "bucket"),
    [
        (timedelta(hours=3, minutes=59, seconds=59), 3 + 59 / 60, "<4Hrs"),
        (timedelta(hours=4), 4.0, "4Hrs-24Hrs"),
        (timedelta(hours=24), 24.0, "4Hrs-24Hrs"),
        (timedelta(hours=24, seconds=59), 24.0, "4Hrs-24Hrs"),
        (timedelta(hours=24, minutes=1), 24 + 1 / 60, ">24Hrs"),
        (timedelta(seconds=-1), -1 / 60, "<4Hrs"),
    ],
)
def test_aging(spark, span, hours, bucket):
    aging = C.aging_hours("x", AS_OF)
    got = values(spark, [(AS_OF - span,)], "x TIMESTAMP", aging, C.aging_bucket(aging))[0]
    assert got == (pytest.approx(hours), bucket)


def test_aging_of_nothing(spark):
    aging = C.aging_hours("x", AS_OF)
    assert values(spark, [(None,)], "x TIMESTAMP", aging, C.aging_bucket(aging), C.aging_text("x", AS_OF)) == [(None,) * 3]


def test_workgroup_takes_the_first_rule(spark):
    rows = [
        ("WFS_TSC", "x"),
        ("NA", "crew TAC 5"),
        ("NOC_BIS_1", None),
        ("NOC_CNCC", None),
        ("NOC_NAC_NSC", None),
        ("NOC_OTHER", None),
        ("NA", None),
        ("nothing", "WFS"),
        ("FxATOP", None),
    ]
    new = C.workgroup("g", "p")
    old = C.workgroup("g", "p", fixed.OLDER_WORKGROUP_RULES)
    got = values(spark, rows, "g STRING, p STRING", new, old)
    assert [g[0] for g in got] == ["WFS", "TSC", "NOC_BIS", "NOC_CNCC", "NOC", None, None, None, "FFS"]
    assert [g[1] for g in got] == ["WFS", "TSC", "NOC", "NOC", "NOC", "NOC", None, None, "FFS"]


def test_area_repair(spark):
    rows = [
        ("Visayas", "Mindanao | x", "NFS_AMM_01"),
        ("elsewhere", " Mindanao | x", "NFS_AMM_01"),
        ("elsewhere", "title", "NFS_AMM_01"),
        (None, None, "NFS_VIS_9"),
        (None, "no bar", "NFS_amm_01"),
        (None, "x", "NA"),
    ]
    got = values(spark, rows, "a STRING, t STRING, g STRING", C.area_code(C.repaired_area("a", "t", "g")))
    assert [g[0] for g in got] == ["VIS", "MIN", "MM", "VIS", None, None]


def test_coded_item_ranks_codes_not_items(spark):
    items = ["NOC_1;TSC_2;TSC_3", "a;b", "x;Network Build 7", "FCC;WFS", None]
    assert column(spark, items, "STRING", C.coded_item("x")) == ["TSC_2", None, "Network Build 7", "WFS", None]


def test_severity(spark):
    got = values(spark, [("Critical",), ("Alarm Clearing",), ("Odd",), (None,)], "x STRING", C.severity_rank("x"), C.listed_severity("x"))
    assert got == [(0, "Critical"), (5, "Alarm Clearing"), (None, None), (None, None)]
