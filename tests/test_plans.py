"""Shape of the physical plans: what reaches the scan, how joins run and what is shuffled."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from checks import QUERIES
from triagegrid.analog import Tables
from triagegrid.operators import dedupe, lists, lookups, pivots
from triagegrid.plans import r7_team_daily as R7
from triagegrid.plans.r1_adhoc_sdt import adhoc_sdt_tickets
from triagegrid.plans.r3_daily_tickets import daily_tickets
from triagegrid.plans.r6_missing_cause import missing_cause

FOLDER = "/root/testdata/sf0.001"


def plan(df, mode="formatted"):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are for large inputs."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


PLANNED = [n for n in QUERIES if not re.match(r"s\d|w4|r5[def]", n)]


@pytest.mark.parametrize("name", PLANNED)
def test_no_cross_joins_and_no_python(spark, no_broadcast, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for node in ("BroadcastNestedLoopJoin", "CartesianProduct", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert node not in text, node
    # No window may run over one partition for all rows.
    assert "SinglePartition" not in re.sub(r"HashAggregate.*?\n", "", text) or "Window" not in text


def test_time_bound_reaches_the_scan(spark):
    text = plan(R7.work_accepted(Tables(spark, FOLDER), "1999-03-01 00:00:00", "1999-04-01 00:00:00"))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(l_shipdate,.*LessThanOrEqual\(l_shipdate,", text)


def test_only_needed_columns_are_read(spark):
    tables = Tables(spark, FOLDER)
    table = pivots.pivot_with_total(tables["trouble_ticket"], ["area_"], "technology_", "orderid", "count", ["2G"])
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>", plan(table))


def test_pivot_aggregates_before_its_shuffle(spark):
    tables = Tables(spark, FOLDER)
    text = plan(pivots.pivot_with_total(tables["trouble_ticket"], ["area_"], "technology_", "orderid", "count", ["2G"]), "simple")
    first_exchange = text[text.rindex("Exchange hashpartitioning") :]
    assert "partial_count" in first_exchange and "Expand" not in first_exchange
    assert "Sort" not in text


def test_hot_keys_can_be_split(spark, no_broadcast):
    """Both sides of a lookup get their own exchange on key and spread, which is what AQE's skew join works on."""
    tables = Tables(spark, FOLDER)
    df = lookups.lookup(tables["work_order"], "parentticketid", tables["ticket_order"], "ticketid", "orderid", "o")
    text = plan(df, "simple")
    assert len(re.findall(r"Exchange hashpartitioning\(__key#\d+L?, __spread#\d+L", text)) == 1
    assert len(re.findall(r"Exchange hashpartitioning\(__dim_key#\d+L?, __dim_spread#\d+L", text)) == 1


def test_a_table_of_many_hot_keys_is_not_broadcast(spark, no_broadcast):
    """With few rows per part there may be as many hot keys as rows; with a million there are few."""
    tables = Tables(spark, FOLDER)
    sides = tables["trouble_ticket"].select("ticketid", "orderid"), "ticketid", tables["ticket_associate"], "associateticketid"
    for hot_rows, joins in ((1, 0), (lookups.HOT_ROWS, 2)):
        df = lookups.fan_out_left(*sides, {"sourceticketid": "source"}, ["orderid"], hot_rows)
        assert plan(df, "simple").count("BroadcastHashJoin") == joins


def test_joins_on_the_own_id_share_a_partitioning(spark, no_broadcast):
    """Child lists and processors are both attached by ticket id: the tickets are shuffled once."""
    tables = Tables(spark, FOLDER)
    made = lists.child_lists(tables["work_order"], "parentticketid", {"c": ("orderid", "ticketid")})
    df = lists.with_child_lists(tables["trouble_ticket"].select("ticketid", "orderid"), "ticketid", made, "parentticketid")
    df = lookups.lookup(df, "ticketid", tables["tt_processor"], "ticketid", "processors", "p", unique=True, own_id=True)
    text = plan(df, "simple")
    assert len(re.findall(r"Exchange hashpartitioning\(ticketid#", text)) == 1
    assert len(re.findall(r"SortMergeJoin \[ticketid#", text)) == 2


def test_skew_join_splits_a_hot_key(spark, no_broadcast):
    """One key in half of the rows: AQE reads its partition in several pieces."""
    df = spark.range(0, 400_000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 512).alias("x")
    )
    dim = spark.range(0, 400_000, 1, 8).select("id", F.lit("label").alias("v"))
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = lookups.lookup(df, "k", dim, "id", "v", "out")
        assert joined.where(F.col("out").isNotNull()).count() == 400_000
        counted = joined.agg(F.count("out"), F.max("x"))
        counted.collect()
        text = plan(counted, "simple")
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert "skew=true" in text or "skewed" in text


def test_lists_are_grouped_by_parent_and_block(spark, no_broadcast):
    tables = Tables(spark, FOLDER)
    made = lists.child_lists(tables["work_order"], "parentticketid", {"c": ("orderid", "ticketid")}, block_items=5)
    text = plan(made)
    assert re.search(r"Keys \[1\]: \[_groupingexpression#\d+\]", text) and "struct(__parent" in text and "Window" not in text


def test_lists_within_one_block_need_one_exchange(spark):
    tables = Tables(spark, FOLDER)
    made = lists.child_lists(tables["work_order"], "parentticketid", {"c": ("orderid", "ticketid")})
    assert plan(made, "simple").count("Exchange hashpartitioning") == 1


def test_keep_one_thins_out_before_the_shuffle(spark):
    tables = Tables(spark, FOLDER)
    text = plan(dedupe.keep_one(tables["lineitem"], ["l_orderkey"], ["l_partkey"]), "simple")
    assert "partial_min_by" in text and "Window" not in text


def test_report_is_sorted_before_it_is_formatted(spark):
    text = plan(daily_tickets(Tables(spark, FOLDER), "1999-03-01 00:00:00", "1999-04-01 00:00:00"), "simple")
    assert text.index("date_format") < text.index("rangepartitioning")


def test_escalations_skip_the_pending_lookups(spark):
    """Only the ids of the pending rows are needed, so their name and parent joins are dropped."""
    tables = Tables(spark, FOLDER)
    text = plan(R7.work_escalations(tables, R7.pending_child_work(tables)))
    assert text.count("o_orderkey") == 0


def test_snapshot_reads_one_day(spark, tmp_path):
    path = str(tmp_path / "history")
    for day in ("2021-12-09", "2021-12-10"):
        spark.range(3).withColumn("asof", F.lit(day)).write.mode("append").partitionBy("asof").parquet(path)
    text = plan(spark.read.parquet(path).where(F.col("asof") == "2021-12-10"))
    assert re.search(r"PartitionFilters: \[.*asof", text)


REPORTS = {
    "description_": lambda t: daily_tickets(t, "1999-03-01 00:00:00", "1999-04-01 00:00:00"),
    "details_": lambda t: adhoc_sdt_tickets(t, "1"),
    "subcausethree_": missing_cause,
}


@pytest.mark.parametrize("column", REPORTS)
def test_wide_rows_are_shuffled_by_their_own_id_only(spark, no_broadcast, column):
    """Exchanges that carry a column which only the report shows: by ticket, by ticket and part of a fan-out, and the final sort."""
    text = plan(REPORTS[column](Tables(spark, FOLDER)))
    nodes = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]\nArguments: (\w+)\((.*?)\), ENSURE", text)
    wide = [(kind, re.sub(r"#\d+L?", "", keys)) for columns, kind, keys in nodes if re.search(rf"\b{column}#", columns)]
    by_hash = [re.sub(r", \d+$", "", keys) for kind, keys in wide if kind == "hashpartitioning"]
    assert len(nodes) > 6 and len(by_hash) <= 2 and set(by_hash) <= {"ticketid", "__key, __part"}
    assert len(wide) - len(by_hash) == 1
