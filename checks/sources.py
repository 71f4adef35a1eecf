"""Sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.base import check, local
from triagegrid.functions.scalars import local_text
from triagegrid.session import new_path
from triagegrid.sources import history, readers, sinks


@check(
    "s1_query_source",
    """SELECT orderid AS ticket_id, title_ AS title, currentseverity_ AS severity FROM trouble_ticket
       WHERE processstatus = 'running'""",
)
def query_source(t):
    text = "SELECT orderid, title_, currentseverity_ FROM {tickets} WHERE processstatus = :status"
    names = {"orderid": "ticket_id", "title_": "title", "currentseverity_": "severity", "not_there": "x"}
    return readers.query(t.spark, text, {"tickets": t["trouble_ticket"]}, {"status": "running"}, names)


_LINE = "CAST(o_orderkey AS STRING) || '|' || o_orderstatus"


@check(
    "s2_csv_source",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status,
              CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE 'a|b ' || o_orderpriority END AS note
       FROM orders WHERE o_orderpriority <> '1-URGENT'""",
)
def csv_source(t):
    """Lines of urgent orders have a field too many and are skipped; those of low ones are short."""
    line = F.expr(
        f"CASE o_orderpriority WHEN '1-URGENT' THEN {_LINE} || '|x|y' WHEN '5-LOW' THEN {_LINE} "
        f"ELSE {_LINE} || '|\"a|b ' || o_orderpriority || '\"' END"
    )
    path = new_path(t.spark, "csv-source")
    t["orders"].select(line.alias("value")).write.text(path)
    return readers.csv_all_text(t.spark, path, sep="|", fields=["id", "status", "note"])


@check(
    "s2_csv_header",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status FROM orders
       UNION ALL SELECT 'order', 'state' UNION ALL SELECT 'order', 'state'""",
)
def csv_header(t):
    """Files with a header each, and data lines that say the same."""
    same = t.spark.sql("SELECT explode(array('order', 'order')) AS `order`, 'state' AS state")
    rows = t["orders"].select(F.col("o_orderkey").cast("string").alias("order"), F.col("o_orderstatus").alias("state"))
    path = new_path(t.spark, "csv-header")
    rows.unionByName(same).write.option("header", True).option("sep", "|").csv(path)
    return readers.csv_all_text(t.spark, path, sep="|", names={"order": "id", "state": "status"})


@check(
    "s3_rename_map",
    "SELECT ticketid AS id, orderid AS public_id, processstatus FROM work_order",
)
def rename_map(t):
    chosen = t["work_order"].select("ticketid", "orderid", "processstatus")
    return readers.rename(chosen, {"ticketid": "id", "orderid": "public_id", "unknown": "ignored"})


@check(
    "s4_csv_sink",
    f"""SELECT orderid AS "TicketID", area_ AS "Area", {local('createtime')} AS "Created" FROM trouble_ticket""",
)
def csv_sink(t):
    rows = t["trouble_ticket"].select(
        F.col("orderid").alias("TicketID"), F.col("area_").alias("Area"), local_text("createtime").alias("Created")
    )
    target = sinks.write_csv(rows, new_path(t.spark, "csv-sink"), "20211210")
    return t.spark.read.schema("TicketID STRING, Area STRING, Created STRING").option("header", True).csv(target)


@check(
    "s5_append_path",
    "SELECT orderid, processstatus, createtime IS NOT NULL AS dated FROM work_order",
)
def append_path(t):
    path = new_path(t.spark, "append")
    rows = t["work_order"].select("orderid", "processstatus", F.col("createtime").isNotNull().alias("dated"))
    sinks.append_path(rows.where(F.col("processstatus") == "running"), path)
    sinks.append_path(rows.where(F.col("processstatus") != "running"), path)
    return t.spark.read.parquet(path)


@check(
    "s5_append_table",
    "SELECT orderid, processstatus, CASE WHEN processstatus = 'running' THEN area_ END AS area FROM work_order",
)
def append_table(t):
    """Two appends by name, the second one in another order and without one of the columns."""
    name = f"appended_{uuid.uuid4().hex}"
    rows = t["work_order"].select("orderid", "processstatus", F.col("area_").alias("area"))
    sinks.append_table(rows.where(F.col("processstatus") == "running"), name)
    sinks.append_table(rows.where(F.col("processstatus") != "running").select("processstatus", "orderid"), name)
    return t.spark.table(name)


@check(
    "s6_dated_snapshot",
    """SELECT d.day AS asof, orderid AS ticket_id, area_ AS area FROM trouble_ticket
       CROSS JOIN (VALUES ('2021-12-09'), ('2021-12-10')) d(day) WHERE faultrecoverytime_ IS NOT NULL""",
)
def dated_snapshot(t):
    """Two days, the second one run twice: the history holds each day once."""
    rows = t["trouble_ticket"].where(F.col("faultrecoverytime_").isNotNull())
    rows = rows.select(F.col("orderid").alias("Ticket ID"), F.col("area_").alias("Area"))
    path = new_path(t.spark, "snapshot")
    for day in ("2021-12-09", "2021-12-10", "2021-12-10"):
        sinks.write_snapshot(rows, path, day)
    return t.spark.read.parquet(path).select(F.col("asof").cast("string").alias("asof"), "ticket_id", "area")


@check(
    "s6_change_history",
    """WITH d AS (SELECT unnest(['01', '02', '03']) AS day, unnest([30, 60, 45]) AS most)
       SELECT day, orderid, area_ FROM d JOIN trouble_ticket ON ticketid % 100 < most""",
)
def change_history(t):
    """Three days, the second one written last, once wrong and once right; each day as it was."""
    tt, path = t["trouble_ticket"].select("orderid", "area_", "ticketid"), new_path(t.spark, "history")
    for day, most in (("01", 30), ("03", 45), ("02", 99), ("02", 60)):
        history.write_day(tt.where(F.col("ticketid") % 100 < most).drop("ticketid"), path, day)
    views = [history.as_of(t.spark, path, day).select(F.lit(day).alias("day"), "orderid", "area_") for day in ("01", "02", "03")]
    return views[0].union(views[1]).union(views[2])


@check(
    "s7_parameterised_query",
    f"""SELECT orderid, {local('wo005_submit_wo005')} AS processed FROM work_order
        WHERE wo005_submit_wo005 + INTERVAL 8 HOUR >= TIMESTAMP '1999-03-01 00:00:00'
          AND wo005_submit_wo005 + INTERVAL 8 HOUR <= TIMESTAMP '1999-09-01 00:00:00'""",
)
def parameterised_query(t):
    text = """SELECT orderid, date_format(from_utc_timestamp(wo005_submit_wo005, :zone), 'yyyy-MM-dd HH:mm:ss') AS processed
              FROM {wo} WHERE wo005_submit_wo005 BETWEEN
                CAST(to_utc_timestamp(CAST(:start AS TIMESTAMP), :zone) AS TIMESTAMP_NTZ)
                AND CAST(to_utc_timestamp(CAST(:end AS TIMESTAMP), :zone) AS TIMESTAMP_NTZ)"""
    args = {"start": "1999-03-01 00:00:00", "end": "1999-09-01 00:00:00", "zone": "Asia/Manila"}
    return readers.query(t.spark, text, {"wo": t["work_order"]}, args)


@check(
    "s8_multi_dataset_report",
    """SELECT 'open' AS dataset, count(*) AS rows FROM trouble_ticket WHERE processstatus = 'running'
       UNION ALL SELECT 'closed', count(*) FROM trouble_ticket WHERE processstatus <> 'running'
       UNION ALL SELECT 'work', count(*) FROM work_order""",
)
def multi_dataset_report(t):
    tt = t["trouble_ticket"].select("ticketid", "orderid", "processstatus")
    datasets = {
        "open": tt.where(F.col("processstatus") == "running"),
        "closed": tt.where(F.col("processstatus") != "running"),
        "work": t["work_order"].select("ticketid", "orderid"),
    }
    return sinks.counts_frame(t.spark, sinks.write_counted(datasets, new_path(t.spark, "report"))[1])
