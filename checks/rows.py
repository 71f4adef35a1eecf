"""Keep-one rows, duplicates, sorts, limits, unions and table edits."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import check
from triagegrid.functions import fixed
from triagegrid.functions.classify import aging_hours, severity_rank
from triagegrid.operators import dedupe as D
from triagegrid.operators.builder import TableQuery, TicketFrame
from triagegrid.plans.common import label_of

_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"]


@check(
    "w1_keep_one",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_returnflag) = 1""",
)
def keep_one(t):
    return D.keep_one(
        t["lineitem"].select(*_LINE), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_returnflag"]
    )


@check(
    "w1_keep_last",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_returnflag, l_linenumber FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey DESC, l_suppkey DESC, l_linenumber DESC) = 1""",
)
def keep_last(t):
    return D.keep_one(t["lineitem"].select(*_LINE), ["l_orderkey"], ["l_partkey", "l_suppkey", "l_linenumber"], "last")


@check(
    "w1_distinct_rows",
    "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem",
)
def distinct_rows(t):
    return D.keep_one(t["lineitem"].select("l_suppkey", "l_returnflag", "l_linestatus"), [], [])


@check(
    "w2_removed_rows",
    """WITH r AS (SELECT l_orderkey AS k, l_linenumber AS n, l_returnflag AS f, l_linestatus AS s FROM lineitem),
       kept AS (SELECT DISTINCT k, n, f, s FROM r QUALIFY rank() OVER (PARTITION BY k, n ORDER BY f, s) = 1),
       once AS (SELECT k, n, f, s FROM r GROUP BY ALL HAVING count(*) = 1)
       SELECT k, n, f, s FROM once EXCEPT SELECT k, n, f, s FROM kept""",
)
def removed_rows(t):
    rows = t["lineitem"].selectExpr("l_orderkey AS k", "l_linenumber AS n", "l_returnflag AS f", "l_linestatus AS s")
    return D.removed_rows(rows, ["k", "n"], ["f", "s"])


@check(
    "w3_worst_per_site",
    """WITH j AS (SELECT t.siteid_, t.orderid, t.ticketid, s.label, t.area_,
                 floor(epoch(TIMESTAMP '2001-06-30 12:00:34' - t.createtime) / 60) / 60 AS hours
               FROM trouble_ticket t LEFT JOIN severity s ON s.code = t.currentseverity_ WHERE t.siteid_ IS NOT NULL),
       r AS (SELECT *, round(avg(hours) OVER (PARTITION BY siteid_), 6) AS mean_hours, row_number() OVER (PARTITION BY siteid_
               ORDER BY list_position(['Critical','Moderate','Major','Minor','Low','Alarm Clearing'], label) NULLS LAST, ticketid) AS n FROM j)
       SELECT siteid_, orderid, ticketid, label, area_, mean_hours AS hours FROM r WHERE n = 1""",
)
def worst_per_site(t):
    tt = label_of(t["trouble_ticket"], t, "severity", "currentseverity_", "label")
    rows = tt.select(
        "siteid_", "orderid", "ticketid", "label", "area_", aging_hours("createtime", "2001-06-30 12:00:34").alias("hours")
    )
    worst = D.worst_per_key(rows, "siteid_", "label", "hours", "ticketid")
    return worst.withColumn("hours", F.round("hours", 6))


@check(
    "w4_row_index",
    "SELECT row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS idx, o_orderkey, o_totalprice FROM orders",
)
def row_index(t):
    rows = t["orders"].select("o_orderkey", "o_totalprice")
    return D.row_index(rows, [F.col("o_totalprice").asc(), F.col("o_orderkey").asc()], "idx")


@check(
    "o1_sorted_rows",
    "SELECT orderid, area_, servicestatus FROM trouble_ticket ORDER BY area_ NULLS LAST, orderid",
)
def sorted_rows(t):
    return D.sort_rows(t["trouble_ticket"].select("orderid", "area_", "servicestatus"), ["area_", "orderid"])


@check(
    "o2_category_order",
    """SELECT code, CASE WHEN label IN ('Critical','Moderate','Major','Minor','Low','Alarm Clearing') THEN label END AS label,
              CAST(list_position(['Critical','Moderate','Major','Minor','Low','Alarm Clearing'], label) - 1 AS INTEGER) AS category_rank, orderid
       FROM severity JOIN trouble_ticket ON currentseverity_ = code""",
)
def category_order(t):
    rows = t["severity"].join(t["trouble_ticket"], F.col("currentseverity_") == F.col("code"))
    rows = rows.select("code", "label", severity_rank("label").alias("category_rank"), "orderid")
    return D.sort_by_category(rows, "label", fixed.SEVERITY_ORDER, ascending=False)


@check(
    "o3_top_rows",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 25",
)
def top_rows(t):
    q = TableQuery(t.spark, {"orders": t["orders"]}).table("orders").select(["o_orderkey", "o_totalprice"])
    return q.orderBy(["o_totalprice", "o_orderkey"], "DESC").limit(25).get()


@check(
    "o4_offset_page",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 25 OFFSET 50",
)
def offset_page(t):
    q = TableQuery(t.spark, {"orders": t["orders"]}).table("orders").select(["o_orderkey", "o_totalprice"])
    return q.orderBy(["o_totalprice", "o_orderkey"]).limit(25, 50).get()


@check(
    "o4_deep_page",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 11000 OFFSET 700",
)
def deep_page(t):
    q = TableQuery(t.spark, {"orders": t["orders"]}).table("orders").select(["o_orderkey", "o_totalprice"])
    return q.orderBy(["o_totalprice", "o_orderkey"], "DESC").limit(11_000, 700).get()


@check(
    "u1_concatenate",
    """SELECT orderid, createtitle_, processstatus, area_, NULL AS category_ FROM work_order
       UNION ALL SELECT orderid, createtitle_, processstatus, NULL, category_ FROM sdt_ticket""",
)
def concatenate(t):
    wo = t["work_order"].select("orderid", "createtitle_", "processstatus", "area_")
    sdt = t["sdt_ticket"].select("category_", "orderid", "createtitle_", "processstatus")
    return TicketFrame(t.spark, wo).concat([sdt]).df


@check(
    "u2_delta",
    """WITH both_rows AS (SELECT orderid, processstatus FROM trouble_ticket WHERE fixedwirelesscreate_ = 'Wireless'
         UNION ALL SELECT orderid, processstatus FROM trouble_ticket WHERE domain_ = 'RAN')
       SELECT orderid, processstatus FROM both_rows GROUP BY ALL HAVING count(*) = 1""",
)
def delta(t):
    tt = t["trouble_ticket"]
    one = tt.where("fixedwirelesscreate_ = 'Wireless'").select("orderid", "processstatus")
    two = tt.where("domain_ = 'RAN'").select("orderid", "processstatus")
    return TicketFrame(t.spark, one).delta(two)


def _query(t, name):
    return TableQuery(t.spark, {name: t[name]}).table(name)


@check(
    "m1_insert_record",
    """SELECT ticketid, orderid, processors FROM (SELECT ticketid, CAST(ticketid AS VARCHAR) AS orderid, processors FROM tt_processor)
       UNION ALL SELECT -5, 'new one', NULL""",
)
def insert_record(t):
    base = t["tt_processor"].selectExpr("ticketid", "CAST(ticketid AS STRING) AS orderid", "processors")
    return TableQuery(t.spark, {"p": base}).table("p").insert({"ticketid": -5, "orderid": "new one", "processors": "NULL"})


@check(
    "m2_update_where",
    """SELECT orderid, CASE WHEN area_ = 'Unknown' AND domain_ = 'RAN' THEN 'Visayas' ELSE area_ END AS area_,
              CASE WHEN area_ = 'Unknown' AND domain_ = 'RAN' THEN NULL ELSE remarks_ END AS remarks_, domain_ FROM trouble_ticket""",
)
def update_where(t):
    base = t["trouble_ticket"].select("orderid", "area_", "remarks_", "domain_")
    q = TableQuery(t.spark, {"tt": base}).table("tt").where(["area_", "Unknown"]).where(["domain_", "RAN"])
    return q.update({"area_": "Visayas", "remarks_": "NULL"})


@check(
    "m3_delete_where",
    "SELECT orderid, area_ FROM trouble_ticket WHERE (area_ = 'Unknown' OR domain_ = 'Transport') IS NOT TRUE",
)
def delete_where(t):
    q = _query(t, "trouble_ticket").where(["area_", "Unknown"]).orWhere(["domain_", "Transport"])
    return q.delete().select("orderid", "area_")


@check(
    "m4_set_cell",
    "SELECT orderid, CASE WHEN orderid = 'TT-42' THEN 'seen' ELSE remarks_ END AS remarks_ FROM trouble_ticket",
)
def set_cell(t):
    frame = TicketFrame(t.spark, t["trouble_ticket"].select("orderid", "remarks_"))
    return frame.updateCell("orderid", "TT-42", "remarks_", "seen").df


@check(
    "m5_fluent_chain",
    """SELECT area_, technology_, count(*) AS tickets, max(orderid) AS last_order FROM trouble_ticket t
       JOIN (SELECT code, label FROM severity) s ON t.currentseverity_ = s.code
       WHERE processstatus = 'running' AND (label = 'Critical' OR label = 'Major')
       GROUP BY area_, technology_""",
)
def fluent_chain(t):
    q = TableQuery(t.spark, {"tickets": t["trouble_ticket"], "severity": t["severity"]}).table("tickets")
    q.select(["area_", "technology_", "count(*) AS tickets", "max(orderid) AS last_order"])
    q.join("severity", ["currentseverity_", "code"])
    q.where(["processstatus", "running"])
    q.groupWhere("open")
    q.where(["label", "Critical"])
    q.groupWhere("close")
    q.orWhere(["label", "Major"])
    return q.groupBy(["area_", "technology_"]).orderBy(["area_", "technology_"]).get()
