"""Aggregates, pivots with totals and grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import AS_OF, check, rounded, sql_pivot
from triagegrid.functions import classify as C
from triagegrid.functions import fixed
from triagegrid.functions.scalars import local_time
from triagegrid.operators import grids, lists
from triagegrid.operators import pivots as P
from triagegrid.operators.builder import TableQuery
from triagegrid.plans.common import processors_of

TECH = ["2G", "3G", "FDLTE", "5G", "Canopy", "TDLTE", "WIFI"]
AREAS = list(fixed.AREA_CODES)
_HOURS = f"floor(epoch(TIMESTAMP '{AS_OF}' - (createtime + INTERVAL 8 HOUR)) / 60) / 60"


def _tickets(t):
    hours = C.aging_hours(local_time("createtime"), AS_OF)
    return t["trouble_ticket"].withColumn("hours", F.when(F.col("deviceid_").isNotNull(), hours))


@check(
    "a1_child_list",
    """SELECT t.orderid, (SELECT string_agg(w.orderid, ',' ORDER BY w.ticketid) FROM work_order w WHERE w.parentticketid = t.ticketid) AS children
       FROM trouble_ticket t""",
)
def child_list(t):
    made = lists.child_lists(t["work_order"], "parentticketid", {"children": ("orderid", "ticketid")})
    df = lists.with_child_lists(t["trouble_ticket"], "ticketid", made, "parentticketid")
    return df.select("orderid", "children")


@check(
    "a1_child_blocks",
    """WITH i AS (SELECT parentticketid, orderid, processstatus, row_number() OVER (PARTITION BY parentticketid ORDER BY ticketid) - 1 AS a,
                 row_number() OVER (PARTITION BY parentticketid ORDER BY processstatus, orderid) - 1 AS b FROM work_order WHERE parentticketid IS NOT NULL),
       x AS (SELECT parentticketid, a // 3 AS piece, string_agg(orderid, ',' ORDER BY a) AS children FROM i GROUP BY 1, 2),
       y AS (SELECT parentticketid, b // 3 AS piece, string_agg(processstatus, ',' ORDER BY b) AS statuses FROM i GROUP BY 1, 2)
       SELECT parentticketid, piece::bigint AS piece, children, statuses FROM x FULL JOIN y USING (parentticketid, piece)""",
)
def child_blocks(t):
    named = {"children": ("orderid", "ticketid"), "statuses": ("processstatus", "processstatus")}
    return lists.child_lists(t["work_order"], "parentticketid", named, block_items=3)


@check(
    "a2_child_value_lists",
    """SELECT t.orderid, l.statuses, l.processors FROM trouble_ticket t LEFT JOIN (
         SELECT w.parentticketid, string_agg(w.processstatus, ',' ORDER BY w.processstatus) AS statuses,
                string_agg(p.processors, ',' ORDER BY p.processors) AS processors
         FROM work_order w LEFT JOIN wo_processor p ON p.ticketid = w.ticketid GROUP BY 1) l ON l.parentticketid = t.ticketid""",
)
def child_value_lists(t):
    wo = processors_of(t["work_order"], t, "wo_processor", "processors")
    made = lists.child_lists(
        wo, "parentticketid", {"statuses": ("processstatus", "processstatus"), "processors": ("processors", "processors")}
    )
    df = lists.with_child_lists(t["trouble_ticket"], "ticketid", made, "parentticketid")
    return df.select("orderid", "statuses", "processors")


@check(
    "a3_group_mean",
    f"""SELECT siteid_, round(avg(h), 6) AS hours FROM (SELECT siteid_, CASE WHEN deviceid_ IS NOT NULL THEN {_HOURS} END AS h FROM trouble_ticket)
        WHERE siteid_ IS NOT NULL GROUP BY siteid_ HAVING avg(h) IS NOT NULL""",
)
def group_mean(t):
    return rounded(P.group_mean(_tickets(t), "siteid_", "hours"), "hours")


@check(
    "a4_count_pivot",
    sql_pivot("SELECT area_ AS r, technology_ AS c, deviceid_ AS v FROM trouble_ticket", ["r"], TECH, "count", ["area_"]),
)
def count_pivot(t):
    return P.pivot_with_total(t["trouble_ticket"], ["area_"], "technology_", "deviceid_", "count", TECH)


@check(
    "a4_paged_pivot",
    """WITH x AS (SELECT siteid_ AS c, dense_rank() OVER (ORDER BY siteid_) - 1 AS n FROM (SELECT DISTINCT siteid_ FROM trouble_ticket
                  WHERE area_ IS NOT NULL AND siteid_ IS NOT NULL AND siteid_ <> '')),
       k AS (SELECT coalesce(area_, 'All') AS area, siteid_ AS site, count(deviceid_) AS cell FROM trouble_ticket
             WHERE area_ IS NOT NULL AND siteid_ IS NOT NULL AND siteid_ <> '' GROUP BY GROUPING SETS ((area_, siteid_), (siteid_)))
       SELECT area, (n // 7)::integer AS page, site, cell FROM k JOIN x ON x.c = k.site""",
)
def paged_pivot(t):
    paged = P.paged_pivot(t["trouble_ticket"], ["area_"], "siteid_", "deviceid_", "count", page_columns=7)
    cells = paged.cells.select(F.col("area_").alias("area"), F.col("__page").alias("page"), F.explode("__cells").alias("site", "cell"))
    return cells


@check(
    "a5_mean_pivot",
    sql_pivot(
        f"SELECT area_ AS r, technology_ AS c, CASE WHEN deviceid_ IS NOT NULL THEN {_HOURS} END AS v FROM trouble_ticket",
        ["r"], TECH, "mean", ["area_"],
    ),
)
def mean_pivot(t):
    table = P.pivot_with_total(_tickets(t), ["area_"], "technology_", "hours", "mean", TECH)
    return rounded(table, *TECH, "All")


@check(
    "a6_mean_with_total",
    f"""SELECT CASE WHEN grouping(area_) = 1 THEN 'All' ELSE area_ END AS area_, round(avg(h), 6) AS hours
        FROM (SELECT area_, CASE WHEN deviceid_ IS NOT NULL THEN {_HOURS} END AS h FROM trouble_ticket WHERE area_ IS NOT NULL)
        GROUP BY ROLLUP (area_)""",
)
def mean_with_total(t):
    return rounded(P.mean_with_total(_tickets(t), "area_", "hours"), "hours")


@check(
    "a7_two_level_pivot",
    sql_pivot(
        "SELECT area_ AS r1, issitedown_ AS r2, technology_ AS c, deviceid_ AS v FROM trouble_ticket",
        ["r1", "r2"], TECH, "count", ["area_", "issitedown_"],
    ),
)
def two_level_pivot(t):
    return P.pivot_with_total(t["trouble_ticket"], ["area_", "issitedown_"], "technology_", "deviceid_", "count", TECH)


@check(
    "a7_two_level_mean",
    sql_pivot(
        f"SELECT area_ AS r1, issitedown_ AS r2, processstatus AS c, {_HOURS} AS v FROM trouble_ticket",
        ["r1", "r2"], ["running", "closed"], "mean", ["area_", "issitedown_"],
    ),
)
def two_level_mean(t):
    table = P.pivot_with_total(
        _tickets(t).withColumn("hours", C.aging_hours(local_time("createtime"), AS_OF)),
        ["area_", "issitedown_"], "processstatus", "hours", "mean", ["running", "closed"],
    )
    return rounded(table, "running", "closed", "All")


@check(
    "a8_axis_values",
    """SELECT DISTINCT nullif(replace(servicestatus, 'BusinessStatus', ''), '') AS status FROM trouble_ticket
       WHERE replace(servicestatus, 'BusinessStatus', '') NOT IN ('', 'WIP')""",
)
def axis_values(t):
    rows = t["trouble_ticket"].select(C.business_status("servicestatus").alias("status"))
    return P.distinct_axis(rows, "status", exclude=["WIP"])


@check(
    "a9_builder_group_by",
    """SELECT domain_, region_, count(*) AS n, max(ticketid) AS newest, count(DISTINCT parentticketid) AS parents
       FROM work_order WHERE processstatus = 'running' GROUP BY domain_, region_""",
)
def builder_group_by(t):
    q = TableQuery(t.spark, {"wo": t["work_order"]}).table("wo").where(["processstatus", "running"])
    fields = ["domain_", "region_", "count(*) AS n", "max(ticketid) AS newest", "count(DISTINCT parentticketid) AS parents"]
    return q.select(fields).groupBy(["domain_", "region_"]).get()


_AXIS = "(VALUES " + ", ".join(f"('{a}')" for a in [*AREAS, "Atlantis", "All"]) + ") axis(a)"


@check(
    "a10_dense_grid",
    f"""SELECT CASE WHEN a = 'All' THEN 'TOTAL' ELSE a END AS area_, "2G", "WIFI", CAST(NULL AS BIGINT) AS "6G", p."All" AS "TOTAL"
        FROM {_AXIS} LEFT JOIN ({{0}}) p ON p.area_ = a""".format(
        sql_pivot("SELECT area_ AS r, technology_ AS c, orderid AS v FROM trouble_ticket", ["r"], TECH, "count", ["area_"])
    ),
)
def dense_grid(t):
    table = P.pivot_with_total(t["trouble_ticket"], ["area_"], "technology_", "orderid", "count", TECH)
    return grids.dense_grid(table, ["area_"], [[*AREAS, "Atlantis"]], ["2G", "WIFI", "6G"], total_column="TOTAL")


@check(
    "a11_two_level_grid",
    """SELECT x.area_, y.kind AS issitedown_, p."running", p."closed", p."All" AS "TOTAL" FROM
         (SELECT DISTINCT area_ FROM trouble_ticket WHERE area_ IS NOT NULL AND area_ <> 'Unknown') x
         CROSS JOIN (VALUES ('isYes'), ('isNo'), ('isMaybe')) y(kind) LEFT JOIN ({0}) p ON p.area_ = x.area_ AND p.issitedown_ = y.kind""".format(
        sql_pivot(
            "SELECT area_ AS r1, issitedown_ AS r2, processstatus AS c, orderid AS v FROM trouble_ticket",
            ["r1", "r2"], ["running", "closed"], "count", ["area_", "issitedown_"],
        )
    ),
)
def two_level_grid(t):
    keys = ["area_", "issitedown_"]
    table = P.pivot_with_total(t["trouble_ticket"], keys, "processstatus", "orderid", "count", ["running", "closed"])
    axis = P.distinct_axis(t["trouble_ticket"], "area_", exclude=["Unknown"])
    return grids.dense_grid_over(
        axis, table, keys, ["running", "closed"], inner=["isYes", "isNo", "isMaybe"], total_column="TOTAL", total_row=None
    )


@check(
    "a12_summary_measures",
    """WITH b AS (SELECT area_, processstatus AS s, faultrecoverytime_ AS frt, o_h AS h FROM (
         SELECT *, floor(epoch(TIMESTAMP '2001-06-30 12:00:34' - (createtime + INTERVAL 8 HOUR)) / 60) / 60 AS o_h FROM trouble_ticket)
         WHERE area_ IS NOT NULL)
       SELECT CASE WHEN grouping(area_) = 1 THEN 'All' ELSE area_ END AS area_,
         nullif(count(*) FILTER (WHERE s = 'running'), 0) AS running,
         nullif(count(*) FILTER (WHERE s = 'running' AND frt IS NOT NULL), 0) AS with_frt,
         round(avg(h) FILTER (WHERE s = 'running' AND frt IS NOT NULL), 6) AS frt_hours,
         round(avg(h), 6) AS hours,
         nullif(count(*) FILTER (WHERE h < 4), 0) AS under_4, nullif(count(*) FILTER (WHERE h > 24), 0) AS over_24
       FROM b GROUP BY ROLLUP (area_)""",
)
def summary_measures(t):
    running = F.col("processstatus") == "running"
    frt = running & F.col("faultrecoverytime_").isNotNull()
    order, hours = F.col("orderid"), F.col("hours")
    measures = [
        P.Measure("running", "count", order, running),
        P.Measure("with_frt", "count", order, frt),
        P.Measure("frt_hours", "mean", hours, frt),
        P.Measure("hours", "mean", hours),
        P.Measure("under_4", "count", order, hours < 4),
        P.Measure("over_24", "count", order, hours > 24),
    ]
    rows = t["trouble_ticket"].withColumn("hours", C.aging_hours(local_time("createtime"), AS_OF))
    return rounded(P.with_total(rows, ["area_"], measures), "frt_hours", "hours")


@check(
    "a13_row_counts",
    """SELECT 'tickets' AS dataset, count(*) AS rows FROM trouble_ticket UNION ALL SELECT 'work', count(*) FROM work_order
       UNION ALL SELECT 'none', count(*) FROM change_request WHERE orderid IS NULL""",
)
def row_counts(t):
    return P.row_counts(
        {
            "tickets": t["trouble_ticket"],
            "work": t["work_order"],
            "none": t["change_request"].where(F.col("orderid").isNull()),
        }
    )
