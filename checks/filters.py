"""Projections, filters and predicates."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from checks.base import END, FIRST_YEAR, START, check, local
from triagegrid.functions import fixed
from triagegrid.functions.classify import business_status
from triagegrid.functions.scalars import local_text
from triagegrid.operators import predicates as P
from triagegrid.operators.builder import TableQuery, TicketFrame
from triagegrid.operators.edits import insert_columns
from triagegrid.plans.common import handled_by, of_team, roster
from triagegrid.sources.readers import columns


def _query(t, *names):
    return TableQuery(t.spark, {n: t[n] for n in names})


@check("p1_column_list", "SELECT orderid, area_, technology_ FROM trouble_ticket")
def column_list(t):
    return columns(t["trouble_ticket"], ["orderid", "area_", "technology_"])


@check(
    "p2_exact_names",
    f"""SELECT orderid AS "TicketID", nullif(replace(servicestatus, 'BusinessStatus', ''), '') AS "BusinessStatus",
               {local('faultfirstoccurtime_')} AS "Fault First Occur Time" FROM trouble_ticket""",
)
def exact_names(t):
    return t["trouble_ticket"].select(
        F.col("orderid").alias("TicketID"),
        business_status("servicestatus").alias("BusinessStatus"),
        local_text("faultfirstoccurtime_").alias("Fault First Occur Time"),
    )


@check(
    "p3_constant_columns",
    """SELECT orderid, CAST(NULL AS DOUBLE) AS "Aging (Hrs)", '' AS "EscalationTime" FROM work_order""",
)
def constant_columns(t):
    return t["work_order"].select(
        "orderid", F.lit(None).cast("double").alias("Aging (Hrs)"), F.lit("").alias("EscalationTime")
    )


@check(
    "p4_insert_at_position",
    """SELECT orderid, '' AS "Aging Grp", processstatus, '' AS "Workgroup", domain_, '' AS "Kind", area_ FROM work_order""",
)
def insert_at_position(t):
    base = t["work_order"].select("orderid", "processstatus", "domain_", "area_")
    return insert_columns(base, [(2, "Workgroup", F.lit("")), (1, "Aging Grp", F.lit("")), (5, "Kind", F.lit(""))])


@check("p5_drop_columns", "SELECT orderid, processstatus FROM work_order")
def drop_columns(t):
    return t["work_order"].select("orderid", "processstatus", "parentticketid", "area_").drop("parentticketid", "area_")


@check("p6_comparison", "SELECT orderid, area_ FROM work_order WHERE processstatus = 'running' AND parentticketid >= 100")
def comparison(t):
    q = _query(t, "work_order").table("work_order").select(["orderid", "area_"])
    return q.where(["processstatus", "running"]).where(["parentticketid", ">=", 100]).get()


@check("p7_between", "SELECT orderid, parentticketid FROM work_order WHERE parentticketid BETWEEN 50 AND 900")
def between(t):
    q = _query(t, "work_order").table("work_order").select(["orderid", "parentticketid"])
    return q.where(["parentticketid", 50, 900], between=True).get()


@check(
    "p8_condition_groups",
    """SELECT orderid, domain_, region_ FROM work_order
       WHERE fixedwireless_ = 'Wireless' AND (domain_ = 'RAN' AND region_ = 'North' OR area_ = 'Visayas')
          OR createtitle_ LIKE '%Minor%' AND processstatus != 'closed'""",
)
def condition_groups(t):
    q = _query(t, "work_order").table("work_order").select("orderid, domain_, region_".split(", "))
    q.where(["fixedwireless_", "Wireless"])
    q.groupWhere("open")
    q.where(["domain_", "RAN"]).where(["region_", "North"])
    q.groupWhere("close")
    q.orWhere(["area_", "Visayas"])
    q.orWhere(["createtitle_", "LIKE", "%Minor%"]).where(["processstatus", "!=", "closed"])
    return q.get()


@check(
    "p9_literal_coercion",
    """SELECT ticketid, orderid, CAST(NULL AS VARCHAR) AS cleared, DATE '2001-02-03' AS cut_date, 7 AS whole, 2.5 AS part
       FROM trouble_ticket WHERE faultfirstoccurtime_ >= DATE '1999-05-06'""".replace("2.5 AS", "CAST(2.5 AS DOUBLE) AS"),
)
def literal_coercion(t):
    rows = t["trouble_ticket"].where(P.compare("faultfirstoccurtime_", ">=", datetime(1999, 5, 6, 17, 30)))
    return rows.select(
        "ticketid",
        "orderid",
        P.literal("NULL").cast("string").alias("cleared"),
        P.literal(datetime(2001, 2, 3, 4, 5, 6)).alias("cut_date"),
        P.literal(7).alias("whole"),
        P.literal(2.5).alias("part"),
    )


@check(
    "p10_mask",
    """SELECT orderid, area_ FROM trouble_ticket
       WHERE (area_ = 'Visayas' OR area_ = 'Mindanao') AND faultrecoverytime_ IS NOT NULL AND issitedown_ = 'isYes'""",
)
def mask(t):
    cond = P.equals_any("area_", ["Visayas", "Mindanao"]) & F.col("faultrecoverytime_").isNotNull()
    return t["trouble_ticket"].where(cond & (F.col("issitedown_") == "isYes")).select("orderid", "area_")


@check(
    "p11_contains_any",
    "SELECT orderid, createtitle_ FROM work_order WHERE "
    + " OR ".join(f"createtitle_ LIKE '{p}'" for p in fixed.PENDING_TITLES),
)
def contains_any(t):
    return t["work_order"].where(P.like_any("createtitle_", fixed.PENDING_TITLES)).select("orderid", "createtitle_")


@check(
    "p12_contains_none",
    "SELECT orderid, createtitle_ FROM work_order WHERE createtitle_ NOT LIKE '%lower%' AND createtitle_ NOT LIKE '%TSC_%'",
)
def contains_none(t):
    kept = t["work_order"].where(P.like_none("createtitle_", fixed.PENDING_TITLES_REJECTED))
    return kept.select("orderid", "createtitle_")


@check("p13_in_list", "SELECT ticketid, nodeid, assignto FROM ticket_task WHERE nodeid IN ('WO002', 'WO004', 'WO005')")
def in_list(t):
    tasks = t["ticket_task"].where(P.equals_any("nodeid", list(fixed.PHASE_LABELS)))
    return tasks.select("ticketid", "nodeid", "assignto")


@check(
    "p14_team_allow_list",
    """SELECT w.orderid, u.fullname AS "Operator" FROM work_order w JOIN user_dim u
         ON u.user_id = CAST(w.wo005_user_wo005 AS BIGINT)
       WHERE u.fullname IN (SELECT fullname FROM user_dim WHERE active = 1 AND user_default_group = 'TSC_TRANSPORT')""",
)
def team_allow_list(t):
    return of_team(t["work_order"], t, "wo005_user_wo005", roster(t)).select("orderid", "Operator")


@check(
    "p15_not_recovered",
    "SELECT orderid FROM trouble_ticket WHERE faultrecoverytime_ IS NULL OR year(faultrecoverytime_) = 1970",
)
def not_recovered(t):
    tt = t["trouble_ticket"]
    return tt.where(P.not_recovered(tt, "faultrecoverytime_")).select("orderid")


@check(
    "p16_overlaps_range",
    f"""SELECT orderid, {local('faultfirstoccurtime_')} AS first FROM trouble_ticket
        WHERE (faultfirstoccurtime_ + INTERVAL 8 HOUR <= TIMESTAMP '{END}'
               AND faultrecoverytime_ + INTERVAL 8 HOUR >= TIMESTAMP '{START}')
           OR faultrecoverytime_ IS NULL OR year(faultrecoverytime_) = 1970""",
)
def overlaps_range(t):
    tt = t["trouble_ticket"]
    hit = tt.where(P.open_in_range(tt, "faultfirstoccurtime_", "faultrecoverytime_", START, END))
    return hit.select("orderid", local_text("faultfirstoccurtime_").alias("first"))


@check(
    "p17_closed_day_range",
    f"""SELECT orderid, {local('wo004_submit_wo004')} AS submitted FROM work_order
        WHERE wo004_submit_wo004 + INTERVAL 8 HOUR BETWEEN TIMESTAMP '1999-03-01 08:00:00' AND TIMESTAMP '1999-04-01 08:00:00'""",
)
def closed_day_range(t):
    wo = t["work_order"]
    hit = wo.where(P.in_local_range(wo, "wo004_submit_wo004", "1999-03-01 08:00:00", "1999-04-01 08:00:00"))
    return hit.select("orderid", local_text("wo004_submit_wo004").alias("submitted"))


@check(
    "p18_year_floor",
    f"SELECT orderid FROM trouble_ticket WHERE year(createtime + INTERVAL 8 HOUR) >= {FIRST_YEAR}",
)
def year_floor(t):
    tt = t["trouble_ticket"]
    return tt.where(P.since_year(tt, "createtime", FIRST_YEAR)).select("orderid")


@check(
    "p19_status_exclusion",
    """SELECT orderid, servicestatus FROM trouble_ticket WHERE servicestatus != 'BusinessStatusCompleted'
         AND servicestatus != 'BusinessStatusClosed' AND servicestatus != 'BusinessStatusCancel'""",
)
def status_exclusion(t):
    done = ["BusinessStatusCompleted", "BusinessStatusClosed", "BusinessStatusCancel"]
    return t["trouble_ticket"].where(P.equals_none("servicestatus", done)).select("orderid", "servicestatus")


@check(
    "p20_missing_cause",
    "SELECT orderid, causeofoutage_, subcauseone_ FROM trouble_ticket WHERE causeofoutage_ IS NULL OR subcauseone_ IS NULL",
)
def missing_cause(t):
    rows = t["trouble_ticket"].where(P.any_missing("causeofoutage_", "subcauseone_"))
    return rows.select("orderid", "causeofoutage_", "subcauseone_")


@check(
    "p21_id_in_text",
    """SELECT orderid, createassignto_,
              list_contains(string_split(regexp_replace(createassignto_, '(group|user):', '', 'g'), ';'), '90000000') AS exact
       FROM sdt_ticket WHERE createassignto_ LIKE '%90000000%'""",
)
def id_in_text(t):
    hit = t["sdt_ticket"].where(P.id_in_text("createassignto_", "90000000"))
    return hit.select("orderid", "createassignto_", P.id_in_list("createassignto_", "90000000").alias("exact"))


@check(
    "p22_group_of_lookup",
    """SELECT w.orderid FROM work_order w JOIN wo_processor p ON p.ticketid = w.ticketid
       WHERE p.processors LIKE '%TSC_TRANSPORT%'""",
)
def group_of_lookup(t):
    return handled_by(t["work_order"], t, "wo_processor").select("orderid")


@check(
    "p23_far_bound",
    "SELECT orderid FROM work_order WHERE finishtime_ + INTERVAL 8 HOUR <= TIMESTAMP '2030-12-31 23:59:59'",
)
def far_bound(t):
    wo = t["work_order"].select("orderid", F.col("finishtime_").cast("timestamp_ntz").alias("finishtime_"))
    return wo.where(P.finishes_by(wo, "finishtime_")).select("orderid")


@check("p24_null_test", "SELECT orderid, area_ IS NULL AS no_area FROM trouble_ticket")
def null_test(t):
    return t["trouble_ticket"].select("orderid", TicketFrame.isNull("area_").alias("no_area"))
