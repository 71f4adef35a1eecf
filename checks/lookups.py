"""Joins and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import check, one_of
from triagegrid.operators import lists
from triagegrid.operators import lookups as L
from triagegrid.operators.builder import TableQuery
from triagegrid.operators.pivots import group_mean
from triagegrid.plans.common import known_people, label_ask, label_of, processors_of, team_tasks, user_ask, user_name
from triagegrid.plans.r7_team_daily import escalation_times


@check(
    "j1_left_on_order_id",
    """SELECT w.orderid, t.orderid AS parent, t.technology_ AS technology FROM work_order w
       LEFT JOIN trouble_ticket t ON w.parentorderid_ = t.orderid""",
)
def left_on_order_id(t):
    take = {"orderid": "parent", "technology_": "technology"}
    joined = L.left_by_key(t["work_order"], "parentorderid_", t["trouble_ticket"], "orderid", take, ["orderid"])
    return joined.select("orderid", "parent", "technology")


@check(
    "j2_parent_fallback",
    """SELECT w.orderid, CASE WHEN w.parentorderid_ IS NOT NULL THEN w.parentorderid_ ELSE t.orderid END AS parent
       FROM work_order w LEFT JOIN trouble_ticket t ON t.ticketid = w.parentticketid""",
)
def parent_fallback(t):
    df = L.parent_fallback(
        t["work_order"], t["trouble_ticket"], "parentticketid", "parentorderid_", "parent", ["orderid"]
    )
    return df.select("orderid", "parent")


@check(
    "j3_association_fan_out",
    """SELECT t.orderid, a.sourceticketid AS source FROM trouble_ticket t
       LEFT JOIN ticket_associate a ON a.associateticketid = t.ticketid""",
)
def association_fan_out(t):
    take = {"sourceticketid": "source"}
    df = L.fan_out_left(t["trouble_ticket"], "ticketid", t["ticket_associate"], "associateticketid", take, ["orderid"])
    return df.select("orderid", "source")


@check(
    "j3_split_fan_out",
    """SELECT t.orderid, a.sourceticketid AS source FROM trouble_ticket t
       LEFT JOIN ticket_associate a ON a.associateticketid = t.ticketid""",
)
def split_fan_out(t):
    """Every ticket with more than one association counts as hot and is split."""
    take = {"sourceticketid": "source"}
    df = L.fan_out_left(t["trouble_ticket"], "ticketid", t["ticket_associate"], "associateticketid", take, ["orderid"], hot_rows=1)
    return df.select("orderid", "source")


@check(
    "j9_stacked_lookups",
    f"""SELECT t.orderid, s.v AS severity, c.v AS cause, u.v AS creator FROM trouble_ticket t LEFT JOIN {one_of("severity", "code", "label")} s ON s.k = t.currentseverity_
        LEFT JOIN {one_of("data_source", "code", "label")} c ON c.k = t.causeofoutage_
        LEFT JOIN {one_of("user_dim", "user_id", "fullname")} u ON u.k = TRY_CAST(replace(t.originator, 'user:', '') AS BIGINT)""",
)
def stacked_lookups(t):
    asks = [
        label_ask(t, "severity", "currentseverity_", "severity"),
        label_ask(t, "data_source", "causeofoutage_", "cause"),
        user_ask(t, "originator", "creator"),
    ]
    return L.stacked_lookups(t["trouble_ticket"], "ticketid", asks).select("orderid", "severity", "cause", "creator")


@check(
    "j4_inner_with_tasks",
    """SELECT w.orderid, k.nodeid, g.v AS assign_group FROM ticket_task k, work_order w, """
    + one_of("user_group", "code", "label")
    + """ g WHERE k.ticketid = w.ticketid AND k.nodeid IN ('WO002', 'WO005')
           AND g.k = rtrim(substr(k.assignto, 11, 1000), '"}') AND upper(g.v) LIKE '%TSC_TRANSPORT%'""",
)
def inner_with_tasks(t):
    wo = t["work_order"].select("ticketid", "orderid")
    return wo.join(team_tasks(t, ["WO002", "WO005"]), "ticketid", "inner").select("orderid", "nodeid", "assign_group")


@check(
    "j5_builder_joins",
    """SELECT w.parentorderid_, w.createtitle_, t.area_, s.c_name FROM work_order w
       INNER JOIN (SELECT orderid AS tt_order, area_ AS area_, ticketid AS tt_id, CAST(substr(deviceid_, 5) AS BIGINT) AS dev
                   FROM trouble_ticket) t ON w.parentorderid_ = t.tt_order AND w.parentticketid <= t.tt_id
       LEFT JOIN customer s ON t.dev = s.c_custkey""",
)
def builder_joins(t):
    tt = t["trouble_ticket"].selectExpr(
        "orderid AS tt_order", "area_ AS tt_area", "ticketid AS tt_id", "CAST(substring(deviceid_, 5) AS BIGINT) AS dev"
    )
    wo = t["work_order"].select("parentorderid_", "createtitle_", "parentticketid")
    q = TableQuery(t.spark, {"wo": wo, "tt": tt, "customer": t["customer"]}).table("wo")
    q.join("tt", [["parentorderid_", "tt_order"], ["parentticketid", "<=", "tt_id"]])
    q.join("customer", ["dev", "c_custkey"], "LEFT")
    return q.select(["parentorderid_", "createtitle_", "tt_area AS area_", "c_name"]).get()


@check(
    "j5_shared_names",
    """SELECT work_order.orderid AS wo, trouble_ticket.orderid AS tt, trouble_ticket.area_ AS area FROM work_order
       INNER JOIN trouble_ticket ON work_order.parentticketid = trouble_ticket.ticketid LEFT JOIN tt_processor ON trouble_ticket.ticketid = tt_processor.ticketid
       WHERE trouble_ticket.processstatus = 'running' AND work_order.processstatus = 'running'""",
)
def shared_names(t):
    q = TableQuery(t.spark, {n: t[n] for n in ("work_order", "trouble_ticket", "tt_processor")}).table("work_order")
    q.join("trouble_ticket", ["parentticketid", "ticketid"]).join("tt_processor", ["trouble_ticket.ticketid", "ticketid"], "LEFT")
    q.where(["trouble_ticket.processstatus", "running"]).where(["work_order.processstatus", "running"])
    return q.select(["work_order.orderid AS wo", "trouble_ticket.orderid AS tt", "trouble_ticket.area_ AS area"]).get()


@check(
    "j5_range_join",
    """SELECT o.o_orderkey, c.c_custkey FROM orders o
       INNER JOIN customer c ON o.o_totalprice >= 100 * c.c_custkey AND o.o_totalprice < 100 * c.c_custkey + 250""",
)
def ranges(t):
    customer = t["customer"].selectExpr("c_custkey", "100 * c_custkey AS low", "100 * c_custkey + 250 AS high")
    q = TableQuery(t.spark, {"orders": t["orders"], "customer": customer}).table("orders")
    q.join("customer", [["o_totalprice", ">=", "low"], ["o_totalprice", "<", "high"]])
    return q.select(["o_orderkey", "c_custkey"]).get()


@check(
    "j5_inequality_join",
    """SELECT n.n_nationkey, s.s_suppkey, s.s_acctbal FROM nation n LEFT JOIN supplier s ON n.n_nationkey * 300.0 < s.s_acctbal AND n.n_nationkey <> s.s_nationkey""",
)
def inequality(t):
    nation = t["nation"].selectExpr("n_nationkey", "n_nationkey * 300.0 AS least")
    q = TableQuery(t.spark, {"nation": nation, "supplier": t["supplier"]}).table("nation")
    q.join("supplier", [["least", "<", "s_acctbal"], ["n_nationkey", "<>", "s_nationkey"]], "LEFT")
    return q.select(["n_nationkey", "s_suppkey", "s_acctbal"]).get()


@check(
    "j6_distinct_scalar_lookup",
    """SELECT a.associateticketid, a.sourceticketid,
              (SELECT DISTINCT v.orderid FROM ticket_order v WHERE v.ticketid = a.sourceticketid) AS parent
       FROM ticket_associate a""",
)
def distinct_scalar_lookup(t):
    return L.lookup(
        t["ticket_associate"], "sourceticketid", t["ticket_order"], "ticketid", "orderid", "parent", strict=True
    )


@check(
    "j7_case_lookup",
    """SELECT t.orderid, CASE WHEN t.siteid_ LIKE '%A1%' THEN (SELECT min(s.site_id) FROM site s WHERE s.id = t.siteid_ AND s.active = 1)
         WHEN t.site_ LIKE '%A1%' THEN (SELECT min(s.site_id) FROM site s WHERE s.id = t.site_ AND s.active = 1)
         WHEN t.siteid_ IS NULL THEN t.site_ ELSE t.siteid_ END AS resolved FROM trouble_ticket t""",
)
def case_lookup(t):
    site, other = F.col("siteid_"), F.col("site_")
    branches = [
        (site.like("%A1%"), site, True),
        (other.like("%A1%"), other, True),
        (site.isNull(), other, False),
        (F.lit(True), site, False),
    ]
    active = t["site"].where("active = 1")
    return L.branch_lookup(t["trouble_ticket"], branches, active, "id", "site_id", "resolved").select(
        "orderid", "resolved"
    )


@check(
    "j8_either_key_lookup",
    """SELECT t.orderid, t.siteid_, t.site_, p.province FROM trouble_ticket t LEFT JOIN (
         SELECT x.ticketid, min(s.province_name) AS province FROM (
           SELECT ticketid, siteid_ AS k FROM trouble_ticket UNION SELECT ticketid, site_ FROM trouble_ticket) x
         JOIN site s ON s.site_id = x.k AND s.active = 1 GROUP BY x.ticketid) p ON p.ticketid = t.ticketid""",
)
def either_key_lookup(t):
    df = L.either_key_lookup(
        t["trouble_ticket"], ("siteid_", "site_"), t["site"].where("active = 1"), "site_id", "province_name", "province"
    )
    return df.select("orderid", "siteid_", "site_", "province")


@check(
    "j9_dimension_lookups",
    f"""SELECT w.orderid, s.v AS severity, u.v AS last_operator, p.processors, n.v AS operator FROM work_order w
        LEFT JOIN {one_of('severity', 'code', 'label')} s ON s.k = w.faultseveritylevelwo_
        LEFT JOIN {one_of('user_group', 'code', 'label')} u ON u.k = w.lastoperator
        LEFT JOIN wo_processor p ON p.ticketid = w.ticketid
        LEFT JOIN {one_of('user_dim', 'user_id', 'fullname')} n ON n.k = CAST(w.wo004_user_wo004 AS BIGINT)""",
)
def dimension_lookups(t):
    df = label_of(t["work_order"], t, "severity", "faultseveritylevelwo_", "severity")
    df = label_of(df, t, "user_group", "lastoperator", "last_operator")
    df = processors_of(df, t, "wo_processor", "processors")
    df = user_name(df, t, "wo004_user_wo004", "operator")
    return df.select("orderid", "severity", "last_operator", "processors", "operator")


_PEOPLE = "(SELECT * FROM user_dim WHERE active = 1 AND user_default_group IS NOT NULL)"


@check(
    "j10_default_group",
    f"""SELECT p.ticketid, CASE
          WHEN EXISTS (SELECT 1 FROM {_PEOPLE} u WHERE u.fullname = p.processors)
            THEN (SELECT arg_min(u.user_default_group, u.user_id) FROM {_PEOPLE} u WHERE u.fullname = p.processors)
          WHEN p.processors IN (SELECT user_default_group FROM {_PEOPLE} x) THEN p.processors ELSE 'NA' END AS grp
        FROM wo_processor p""",
)
def default_group(t):
    directory = L.group_directory(known_people(t))
    return L.default_group(t["wo_processor"], "processors", directory, "grp").select("ticketid", "grp")


@check(
    "j11_id_list_names",
    f"""WITH texts AS (SELECT orderid, replace(replace(transferto_, 'user:', ''), 'group:', '') AS ids FROM sdt_ticket
                       WHERE transferto_ LIKE '%;%'
                       UNION ALL SELECT orderid || '#', replace(createassignto_, 'group:', '') FROM sdt_ticket
                       WHERE createassignto_ LIKE '%;%'),
        single AS (SELECT orderid, unnest(string_split(ids, ';')) AS id, generate_subscripts(string_split(ids, ';'), 1) AS pos FROM texts),
        named AS (SELECT orderid, pos, coalesce(g.v, u.v) AS name FROM single
          LEFT JOIN (SELECT group_id AS k, min(groupname) AS v FROM group_dim WHERE active = 1 GROUP BY 1) g ON g.k = CAST(id AS BIGINT)
          LEFT JOIN (SELECT user_id AS k, min(fullname) AS v FROM {_PEOPLE} q GROUP BY 1) u ON u.k = CAST(id AS BIGINT)),
        kept AS (SELECT orderid, pos, name, min(pos) FILTER (WHERE name IS NOT NULL) OVER (PARTITION BY orderid) AS first FROM named)
        SELECT orderid, coalesce(string_agg(coalesce(name, ''), ';' ORDER BY pos) FILTER (WHERE pos >= first), '') AS names
        FROM kept GROUP BY orderid""",
)
def id_list_names(t):
    sdt = t["sdt_ticket"]
    one = sdt.select("orderid", F.col("transferto_").alias("names"), F.lit(None).cast("string").alias("other"))
    two = sdt.select(F.concat("orderid", F.lit("#")).alias("orderid"), F.lit(None).cast("string").alias("names"),
                     F.replace("createassignto_", F.lit("group:"), F.lit("")).alias("other"))
    both = one.unionByName(two).where(F.contains(F.coalesce("names", "other"), F.lit(";")))
    named = lists.resolve_id_lists(
        both, ["names", "other"], t["group_dim"].where("active = 1"), known_people(t),
        prefixes={"names": ["user:", "group:"]},
    )
    return named.select("orderid", F.coalesce("names", "other").alias("names"))


@check(
    "j12_backfill_parent",
    """SELECT w.orderid, coalesce(w.parentorderid_, (SELECT string_agg(t.orderid, ';' ORDER BY t.orderid)
         FROM trouble_ticket t WHERE t.ticketid = w.parentticketid), '') AS parent FROM work_order w""",
)
def backfill_parent(t):
    df = lists.backfilled_parent(t["work_order"], "parentorderid_", "parentticketid", t["trouble_ticket"], ["orderid"])
    return df.select("orderid", F.col("parentorderid_").alias("parent"))


@check(
    "j13_first_match",
    f"""SELECT s.orderid, coalesce(h.first, '') AS "EscalationTime" FROM sdt_ticket s LEFT JOIN (
          SELECT k.ticketid, min(strftime(date_trunc('second', k.operationtime + INTERVAL 8 HOUR), '%Y-%m-%d %H:%M:%S')) AS first
          FROM ticket_task k JOIN {one_of('user_group', 'code', 'label')} g ON g.k = rtrim(substr(k.assignto, 11, 1000), '"}}')
          WHERE k.nodeid = 'SDT004' AND upper(g.v) LIKE '%TSC_TRANSPORT%' GROUP BY 1) h ON h.ticketid = s.ticketid""",
)
def first_match(t):
    hits = escalation_times(t, t["sdt_ticket"], "SDT004")
    df = L.first_match(t["sdt_ticket"], "orderid", hits, "ORDERID", "ENDORSE_TIME", "EscalationTime")
    return df.select("orderid", "EscalationTime")


@check(
    "j14_keys_of_result",
    """SELECT k.ticketid, k.nodeid, k.operator FROM ticket_task k WHERE k.ticketid IN (
         SELECT w.ticketid FROM work_order w JOIN wo_processor p ON p.ticketid = w.ticketid
         WHERE w.fixedwireless_ = 'Wireless' AND p.processors LIKE '%TSC_TRANSPORT%')""",
)
def keys_of_result(t):
    wireless = t["work_order"].where("fixedwireless_ = 'Wireless'")
    listed = L.keys_only(wireless, "ticketid", t["wo_processor"].where("processors LIKE '%TSC_TRANSPORT%'"), "ticketid")
    return L.keys_only(t["ticket_task"], "ticketid", listed, "ticketid").select("ticketid", "nodeid", "operator")


@check(
    "j15_merge_aggregate",
    """SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, round(avg(l_quantity) OVER (PARTITION BY l_suppkey), 6) AS mean_quantity
       FROM lineitem""",
)
def merge_aggregate(t):
    rows = t["lineitem"].select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    means = group_mean(rows, "l_suppkey", "l_quantity").withColumnRenamed("l_quantity", "mean")
    merged = L.merge_left(rows, means, "l_suppkey")
    return merged.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", F.round("mean", 6).alias("mean_quantity"))
