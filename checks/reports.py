"""Report plans R1 to R7."""

from __future__ import annotations

from checks.base import AS_OF, END, EVENT_END, EVENT_START, FIRST_YEAR, START, check, local, one_of, rounded, stripped
from checks.scalars import AREA_CASE, GROUPED, TECH_CASE, sql_rules
from triagegrid.functions import fixed
from triagegrid.operators.pivots import row_counts
from triagegrid.plans import pending_work as W
from triagegrid.plans import r2_pending_outages as R2
from triagegrid.plans import r7_team_daily as R7
from triagegrid.plans.r1_adhoc_sdt import adhoc_sdt_tickets
from triagegrid.plans.r3_daily_tickets import daily_tickets
from triagegrid.plans.r6_missing_cause import missing_cause
from triagegrid.session import new_path
from triagegrid.sources.sinks import as_of_rows

_PEOPLE = "(SELECT * FROM user_dim WHERE active = 1 AND user_default_group IS NOT NULL)"
USER = one_of("user_dim", "user_id", "fullname")
DS, SEV, ASG = (one_of(d, "code", "label") for d in ("data_source", "severity", "assign_to"))


@check(
    "r1_adhoc_sdt_tickets",
    f"""WITH texts AS (SELECT DISTINCT ids FROM (
            SELECT replace(createassignto_, 'group:', '') AS ids FROM sdt_ticket WHERE createassignto_ LIKE '%;%'
            UNION ALL SELECT replace(replace(transferto_, 'user:', ''), 'group:', '') FROM sdt_ticket WHERE transferto_ LIKE '%;%')),
        single AS (SELECT ids, unnest(string_split(ids, ';')) AS id, generate_subscripts(string_split(ids, ';'), 1) AS pos FROM texts),
        named AS (SELECT ids, pos, coalesce(g.v, u.v) AS name FROM single
          LEFT JOIN (SELECT group_id AS k, min(groupname) AS v FROM group_dim WHERE active = 1 GROUP BY 1) g ON g.k = CAST(id AS BIGINT)
          LEFT JOIN (SELECT user_id AS k, min(fullname) AS v FROM {_PEOPLE} q GROUP BY 1) u ON u.k = CAST(id AS BIGINT)),
        kept AS (SELECT ids, pos, name, min(pos) FILTER (WHERE name IS NOT NULL) OVER (PARTITION BY ids) AS first FROM named),
        lists AS (SELECT ids, coalesce(string_agg(coalesce(name, ''), ';' ORDER BY pos) FILTER (WHERE pos >= first), '') AS names FROM kept GROUP BY ids)
        SELECT s.orderid AS "ORDERID", s.createtitle_ AS "CREATETITLE", s.servicestatus AS "SERVICESTATUS", s.processstatus AS "PROCESSSTATUS",
          {local('s.createtime')} AS "CREATETIME", {local('s.lastupdatetime')} AS "LASTUPDATETIME", {local('s.sdt005_submit_sdt005')} AS "CLOSETIME",
          s.details_ AS "DETAILS",
          (SELECT string_agg(w.orderid, ',' ORDER BY w.ticketid) FROM work_order w WHERE w.parentticketid = s.ticketid) AS "SUBPROCESS_WO",
          CASE WHEN s.createassignto_ LIKE '%;%' THEN l1.names ELSE a1.v END AS "CREATEASSIGNTO",
          CASE WHEN s.transferto_ LIKE '%;%' THEN l2.names ELSE a2.v END AS "TRANSFERTO",
          p.processors AS "CURRENTPROCESSOR", u1.v AS "LASTOPERATOR", u2.v AS "ORIGINATOR", s.category_ AS "CATEGORY",
          s.subcategory_ AS "SUBCATEGORY", s.suplementaryinfo_ AS "SUPLEMENTARYINFO", s.resolvesolutiondes_ AS "RESOLVESOLUTION",
          s.closedescriptiona_ AS "CLOSEDESCRIPTION", s.remarks_ AS "REMARKS"
        FROM sdt_ticket s LEFT JOIN {ASG} a1 ON a1.k = s.createassignto_ LEFT JOIN {ASG} a2 ON a2.k = s.transferto_
        LEFT JOIN lists l1 ON l1.ids = replace(s.createassignto_, 'group:', '')
        LEFT JOIN lists l2 ON l2.ids = replace(replace(s.transferto_, 'user:', ''), 'group:', '')
        LEFT JOIN sdt_processor p ON p.ticketid = s.ticketid
        LEFT JOIN {USER} u1 ON u1.k = CAST(replace(s.lastoperator, 'user:', '') AS BIGINT)
        LEFT JOIN {USER} u2 ON u2.k = CAST(replace(s.originator, 'user:', '') AS BIGINT)
        WHERE s.createassignto_ LIKE '%900000001%'""",
)
def r1(t):
    return adhoc_sdt_tickets(t, "900000001")


_R2_DETAIL = f"""SELECT a.orderid AS "TicketID", {stripped('a.servicestatus', 'BusinessStatus')} AS "BusinessStatus", a.title_ AS "Title",
    a.description_ AS "Description", {AREA_CASE.format('a.area_')} AS "Area", a.isassociated_ AS "RelationshipType",
    {local('a.faultlastoccurtime_')} AS "FaultLastOccurTime", {local('a.faultrecoverytime_')} AS "FaultRecoveryTime", a.siteid_ AS "SiteID",
    a.sitename_ AS "SiteName", a.alarmname_ AS "AlarmName", {TECH_CASE.format('a.technology_')} AS "Technology", a.band_ AS "Band",
    a.sitemaintainergroup_ AS "SiteMaintainerGroup", a.city_ AS "City", a.province_ AS "Province", d.v AS "CauseOfOutage",
    s.v AS "CurrentSeverity", a.remarks_ AS "Remarks"
  FROM trouble_ticket a LEFT JOIN {DS} d ON d.k = a.causeofoutage_ LEFT JOIN {SEV} s ON s.k = a.currentseverity_
  WHERE a.fixedwirelesscreate_ = 'Wireless' AND a.domain_ = 'RAN' AND a.description_ LIKE '%FULL OUTAGE%'
    AND (a.faultrecoverytime_ IS NULL OR year(a.faultrecoverytime_) = 1970) AND a.processstatus = 'running'"""


@check("r2_outage_tickets", _R2_DETAIL)
def r2_detail(t):
    return R2.outage_tickets(t)


def _tech_grid(detail: str, value: str, where: str) -> str:
    cells = ", ".join(f"""nullif(count({value}) FILTER (WHERE "Technology" = '{c}'), 0) AS "{c}" """ for c in fixed.TECHNOLOGY_AXIS)
    areas = ", ".join(f"('{a}')" for a in fixed.AREA_AXIS)
    return f"""WITH d AS ({detail}), f AS (SELECT * FROM d WHERE "Area" IS NOT NULL AND "Technology" IS NOT NULL AND {where}),
        g AS (SELECT CASE WHEN grouping("Area") = 1 THEN 'TOTAL' ELSE "Area" END AS a, {cells}, nullif(count({value}), 0) AS "TOTAL"
              FROM f GROUP BY ROLLUP ("Area"))
        SELECT x.a AS "Area", {', '.join(f'g."{c}"' for c in fixed.TECHNOLOGY_AXIS)}, g."TOTAL"
        FROM (VALUES {areas}, ('TOTAL')) x(a) LEFT JOIN g ON g.a = x.a"""


@check("r2_outage_grid", _tech_grid(_R2_DETAIL, '"TicketID"', "\"Area\" IN ('MM', 'NL', 'SL', 'VIS', 'MIN')"))
def r2_grid(t):
    return R2.outage_grid(R2.outage_tickets(t))


@check(
    "r3_daily_tickets",
    f"""SELECT v.orderid AS "ParentTicketID", t.orderid AS "TicketID",
          (SELECT string_agg(w.orderid, ',' ORDER BY w.ticketid) FROM work_order w WHERE w.parentticketid = t.ticketid) AS "SubProcessWO",
          t.processstatus AS "ProcessStatus", {stripped('t.servicestatus', 'BusinessStatus')} AS "BusinessStatus", t.title_ AS "Title",
          t.description_ AS "Description", {AREA_CASE.format('t.area_')} AS "Area", t.isassociated_ AS "RelationshipType", u.v AS "CreatedBy",
          {local('t.createtime')} AS "TicketCreatedTime", {local('t.faultfirstoccurtime_')} AS "Fault First Occur Time",
          {local('t.faultlastoccurtime_')} AS "FaultLastOccurTime", {local('t.faultrecoverytime_')} AS "FaultRecoveryTime",
          t.siteid_ AS "SiteID", t.sitename_ AS "SiteName", t.alarmname_ AS "AlarmName", {TECH_CASE.format('t.technology_')} AS "Technology",
          t.band_ AS "Band", t.sitemaintainergroup_ AS "SiteMaintainerGroup", t.city_ AS "City", t.province_ AS "Province", d.v AS "CauseOfOutage",
          t.subcauseone_ AS "SubCause1", t.subcausetwo_ AS "SubCause2", s.v AS "CurrentSeverity", t.remarks_ AS "Remarks"
        FROM trouble_ticket t LEFT JOIN ticket_associate m ON m.associateticketid = t.ticketid
        LEFT JOIN ticket_order v ON v.ticketid = m.sourceticketid LEFT JOIN {DS} d ON d.k = t.causeofoutage_
        LEFT JOIN {SEV} s ON s.k = t.currentseverity_ LEFT JOIN {USER} u ON u.k = CAST(replace(t.originator, 'user:', '') AS BIGINT)
        WHERE t.fixedwirelesscreate_ = 'Wireless' AND (
          (t.faultfirstoccurtime_ + INTERVAL 8 HOUR <= TIMESTAMP '{END}' AND t.faultrecoverytime_ + INTERVAL 8 HOUR >= TIMESTAMP '{START}')
          OR t.faultrecoverytime_ IS NULL OR year(t.faultrecoverytime_) = 1970)""",
)
def r3(t):
    return daily_tickets(t, START, END)


_HEAD = f"""SELECT DISTINCT p.ticketid, CASE
    WHEN EXISTS (SELECT 1 FROM {_PEOPLE} u WHERE u.fullname = p.head) THEN (SELECT arg_min(u.user_default_group, u.user_id) FROM {_PEOPLE} u WHERE u.fullname = p.head)
    WHEN p.head IN (SELECT user_default_group FROM {_PEOPLE} x) THEN p.head ELSE 'NA' END AS grp
  FROM (SELECT ticketid, string_split(processors, ';')[1] AS head FROM wo_processor) p"""
_M = f"CAST(floor(epoch(TIMESTAMP '{AS_OF}' - (w.createtime + INTERVAL 8 HOUR)) / 60) AS BIGINT)"
_SPAN = (
    f"CAST(CAST(floor({_M} / 1440.0) AS BIGINT) AS VARCHAR) || ' days ' || "
    f"lpad(CAST(CAST(floor(({_M} - floor({_M} / 1440.0) * 1440) / 60) AS BIGINT) AS VARCHAR), 2, '0') || ':' || "
    f"lpad(CAST(CAST({_M} - floor({_M} / 60.0) * 60 AS BIGINT) AS VARCHAR), 2, '0')"
)
_WO_FROM = f"""FROM work_order w LEFT JOIN trouble_ticket b ON w.parentorderid_ = b.orderid
  LEFT JOIN {SEV} s ON s.k = w.faultseveritylevelwo_ LEFT JOIN {one_of('user_group', 'code', 'label')} o ON o.k = w.lastoperator
  LEFT JOIN wo_processor p ON p.ticketid = w.ticketid LEFT JOIN trouble_ticket f ON w.parentorderid_ IS NULL AND f.ticketid = w.parentticketid
  LEFT JOIN grouped g ON g.ticketid = w.ticketid
  WHERE w.fixedwireless_ = 'Wireless' AND w.parentbpdtypeid = 'TroubleTicket' AND w.processstatus = 'running'
    AND year(w.createtime + INTERVAL 8 HOUR) >= {FIRST_YEAR}
    AND CAST(w.wo002_user_wo002 AS BIGINT) IN (SELECT user_id FROM user_dim WHERE user_default_group = 'NOC_NAC_NSC')"""
_WO_COMMON = f"""w.orderid AS "WO_TicketID", w.createtitle_ AS "WO_Title", w.processstatus AS "WO_Status",
  {local('w.createtime')} AS "WO_CreateTime", {local('w.lastupdatetime')} AS "WO_LastUpdateTime", 'NOC_NAC_NSC' AS "WO_OriginatorGroup",
  o.v AS "WO_LastOperator", p.processors AS "WO_CurrentProcessor", g.grp AS "WO_CurrentProcessorGroup", w.domain_ AS "Domain",
  w.region_ AS "Region", coalesce(w.parentorderid_, f.orderid, '') AS "TT_TicketID", b.site_id AS "SiteID", b.site_name AS "SiteName",
  b.issitedown_ AS "SiteDown", b.processstatus AS "TT_TicketStatus", {local('b.faultfirstoccurtime_')} AS "TT_FaultFirstOccurTime",
  {local('b.faultrecoverytime_')} AS "TT_FaultRecoveryTime", {local('b.lastupdatetime')} AS "TT_LastUpdateTime", b.alarmname_ AS "TT_AlarmName" """


@check(
    "r4_pending_flat",
    f"""WITH grouped AS ({_HEAD}) SELECT {_WO_COMMON}, s.v AS "Fault_Severity_Level", w.area_ AS "Area", {_SPAN} AS "Aging" {_WO_FROM}""",
)
def r4(t):
    return W.pending_flat(t, AS_OF, FIRST_YEAR)


_AREA_LIST = "('Metro Manila', 'North Luzon', 'South Luzon', 'Visayas', 'Mindanao')"
_TITLE_AREA = "trim(string_split(w.createtitle_, '|')[1])"
_AREA = f"""CASE WHEN w.area_ IN {_AREA_LIST} THEN w.area_ WHEN {_TITLE_AREA} IN {_AREA_LIST} THEN {_TITLE_AREA}
  ELSE {sql_rules('g.grp', fixed.AREA_RULES)} END"""
PREPARED = f"""SELECT {_WO_COMMON}, {stripped('w.servicestatus', 'BusinessStatus')} AS "WO_BusinessStatus",
    CASE WHEN s.v <> 'Unlisted' THEN s.v END AS "Fault_Severity_Level", {_M} / 60.0::DOUBLE AS "Aging (Hrs)",
    CASE WHEN {_M} < 240 THEN '<4Hrs' WHEN {_M} <= 1440 THEN '4Hrs-24Hrs' ELSE '>24Hrs' END AS "Aging Grp",
    {sql_rules("CASE WHEN g.grp = 'NA' THEN p.processors ELSE g.grp END", fixed.WORKGROUP_RULES)} AS "Workgroup",
    {AREA_CASE.format('(' + _AREA + ')')} AS "Area", {TECH_CASE.format('b.technology_')} AS "Technology",
    CASE b.issitedown_ WHEN 'isNo' THEN 'PSA' WHEN 'isYes' THEN 'SA' END AS "Service Affecting Type",
    CAST(year(w.createtime + INTERVAL 8 HOUR) AS INTEGER) AS "WO_CreateYear" {_WO_FROM}"""


def _detail(t):
    return W.prepared(t, AS_OF, FIRST_YEAR)


def _cells(t):
    return W.pending_lattice(_detail(t))


def _with_detail(rest: str) -> str:
    """A query over the prepared detail ``d``."""
    return f"WITH grouped AS ({GROUPED}), d AS ({PREPARED}) {rest}"


@check("r5a_pending_prepared", _with_detail("SELECT * FROM d"))
def r5a(t):
    return _detail(t)


_SITES = """, s1 AS (SELECT *, avg("Aging (Hrs)") OVER (PARTITION BY "SiteID") AS site_mean, row_number() OVER (PARTITION BY "SiteID"
    ORDER BY list_position(['Critical','Moderate','Major','Minor','Low','Alarm Clearing'], "Fault_Severity_Level") NULLS LAST, "WO_TicketID") AS n
    FROM d WHERE "SiteDown" = 'isYes' AND "SiteID" IS NOT NULL),
  sites AS (SELECT * EXCLUDE ("Aging (Hrs)", site_mean, n), site_mean AS "Aging (Hrs)" FROM s1 WHERE n = 1)"""


def _down_grid() -> str:
    grid = _tech_grid("SELECT * FROM prep", '"WO_TicketID"', "\"SiteDown\" = 'isYes'")
    return f"WITH grouped AS ({GROUPED}), prep AS ({PREPARED}), " + grid[len("WITH ") :]


@check("r5b_site_down_grid", _down_grid())
def r5b(t):
    return W.site_down_grid(_cells(t))


@check(
    "r5c_unique_sites",
    f"""WITH grouped AS ({GROUPED}), d AS ({PREPARED}) {_SITES}
        SELECT * EXCLUDE ("Aging (Hrs)"), round("Aging (Hrs)", 6) AS "Aging (Hrs)" FROM sites""",
)
def r5c(t):
    return rounded(W.unique_sites(_detail(t)), W.AGING)


@check(
    "r5d_workgroup_grid",
    f"""WITH grouped AS ({GROUPED}), d AS ({PREPARED}) {_SITES},
        m AS (SELECT CASE WHEN grouping("Workgroup") = 1 THEN 'TOTAL' ELSE "Workgroup" END AS g, round(avg("Aging (Hrs)"), 6) AS a,
          nullif(count(*) FILTER (WHERE "WO_CreateYear" < 2001), 0) AS p,
          nullif(count(*) FILTER (WHERE "WO_CreateYear" = 2001 AND "Aging Grp" = '<4Hrs'), 0) AS b1,
          nullif(count(*) FILTER (WHERE "WO_CreateYear" = 2001 AND "Aging Grp" = '4Hrs-24Hrs'), 0) AS b2,
          nullif(count(*) FILTER (WHERE "WO_CreateYear" = 2001 AND "Aging Grp" = '>24Hrs'), 0) AS b3
          FROM sites WHERE "Workgroup" IS NOT NULL GROUP BY ROLLUP ("Workgroup"))
        SELECT x.g AS "Workgroup", a AS "Average (Hrs)", p AS "Prev Years", b1 AS "<4Hrs", b2 AS "4Hrs-24Hrs", b3 AS ">24Hrs"
        FROM (SELECT DISTINCT "Workgroup" AS g FROM d WHERE "Workgroup" IS NOT NULL AND "Workgroup" <> 'NOC' UNION ALL SELECT 'TOTAL') x
        LEFT JOIN m ON m.g = x.g""",
)
def r5d(t):
    return rounded(W.workgroup_grid(_cells(t), W.unique_sites(_detail(t)), AS_OF), "Average (Hrs)")


STATUSES = ["EscalatedtoVendor", "New", "Pending", "Resovled", "WIP"]
_MEASURES = (
    """nullif(count(*), 0) AS "Total Pending", nullif(count("TT_FaultRecoveryTime"), 0) AS "With FRT",
    round(avg("Aging (Hrs)") FILTER (WHERE "TT_FaultRecoveryTime" IS NOT NULL), 6) AS "With FRT Average (Hrs)",
    round(avg("Aging (Hrs)"), 6) AS "Average (Hrs)", """
    + ", ".join(f"""nullif(count(*) FILTER (WHERE "Aging Grp" = '{b}'), 0) AS "{b}" """ for b in fixed.AGING_AXIS)
    + ", "
    + ", ".join(
        f"""nullif(count(*) FILTER (WHERE "WO_BusinessStatus" = '{s}'), 0) AS "{s.replace('Resovled', 'Resolved')}" """
        for s in STATUSES
    )
)


@check(
    "r5e_severity_grid",
    f"""WITH grouped AS ({GROUPED}), d AS ({PREPARED}),
        m AS (SELECT CASE WHEN grouping("Service Affecting Type") = 1 THEN 'All' ELSE "Service Affecting Type" END AS "Service Affecting Type", {_MEASURES}
              FROM d WHERE "Service Affecting Type" IS NOT NULL GROUP BY ROLLUP ("Service Affecting Type"))
        SELECT x.k AS "Service Affecting Type", m.* EXCLUDE ("Service Affecting Type")
        FROM (VALUES ('SA'), ('PSA'), ('All')) x(k) LEFT JOIN m ON m."Service Affecting Type" = x.k""",
)
def r5e(t):
    return rounded(W.severity_grid(_cells(t), STATUSES), "With FRT Average (Hrs)", "Average (Hrs)")


@check(
    "r5f_workgroup_severity_grid",
    f"""WITH grouped AS ({GROUPED}), d AS ({PREPARED}),
        m AS (SELECT "Workgroup", "Service Affecting Type", {_MEASURES} FROM d
              WHERE "Service Affecting Type" IS NOT NULL AND "Workgroup" IS NOT NULL GROUP BY ALL)
        SELECT w.g AS "Workgroup", x.k AS "Service Affecting Type", m.* EXCLUDE ("Workgroup", "Service Affecting Type")
        FROM (SELECT DISTINCT "Workgroup" AS g FROM d WHERE "Workgroup" IS NOT NULL AND "Workgroup" <> 'NOC') w
        CROSS JOIN (VALUES ('SA'), ('PSA')) x(k) LEFT JOIN m ON m."Workgroup" = w.g AND m."Service Affecting Type" = x.k""",
)
def r5f(t):
    return rounded(W.workgroup_severity_grid(_cells(t), STATUSES), "With FRT Average (Hrs)", "Average (Hrs)")


@check(
    "r5_pending_report",
    f"""WITH grouped AS ({GROUPED}), d AS MATERIALIZED ({PREPARED}) {_SITES}
        SELECT 'All Raw Data' AS dataset, count(*) AS rows FROM d UNION ALL SELECT 'Unique Sites', count(*) FROM sites
        UNION ALL SELECT 'Per Technology', 6 UNION ALL SELECT 'Per Severity', 3
        UNION ALL SELECT 'Per Resolving Team', 1 + count(DISTINCT "Workgroup") FILTER (WHERE "Workgroup" <> 'NOC') FROM d
        UNION ALL SELECT 'Per Workgroup and Severity', 2 * count(DISTINCT "Workgroup") FILTER (WHERE "Workgroup" <> 'NOC') FROM d""",
)
def r5(t):
    """The whole report, written; the rows of each of its datasets."""
    written = W.write_pending_report(t, new_path(t.spark, "pending-report"), AS_OF, first_year=FIRST_YEAR)
    return row_counts({name: t.spark.read.parquet(path) for name, path in written.items()})


def _nvl(c: str) -> str:
    return f"coalesce(t.{c}, '-')"


_SITE = one_of("active_site", "id", "site_id")
_PROVINCE = one_of("active_site", "site_id", "province_name")


@check(
    "r6_missing_cause_snapshot",
    f"""WITH active_site AS (SELECT * FROM site WHERE active = 1),
        kids AS (SELECT w.parentticketid AS k, string_agg(w.orderid, ',' ORDER BY w.ticketid) AS ids,
            string_agg(w.processstatus, ',' ORDER BY w.processstatus) AS statuses, string_agg(p.processors, ',' ORDER BY p.processors) AS procs
          FROM work_order w LEFT JOIN wo_processor p ON p.ticketid = w.ticketid GROUP BY 1)
        SELECT '2021-12-10' AS asof, v.orderid AS parent_ticket_id, t.orderid AS ticket_id,
          CASE WHEN t.siteid_ LIKE '%A1%' THEN s1.v WHEN t.site_ LIKE '%A1%' THEN s2.v WHEN t.siteid_ IS NULL THEN t.site_ ELSE t.siteid_ END AS site_id,
          {_nvl('sitenametest_')} AS site_name, {_nvl('domain_')} AS domain, {_nvl('technology_')} AS technology, {_nvl('band_')} AS band,
          {_nvl('deviceid_')} AS device, {_nvl('sitemaintainergroup_')} AS device_owner, {_nvl('city_')} AS city,
          coalesce(p1.v, p2.v) AS province, {_nvl('area_')} AS area,
          coalesce(nullif(replace(t.initialserviceaffectingne_, 'TTAffectedService', ''), ''), 'A100000029') AS service_affecting,
          replace({_nvl('issitedown_')}, 'is', '') AS site_down, t.causeofoutage_ AS cause_of_outage, t.subcauseone_ AS sub_cause_1,
          t.subcausetwo_ AS sub_cause_2, t.subcausethree_ AS sub_cause_3,
          nullif(replace({_nvl('servicestatus')}, 'BusinessStatus', ''), '') AS ticket_status, k.ids AS subprocess_wo,
          k.statuses AS subprocess_wo_status, k.procs AS subprocess_wo_currentprocessor, {local('t.createtime')} AS ticket_created_time,
          {local('t.faultfirstoccurtime_')} AS fault_first_occur_time, {local('t.faultrecoverytime_')} AS fault_recovery_time,
          a.v AS assign_to, p.processors AS tt_currentprocessor, coalesce(t.isassociated_, 'NA') AS relationship_type
        FROM trouble_ticket t LEFT JOIN ticket_associate m ON m.associateticketid = t.ticketid LEFT JOIN ticket_order v ON v.ticketid = m.sourceticketid
        LEFT JOIN {_SITE} s1 ON s1.k = t.siteid_ LEFT JOIN {_SITE} s2 ON s2.k = t.site_
        LEFT JOIN {_PROVINCE} p1 ON p1.k = t.siteid_ LEFT JOIN {_PROVINCE} p2 ON p2.k = t.site_
        LEFT JOIN {ASG} a ON a.k = t.assignto_ LEFT JOIN tt_processor p ON p.ticketid = t.ticketid LEFT JOIN kids k ON k.k = t.ticketid
        WHERE t.fixedwirelesscreate_ = 'Wireless'
          AND t.servicestatus NOT IN ('BusinessStatusCompleted', 'BusinessStatusClosed', 'BusinessStatusCancel')
          AND (t.faultrecoverytime_ IS NOT NULL OR year(t.faultrecoverytime_ + INTERVAL 8 HOUR) <> 1970)
          AND year(t.faultfirstoccurtime_ + INTERVAL 8 HOUR) >= {FIRST_YEAR} AND (t.causeofoutage_ IS NULL OR t.subcauseone_ IS NULL)""",
)
def r6(t):
    return as_of_rows(missing_cause(t, FIRST_YEAR), "2021-12-10")


def _range(c: str, start: str = START, end: str = END) -> str:
    return f"{c} + INTERVAL 8 HOUR >= TIMESTAMP '{start}' AND {c} + INTERVAL 8 HOUR <= TIMESTAMP '{end}'"


_TEAM = "(SELECT fullname FROM user_dim WHERE active = 1 AND user_default_group = 'TSC_TRANSPORT')"


@check(
    "r7a_change_work_handled",
    f"""SELECT w.createtitle_ AS "Title", w.orderid AS "TicketID", d.v AS "ImplementationType", u.v AS "Operator", {local('w.wo005_submit_wo005')} AS "OperationTime"
        FROM work_order w JOIN {ASG} a ON a.k = w.createassignto_ LEFT JOIN {DS} d ON d.k = w.implementationtype_
        LEFT JOIN {USER} u ON u.k = CAST(w.wo005_user_wo005 AS BIGINT)
        WHERE w.fixedwireless_ = 'Wireless' AND a.v = 'TSC_TRANSPORT' AND w.parentcrid_ IS NOT NULL AND """
    + " AND ".join(f"w.createtitle_ NOT LIKE '{p}'" for p in fixed.HANDLED_TITLES_REJECTED)
    + f" AND {_range('w.wo005_submit_wo005')}",
)
def r7a(t):
    return R7.change_work_handled(t, START, END)


@check(
    "r7b_changes_handled",
    f"""SELECT c.createtitle_ AS "Title", c.orderid AS "TicketID", d.v AS "Action", u.v AS "Operator", {local('c.cr004_submit_cr004')} AS "OperationTime"
        FROM change_request c LEFT JOIN {DS} d ON d.k = c.operationmodeapprovecr_ JOIN {USER} u ON u.k = CAST(c.cr004_user_cr004 AS BIGINT)
        WHERE u.v IN {_TEAM} AND {_range('c.cr004_submit_cr004', EVENT_START, EVENT_END)}""",
)
def r7b(t):
    return R7.changes_handled(t, EVENT_START, EVENT_END)


@check(
    "r7c_work_accepted",
    f"""SELECT w.createtitle_ AS "Title", w.orderid AS "TicketID", w.processstatus AS "Status", u.v AS "Operator", {local('w.wo004_submit_wo004')} AS "OperationTime"
        FROM work_order w JOIN {USER} u ON u.k = CAST(w.wo004_user_wo004 AS BIGINT)
        WHERE w.fixedwireless_ = 'Wireless' AND u.v IN {_TEAM} AND {_range('w.wo004_submit_wo004')}""",
)
def r7c(t):
    return R7.work_accepted(t, START, END)


_CHILD = f"""SELECT w.parentbpdtypeid AS "Workflow", w.createtitle_ AS "Title", w.orderid AS "TicketID", w.processstatus AS "Status", u.v AS "Operator",
    {stripped('w.processoptmode_', 'ProcessWOOptMode')} AS "Action",
    CASE WHEN w.parentorderid_ IS NOT NULL THEN w.parentorderid_ ELSE b.orderid END AS "ParentTicket"
  FROM work_order w LEFT JOIN trouble_ticket b ON b.ticketid = w.parentticketid LEFT JOIN {USER} u ON u.k = CAST(w.wo005_user_wo005 AS BIGINT)
  WHERE w.fixedwireless_ = 'Wireless' AND w.parentbpdtypeid IS NOT NULL"""


@check("r7d_new_child_work", f"{_CHILD} AND u.v IN {_TEAM} AND {_range('w.wo005_submit_wo005')}")
def r7d(t):
    return R7.new_child_work(t, START, END)


_PENDING = (
    f"{_CHILD} AND w.finishtime_ + INTERVAL 8 HOUR <= TIMESTAMP '2030-12-31 23:59:59' AND ("
    + " OR ".join(f"w.createtitle_ LIKE '{p}'" for p in fixed.PENDING_TITLES)
    + ") AND w.createtitle_ NOT LIKE '%lower%' AND w.createtitle_ NOT LIKE '%TSC_%'"
    + " AND w.ticketid IN (SELECT ticketid FROM wo_processor WHERE processors LIKE '%TSC_TRANSPORT%')"
)


@check("r7e_pending_child_work", _PENDING)
def r7e(t):
    return R7.pending_child_work(t)


_GRP = one_of("user_group", "code", "label")


@check(
    "r7f_work_escalations",
    f"""WITH pending AS ({_PENDING})
        SELECT w.orderid AS "ORDERID", upper(strftime(k.operationtime + INTERVAL 8 HOUR, '%d-%b-%Y %H:%M:%S')) AS "ENDORSE_TIME",
          CASE k.nodeid WHEN 'WO002' THEN 'Create WO' WHEN 'WO004' THEN 'Handle WO' WHEN 'WO005' THEN 'Process WO' ELSE 'Confirm WO' END AS "PHASE",
          u.v AS "PROCESSOR", g.v AS "ASSIGN_TO", w.processdesct_ AS "PROCESSREMARKS"
        FROM ticket_task k JOIN work_order w ON w.ticketid = k.ticketid JOIN {_GRP} g ON g.k = rtrim(substr(k.assignto, 11, 1000), '"}}')
        LEFT JOIN {USER} u ON u.k = CAST(k.operator AS BIGINT)
        WHERE k.nodeid IN ('WO002', 'WO004', 'WO005') AND upper(g.v) LIKE '%TSC_TRANSPORT%' AND w.orderid IN (SELECT "TicketID" FROM pending)""",
)
def r7f(t):
    return R7.work_escalations(t, R7.pending_child_work(t))


_ENDORSED = "strftime(date_trunc('second', k.operationtime + INTERVAL 8 HOUR), '%Y-%m-%d %H:%M:%S')"


@check(
    "r7g_running_sdt",
    f"""SELECT s.createtitle_ AS "Title", s.orderid AS "TicketID", s.processstatus AS "TicketStatus",
          {stripped('s.servicestatus', 'BusinessStatus')} AS "BusinessStatus", p.processors AS "ProcessBy", u.v AS "CreatedBy",
          {local('s.createtime')} AS "CreateTime", coalesce(h.first, '') AS "EscalationTime"
        FROM sdt_ticket s JOIN sdt_processor p ON p.ticketid = s.ticketid LEFT JOIN {USER} u ON u.k = CAST(s.sdt001_user_sdt001 AS BIGINT)
        LEFT JOIN (SELECT k.ticketid, min({_ENDORSED}) AS first FROM ticket_task k JOIN {_GRP} g ON g.k = rtrim(substr(k.assignto, 11, 1000), '"}}')
          WHERE k.nodeid = 'SDT004' AND upper(g.v) LIKE '%TSC_TRANSPORT%' GROUP BY 1) h ON h.ticketid = s.ticketid
        WHERE s.processstatus = 'running' AND p.processors LIKE '%TSC_TRANSPORT%'""",
)
def r7g(t):
    return R7.running_sdt(t)


@check(
    "r7h_escalation_times",
    f"""SELECT w.orderid AS "ORDERID", {_ENDORSED} AS "ENDORSE_TIME", g.v AS "ASSIGN_TO"
        FROM ticket_task k JOIN work_order w ON w.ticketid = k.ticketid JOIN {_GRP} g ON g.k = rtrim(substr(k.assignto, 11, 1000), '"}}')
        WHERE k.nodeid = 'WO005' AND upper(g.v) LIKE '%TSC_TRANSPORT%'""",
)
def r7h(t):
    return R7.escalation_times(t, t["work_order"], "WO005")


@check(
    "r7h_team_roster",
    "SELECT user_id, fullname, user_default_group FROM user_dim WHERE active = 1 AND user_default_group = 'TSC_TRANSPORT'",
)
def r7h_roster(t):
    return R7.team_roster(t)
