"""Scalar functions and classification rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import AS_OF, check, local
from triagegrid.functions import classify as C
from triagegrid.functions import fixed
from triagegrid.functions import scalars as S
from triagegrid.operators.builder import TicketFrame
from triagegrid.operators.lookups import group_directory, processor_group
from triagegrid.plans.common import known_people, label_of

_PEOPLE = "(SELECT * FROM user_dim WHERE active = 1 AND user_default_group IS NOT NULL)"


@check(
    "f1_strip_text",
    """SELECT orderid, nullif(replace(servicestatus, 'BusinessStatus', ''), '') AS status,
              nullif(replace(originator, 'user:', ''), '') AS originator FROM trouble_ticket""",
)
def strip_text(t):
    status, who = S.strip_text("servicestatus", "BusinessStatus"), S.strip_text("originator", "user:")
    return t["trouble_ticket"].select("orderid", status.alias("status"), who.alias("originator"))


@check("f2_has_separator", "SELECT orderid, strpos(createassignto_, ';') > 0 AS listed FROM sdt_ticket")
def has_separator(t):
    return t["sdt_ticket"].select("orderid", S.has_separator("createassignto_").alias("listed"))


@check(
    "f3_clean_assignment",
    """SELECT s.orderid, CASE WHEN strpos(s.createassignto_, ';') > 0 THEN replace(s.createassignto_, 'group:', '') ELSE a.label END AS assigned
       FROM sdt_ticket s LEFT JOIN assign_to a ON a.code = s.createassignto_""",
)
def clean_assignment(t):
    df = label_of(t["sdt_ticket"], t, "assign_to", "createassignto_", "label")
    return df.select("orderid", S.clean_assignment("createassignto_", F.col("label")).alias("assigned"))


@check(
    "f4_braced_value",
    """SELECT ticketid, nodeid, operationtime IS NULL AS undated, rtrim(substr(assignto, 11, 1000), '"}') AS group_id FROM ticket_task""",
)
def braced_value(t):
    cut = S.braced_value("assignto").alias("group_id")
    return t["ticket_task"].select("ticketid", "nodeid", F.col("operationtime").isNull().alias("undated"), cut)


@check(
    "f5_upper_contains",
    "SELECT groupname, user_id FROM group_dim JOIN user_dim ON user_id % 25 = group_id - 900000000 "
    "WHERE upper(groupname) LIKE '%TSC_TRANSPORT%'",
)
def upper_contains(t):
    users = t["user_dim"].withColumn("g", F.col("user_id") % 25 + 900000000)
    rows = users.join(t["group_dim"], F.col("g") == F.col("group_id"))
    return rows.where(S.upper_contains("groupname", "TSC_TRANSPORT")).select("groupname", "user_id")


@check(
    "f6_stand_in",
    "SELECT orderid, coalesce(band_, '-') AS band, coalesce(isassociated_, 'NA') AS kind FROM trouble_ticket",
)
def stand_in(t):
    return t["trouble_ticket"].select(
        "orderid", S.or_else("band_").alias("band"), S.or_else("isassociated_", "NA").alias("kind")
    )


@check("f7_time_text", "SELECT orderid, strftime(createtime, '%Y-%m-%d %H:%M:%S') AS created FROM trouble_ticket")
def time_text(t):
    return t["trouble_ticket"].select("orderid", S.time_text("createtime").alias("created"))


@check(
    "f8_month_name_text",
    "SELECT ticketid, nodeid, upper(strftime(operationtime, '%d-%b-%Y %H:%M:%S')) AS at FROM ticket_task",
)
def month_name_text(t):
    return t["ticket_task"].select("ticketid", "nodeid", S.month_name_text("operationtime").alias("at"))


@check("f9_year_number", "SELECT orderid, CAST(year(createtime + INTERVAL 8 HOUR) AS INTEGER) AS created_year FROM work_order")
def year_number(t):
    return t["work_order"].select("orderid", S.year_number(S.local_time("createtime")).alias("created_year"))


@check(
    "f10_parse_time",
    """SELECT orderid, strftime(strptime(txt, '%Y-%m-%d %H:%M:%S') + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS later,
              try_strptime(CASE WHEN orderid LIKE '%7' THEN 'bad' ELSE txt END, '%Y-%m-%d %H:%M:%S') IS NULL AS bad
       FROM (SELECT orderid, strftime(createtime, '%Y-%m-%d %H:%M:%S') AS txt FROM trouble_ticket)""",
)
def parse_time(t):
    rows = t["trouble_ticket"].select("orderid", S.time_text("createtime").alias("txt"))
    later = S.time_text(S.parse_time("txt") + F.expr("INTERVAL '1' HOUR"))
    broken = F.when(F.col("orderid").like("%7"), "bad").otherwise(F.col("txt"))
    return rows.select("orderid", later.alias("later"), S.parse_time(broken, lenient=True).isNull().alias("bad"))


@check(
    "f11_whole_second",
    "SELECT orderid, strftime(date_trunc('second', cr004_submit_cr004), '%Y-%m-%d %H:%M:%S.%f') AS at FROM change_request",
)
def whole_second(t):
    at = F.date_format(S.whole_second("cr004_submit_cr004"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return t["change_request"].select("orderid", at.alias("at"))


@check("f12_recovery_year", "SELECT orderid, CAST(year(faultrecoverytime_) AS INTEGER) AS recovered FROM trouble_ticket")
def recovery_year(t):
    return t["trouble_ticket"].select("orderid", S.year_number("faultrecoverytime_").alias("recovered"))


@check("f13_local_time", f"SELECT orderid, {local('createtime')} AS created, {local('lastupdatetime')} AS updated FROM work_order")
def local_time(t):
    return t["work_order"].select(
        "orderid", S.local_text("createtime").alias("created"), S.local_text("lastupdatetime").alias("updated")
    )


@check(
    "f14_phase_label",
    """SELECT ticketid, nodeid, CASE WHEN nodeid = 'WO002' THEN 'Create WO' WHEN nodeid = 'WO004' THEN 'Handle WO'
              WHEN nodeid = 'WO005' THEN 'Process WO' ELSE 'Confirm WO' END AS phase FROM ticket_task""",
)
def phase_label(t):
    return t["ticket_task"].select("ticketid", "nodeid", S.phase_label("nodeid").alias("phase"))


@check(
    "f15_split_first",
    """SELECT ticketid, string_split(processors, ';')[1] AS first, len(string_split(processors, ';')) AS items FROM wo_processor""",
)
def split_first(t):
    items = F.size(S.trimmed_items("processors")).cast("long")
    size = F.when(F.col("processors").isNotNull(), items)
    return t["wo_processor"].select("ticketid", S.first_item("processors").alias("first"), size.alias("items"))


@check(
    "f16_first_with_code",
    "SELECT ticketid, [x FOR x IN string_split(processors, ';') IF contains(x, 'FFS')][1] AS hit FROM wo_processor",
)
def first_with_code(t):
    return t["wo_processor"].select("ticketid", S.first_item_with("processors", "FFS").alias("hit"))


@check(
    "f17_regex_search",
    "SELECT ticketid, regexp_matches(processors, 'FFS|FxATOP') AS hit FROM wo_processor",
)
def regex_search(t):
    return t["wo_processor"].select("ticketid", S.matches("processors", "FFS|FxATOP").alias("hit"))


@check(
    "f18_value_map",
    """SELECT orderid, CASE area_ WHEN 'Metro Manila' THEN 'MM' WHEN 'North Luzon' THEN 'NL' WHEN 'South Luzon' THEN 'SL'
              WHEN 'Visayas' THEN 'VIS' WHEN 'Mindanao' THEN 'MIN' ELSE area_ END AS area FROM trouble_ticket""",
)
def value_map(t):
    return t["trouble_ticket"].select("orderid", S.map_values("area_", fixed.AREA_CODES).alias("area"))


@check("f19_fill_null", "SELECT orderid, coalesce(remarks_, 'none') AS remarks_, band_ FROM trouble_ticket")
def fill_null(t):
    frame = TicketFrame(t.spark, t["trouble_ticket"].select("orderid", "remarks_", "band_"))
    return frame.fillNulls("remarks_", "none").df


@check(
    "f20_to_number",
    """SELECT orderid, TRY_CAST(replace(deviceid_, 'DEV-', '') AS DOUBLE) AS device, TRY_CAST(area_ AS INTEGER) AS area_number
       FROM trouble_ticket""",
)
def to_number(t):
    device = S.to_number(S.strip_text("deviceid_", "DEV-"))
    return t["trouble_ticket"].select("orderid", device.alias("device"), S.to_number("area_", "int").alias("area_number"))


_MINUTES = f"CAST(floor(epoch(TIMESTAMP '{AS_OF}' - (createtime + INTERVAL 8 HOUR)) / 60) AS BIGINT)"
_DURATION = (
    "CAST(CAST(floor(m / 1440.0) AS BIGINT) AS VARCHAR) || ' days ' || "
    "lpad(CAST(CAST(floor((m - floor(m / 1440.0) * 1440) / 60) AS BIGINT) AS VARCHAR), 2, '0') || ':' || "
    "lpad(CAST(CAST(m - floor(m / 60.0) * 60 AS BIGINT) AS VARCHAR), 2, '0')"
)


@check(
    "f21_duration_text",
    f"SELECT orderid, {_DURATION} AS span FROM (SELECT orderid, CAST(floor(epoch(lastupdatetime - createtime) / 60) AS BIGINT) AS m FROM trouble_ticket)",
)
def duration_text(t):
    minutes = C.whole_minutes(F.col("lastupdatetime"), F.col("createtime"))
    return t["trouble_ticket"].select("orderid", S.duration_text(minutes).alias("span"))


@check("d1_aging_hours", f"SELECT orderid, {_MINUTES} / 60.0::DOUBLE AS hours FROM work_order")
def aging_hours(t):
    return t["work_order"].select("orderid", C.aging_hours(S.local_time("createtime"), AS_OF).alias("hours"))


@check("d2_aging_text", f"SELECT orderid, {_DURATION} AS aging FROM (SELECT orderid, {_MINUTES} AS m FROM work_order)")
def aging_text(t):
    return t["work_order"].select("orderid", C.aging_text(S.local_time("createtime"), AS_OF).alias("aging"))


@check(
    "d3_aging_bucket",
    f"""SELECT orderid, CASE WHEN m < 240 THEN '<4Hrs' WHEN m <= 1440 THEN '4Hrs-24Hrs' WHEN m > 1440 THEN '>24Hrs' END AS bucket
        FROM (SELECT orderid, {_MINUTES} AS m FROM work_order)""",
)
def aging_bucket(t):
    hours = C.aging_hours(S.local_time("createtime"), AS_OF)
    return t["work_order"].select("orderid", C.aging_bucket(hours).alias("bucket"))


def sql_rules(text: str, rules) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({text}, '{p}') THEN '{label}'" for label, p in rules) + " END"


_GROUPED = f"""SELECT p.ticketid, p.processors, CASE
    WHEN EXISTS (SELECT 1 FROM {_PEOPLE} u WHERE u.fullname = p.head) THEN (SELECT arg_min(u.user_default_group, u.user_id) FROM {_PEOPLE} u WHERE u.fullname = p.head)
    WHEN p.head IN (SELECT user_default_group FROM {_PEOPLE} x) THEN p.head ELSE 'NA' END AS base
  FROM (SELECT ticketid, processors, string_split(processors, ';')[1] AS head FROM wo_processor) p"""
_CODED = "coalesce(" + ", ".join(f"[x FOR x IN string_split(processors, ';') IF contains(x, '{c}')][1]" for c in fixed.LIST_CODES) + ")"
GROUPED = f"SELECT DISTINCT ticketid, processors, CASE WHEN processors LIKE '%;%' THEN coalesce({_CODED}, base) ELSE base END AS grp FROM ({_GROUPED})"


def _grouped(t):
    return processor_group(t["wo_processor"], "processors", group_directory(known_people(t)), "grp")


@check(
    "d4_workgroup",
    f"""SELECT ticketid, {sql_rules("CASE WHEN grp = 'NA' THEN processors ELSE grp END", fixed.WORKGROUP_RULES)} AS workgroup,
               {sql_rules("CASE WHEN grp = 'NA' THEN processors ELSE grp END", fixed.OLDER_WORKGROUP_RULES)} AS older FROM ({GROUPED.replace('DISTINCT ', '')})""",
)
def workgroup(t):
    new = C.workgroup("grp", "processors")
    old = C.workgroup("grp", "processors", fixed.OLDER_WORKGROUP_RULES)
    return _grouped(t).select("ticketid", new.alias("workgroup"), old.alias("older"))


@check(
    "d5_area_from_group",
    f"SELECT ticketid, {sql_rules('string_split(processors, chr(59))[2]', fixed.AREA_RULES)} AS area FROM wo_processor",
)
def area_from_group(t):
    second = F.get(S.list_items("processors"), F.lit(1))
    return t["wo_processor"].select("ticketid", C.area_from_group(second).alias("area"))


AREAS = "('Metro Manila', 'North Luzon', 'South Luzon', 'Visayas', 'Mindanao')"


@check(
    "d6_repaired_area",
    f"""SELECT orderid, CASE WHEN area_ IN {AREAS} THEN area_ WHEN trim(string_split(createtitle_, '|')[1]) IN {AREAS}
          THEN trim(string_split(createtitle_, '|')[1]) ELSE {sql_rules('processors', fixed.AREA_RULES)} END AS area
        FROM work_order w JOIN wo_processor p ON p.ticketid = w.ticketid""",
)
def repaired_area(t):
    rows = t["work_order"].join(t["wo_processor"], "ticketid")
    return rows.select("orderid", C.repaired_area("area_", "createtitle_", "processors").alias("area"))


AREA_CASE = (
    "CASE {0} WHEN 'Metro Manila' THEN 'MM' WHEN 'North Luzon' THEN 'NL' WHEN 'South Luzon' THEN 'SL' "
    "WHEN 'Visayas' THEN 'VIS' WHEN 'Mindanao' THEN 'MIN' ELSE {0} END"
)
TECH_CASE = "CASE {0} WHEN 'FDLTE' THEN 'FD-LTE' WHEN 'TDLTE' THEN 'TD-LTE' ELSE {0} END"


@check("d7_area_code", f"SELECT orderid, {AREA_CASE.format('area_')} AS area FROM work_order")
def area_code(t):
    return t["work_order"].select("orderid", C.area_code("area_").alias("area"))


@check("d8_technology_label", f"SELECT orderid, {TECH_CASE.format('technology_')} AS technology FROM trouble_ticket")
def technology_label(t):
    return t["trouble_ticket"].select("orderid", C.technology_label("technology_").alias("technology"))


@check(
    "d9_affecting_type",
    "SELECT orderid, CASE issitedown_ WHEN 'isNo' THEN 'PSA' WHEN 'isYes' THEN 'SA' END AS kind FROM trouble_ticket",
)
def affecting_type(t):
    return t["trouble_ticket"].select("orderid", C.affecting_type("issitedown_").alias("kind"))


@check("d10_list_group", f"SELECT ticketid, grp FROM ({GROUPED.replace('DISTINCT ', '')})")
def list_group(t):
    return _grouped(t).select("ticketid", "grp")


@check(
    "d11_severity_category",
    """SELECT t.orderid, CASE WHEN s.label <> 'Unlisted' THEN s.label END AS severity,
              CAST(list_position(['Critical','Moderate','Major','Minor','Low','Alarm Clearing'], s.label) - 1 AS INTEGER) AS severity_rank
       FROM trouble_ticket t LEFT JOIN severity s ON s.code = t.currentseverity_""",
)
def severity_category(t):
    df = label_of(t["trouble_ticket"], t, "severity", "currentseverity_", "label")
    return df.select(
        "orderid", C.listed_severity("label").alias("severity"), C.severity_rank("label").alias("severity_rank")
    )


@check(
    "d12_business_status",
    """SELECT orderid, nullif(replace(servicestatus, 'BusinessStatus', ''), '') AS status,
              replace(nullif(replace(servicestatus, 'BusinessStatus', ''), ''), 'Resovled', 'Resolved') AS header FROM work_order""",
)
def business_status(t):
    status = C.business_status("servicestatus")
    return t["work_order"].select("orderid", status.alias("status"), C.status_header(status).alias("header"))


@check(
    "d13_year_split",
    """SELECT orderid, year(createtime + INTERVAL 8 HOUR) < 2001 AS earlier, year(createtime + INTERVAL 8 HOUR) = 2001 AS current
       FROM work_order""",
)
def year_split(t):
    rows = t["work_order"].select("orderid", S.year_number(S.local_time("createtime")).alias("y"))
    return rows.select("orderid", C.before_year("y", AS_OF).alias("earlier"), C.in_year("y", AS_OF).alias("current"))
