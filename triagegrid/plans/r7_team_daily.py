"""The daily report of one team: what it handled, accepted, got and still holds, with escalation times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagegrid.functions import fixed
from triagegrid.functions.classify import business_status
from triagegrid.functions.scalars import (
    local_text,
    local_time,
    month_name_text,
    phase_label,
    strip_text,
    time_text,
    whole_second,
)
from triagegrid.operators.lookups import first_match, keys_only, parent_fallback
from triagegrid.operators.predicates import finishes_by, in_local_range, like_any, like_none
from triagegrid.plans.common import (
    columns_as,
    handled_by,
    label_of,
    of_team,
    processors_of,
    roster,
    team_tasks,
    user_name,
)
from triagegrid.sources.sinks import counts_frame, write_counted

TEAM, ZONE = fixed.REPORT_TEAM_GROUP, fixed.LOCAL_ZONE


def _wireless(tables) -> DataFrame:
    return tables["work_order"].where(F.col("fixedwireless_") == "Wireless")


def change_work_handled(tables, start: str, end: str, team: str = TEAM, zone: str = ZONE, **range_options) -> DataFrame:
    """Work orders of change requests assigned to the team and processed in the range."""
    wo = _wireless(tables)
    wo = wo.where(
        F.col("parentcrid_").isNotNull()
        & like_none("createtitle_", fixed.HANDLED_TITLES_REJECTED)
        & in_local_range(wo, "wo005_submit_wo005", start, end, zone, **range_options)
    )
    wo = keys_only(wo, "createassignto_", tables["assign_to"].where(F.col("label") == team), "code")
    df = label_of(wo, tables, "data_source", "implementationtype_", "implementation")
    df = user_name(df, tables, "wo005_user_wo005", "operator")
    return columns_as(
        df,
        {
            "Title": "createtitle_",
            "TicketID": "orderid",
            "ImplementationType": "implementation",
            "Operator": "operator",
            "OperationTime": local_text("wo005_submit_wo005", zone),
        },
    )


def changes_handled(
    tables, start: str, end: str, members: DataFrame | None = None, zone: str = ZONE, **range_options
) -> DataFrame:
    """Change requests handled in the range by people on the roster."""
    cr = tables["change_request"]
    cr = cr.where(in_local_range(cr, "cr004_submit_cr004", start, end, zone, **range_options))
    df = of_team(cr, tables, "cr004_user_cr004", roster(tables) if members is None else members)
    df = label_of(df, tables, "data_source", "operationmodeapprovecr_", "action")
    return columns_as(
        df,
        {
            "Title": "createtitle_",
            "TicketID": "orderid",
            "Action": "action",
            "Operator": "Operator",
            "OperationTime": local_text("cr004_submit_cr004", zone),
        },
    )


def work_accepted(
    tables, start: str, end: str, members: DataFrame | None = None, zone: str = ZONE, **range_options
) -> DataFrame:
    """Work orders accepted in the range by people on the roster."""
    wo = _wireless(tables)
    wo = wo.where(in_local_range(wo, "wo004_submit_wo004", start, end, zone, **range_options))
    df = of_team(wo, tables, "wo004_user_wo004", roster(tables) if members is None else members)
    return columns_as(
        df,
        {
            "Title": "createtitle_",
            "TicketID": "orderid",
            "Status": "processstatus",
            "Operator": "Operator",
            "OperationTime": local_text("wo004_submit_wo004", zone),
        },
    )


def _child_columns(df: DataFrame, tables) -> DataFrame:
    df = parent_fallback(
        df, tables["trouble_ticket"], "parentticketid", "parentorderid_", "ParentTicket", ["orderid"]
    )
    return columns_as(
        df,
        {
            "Workflow": "parentbpdtypeid",
            "Title": "createtitle_",
            "TicketID": "orderid",
            "Status": "processstatus",
            "Operator": "Operator",
            "Action": strip_text("processoptmode_", "ProcessWOOptMode"),
            "ParentTicket": "ParentTicket",
        },
    )


def new_child_work(
    tables, start: str, end: str, members: DataFrame | None = None, zone: str = ZONE, **range_options
) -> DataFrame:
    """R7d: child work orders processed in the range by people on the roster, with their parent ticket."""
    wo = _wireless(tables)
    wo = wo.where(
        F.col("parentbpdtypeid").isNotNull()
        & in_local_range(wo, "wo005_submit_wo005", start, end, zone, **range_options)
    )
    df = of_team(wo, tables, "wo005_user_wo005", roster(tables) if members is None else members)
    return _child_columns(df, tables)


def pending_child_work(tables, team: str = TEAM, zone: str = ZONE) -> DataFrame:
    """R7e: child work orders with the team, chosen by title patterns."""
    wo = _wireless(tables)
    wo = wo.where(
        F.col("parentbpdtypeid").isNotNull()
        & finishes_by(wo, "finishtime_", zone=zone)
        & like_any("createtitle_", fixed.PENDING_TITLES)
        & like_none("createtitle_", fixed.PENDING_TITLES_REJECTED)
    )
    df = user_name(handled_by(wo, tables, "wo_processor", team), tables, "wo005_user_wo005", "Operator")
    return _child_columns(df, tables)


def _endorsed(zone: str) -> Column:
    return whole_second(local_time("operationtime", zone))


def work_escalations(tables, pending: DataFrame, team: str = TEAM, zone: str = ZONE) -> DataFrame:
    """R7f: the team's task log of the listed work orders."""
    wo = keys_only(tables["work_order"].select("ticketid", "orderid", "processdesct_"), "orderid", pending, "TicketID")
    df = wo.join(team_tasks(tables, list(fixed.PHASE_LABELS), team), "ticketid", "inner")
    df = user_name(df, tables, "operator", "processor")
    return columns_as(
        df,
        {
            "ORDERID": "orderid",
            "ENDORSE_TIME": month_name_text(_endorsed(zone)),
            "PHASE": phase_label("nodeid"),
            "PROCESSOR": "processor",
            "ASSIGN_TO": "assign_group",
            "PROCESSREMARKS": "processdesct_",
        },
    )


def escalation_times(
    tables, tickets: DataFrame, node: str, order_id: str | None = None, team: str = TEAM, zone: str = ZONE
) -> DataFrame:
    """R7h: when a ticket was endorsed to the team, for one order id or for all given tickets."""
    rows = tickets.select("ticketid", "orderid")
    if order_id is not None:
        rows = rows.where(F.col("orderid") == order_id)
    df = rows.join(team_tasks(tables, [node], team), "ticketid", "inner")
    return columns_as(
        df, {"ORDERID": "orderid", "ENDORSE_TIME": time_text(_endorsed(zone)), "ASSIGN_TO": "assign_group"}
    )


def running_sdt(tables, team: str = TEAM, zone: str = ZONE) -> DataFrame:
    """R7g: running SDT tickets of the team with the time they were endorsed to it."""
    sdt = handled_by(tables["sdt_ticket"].where(F.col("processstatus") == "running"), tables, "sdt_processor", team)
    df = processors_of(sdt, tables, "sdt_processor", "processors")
    df = user_name(df, tables, "sdt001_user_sdt001", "creator")
    hits = escalation_times(tables, sdt, "SDT004", team=team, zone=zone)
    df = first_match(df, "orderid", hits, "ORDERID", "ENDORSE_TIME", "EscalationTime")
    return columns_as(
        df,
        {
            "Title": "createtitle_",
            "TicketID": "orderid",
            "TicketStatus": "processstatus",
            "BusinessStatus": business_status("servicestatus"),
            "ProcessBy": "processors",
            "CreatedBy": "creator",
            "CreateTime": local_text("createtime", zone),
            "EscalationTime": "EscalationTime",
        },
    )


def team_roster(tables, team: str = TEAM) -> DataFrame:
    return roster(tables, team).select("user_id", "fullname", "user_default_group")


def team_daily(tables, start: str, end: str, members: DataFrame | None = None) -> dict[str, DataFrame]:
    pending = pending_child_work(tables)
    return {
        "CR_WO_Handled": change_work_handled(tables, start, end),
        "CR_Handled": changes_handled(tables, start, end, members),
        "CR_WO_Accepted": work_accepted(tables, start, end, members),
        "New_WO": new_child_work(tables, start, end, members),
        "Pending_WO": pending,
        "Running_SDT": running_sdt(tables),
        "Pending_WO_Escalation": work_escalations(tables, pending),
    }


def write_team_daily(tables, path: str, start: str, end: str, members: DataFrame | None = None) -> DataFrame:
    """Write the seven datasets and count their rows on the way. The escalations read the written pending rows."""
    spark = tables["work_order"].sparkSession
    datasets = team_daily(tables, start, end, members)
    datasets.pop("Pending_WO_Escalation")
    paths, counts = write_counted(datasets, path)
    written = spark.read.parquet(paths["Pending_WO"])
    counts |= write_counted({"Pending_WO_Escalation": work_escalations(tables, written)}, path)[1]
    return counts_frame(spark, counts)
