"""Pending work orders of one origin group, flat and as a set of pivots and grids."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagegrid.functions import fixed
from triagegrid.functions import classify as C
from triagegrid.functions.scalars import as_col, local_text, local_time
from triagegrid.operators.dedupe import worst_per_key
from triagegrid.operators.edits import insert_columns
from triagegrid.operators.grids import dense_grid, dense_grid_over
from triagegrid.operators.lookups import (
    Ask,
    first_processor,
    group_directory,
    keys_only,
    left_by_key,
    picked_group,
    stacked_lookups,
)
from triagegrid.operators.pivots import (
    TOTAL,
    Lattice,
    Measure,
    axis_values,
    distinct_axis,
    lattice,
    pivot_with_total,
    with_inner_rows,
    with_total,
)
from triagegrid.operators.predicates import since_year
from triagegrid.plans.common import columns_as, known_people, label_ask, processors_of
from triagegrid.session import stored
from triagegrid.sources.sinks import write_report

STATUS = "running"
AGING, BUCKET, AFFECTING = "Aging (Hrs)", "Aging Grp", "Service Affecting Type"
RECOVERED = "Recovered"
# What the grids group and measure by, and what they count and take means of.
GRID_KEYS = ["Area", "Technology", "Workgroup", AFFECTING, "SiteDown", "WO_Status", "WO_BusinessStatus", BUCKET, RECOVERED]
GRID_COUNTS, GRID_MEANS = ["WO_TicketID", "WO_Status"], [AGING]


def selected_work_orders(
    tables, first_year: int, origin_group: str = fixed.REPORT_ORIGIN_GROUP, zone: str = fixed.LOCAL_ZONE
) -> DataFrame:
    """Running wireless work orders of trouble tickets, opened by members of the origin group."""
    wo = tables["work_order"]
    wo = wo.where(
        (F.col("fixedwireless_") == "Wireless")
        & (F.col("parentbpdtypeid") == "TroubleTicket")
        & (F.col("processstatus") == STATUS)
        & since_year(wo, "createtime", first_year, zone)
    )
    members = tables["user_dim"].where(F.col("user_default_group") == origin_group)
    return keys_only(wo, F.col("wo002_user_wo002").try_cast("long"), members, "user_id", unique=True)


def _joined(tables, wo: DataFrame) -> DataFrame:
    """Work orders with their parent ticket and its id, labels, current processors and the default group of the first one."""
    take = {
        "site_id": "SiteID",
        "site_name": "SiteName",
        "technology_": "Technology",
        "issitedown_": "SiteDown",
        "processstatus": "TT_TicketStatus",
        "faultfirstoccurtime_": "tt_first",
        "faultrecoverytime_": "tt_recovered",
        "lastupdatetime": "tt_updated",
        "alarmname_": "TT_AlarmName",
    }
    df = left_by_key(wo, "parentorderid_", tables["trouble_ticket"], "orderid", take, ["orderid"])
    df = processors_of(df, tables, "wo_processor", "WO_CurrentProcessor")
    missing = F.when(F.col("parentorderid_").isNull(), F.col("parentticketid"))
    df = stacked_lookups(
        df,
        "ticketid",
        [
            label_ask(tables, "severity", "faultseveritylevelwo_", "severity"),
            label_ask(tables, "user_group", "lastoperator", "operator_group"),
            Ask("default_group", first_processor("WO_CurrentProcessor"), group_directory(known_people(tables)), "text", "group"),
            Ask("found_parent", missing, tables["trouble_ticket"], "ticketid", "orderid"),
        ],
    )
    filled = F.coalesce("parentorderid_", "found_parent", F.lit(""))
    return df.withColumns({"parentorderid_": filled, "default_group": F.coalesce("default_group", F.lit("NA"))})


def _tt_columns(zone: str) -> dict[str, Column | str]:
    return {
        "TT_FaultFirstOccurTime": local_text("tt_first", zone),
        "TT_FaultRecoveryTime": local_text("tt_recovered", zone),
        "TT_LastUpdateTime": local_text("tt_updated", zone),
        "TT_AlarmName": "TT_AlarmName",
    }


def pending_flat(
    tables,
    as_of: str | datetime,
    first_year: int = fixed.FIRST_REPORT_YEAR,
    origin_group: str = fixed.REPORT_ORIGIN_GROUP,
    zone: str = fixed.LOCAL_ZONE,
) -> DataFrame:
    """One row per pending work order; the group comes from the first current processor."""
    df = _joined(tables, selected_work_orders(tables, first_year, origin_group, zone))
    df = df.withColumn("processor_group", picked_group("WO_CurrentProcessor", "default_group", codes=[]))
    return columns_as(
        df,
        {
            "WO_TicketID": "orderid",
            "WO_Title": "createtitle_",
            "WO_Status": "processstatus",
            "Fault_Severity_Level": "severity",
            "WO_CreateTime": local_text("createtime", zone),
            "WO_LastUpdateTime": local_text("lastupdatetime", zone),
            "Aging": C.aging_text(local_time("createtime", zone), as_of),
            "WO_OriginatorGroup": F.lit(origin_group),
            "WO_LastOperator": "operator_group",
            "WO_CurrentProcessor": "WO_CurrentProcessor",
            "WO_CurrentProcessorGroup": "processor_group",
            "Domain": "domain_",
            "Area": "area_",
            "Region": "region_",
            "TT_TicketID": "parentorderid_",
            "SiteID": "SiteID",
            "SiteName": "SiteName",
            "SiteDown": "SiteDown",
            "TT_TicketStatus": "TT_TicketStatus",
            **_tt_columns(zone),
        },
    )


def prepared(
    tables,
    as_of: str | datetime,
    first_year: int = fixed.FIRST_REPORT_YEAR,
    origin_group: str = fixed.REPORT_ORIGIN_GROUP,
    zone: str = fixed.LOCAL_ZONE,
) -> DataFrame:
    """The classified detail that all pending-work pivots read."""
    df = _joined(tables, selected_work_orders(tables, first_year, origin_group, zone))
    df = df.withColumn("processor_group", picked_group("WO_CurrentProcessor", "default_group"))
    df = df.withColumn("aging", C.aging_hours(local_time("createtime", zone), as_of))
    base = columns_as(
        df,
        {
            "WO_TicketID": "orderid",
            "WO_Title": "createtitle_",
            "WO_Status": "processstatus",
            "WO_BusinessStatus": C.business_status("servicestatus"),
            "Fault_Severity_Level": C.listed_severity("severity"),
            "WO_CreateTime": local_text("createtime", zone),
            "WO_LastUpdateTime": local_text("lastupdatetime", zone),
            AGING: "aging",
            "WO_OriginatorGroup": F.lit(origin_group),
            "WO_LastOperator": "operator_group",
            "WO_CurrentProcessor": "WO_CurrentProcessor",
            "WO_CurrentProcessorGroup": "processor_group",
            "Domain": "domain_",
            "Area": C.area_code(C.repaired_area("area_", "createtitle_", "processor_group")),
            "Region": "region_",
            "PARENTTICKETID": "parentticketid",
            "TT_TicketID": "parentorderid_",
            "SiteID": "SiteID",
            "SiteName": "SiteName",
            "Technology": C.technology_label("Technology"),
            "SiteDown": "SiteDown",
            "TT_TicketStatus": "TT_TicketStatus",
            **_tt_columns(zone),
            "WO_CreateYear": F.year(local_time("createtime", zone)),
        },
    )
    placed = insert_columns(
        base,
        [
            (11, "Workgroup", C.workgroup("WO_CurrentProcessorGroup", "WO_CurrentProcessor")),
            (8, BUCKET, C.aging_bucket(AGING)),
            (22, AFFECTING, C.affecting_type("SiteDown")),
        ],
    )
    return placed.drop("PARENTTICKETID")


def pending_lattice(detail: DataFrame) -> Lattice:
    """The detail aggregated once by all that the grids group by; read back from where it is written."""
    cells = lattice(detail.withColumn(RECOVERED, F.col("TT_FaultRecoveryTime").isNotNull()), GRID_KEYS, GRID_COUNTS, GRID_MEANS)
    return replace(cells, frame=stored(cells.frame, "pending-lattice"))


def site_down_grid(cells: Lattice) -> DataFrame:
    """Work orders of down sites, area by technology."""
    down = cells.where(F.col("SiteDown") == "isYes")
    table = pivot_with_total(down, ["Area"], "Technology", "WO_TicketID", "count", fixed.TECHNOLOGY_AXIS)
    return dense_grid(table, ["Area"], [fixed.AREA_AXIS], fixed.TECHNOLOGY_AXIS, total_column="TOTAL")


def unique_sites(detail: DataFrame) -> DataFrame:
    """One row per down site, its worst work order with the site's mean aging."""
    down = detail.where(F.col("SiteDown") == "isYes")
    return worst_per_key(down, "SiteID", "Fault_Severity_Level", AGING, "WO_TicketID")


def _buckets(when: Column | None = None) -> list[Measure]:
    made = []
    for label in fixed.AGING_AXIS:
        hit = as_col(BUCKET) == label
        made.append(Measure(label, "count", "WO_TicketID", hit if when is None else hit & when))
    return made


def workgroup_grid(cells: Lattice, sites: DataFrame, as_of: str | datetime) -> DataFrame:
    """R5d: per workgroup the mean aging, last years' count and this year's aging buckets of the down sites."""
    earlier = C.before_year("WO_CreateYear", as_of) & (F.col("WO_Status") == STATUS)
    current = C.in_year("WO_CreateYear", as_of)
    measures = [
        Measure("Average (Hrs)", "mean", AGING),
        Measure("Prev Years", "count", "WO_TicketID", earlier),
        *_buckets(current),
    ]
    table = with_total(sites, ["Workgroup"], measures)
    axis = distinct_axis(cells, "Workgroup", exclude=["NOC"])
    return dense_grid_over(axis, table, ["Workgroup"], [m.name for m in measures])


def _severity_measures(statuses: list[str]) -> list[Measure]:
    running = F.col("WO_Status") == STATUS
    recovered = running & F.col(RECOVERED)
    return [
        Measure("Total Pending", "count", "WO_TicketID", running),
        Measure("With FRT", "count", "WO_TicketID", recovered),
        Measure("With FRT Average (Hrs)", "mean", AGING, recovered),
        Measure("Average (Hrs)", "mean", AGING, running),
        *_buckets(),
        *[Measure(s, "count", "WO_Status", F.col("WO_BusinessStatus") == s) for s in statuses],
    ]


def _headed(df: DataFrame, statuses: list[str]) -> DataFrame:
    """Status columns under their corrected spelling."""
    return df.withColumnsRenamed({s: fixed.STATUS_SPELLING[s] for s in statuses if s in fixed.STATUS_SPELLING})


def severity_grid(cells: Lattice, statuses: list[str] | None = None) -> DataFrame:
    """R5e: service-affecting type by all measures."""
    statuses = axis_values(cells, "WO_BusinessStatus") if statuses is None else statuses
    measures = _severity_measures(statuses)
    table = with_total(cells, [AFFECTING], measures)
    grid = dense_grid(table, [AFFECTING], [fixed.AFFECTING_AXIS], [m.name for m in measures], total_row=TOTAL)
    return _headed(grid, statuses)


def workgroup_severity_grid(cells: Lattice, statuses: list[str] | None = None) -> DataFrame:
    """R5f: workgroup and service-affecting type by all measures."""
    statuses = axis_values(cells, "WO_BusinessStatus") if statuses is None else statuses
    measures = _severity_measures(statuses)
    grid = with_inner_rows(cells, "Workgroup", AFFECTING, fixed.AFFECTING_AXIS, measures, exclude=["NOC"])
    return _headed(grid, statuses)


def write_pending_report(tables, path: str, as_of: str | datetime, **options) -> dict[str, str]:
    """The whole R5 report. The detail is written first, as it is a dataset of the report; one pass over it makes the lattice that
    every grid adds up, another one the unique sites."""
    raw = write_report({"All Raw Data": prepared(tables, as_of, **options)}, path)
    detail = tables["work_order"].sparkSession.read.parquet(raw["All Raw Data"])
    cells = pending_lattice(detail)
    statuses = axis_values(cells, "WO_BusinessStatus")
    written = write_report({"Unique Sites": unique_sites(detail)}, path)
    sites = detail.sparkSession.read.parquet(written["Unique Sites"])
    grids = {
        "Per Technology": site_down_grid(cells),
        "Per Resolving Team": workgroup_grid(cells, sites, as_of),
        "Per Severity": severity_grid(cells, statuses),
        "Per Workgroup and Severity": workgroup_severity_grid(cells, statuses),
    }
    return {**raw, **written, **write_report(grids, path)}
