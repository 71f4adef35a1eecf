"""R2: open full outages of the wireless access network, by area and technology."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagegrid.functions import fixed
from triagegrid.functions.classify import area_code, business_status, technology_label
from triagegrid.functions.scalars import local_text
from triagegrid.operators.grids import dense_grid
from triagegrid.operators.pivots import pivot_with_total
from triagegrid.operators.predicates import equals_any, not_recovered
from triagegrid.plans.common import columns_as, label_of
from triagegrid.sources.sinks import write_report


def outage_tickets(tables, zone: str = fixed.LOCAL_ZONE) -> DataFrame:
    """The raw data sheet: 19 columns."""
    tt = tables["trouble_ticket"]
    tt = tt.where(
        (F.col("fixedwirelesscreate_") == "Wireless")
        & (F.col("domain_") == "RAN")
        & F.col("description_").like("%FULL OUTAGE%")
        & not_recovered(tt, "faultrecoverytime_")
        & (F.col("processstatus") == "running")
    )
    df = label_of(tt, tables, "data_source", "causeofoutage_", "cause")
    df = label_of(df, tables, "severity", "currentseverity_", "severity")
    return columns_as(
        df,
        {
            "TicketID": "orderid",
            "BusinessStatus": business_status("servicestatus"),
            "Title": "title_",
            "Description": "description_",
            "Area": area_code("area_"),
            "RelationshipType": "isassociated_",
            "FaultLastOccurTime": local_text("faultlastoccurtime_", zone),
            "FaultRecoveryTime": local_text("faultrecoverytime_", zone),
            "SiteID": "siteid_",
            "SiteName": "sitename_",
            "AlarmName": "alarmname_",
            "Technology": technology_label("technology_"),
            "Band": "band_",
            "SiteMaintainerGroup": "sitemaintainergroup_",
            "City": "city_",
            "Province": "province_",
            "CauseOfOutage": "cause",
            "CurrentSeverity": "severity",
            "Remarks": "remarks_",
        },
    )


def outage_grid(detail: DataFrame) -> DataFrame:
    """Areas by technologies with a TOTAL column and row."""
    in_areas = detail.where(equals_any("Area", fixed.AREA_AXIS))
    table = pivot_with_total(in_areas, ["Area"], "Technology", "TicketID", "count", fixed.TECHNOLOGY_AXIS)
    return dense_grid(table, ["Area"], [fixed.AREA_AXIS], fixed.TECHNOLOGY_AXIS, total_column="TOTAL")


def pending_outages(tables, zone: str = fixed.LOCAL_ZONE) -> dict[str, DataFrame]:
    detail = outage_tickets(tables, zone)
    return {"Per Technology": outage_grid(detail), "Raw Data": detail}


def write_pending_outages(tables, path: str, zone: str = fixed.LOCAL_ZONE) -> dict[str, str]:
    """Both datasets; the detail is written first and the grid counts what is written."""
    raw = write_report({"Raw Data": outage_tickets(tables, zone)}, path)
    detail = tables["trouble_ticket"].sparkSession.read.parquet(raw["Raw Data"])
    return {**raw, **write_report({"Per Technology": outage_grid(detail)}, path)}
