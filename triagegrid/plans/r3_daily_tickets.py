"""Wireless tickets whose fault touches the day, or is still open; one row per association."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagegrid.functions import fixed
from triagegrid.functions.classify import area_code, business_status, technology_label
from triagegrid.functions.scalars import local_text
from triagegrid.operators.lists import child_lists_of, first_piece_key, with_child_lists
from triagegrid.operators.lookups import fan_out_left, stacked_lookups
from triagegrid.operators.predicates import open_in_range
from triagegrid.plans.common import columns_as, label_ask, parents_of, user_ask


def daily_tickets(tables, start: str, end: str, zone: str = fixed.LOCAL_ZONE) -> DataFrame:
    """27 columns. Child lists are attached before the associations fan the rows out."""
    tt = tables["trouble_ticket"]
    tt = tt.where(
        (F.col("fixedwirelesscreate_") == "Wireless")
        & open_in_range(tt, "faultfirstoccurtime_", "faultrecoverytime_", start, end, zone)
    )
    children = child_lists_of(
        tt, "ticketid", tables["work_order"], "parentticketid", {"SubProcessWO": ("orderid", "ticketid")}
    )
    asks = [
        label_ask(tables, "data_source", "causeofoutage_", "cause"),
        label_ask(tables, "severity", "currentseverity_", "severity"),
        user_ask(tables, "originator", "creator"),
    ]
    df = with_child_lists(stacked_lookups(tt, "ticketid", asks), "ticketid", children, "parentticketid", piece="piece")
    parents = parents_of(tt, tables)
    first = first_piece_key("ticketid", "piece")
    df = fan_out_left(df, first, parents, "associateticketid", {"parent": "parent"}, ["orderid", "piece"])
    # Sorted before the texts are made: the sort samples its input first, and that pass then skips the formatting.
    return columns_as(
        df.orderBy(F.col("orderid").asc_nulls_last(), "parent"),
        {
            "ParentTicketID": "parent",
            "TicketID": "orderid",
            "SubProcessWO": "SubProcessWO",
            "ProcessStatus": "processstatus",
            "BusinessStatus": business_status("servicestatus"),
            "Title": "title_",
            "Description": "description_",
            "Area": area_code("area_"),
            "RelationshipType": "isassociated_",
            "CreatedBy": "creator",
            "TicketCreatedTime": local_text("createtime", zone),
            "Fault First Occur Time": local_text("faultfirstoccurtime_", zone),
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
            "SubCause1": "subcauseone_",
            "SubCause2": "subcausetwo_",
            "CurrentSeverity": "severity",
            "Remarks": "remarks_",
        },
    )
