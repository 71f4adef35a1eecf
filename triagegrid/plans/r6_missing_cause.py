"""Recovered wireless tickets without a cause, kept as a dated history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagegrid.functions import fixed
from triagegrid.functions.scalars import local_text, local_time, or_else, strip_text
from triagegrid.operators.lists import child_lists, first_piece_key, with_child_lists
from triagegrid.operators.lookups import Ask, either_value, fan_out_left, keys_only, stacked_lookups
from triagegrid.operators.predicates import any_missing, equals_none, since_year
from triagegrid.plans.common import columns_as, label_ask, parents_of, processors_of
from triagegrid.sources.sinks import write_snapshot

DONE = ["BusinessStatusCompleted", "BusinessStatusClosed", "BusinessStatusCancel"]


def selected_tickets(tables, first_year: int, zone: str, strict: bool) -> DataFrame:
    """By default an epoch recovery time counts as recovered; with ``strict`` it does not."""
    tt = tables["trouble_ticket"]
    recovered = F.col("faultrecoverytime_").isNotNull()
    real = F.year(local_time("faultrecoverytime_", zone)) != fixed.EPOCH_YEAR
    return tt.where(
        (F.col("fixedwirelesscreate_") == "Wireless")
        & equals_none("servicestatus", DONE)
        & (recovered & real if strict else recovered | real)
        & since_year(tt, "faultfirstoccurtime_", first_year, zone)
        & any_missing("causeofoutage_", "subcauseone_")
    )


def missing_cause(
    tables, first_year: int = fixed.FIRST_REPORT_YEAR, zone: str = fixed.LOCAL_ZONE, strict: bool = False
) -> DataFrame:
    tt = selected_tickets(tables, first_year, zone, strict)
    active = tables["site"].where(F.col("active") == 1)
    children = processors_of(
        keys_only(tables["work_order"], "parentticketid", tt, "ticketid", unique=True), tables, "wo_processor", "processors"
    )
    lists = child_lists(
        children,
        "parentticketid",
        counted=tables["work_order"],
        lists={
            "SubProcessWO": ("orderid", "ticketid"),
            "SubProcessWO_Status": ("processstatus", "processstatus"),
            "SubProcessWO_CurrentProcessor": ("processors", "processors"),
        },
    )
    site, other = F.col("siteid_"), F.col("site_")
    listed, other_listed = F.coalesce(site.like("%A1%"), F.lit(False)), F.coalesce(other.like("%A1%"), F.lit(False))
    resolves = listed | other_listed
    df = stacked_lookups(
        tt,
        "ticketid",
        [
            Ask("listed_site", F.when(listed, site).when(other_listed, other), active, "id", "site_id"),
            Ask("site_province", site, active, "site_id", "province_name", strict=True),
            Ask("other_province", other, active, "site_id", "province_name", strict=True),
            label_ask(tables, "assign_to", "assignto_", "assigned"),
        ],
    )
    resolved = F.when(resolves, F.col("listed_site")).when(site.isNull(), other).otherwise(site)
    df = df.withColumns({"resolved_site": resolved, "found_province": either_value("site_province", "other_province", "province_name")})
    df = with_child_lists(df, "ticketid", lists, "parentticketid", piece="piece")
    df = processors_of(df, tables, "tt_processor", "processors")
    parents = parents_of(tt, tables)
    first = first_piece_key("ticketid", "piece")
    df = fan_out_left(df, first, parents, "associateticketid", {"parent": "parent"}, ["orderid", "piece"])
    # Sorted before the texts are made: the sort samples its input first, and that pass then skips the formatting.
    return columns_as(
        df.orderBy(F.col("orderid").asc_nulls_last(), "parent"),
        {
            "Parent Ticket ID": "parent",
            "Ticket ID": "orderid",
            "Site ID": "resolved_site",
            "Site Name": or_else("sitenametest_"),
            "Domain": or_else("domain_"),
            "Technology": or_else("technology_"),
            "Band": or_else("band_"),
            "Device": or_else("deviceid_"),
            "Device Owner": or_else("sitemaintainergroup_"),
            "City": or_else("city_"),
            "Province": "found_province",
            "Area": or_else("area_"),
            "Service Affecting": or_else(strip_text("initialserviceaffectingne_", "TTAffectedService"), "A100000029"),
            "Site Down": strip_text(or_else("issitedown_"), "is"),
            "Cause of Outage": "causeofoutage_",
            "Sub Cause 1": "subcauseone_",
            "Sub Cause 2": "subcausetwo_",
            "Sub Cause 3": "subcausethree_",
            "Ticket Status": strip_text(or_else("servicestatus"), "BusinessStatus"),
            "SubProcessWO": "SubProcessWO",
            "SubProcessWO_Status": "SubProcessWO_Status",
            "SubProcessWO_CurrentProcessor": "SubProcessWO_CurrentProcessor",
            "Ticket Created Time": local_text("createtime", zone),
            "Fault First Occur Time": local_text("faultfirstoccurtime_", zone),
            "Fault Recovery Time": local_text("faultrecoverytime_", zone),
            "Assign To": "assigned",
            "TT_CurrentProcessor": "processors",
            "Relationship Type": or_else("isassociated_", "NA"),
        },
    )


def append_missing_cause(tables, history: str, as_of: str, **options) -> str:
    """Write the day's rows into the history under their snapshot names."""
    return write_snapshot(missing_cause(tables, **options), history, as_of)
