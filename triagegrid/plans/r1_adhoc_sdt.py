"""SDT tickets assigned to one group or user, with id lists turned into names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagegrid.functions import fixed
from triagegrid.functions.scalars import has_separator, local_text
from triagegrid.operators.lists import child_lists_of, list_key, list_names, with_child_lists
from triagegrid.operators.lookups import Ask, stacked_lookups
from triagegrid.operators.predicates import id_in_list, id_in_text
from triagegrid.plans.common import columns_as, known_people, label_ask, processors_of, user_ask


def _assigned(text: str, names: str, label: str) -> Column:
    """The names of an id list, or the label of a single code."""
    return F.when(has_separator(text), F.col(names)).otherwise(F.col(label))


def adhoc_sdt_tickets(tables, ident: str, zone: str = fixed.LOCAL_ZONE, exact: bool = False) -> DataFrame:
    assigned = (id_in_list if exact else id_in_text)("createassignto_", ident)
    sdt = tables["sdt_ticket"].where(assigned)
    ids = {"createassignto_": list_key("createassignto_", ["group:"]), "transferto_": list_key("transferto_", ["user:", "group:"])}
    texts = sdt.select(F.explode(F.array(*ids.values())))
    names = list_names(texts, tables["group_dim"].where(F.col("active") == 1), known_people(tables))
    children = child_lists_of(
        sdt, "ticketid", tables["work_order"], "parentticketid", {"SUBPROCESS_WO": ("orderid", "ticketid")}
    )
    df = stacked_lookups(
        sdt,
        "ticketid",
        [
            Ask("create_names", ids["createassignto_"], names, "ids", "text"),
            Ask("transfer_names", ids["transferto_"], names, "ids", "text"),
            label_ask(tables, "assign_to", "createassignto_", "create_label"),
            label_ask(tables, "assign_to", "transferto_", "transfer_label"),
            user_ask(tables, "lastoperator", "last_name"),
            user_ask(tables, "originator", "origin_name"),
        ],
    )
    df = with_child_lists(df, "ticketid", children, "parentticketid")
    df = processors_of(df, tables, "sdt_processor", "CURRENTPROCESSOR")
    # Sorted before the texts are made: the sort samples its input first, and that pass then skips the formatting.
    return columns_as(
        df.orderBy(F.col("createtime").asc_nulls_last(), "orderid"),
        {
            "ORDERID": "orderid",
            "CREATETITLE": "createtitle_",
            "SERVICESTATUS": "servicestatus",
            "PROCESSSTATUS": "processstatus",
            "CREATETIME": local_text("createtime", zone),
            "LASTUPDATETIME": local_text("lastupdatetime", zone),
            "CLOSETIME": local_text("sdt005_submit_sdt005", zone),
            "DETAILS": "details_",
            "SUBPROCESS_WO": "SUBPROCESS_WO",
            "CREATEASSIGNTO": _assigned("createassignto_", "create_names", "create_label"),
            "TRANSFERTO": _assigned("transferto_", "transfer_names", "transfer_label"),
            "CURRENTPROCESSOR": "CURRENTPROCESSOR",
            "LASTOPERATOR": "last_name",
            "ORIGINATOR": "origin_name",
            "CATEGORY": "category_",
            "SUBCATEGORY": "subcategory_",
            "SUPLEMENTARYINFO": "suplementaryinfo_",
            "RESOLVESOLUTION": "resolvesolutiondes_",
            "CLOSEDESCRIPTION": "closedescriptiona_",
            "REMARKS": "remarks_",
        },
    )
