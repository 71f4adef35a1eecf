"""Columns of the canonical tables the report plans read.

Times are UTC and may be stored with or without a zone; the plans adapt their bounds to the stored type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TEXT, _LONG, _INT, _TIME = T.StringType(), T.LongType(), T.IntegerType(), T.TimestampType()


def _table(longs: str = "", texts: str = "", times: str = "", ints: str = "") -> T.StructType:
    kinds = [(longs, _LONG), (texts, _TEXT), (times, _TIME), (ints, _INT)]
    return T.StructType([T.StructField(name, kind) for names, kind in kinds for name in names.split()])


TABLES: dict[str, T.StructType] = {
    "trouble_ticket": _table(
        longs="ticketid",
        texts="orderid processstatus servicestatus title_ description_ remarks_ alarmname_ fixedwirelesscreate_ domain_ "
        "technology_ band_ deviceid_ area_ city_ province_ siteid_ site_ site_id site_name sitename_ sitenametest_ "
        "sitemaintainergroup_ issitedown_ initialserviceaffectingne_ causeofoutage_ subcauseone_ subcausetwo_ "
        "subcausethree_ currentseverity_ isassociated_ originator assignto_",
        times="createtime lastupdatetime faultfirstoccurtime_ faultlastoccurtime_ faultrecoverytime_",
    ),
    "work_order": _table(
        longs="ticketid parentticketid",
        texts="orderid parentorderid_ parentbpdtypeid parentcrid_ createtitle_ processstatus servicestatus "
        "faultseveritylevelwo_ processoptmode_ processdesct_ implementationtype_ domain_ area_ region_ fixedwireless_ "
        "wo002_user_wo002 wo004_user_wo004 wo005_user_wo005 lastoperator createassignto_",
        times="createtime lastupdatetime wo004_submit_wo004 wo005_submit_wo005 finishtime_",
    ),
    "sdt_ticket": _table(
        longs="ticketid",
        texts="orderid createtitle_ servicestatus processstatus details_ createassignto_ transferto_ lastoperator "
        "originator sdt001_user_sdt001 category_ subcategory_ suplementaryinfo_ resolvesolutiondes_ closedescriptiona_ "
        "remarks_",
        times="createtime lastupdatetime sdt005_submit_sdt005",
    ),
    "change_request": _table(
        texts="orderid createtitle_ operationmodeapprovecr_ cr004_user_cr004", times="cr004_submit_cr004"
    ),
    "ticket_associate": _table(longs="associateticketid sourceticketid"),
    "ticket_order": _table(longs="ticketid", texts="orderid"),
    "ticket_task": _table(longs="ticketid", texts="nodeid operator assignto", times="operationtime"),
    "site": _table(texts="id site_id province_name", ints="active"),
    "user_dim": _table(longs="user_id", texts="fullname user_default_group", ints="active"),
    "group_dim": _table(longs="group_id", texts="groupname", ints="active"),
    "severity": _table(texts="code label"),
    "data_source": _table(texts="code label"),
    "assign_to": _table(texts="code label"),
    "user_group": _table(texts="code label"),
    "tt_processor": _table(longs="ticketid", texts="processors"),
    "wo_processor": _table(longs="ticketid", texts="processors"),
    "sdt_processor": _table(longs="ticketid", texts="processors"),
}


def conform(df: DataFrame, table: str) -> DataFrame:
    """The canonical columns by name; a column the source lacks is null, times keep their stored type."""
    cells = []
    for field in TABLES[table].fields:
        if field.name not in df.columns:
            cells.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif isinstance(df.schema[field.name].dataType, (T.TimestampType, T.TimestampNTZType)):
            cells.append(F.col(field.name))
        else:
            cells.append(F.col(field.name).cast(field.dataType).alias(field.name))
    return df.select(*cells)
