"""Canonical tables derived from the given star-schema and event tables.

Each canonical table is one projection (or union of projections) of the given files, so column pruning and filters
reach the parquet scan. The expressions are plain SQL that both Spark and another engine can read; ``{ts}`` stands for
the keyword of a zone-free time literal.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

_WO_ID = "((l_orderkey * 10 + l_linenumber) * 10000000 + l_partkey * 100 + l_suppkey % 100)"
_GROUP = "CAST(900000000 + {0} AS STRING)"
_AREAS = "0 THEN 'Metro Manila' WHEN 1 THEN 'North Luzon' WHEN 2 THEN 'South Luzon' WHEN 3 THEN 'Visayas' WHEN 4 THEN 'Mindanao'"
_GROUP_NAME = (
    "CASE n_nationkey WHEN 0 THEN 'TSC_TRANSPORT' WHEN 1 THEN 'tsc_transport_north' WHEN 2 THEN 'NOC_NAC_NSC' "
    "WHEN 3 THEN 'WFS_MM_01' WHEN 4 THEN 'FFS_VIS_02' WHEN 5 THEN 'NFS_AMM_01' ELSE 'GROUP_' || CAST(n_nationkey AS STRING) END"
)
_USER_GROUP = (
    "CASE s_suppkey % 9 WHEN 5 THEN 'TSC_TRANSPORT' WHEN 6 THEN 'NFS_QVIS_7' WHEN 7 THEN 'FNAS_CENTRAL' "
    "WHEN 8 THEN NULL ELSE 'NOC_NAC_NSC' END"
)
_SUPPLIER = "'Supplier#' || lpad(CAST({0} AS STRING), 9, '0')"

_TROUBLE_TICKET = {
    "ticketid": "o_orderkey",
    "orderid": "'TT-' || CAST(o_orderkey AS STRING)",
    "processstatus": "CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE 'running' END",
    "servicestatus": "CASE o_custkey % 9 WHEN 0 THEN 'BusinessStatusNew' WHEN 1 THEN 'BusinessStatusWIP' "
    "WHEN 2 THEN 'BusinessStatusEscalatedtoVendor' WHEN 3 THEN 'BusinessStatusResovled' "
    "WHEN 4 THEN 'BusinessStatusCompleted' WHEN 5 THEN 'BusinessStatusClosed' WHEN 6 THEN 'BusinessStatusCancel' "
    "WHEN 7 THEN 'BusinessStatus' ELSE NULL END",
    "title_": "CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE 'Site ' || CAST(o_custkey AS STRING) || ' ' || o_orderpriority END",
    "description_": "CASE WHEN o_totalprice >= 150000 THEN 'OFFLINE | FULL OUTAGE | ' || o_orderpriority "
    "ELSE 'Degraded | ' || o_orderpriority END",
    "remarks_": "CASE WHEN o_custkey % 6 = 0 THEN NULL ELSE 'checked by shift ' || CAST(o_custkey % 3 AS STRING) END",
    "alarmname_": "'Alarm ' || o_orderpriority",
    "fixedwirelesscreate_": "CASE WHEN o_custkey % 10 < 8 THEN 'Wireless' ELSE 'Fixed' END",
    "domain_": "CASE WHEN o_custkey % 7 < 5 THEN 'RAN' WHEN o_custkey % 7 = 5 THEN 'Transport' ELSE NULL END",
    "technology_": "CASE o_orderkey % 9 WHEN 0 THEN '2G' WHEN 1 THEN '3G' WHEN 2 THEN 'FDLTE' WHEN 3 THEN '5G' "
    "WHEN 4 THEN 'Canopy' WHEN 5 THEN 'TDLTE' WHEN 6 THEN 'WIFI' WHEN 7 THEN 'Microwave' ELSE NULL END",
    "band_": "CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE 'B' || CAST(o_custkey % 4 AS STRING) END",
    "deviceid_": "CASE WHEN o_custkey % 12 = 0 THEN NULL ELSE 'DEV-' || CAST(o_custkey % 50 AS STRING) END",
    "area_": f"CASE o_custkey % 8 WHEN {_AREAS} WHEN 5 THEN 'Unknown' WHEN 6 THEN NULL ELSE 'Metro Manila' END",
    "city_": "CASE WHEN o_custkey % 15 = 0 THEN NULL ELSE 'City ' || CAST(o_custkey % 40 AS STRING) END",
    "province_": "'Province ' || CAST(o_custkey % 25 AS STRING)",
    "siteid_": "CASE o_custkey % 5 WHEN 0 THEN 'A1-' || CAST(o_custkey AS STRING) WHEN 1 THEN NULL "
    "WHEN 3 THEN 'A1-X' || CAST(o_custkey AS STRING) ELSE 'SITE-' || CAST(o_custkey AS STRING) END",
    "site_": "CASE WHEN o_custkey % 5 = 1 AND o_orderkey % 2 = 0 THEN 'A1-' || CAST(o_custkey AS STRING) "
    "WHEN o_custkey % 4 = 0 THEN NULL ELSE 'SITE-' || CAST(o_custkey AS STRING) END",
    "site_id": "CASE WHEN o_custkey % 13 = 0 THEN NULL ELSE 'SITE-' || CAST(o_custkey AS STRING) END",
    "site_name": "'Site name ' || CAST(o_custkey AS STRING)",
    "sitename_": "'Site name ' || CAST(o_custkey AS STRING)",
    "sitenametest_": "CASE WHEN o_custkey % 10 = 3 THEN NULL ELSE 'Site name ' || CAST(o_custkey AS STRING) END",
    "sitemaintainergroup_": "CASE WHEN o_custkey % 9 = 1 THEN NULL ELSE 'Maintainer ' || CAST(o_custkey % 8 AS STRING) END",
    "issitedown_": "CASE o_orderkey % 5 WHEN 0 THEN 'isYes' WHEN 1 THEN 'isYes' WHEN 4 THEN NULL ELSE 'isNo' END",
    "initialserviceaffectingne_": "CASE o_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'TTAffectedServiceVoice' "
    "ELSE 'TTAffectedServiceData' END",
    "causeofoutage_": "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'DS-' || CAST(o_orderkey % 27 AS STRING) END",
    "subcauseone_": "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'Sub ' || CAST(o_orderkey % 6 AS STRING) END",
    "subcausetwo_": "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'Second ' || CAST(o_orderkey % 4 AS STRING) END",
    "subcausethree_": "CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE 'Third' END",
    "currentseverity_": "'SEV-' || CAST(o_orderkey % 29 AS STRING)",
    "isassociated_": "CASE o_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'Parent' ELSE 'Child' END",
    "originator": "'user:' || CAST(o_custkey % 120 AS STRING)",
    "assignto_": f"CASE WHEN o_custkey % 2 = 0 THEN 'group:' || {_GROUP.format('o_custkey % 28')} "
    "ELSE 'user:' || CAST(o_custkey % 110 AS STRING) END",
    "createtime": "o_orderdate + (o_orderkey % 1440) * INTERVAL '1' MINUTE",
    "lastupdatetime": "o_orderdate + INTERVAL '2' DAY",
    "faultfirstoccurtime_": "o_orderdate",
    "faultlastoccurtime_": "o_orderdate + INTERVAL '3' HOUR",
    "faultrecoverytime_": "CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN {ts} '1970-01-01 00:00:00' "
    "ELSE o_orderdate + INTERVAL '1' DAY END",
}

_WORK_ORDER = {
    "ticketid": _WO_ID,
    "parentticketid": "CASE WHEN l_suppkey % 20 = 0 THEN NULL ELSE l_orderkey END",
    "orderid": f"'WO-' || CAST({_WO_ID} AS STRING)",
    "parentorderid_": "CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE 'TT-' || CAST(l_orderkey AS STRING) END",
    "parentbpdtypeid": "CASE l_linenumber WHEN 6 THEN NULL WHEN 7 THEN 'ProblemTicket' ELSE 'TroubleTicket' END",
    "parentcrid_": "CASE WHEN l_linenumber = 6 THEN 'CR-' || CAST(l_partkey AS STRING) ELSE NULL END",
    "createtitle_": "CASE l_partkey % 16 WHEN 0 THEN 'Metro Manila | Major alarm on link' WHEN 1 THEN 'Visayas | Link Utilization high' "
    "WHEN 2 THEN ' North Luzon | Critical cell down' WHEN 3 THEN 'Mindanao|Minor alarm' WHEN 4 THEN 'Low optical power' "
    "WHEN 5 THEN 'lower Low power' WHEN 6 THEN 'Requests for TSC' WHEN 7 THEN 'NOC Assistance TSCx' "
    "WHEN 8 THEN 'Protection Switching test' WHEN 9 THEN 'NMS Uploading and Remote login' WHEN 10 THEN 'TPE-AP swap' "
    "WHEN 11 THEN 'Alarm Clearing task' WHEN 12 THEN 'Complaint of customer' WHEN 13 THEN NULL "
    "WHEN 14 THEN 'South Luzon | Others' ELSE 'Planned upgrade' END",
    "processstatus": "CASE WHEN l_linestatus = 'O' THEN 'running' ELSE 'closed' END",
    "servicestatus": "CASE l_suppkey % 7 WHEN 0 THEN 'BusinessStatusNew' WHEN 1 THEN 'BusinessStatusWIP' "
    "WHEN 2 THEN 'BusinessStatusEscalatedtoVendor' WHEN 3 THEN 'BusinessStatusResovled' WHEN 4 THEN 'BusinessStatusPending' "
    "WHEN 5 THEN 'BusinessStatusWIP' ELSE NULL END",
    "faultseveritylevelwo_": "'SEV-' || CAST(l_partkey % 29 AS STRING)",
    "processoptmode_": "CASE l_returnflag WHEN 'A' THEN 'ProcessWOOptModeAccept' WHEN 'N' THEN 'ProcessWOOptMode' "
    "ELSE 'ProcessWOOptModeResolve' END",
    "processdesct_": "CASE WHEN l_quantity > 40 THEN NULL ELSE 'handled ' || l_returnflag END",
    "implementationtype_": "'DS-' || CAST(l_linenumber * 4 AS STRING)",
    "domain_": "CASE WHEN l_quantity > 45 THEN NULL WHEN l_quantity > 20 THEN 'RAN' ELSE 'Transport' END",
    "area_": f"CASE l_partkey % 7 WHEN {_AREAS} WHEN 5 THEN 'Region X' ELSE NULL END",
    "region_": "CASE WHEN l_tax > 0.05 THEN 'North' ELSE 'South' END",
    "fixedwireless_": "CASE WHEN l_linenumber = 5 THEN 'Fixed' ELSE 'Wireless' END",
    "wo002_user_wo002": "CAST(l_suppkey AS STRING)",
    "wo004_user_wo004": "CAST(l_suppkey + 1 AS STRING)",
    "wo005_user_wo005": "CAST(l_suppkey + 2 AS STRING)",
    "lastoperator": "CAST(l_partkey % 120 AS STRING)",
    "createassignto_": f"'group:' || {_GROUP.format('l_suppkey % 4')}",
    "createtime": "l_shipdate + (l_partkey % 1440) * INTERVAL '1' MINUTE",
    "lastupdatetime": "l_shipdate + INTERVAL '1' DAY",
    "wo004_submit_wo004": "l_shipdate",
    "wo005_submit_wo005": "l_shipdate",
    "finishtime_": "CASE WHEN l_linestatus = 'F' OR l_returnflag = 'N' THEN l_shipdate + INTERVAL '5' DAY ELSE NULL END",
}

_SDT_TICKET = {
    "ticketid": "event_id",
    "orderid": "'SDT-' || CAST(event_id AS STRING)",
    "createtitle_": "event_type || ' request'",
    "servicestatus": "CASE event_type WHEN 'view' THEN 'BusinessStatusNew' WHEN 'click' THEN 'BusinessStatusWIP' "
    "WHEN 'error' THEN 'BusinessStatusClosed' WHEN 'signup' THEN 'BusinessStatus' ELSE NULL END",
    "processstatus": "CASE WHEN event_type = 'error' THEN 'closed' ELSE 'running' END",
    "details_": "props",
    "createassignto_": f"CASE event_id % 6 WHEN 0 THEN 'group:' || {_GROUP.format('3')} "
    f"WHEN 1 THEN 'group:' || {_GROUP.format('1')} || ';group:' || {_GROUP.format('2')} "
    "WHEN 2 THEN 'user:' || CAST(user_id AS STRING) "
    f"WHEN 3 THEN 'group:' || {_GROUP.format('77')} || ';group:' || {_GROUP.format('1')} || ';group:17' "
    f"WHEN 4 THEN 'group:' || {_GROUP.format('1')} || ';group:' || {_GROUP.format('78')} || ';group:5' "
    f"ELSE 'group:' || {_GROUP.format('1')} || ';group:' || {_GROUP.format('79')} END",
    "transferto_": f"CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'group:' || {_GROUP.format('user_id % 30')} "
    f"WHEN 2 THEN 'user:' || CAST(user_id AS STRING) || ';group:' || {_GROUP.format('4')} "
    f"ELSE 'group:' || {_GROUP.format('80')} || ';user:' || CAST(user_id AS STRING) END",
    "lastoperator": "'user:' || CAST(user_id AS STRING)",
    "originator": "'user:' || CAST(user_id % 90 AS STRING)",
    "sdt001_user_sdt001": "CAST(user_id AS STRING)",
    "category_": "event_type",
    "subcategory_": "CASE WHEN user_id % 3 = 0 THEN NULL ELSE 'sub ' || event_type END",
    "suplementaryinfo_": "CAST(NULL AS STRING)",
    "resolvesolutiondes_": "CASE WHEN event_type = 'error' THEN 'reset' ELSE NULL END",
    "closedescriptiona_": "CASE WHEN event_type = 'error' THEN 'closed after reset' ELSE NULL END",
    "remarks_": "CASE WHEN user_id % 5 = 0 THEN 'vip' ELSE NULL END",
    "createtime": "ts",
    "lastupdatetime": "ts + INTERVAL '1' HOUR",
    "sdt005_submit_sdt005": "CASE WHEN event_type = 'error' THEN ts + INTERVAL '2' DAY ELSE NULL END",
}

_CHANGE_REQUEST = {
    "orderid": "'CR-' || CAST(event_id AS STRING)",
    "createtitle_": "event_type || ' change'",
    "operationmodeapprovecr_": "'DS-' || CAST(user_id % 27 AS STRING)",
    "cr004_user_cr004": "CAST(user_id AS STRING)",
    "cr004_submit_cr004": "ts",
}

_WO_TASK = {
    "ticketid": _WO_ID,
    "nodeid": "CASE WHEN l_returnflag = 'A' THEN 'WO002' WHEN l_returnflag = 'N' THEN 'WO004' "
    "WHEN l_linestatus = 'O' THEN 'WO005' ELSE 'WO009' END",
    "operator": "CAST(l_suppkey + 3 AS STRING)",
    "assignto": "'{{\"group\":\"' || " + _GROUP.format("l_partkey % 6") + " || '\"}}'",
    "operationtime": "l_shipdate + INTERVAL '90' MINUTE",
}
_SDT_TASK = {
    "ticketid": "user_id",
    "nodeid": "CASE WHEN event_type IN ('click', 'view') THEN 'SDT004' ELSE 'SDT002' END",
    "operator": "CAST(user_id AS STRING)",
    "assignto": "'{{\"group\":\"' || " + _GROUP.format("event_id % 6") + " || '\"}}'",
    "operationtime": "ts",
}

_PROCESSORS = {
    "wo_processor": (
        "lineitem",
        _WO_ID,
        f"CASE l_suppkey % 11 WHEN 0 THEN {_SUPPLIER.format('l_suppkey')} WHEN 1 THEN 'TSC_TRANSPORT' WHEN 2 THEN 'NFS_QVIS_7' "
        f"WHEN 3 THEN 'WFS crew' WHEN 4 THEN {_SUPPLIER.format('l_suppkey')} || ';FFS_VIS_2;TSC_9' "
        f"WHEN 5 THEN {_SUPPLIER.format('l_suppkey')} || ';Somebody' WHEN 6 THEN NULL WHEN 7 THEN 'NFS_ASL_3' "
        f"WHEN 8 THEN {_SUPPLIER.format('l_suppkey + 1')} WHEN 9 THEN {_SUPPLIER.format('l_suppkey + 4')} "
        "ELSE 'NOC_NAC_NSC;NFS_AMIN_1' END",
    ),
    "tt_processor": (
        "orders",
        "o_orderkey",
        f"CASE o_custkey % 4 WHEN 0 THEN 'TSC_TRANSPORT' WHEN 1 THEN {_SUPPLIER.format('o_custkey % 100')} WHEN 2 THEN NULL "
        "ELSE 'NOC_NAC_NSC;WFS_MM_01' END",
    ),
    "sdt_processor": (
        "events",
        "event_id",
        f"CASE user_id % 3 WHEN 0 THEN 'TSC_TRANSPORT;Somebody' WHEN 1 THEN {_SUPPLIER.format('user_id')} ELSE 'TSC_TRANSPORT_2' END",
    ),
}

# canonical name -> list of (given table, filter or None, {column: expression})
SOURCES: dict[str, list[tuple[str, str | None, dict[str, str]]]] = {
    "trouble_ticket": [("orders", None, _TROUBLE_TICKET)],
    "work_order": [("lineitem", None, _WORK_ORDER)],
    "sdt_ticket": [("events", None, _SDT_TICKET)],
    "change_request": [("events", None, _CHANGE_REQUEST)],
    "ticket_task": [("lineitem", None, _WO_TASK), ("events", None, _SDT_TASK)],
    "ticket_associate": [("lineitem", None, {"associateticketid": "l_orderkey", "sourceticketid": "l_partkey"})],
    "ticket_order": [("orders", None, {k: _TROUBLE_TICKET[k] for k in ("ticketid", "orderid")})],
    "site": [
        (
            "customer",
            None,
            {
                "id": "'A1-' || CAST(c_custkey AS STRING)",
                "site_id": "'SITE-' || CAST(c_custkey AS STRING)",
                "province_name": "'Province ' || CAST(c_nationkey AS STRING)",
                "active": "CASE WHEN c_acctbal < 0 THEN 0 ELSE 1 END",
            },
        )
    ],
    "user_dim": [
        (
            "supplier",
            None,
            {
                "user_id": "s_suppkey",
                "fullname": "s_name",
                "user_default_group": _USER_GROUP,
                "active": "CASE WHEN s_acctbal < 0 THEN 0 ELSE 1 END",
            },
        )
    ],
    "group_dim": [
        (
            "nation",
            None,
            {
                "group_id": "CAST(900000000 + n_nationkey AS BIGINT)",
                "groupname": _GROUP_NAME,
                "active": "CASE WHEN n_nationkey = 24 THEN 0 ELSE 1 END",
            },
        )
    ],
    "severity": [
        (
            "nation",
            None,
            {
                "code": "'SEV-' || CAST(n_nationkey AS STRING)",
                "label": "CASE n_nationkey % 7 WHEN 0 THEN 'Critical' WHEN 1 THEN 'Moderate' WHEN 2 THEN 'Major' "
                "WHEN 3 THEN 'Minor' WHEN 4 THEN 'Low' WHEN 5 THEN 'Alarm Clearing' ELSE 'Unlisted' END",
            },
        )
    ],
    "data_source": [("nation", None, {"code": "'DS-' || CAST(n_nationkey AS STRING)", "label": "n_name"})],
    "assign_to": [
        ("nation", None, {"code": "'group:' || " + _GROUP.format("n_nationkey"), "label": _GROUP_NAME}),
        ("supplier", None, {"code": "'user:' || CAST(s_suppkey AS STRING)", "label": "s_name"}),
    ],
    "user_group": [
        ("nation", None, {"code": _GROUP.format("n_nationkey"), "label": _GROUP_NAME}),
        ("supplier", None, {"code": "CAST(s_suppkey AS STRING)", "label": _USER_GROUP}),
    ],
    **{
        name: [(given, None, {"ticketid": key, "processors": text})]
        for name, (given, key, text) in _PROCESSORS.items()
    },
}



_SCHEMAS: dict[str, StructType] = {}


def open_given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given file. Its schema is read from the footer once per process."""
    path = os.path.join(folder, f"{name}.parquet")
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


class Tables(dict):
    """Canonical and given tables by name, each opened on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__()
        self.spark, self.folder = spark, folder

    def __missing__(self, name: str) -> DataFrame:
        if name in SOURCES:
            df = None
            for given, cond, cells in SOURCES[name]:
                rows = self[given].where(cond) if cond else self[given]
                part = rows.selectExpr(*[f"{e.format(ts='TIMESTAMP_NTZ')} AS {c}" for c, e in cells.items()])
                df = part if df is None else df.unionByName(part)
        else:
            df = open_given(self.spark, self.folder, name)
        self[name] = df
        return df


def table_sql(name: str, ts: str = "TIMESTAMP") -> str:
    """The canonical table as a plain SQL query over the given tables."""
    parts = []
    for given, cond, cells in SOURCES[name]:
        cols = ", ".join(f"{e.format(ts=ts)} AS {c}" for c, e in cells.items())
        parts.append(f"SELECT {cols} FROM {given}" + (f" WHERE {cond}" if cond else ""))
    return " UNION ALL ".join(parts)
