"""Report plans on a small hand-made service desk."""

from __future__ import annotations

from datetime import datetime

import pytest

from tests.conftest import rows_of
from triagegrid.model import TABLES
from triagegrid.plans import pending_work as W
from triagegrid.plans import r2_pending_outages as R2
from triagegrid.plans import r7_team_daily as R7
from triagegrid.plans.r1_adhoc_sdt import adhoc_sdt_tickets
from triagegrid.plans.r3_daily_tickets import daily_tickets
from triagegrid.plans.r6_missing_cause import append_missing_cause, missing_cause

T = datetime
DATA = {
    "trouble_ticket": [
        dict(ticketid=1, orderid="TT-1", processstatus="running", servicestatus="BusinessStatusWIP", area_="Visayas",
             fixedwirelesscreate_="Wireless", domain_="RAN", technology_="FDLTE", description_="x FULL OUTAGE y",
             issitedown_="isYes", site_id="S1", siteid_="A1-1", site_="S1", causeofoutage_="C1", currentseverity_="1",
             originator="user:1", assignto_="group:10", createtime=T(2021, 12, 8), faultfirstoccurtime_=T(2021, 12, 8)),
        dict(ticketid=2, orderid="TT-2", processstatus="running", servicestatus="BusinessStatusNew", area_="Mindanao",
             fixedwirelesscreate_="Wireless", domain_="RAN", technology_="2G", description_="FULL OUTAGE",
             issitedown_="isYes", site_id="S1", site_="raw", currentseverity_="2", originator="user:9",
             createtime=T(2021, 12, 8), faultfirstoccurtime_=T(2021, 12, 8), faultrecoverytime_=T(1970, 1, 1)),
        dict(ticketid=3, orderid="TT-3", processstatus="running", servicestatus=None, area_=None, technology_=None,
             fixedwirelesscreate_="Wireless", domain_="RAN", description_="FULL OUTAGE", issitedown_="isNo", site_id="S2",
             createtime=T(2021, 12, 8), faultfirstoccurtime_=T(2021, 12, 9), faultrecoverytime_=T(2021, 12, 9, 20)),
    ],
    "work_order": [
        dict(ticketid=101, orderid="WO-101", parentticketid=1, parentorderid_="TT-1", parentbpdtypeid="TroubleTicket",
             createtitle_="Low light", processstatus="running", servicestatus="BusinessStatusResovled", area_="Visayas",
             faultseveritylevelwo_="2", fixedwireless_="Wireless", wo002_user_wo002="1", wo005_user_wo005="2",
             lastoperator="1", createtime=T(2021, 12, 9, 20), wo005_submit_wo005=T(2021, 12, 9), finishtime_=T(2021, 12, 9)),
        dict(ticketid=102, orderid="WO-102", parentticketid=2, parentbpdtypeid="TroubleTicket",
             createtitle_="Mindanao | Minor TSC", processstatus="running", area_="?", faultseveritylevelwo_="1",
             fixedwireless_="Wireless", wo002_user_wo002="1", wo005_user_wo005="3", createtime=T(2020, 5, 1),
             wo005_submit_wo005=T(2021, 12, 9), finishtime_=T(2021, 12, 9)),
        dict(ticketid=103, orderid="WO-103", parentticketid=1, parentorderid_="TT-1", parentbpdtypeid="TroubleTicket",
             createtitle_="Minor TSC_x", processstatus="closed", fixedwireless_="Wireless", wo002_user_wo002="1",
             createtime=T(2021, 1, 1)),
    ],
    "sdt_ticket": [
        dict(ticketid=201, orderid="SDT-201", createassignto_="group:10;group:99;group:2", transferto_="user:1;group:10",
             processstatus="running", originator="user:1", sdt001_user_sdt001="2", createtime=T(2021, 12, 9)),
        dict(ticketid=202, orderid="SDT-202", createassignto_="group:10", processstatus="running", createtime=T(2021, 12, 8)),
        dict(ticketid=203, orderid="SDT-203", createassignto_="group:77", processstatus="running", createtime=T(2021, 12, 8)),
    ],
    "change_request": [
        dict(orderid="CR-1", createtitle_="a", operationmodeapprovecr_="C1", cr004_user_cr004="2", cr004_submit_cr004=T(2021, 12, 9)),
        dict(orderid="CR-2", createtitle_="b", cr004_user_cr004="1", cr004_submit_cr004=T(2021, 12, 9)),
    ],
    "ticket_associate": [dict(associateticketid=1, sourceticketid=2), dict(associateticketid=1, sourceticketid=3)],
    "ticket_order": [dict(ticketid=i, orderid=f"TT-{i}") for i in (1, 2, 3)],
    "ticket_task": [
        dict(ticketid=101, nodeid="WO005", operator="2", assignto='{"group":"10"}', operationtime=T(2021, 12, 9, 1, 2, 3, 400)),
        dict(ticketid=101, nodeid="WO001", operator="2", assignto='{"group":"10"}', operationtime=T(2021, 12, 9)),
        dict(ticketid=202, nodeid="SDT004", operator="2", assignto='{"group":"10"}', operationtime=T(2021, 12, 9, 5)),
        dict(ticketid=202, nodeid="SDT004", operator="2", assignto='{"group":"10"}', operationtime=T(2021, 12, 9, 4)),
    ],
    "site": [dict(id="A1-1", site_id="S1", province_name="Cebu", active=1), dict(id="A1-9", site_id="raw", province_name="X", active=0)],
    "user_dim": [
        dict(user_id=1, fullname="Ann", user_default_group="NOC_NAC_NSC", active=1),
        dict(user_id=2, fullname="Bob", user_default_group="TSC_TRANSPORT", active=1),
        dict(user_id=3, fullname="Cy", user_default_group="TSC_TRANSPORT", active=0),
    ],
    "group_dim": [dict(group_id=10, groupname="TSC_TRANSPORT", active=1), dict(group_id=77, groupname="Old", active=0)],
    "severity": [dict(code="1", label="Critical"), dict(code="2", label="Minor")],
    "data_source": [dict(code="C1", label="Power")],
    "assign_to": [dict(code="group:10", label="TSC_TRANSPORT")],
    "user_group": [dict(code="10", label="tsc_transport"), dict(code="1", label="NOC_NAC_NSC")],
    "tt_processor": [dict(ticketid=1, processors="Ann")],
    "wo_processor": [dict(ticketid=101, processors="Ann;TSC_TRANSPORT;z"), dict(ticketid=102, processors="TSC_TRANSPORT")],
    "sdt_processor": [dict(ticketid=201, processors="Ann"), dict(ticketid=202, processors="TSC_TRANSPORT")],
}


@pytest.fixture(scope="module")
def desk(spark):
    tables = {}
    for name, schema in TABLES.items():
        rows = [tuple(row.get(c) for c in schema.names) for row in DATA[name]]
        tables[name] = spark.createDataFrame(rows, schema)
    return tables


@pytest.fixture(scope="module")
def empty_desk(spark):
    return {name: spark.createDataFrame([], schema) for name, schema in TABLES.items()}


AS_OF = "2021-12-10 12:00:00"
DAY = ("2021-12-09 00:00:00", "2021-12-10 00:00:00")


def test_adhoc_sdt(desk):
    got = {r.ORDERID: r for r in adhoc_sdt_tickets(desk, "10").collect()}
    assert set(got) == {"SDT-201", "SDT-202"}
    assert got["SDT-201"].CREATEASSIGNTO == "TSC_TRANSPORT;;Bob" and got["SDT-201"].TRANSFERTO == "Ann;TSC_TRANSPORT"
    assert got["SDT-202"].CREATEASSIGNTO == "TSC_TRANSPORT" and got["SDT-202"].TRANSFERTO is None
    assert [r.ORDERID for r in adhoc_sdt_tickets(desk, "10").collect()] == ["SDT-202", "SDT-201"]
    assert got["SDT-201"].CREATETIME == "2021-12-09 08:00:00" and got["SDT-201"].ORIGINATOR == "Ann"


def test_exact_id_match(desk):
    assert adhoc_sdt_tickets(desk, "1").count() == 2
    assert adhoc_sdt_tickets(desk, "1", exact=True).count() == 0


def test_outages(desk):
    report = R2.pending_outages(desk)
    assert {r.TicketID for r in report["Raw Data"].collect()} == {"TT-1", "TT-2"}
    assert len(report["Raw Data"].columns) == 19
    grid = {r.Area: r for r in report["Per Technology"].collect()}
    assert grid["VIS"]["FD-LTE"] == 1 and grid["VIS"]["TOTAL"] == 1 and grid["MIN"]["2G"] == 1
    assert grid["TOTAL"]["TOTAL"] == 2 and grid["MM"]["TOTAL"] is None


def test_outage_report_is_written(spark, desk, tmp_path):
    paths = R2.write_pending_outages(desk, str(tmp_path))
    read = {name: spark.read.parquet(path) for name, path in paths.items()}
    lazy = R2.pending_outages(desk)
    assert set(read) == set(lazy) and all(rows_of(read[n]) == rows_of(lazy[n]) for n in read)


def test_daily_tickets(desk):
    rows = daily_tickets(desk, *DAY).collect()
    assert len(rows[0]) == 27
    assert [(r.TicketID, r.ParentTicketID) for r in sorted(rows, key=lambda r: (r.TicketID, r.ParentTicketID or ""))] == [
        ("TT-1", "TT-2"), ("TT-1", "TT-3"), ("TT-2", None), ("TT-3", None),
    ]
    assert {r.SubProcessWO for r in rows if r.TicketID == "TT-1"} == {"WO-101,WO-103"}
    assert {r.CreatedBy for r in rows} == {"Ann", None}


def test_pending_flat(desk):
    rows = {r.WO_TicketID: r for r in W.pending_flat(desk, AS_OF).collect()}
    assert set(rows) == {"WO-101", "WO-102"}
    assert rows["WO-102"].TT_TicketID == "TT-2" and rows["WO-101"].Aging == "0 days 08:00"
    assert rows["WO-101"].WO_CurrentProcessorGroup == "NOC_NAC_NSC"
    assert rows["WO-102"].WO_CurrentProcessorGroup == "TSC_TRANSPORT"
    assert len(W.pending_flat(desk, AS_OF).columns) == 23


def test_prepared(desk):
    detail = W.prepared(desk, AS_OF)
    assert detail.columns[8] == "Aging Grp" and detail.columns.index("Workgroup") == detail.columns.index("WO_CurrentProcessorGroup") - 1
    rows = {r.WO_TicketID: r for r in detail.collect()}
    one, two = rows["WO-101"], rows["WO-102"]
    assert (one["Aging (Hrs)"], one["Aging Grp"], one.Workgroup, one.WO_CurrentProcessorGroup) == (8.0, "4Hrs-24Hrs", "TSC", "TSC_TRANSPORT")
    assert (two.Area, two.Workgroup, two["Service Affecting Type"], two.SiteDown) == ("MIN", "TSC", None, None)
    assert (one.Area, one.Technology, one.Fault_Severity_Level, one.WO_BusinessStatus) == ("VIS", "FD-LTE", "Minor", "Resovled")


def test_whole_pending_report(spark, desk, tmp_path):
    paths = W.write_pending_report(desk, str(tmp_path), AS_OF)
    assert set(paths) == {
        "All Raw Data", "Per Technology", "Unique Sites", "Per Resolving Team", "Per Severity", "Per Workgroup and Severity",
    }
    read = {name: spark.read.parquet(path) for name, path in paths.items()}
    team = {r.Workgroup: r for r in read["Per Resolving Team"].collect()}
    assert team["TSC"]["Average (Hrs)"] == 8.0 and team["TOTAL"]["4Hrs-24Hrs"] == 1 and team["TSC"]["Prev Years"] is None
    severity = {r["Service Affecting Type"]: r for r in read["Per Severity"].collect()}
    assert severity["SA"]["Resolved"] == 1 and severity["PSA"]["Total Pending"] is None
    assert severity["All"]["Total Pending"] == 1


def test_missing_cause(desk):
    rows = {(r["Ticket ID"], r["Parent Ticket ID"]): r for r in missing_cause(desk).collect()}
    assert set(rows) == {("TT-2", None)}
    row = rows[("TT-2", None)]
    assert (row["Site ID"], row.Province, row["Site Name"], row["Relationship Type"]) == ("raw", None, "-", "NA")
    assert (row["Service Affecting"], row["Site Down"], row.SubProcessWO) == ("A100000029", "Yes", "WO-102")
    assert row.SubProcessWO_CurrentProcessor == "TSC_TRANSPORT"
    assert missing_cause(desk, strict=True).count() == 0


def test_missing_cause_history(spark, desk, tmp_path):
    path = str(tmp_path / "history")
    for day in ("2021-12-10", "2021-12-10", "2021-12-11"):
        append_missing_cause(desk, path, day)
    assert spark.read.parquet(path).count() == 2


def test_team_daily(spark, desk, tmp_path):
    counts = {r.dataset: r.rows for r in R7.write_team_daily(desk, str(tmp_path), *DAY).collect()}
    assert counts == {
        "CR_WO_Handled": 0, "CR_Handled": 1, "CR_WO_Accepted": 0, "New_WO": 1, "Pending_WO": 2, "Running_SDT": 1,
        "Pending_WO_Escalation": 1,
    }
    sdt = R7.running_sdt(desk).collect()
    assert [(r.TicketID, r.EscalationTime) for r in sdt] == [("SDT-202", "2021-12-09 12:00:00")]
    log = R7.work_escalations(desk, R7.pending_child_work(desk)).collect()
    assert [(r.ORDERID, r.ENDORSE_TIME, r.PHASE, r.PROCESSOR) for r in log] == [
        ("WO-101", "09-DEC-2021 09:02:03", "Process WO", "Bob")
    ]
    one = R7.escalation_times(desk, desk["work_order"], "WO005", "WO-101")
    assert rows_of(one) == [("WO-101", "2021-12-09 09:02:03", "tsc_transport")]
    assert rows_of(R7.team_roster(desk)) == [(2, "Bob", "TSC_TRANSPORT")]


def test_roster_can_be_given(spark, desk):
    everyone = spark.createDataFrame([("Ann",)], "fullname STRING")
    assert [r.TicketID for r in R7.changes_handled(desk, *DAY, members=everyone).collect()] == ["CR-2"]


def test_empty_inputs(empty_desk):
    assert adhoc_sdt_tickets(empty_desk, "1").count() == 0
    assert R2.outage_grid(R2.outage_tickets(empty_desk)).count() == 6
    assert daily_tickets(empty_desk, *DAY).count() == 0
    assert W.pending_flat(empty_desk, AS_OF).count() == 0
    cells = W.pending_lattice(W.prepared(empty_desk, AS_OF))
    assert W.severity_grid(cells, ["New"]).count() == 3 and W.site_down_grid(cells).count() == 6
    assert W.workgroup_severity_grid(cells, ["New"]).count() == 0
    assert missing_cause(empty_desk).count() == 0
    for df in R7.team_daily(empty_desk, *DAY).values():
        assert df.count() == 0
