"""Area names, label lists, code lists and rule patterns that results must equal."""

# Zone of the stored local times.
LOCAL_ZONE = "Asia/Manila"

# Area names and their report codes.
AREA_CODES = {
    "Metro Manila": "MM",
    "North Luzon": "NL",
    "South Luzon": "SL",
    "Visayas": "VIS",
    "Mindanao": "MIN",
}

# Technology spellings.
TECHNOLOGY_LABELS = {"FDLTE": "FD-LTE", "TDLTE": "TD-LTE"}

# Report axes.
AREA_AXIS = ["MM", "NL", "SL", "VIS", "MIN"]
TECHNOLOGY_AXIS = ["2G", "3G", "FD-LTE", "5G", "Canopy", "TD-LTE", "WIFI"]
AGING_AXIS = ["<4Hrs", "4Hrs-24Hrs", ">24Hrs"]
AFFECTING_AXIS = ["SA", "PSA"]

# Severity labels, worst first.
SEVERITY_ORDER = ["Critical", "Moderate", "Major", "Minor", "Low", "Alarm Clearing"]

# Site-down flag to service-affecting type.
AFFECTING_TYPES = {"isNo": "PSA", "isYes": "SA"}

# Business-status spelling in headers.
STATUS_SPELLING = {"Resovled": "Resolved"}

# Area patterns on a processor group, in order.
AREA_RULES = [
    ("Metro Manila", "^NFS_[A-Z]*MM_[A-Z0-9]*$"),
    ("North Luzon", "^NFS_[A-Z]*NL_[A-Z0-9]*$"),
    ("South Luzon", "^NFS_[A-Z]*SL_[A-Z0-9]*$"),
    ("Visayas", "^NFS_[A-Z]*VIS_[A-Z0-9]*$"),
    ("Mindanao", "^NFS_[A-Z]*MIN_[A-Z0-9]*$"),
]

# Workgroup patterns, in order.
WORKGROUP_RULES = [
    ("WFS", "WFS"),
    ("FFS", "FFS|FxATOP"),
    ("TSC", "TSC|TAC"),
    ("BUILD", "Build"),
    ("NPE", "Engineering|NPE"),
    ("NOSM", "SFEM"),
    ("SPM", "SPMONS"),
    ("FCFFS", "FC"),
    ("CoreOps", "CoreOps"),
    ("CSOG", "CSOG"),
    ("ECSA", "ECSA"),
    ("FNAS", "FNAS"),
    ("FSMG", "FSMG"),
    ("OPM", "OPM"),
    ("OVIM", "OVIM"),
    ("PMO", "PMO"),
    ("NOC_BIS", "NOC_BIS"),
    ("NOC_CNCC", "NOC_CNCC"),
    ("NOC", "NOC_NAC_NSC"),
    ("SOC", "SOC"),
]

# The older pattern set knows a single NOC rule.
OLDER_WORKGROUP_RULES = [rule for rule in WORKGROUP_RULES if not rule[0].startswith("NOC") and rule[0] != "SOC"] + [
    ("NOC", "NOC"),
    ("SOC", "SOC"),
]

# Group codes tried in a processor list, in order of preference.
LIST_CODES = [
    "Engineering",
    "NPE",
    "Network Build",
    "TSC",
    "TAC",
    "SFEM",
    "OPM",
    "WFS",
    "NOC_BIS",
    "FNAS",
    "FFS",
    "FxATOP",
    "CNCC",
    "SPMONS",
    "FC",
    "CoreOps",
    "CSOG",
    "OPM",
    "OVIM",
    "PMO",
    "SOC",
    "NOC",
]

# Title patterns kept and rejected by the pending-child report.
PENDING_TITLES = [
    "%Low%",
    "%Major%",
    "%Critical%",
    "%Link Utilization%",
    "%Others%",
    "%Requests%",
    "%NOC Assistance%",
    "%Minor%",
    "%Moderate%",
    "%Alarm Clearing%",
    "%Complaint%",
]
PENDING_TITLES_REJECTED = ["%lower%", "%TSC_%"]

# Title patterns rejected by the handled-change report.
HANDLED_TITLES_REJECTED = [
    "%Protection Switching%",
    "%NMS Uploading and Remote%",
    "%Low%",
    "%TPE-AP%",
    "%Link Utilization%",
    "%Minor%",
    "%Critical%",
    "%Major%",
]

# Phase labels of task nodes; any other node is the last phase.
PHASE_LABELS = {"WO002": "Create WO", "WO004": "Handle WO", "WO005": "Process WO"}
LAST_PHASE = "Confirm WO"

# Group names and codes the reports select on.
REPORT_ORIGIN_GROUP = "NOC_NAC_NSC"
REPORT_TEAM_GROUP = "TSC_TRANSPORT"
FIRST_REPORT_YEAR = 2019
EPOCH_YEAR = 1970
FAR_FUTURE = "2030-12-31 23:59:59"

# Snapshot column names.
SNAPSHOT_NAMES = {
    "Parent Ticket ID": "parent_ticket_id",
    "Ticket ID": "ticket_id",
    "Site ID": "site_id",
    "Site Name": "site_name",
    "Domain": "domain",
    "Technology": "technology",
    "Band": "band",
    "Device": "device",
    "Device Owner": "device_owner",
    "City": "city",
    "Province": "province",
    "Area": "area",
    "Service Affecting": "service_affecting",
    "Site Down": "site_down",
    "Cause of Outage": "cause_of_outage",
    "Sub Cause 1": "sub_cause_1",
    "Sub Cause 2": "sub_cause_2",
    "Sub Cause 3": "sub_cause_3",
    "Ticket Status": "ticket_status",
    "SubProcessWO": "subprocess_wo",
    "SubProcessWO_Status": "subprocess_wo_status",
    "SubProcessWO_CurrentProcessor": "subprocess_wo_currentprocessor",
    "Ticket Created Time": "ticket_created_time",
    "Fault First Occur Time": "fault_first_occur_time",
    "Fault Recovery Time": "fault_recovery_time",
    "Assign To": "assign_to",
    "TT_CurrentProcessor": "tt_currentprocessor",
    "Relationship Type": "relationship_type",
    "AsOf": "asof",
}
