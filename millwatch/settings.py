"""Thresholds, value lists and texts of the telemetry rules, in one place."""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values -------------------------------------------------------------------------------
# Results only agree with existing deployments while these stay as they are.

# Values outside these closed ranges are no readings at all and become NULL.
VALID_RANGE = {"temperature": (0.0, 150.0), "vibration": (0.0, 2.0), "pressure": (0.0, 500.0)}

# Strictly above one of these, or with this status code, a reading is anomalous.
ANOMALY_ABOVE = {"temperature": 100.0, "vibration": 1.0, "pressure": 450.0}
ANOMALY_STATUS = "CRIT"

STATUS_CODES = ["AOK", "WARN", "CRIT"]
SIGNAL_STRENGTH = {"AOK": 100, "WARN": 60, "CRIT": 20}
SIGNAL_STRENGTH_OTHERWISE = 0
READING_STATUSES = ["normal", "anomalous", "invalid"]

DEFAULT_ISSUE = "Immediate maintenance required"


@dataclass(frozen=True)
class Tier:
    """One health class: strictly above either bound puts a machine in it."""

    avg_temperature_above: float
    max_vibration_above: float
    failure_risk_score: int
    health_status: str
    maintenance_recommendation: str


TIERS = [  # worst first
    Tier(90.0, 0.8, 90, "CRITICAL", "Immediate maintenance required"),
    Tier(75.0, 0.6, 60, "NEEDS_MAINTENANCE", "Schedule maintenance within 48 hours"),
    Tier(float("-inf"), float("-inf"), 30, "HEALTHY", "No action needed"),
]
HEALTH_STATUSES = ["HEALTHY", "NEEDS_MAINTENANCE", "CRITICAL"]  # rank = position
RECOMMENDATIONS = ["No action needed", "Schedule maintenance within 48 hours", "Immediate maintenance required"]
RISK_LABELS = {"HEALTHY": "Low Risk", "NEEDS_MAINTENANCE": "Medium Risk"}
RISK_LABEL_OTHERWISE = "High Risk"

# Labelling rule of the device simulator: at or beyond these a reading deserves the code.
LABEL_RULES = [  # (code, temperature from, vibration from, pressure from, pressure down to)
    ("CRIT", 95.0, 0.8, 110.0, 92.0),
    ("WARN", 85.0, 0.5, 105.0, 95.0),
]
LABEL_OTHERWISE = "AOK"

# Edges of the three gauge bands; the alarm line is the top of the second band.
GAUGE_EDGES = {
    "temperature": (0.0, 50.0, 75.0, 100.0),
    "pressure": (0.0, 100.0, 150.0, 200.0),
    "vibration": (0.0, 0.5, 0.8, 1.0),
}

# A current reading further from the machine's mean than this is highlighted.
DELTA_ALERT_ABOVE = {"temperature": 5.0, "pressure": 10.0, "vibration": 0.1}

ROLLING_ROWS = 20
ROLLING_SIGMAS = 2.0
RECENT_ROWS = 1000

LANDING_GLOB = "*.csv"
NULL_TOKENS = ["NULL", "null", ""]
TEXT_LIMITS = {"machine_id": 50, "status_code": 10}
BATCH_FILE_PATTERN = r"sensor_data_batch_(\d+).csv"

PROFILE_LABEL = "Data Quality Check"
RUN_KEY_PREFIX = "s3_files_"

FIRST_EVENT_TIME = "1900-01-01 00:00:00"  # bound of an empty history
FILE_POLL_INTERVAL = "15 seconds"
ALERT_INTERVAL = "30 seconds"
WATERMARK_DELAY = "1 hour"

NOTHING_CRITICAL = "No critical machines found"
REPORT_SUBJECT = "CRITICAL ALERT: %d Machines Require Immediate Attention"
REPORT_TITLE = "CRITICAL MACHINES ALERT REPORT"
REPORT_TOTAL = "Total Critical Machines: "
REPORT_TIME = "Report Generated: "
REPORT_LIST = "CRITICAL MACHINES:"
REPORT_ENTRY = "- Machine ID: %s\n  Risk Score: %s%%\n  Issue: %s\n"
REPORT_ENTRY_HEADINGS = ["Machine ID", "Risk Score", "Issue"]
REPORT_CALL = "Please take immediate action to prevent equipment failure."
# -------------------------------------------------------------------------------------------------

SENSORS = ["temperature", "vibration", "pressure"]
HISTORY_KEY = ["machine_id", "event_time"]
