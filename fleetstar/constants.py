"""Fixed values of the data model and its reports.

These are domain values that results must reproduce exactly (codes, labels,
thresholds); they are kept together here, in their natural order.
"""

# --- fixed values: alert taxonomy (key, code, category, name, severity,
# auto_shutoff, notifies_regional, sla_response_mins) -----------------------
ALERT_TYPES = [
    (1, "THERM-CRIT", "Thermal", "Critical thermal event — device exceeds 245°C", "Critical", True, True, 5),
    (2, "THERM-WARN", "Thermal", "Thermal warning — device above safe threshold", "High", False, False, 15),
    (3, "POWER-SURGE", "Power", "Power draw surge detected", "High", True, True, 10),
    (4, "CONN-LOST", "Connectivity", "Device lost network connectivity", "Medium", False, False, 30),
    (5, "COMPLIANCE", "Compliance", "GDPR or data governance flag raised", "Low", False, False, 60),
]
THERM_CRIT_KEY = 1
THERM_WARN_KEY = 2

# --- fixed values: data quality flags --------------------------------------
QUALITY_FLAGS = ["CLEAN", "NOISY", "MISSING", "SPIKE"]

# --- fixed values: default thresholds --------------------------------------
HIGH_RISK_MIN_RATE = 10          # percent, strict >
TREND_WARM = 2                   # degrees, strict >
TREND_COOL = -2                  # degrees, strict <
EARLY_WARNING_JUMP = 20          # degrees, strict >
FIRMWARE_FAIL = 10               # percent, strict >
FIRMWARE_WARN = 7                # percent, strict >
CRITICAL_TEMP = 245              # degrees, THERM-CRIT above this
ZSCORE_K = 2.5
IQR_MULTIPLIER = 1.5

# --- fixed values: report labels -------------------------------------------
TREND_LABELS = ("WARMING", "COOLING", "STABLE")
EARLY_WARNING_LABELS = ("HIGH RISK — rapid temp escalation", "SPIKE INCOMING", "NORMAL")
MAINTENANCE_LABELS = {
    1: "CRITICAL — immediate inspection required",
    2: "HIGH — schedule maintenance within 7 days",
    3: "MODERATE — monitor closely",
    4: "HEALTHY — no action required",
}
FIRMWARE_LABELS = ("FAILED — force update required", "WARNING — update recommended", "COMPLIANT")

# --- fixed values: alert card and e-mail wording ---------------------------
CARD_CONTENT_TYPE = "application/vnd.microsoft.card.adaptive"
CARD_SCHEMA = "http://adaptivecards.io/schemas/adaptive-card.json"
CARD_HEADLINE = "CRITICAL THERMAL ALERT"
CARD_SHUTOFF_TEXT = "Device has been automatically shut off. Immediate inspection required."
CARD_ACTION_TITLE = "View Dashboard"
CARD_FACT_TITLES = ["Store", "Device ID", "Firmware", "Temperature", "Overage", "Alert Code",
                    "Severity", "SLA", "Timestamp", "Region", "Assigned To"]
EMAIL_SUBJECT = "[CRITICAL] Thermal Alert — %s — %s"
OUTBOX_STATUS = "PENDING"
