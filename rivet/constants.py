"""Domain constants.

FIXED VALUES: the lists and tables below must equal the original
application's values for results to match (sensor names and valid ranges,
diagnosis rules in their evaluation order, failure-mode categories in their
listed order, thresholds). They are stated here plainly and in natural order.
"""

from __future__ import annotations

# --- FIXED VALUES: sensor channels used for features and diagnosis --------
SENSORS = [
    "vibration_mm", "temperature_f", "pressure_psi",
    "flow_rate", "rpm", "motor_current", "oil_quality_index",
]

# --- FIXED VALUES: operating modes ---------------------------------------
OPERATING_MODES = ["normal", "degrading", "critical"]

# --- FIXED VALUES: validation ranges (inclusive) --------------------------
SENSOR_RANGES = {
    "vibration_mm": (0, 20),
    "temperature_f": (-20, 400),
    "pressure_psi": (0, 500),
    "flow_rate": (0, 2000),
    "rpm": (0, 5000),
    "motor_current": (0, 200),
    "oil_quality_index": (0, 100),
    "ambient_temp": (-40, 150),
    "ambient_humidity": (0, 100),
}

# --- FIXED VALUES: diagnosis rules, first match wins ----------------------
# (cause, signals reported, conditions); a condition is (signal, op, value)
# where op is ">" / "<" on the z-score, or "abs>" on its absolute value.
DIAGNOSIS_RULES = [
    ("Bearing wear", ["vibration_mm", "temperature_f"],
     [("vibration_mm", ">", 1.5), ("temperature_f", ">", 1.0)]),
    ("Lubrication failure", ["oil_quality_index", "temperature_f"],
     [("oil_quality_index", "<", -1.5), ("temperature_f", ">", 1.0)]),
    ("Seal leakage / cavitation", ["pressure_psi", "flow_rate"],
     [("pressure_psi", "<", -1.5), ("flow_rate", "<", -1.0)]),
    ("Motor winding failure", ["motor_current", "temperature_f"],
     [("motor_current", ">", 2.0)]),
    ("Rotor imbalance / shaft misalignment", ["vibration_mm", "rpm"],
     [("vibration_mm", ">", 2.0), ("rpm", "abs>", 1.0)]),
    ("Early-stage lubrication degradation", ["oil_quality_index"],
     [("oil_quality_index", "<", -1.5)]),
    ("Flow restriction / suction blockage", ["pressure_psi"],
     [("pressure_psi", "<", -2.0)]),
]
UNCLASSIFIED = "Unclassified anomaly"

# --- FIXED VALUES: failure modes and their categories (listed order) ------
FAILURE_MODE_CATEGORIES = [
    ("bearing_wear", "mechanical"),
    ("shaft_misalignment", "mechanical"),
    ("rotor_imbalance", "mechanical"),
    ("lubrication_failure", "mechanical"),
    ("seal_leakage", "hydraulic"),
    ("cavitation", "hydraulic"),
    ("impeller_erosion", "hydraulic"),
    ("motor_winding_failure", "electrical"),
]

# --- FIXED VALUES: thresholds ---------------------------------------------
HORIZONS_DAYS = [7, 14, 30]
ROLL_WINDOWS = [6, 24, 72]
LAG_ROWS = 24
FFT_WINDOW = 24
FFT_MIN_ROWS = 4
RUL_CAP_HOURS = 3000.0
SEQUENCE_LENGTH = 60
SEQUENCE_STRIDE = 6
MISSING_PCT_LIMIT = 5.0
KS_ALPHA = 0.05
DRIFT_REFERENCE_SHARE = 0.7
FAIRNESS_FLOOR = 0.3
BINDING_TOL = 0.5
RISK_BINS = [(0.0, 0.3, "Low"), (0.3, 0.6, "Medium"), (0.6, 1.0, "High")]
# derate ladder: (risk above, rul below, factor, status)
DERATE_LADDER = [
    (0.7, 50.0, 0.3, "CRITICAL - Derated"),
    (0.4, 200.0, 0.7, "DEGRADED - Reduced"),
]
DERATE_HEALTHY = (1.0, "HEALTHY - Full capacity")
NO_HEALTH_STATUS = "No health data - assumed healthy"
DEFAULT_RISK = 0.1
DEFAULT_RUL_HOURS = 1000.0
ADVICE_LADDER = [
    (0.8, "URGENT"),
    (0.5, "MODERATE"),
]
ADVICE_DEFAULT = "NORMAL"
RISK_MARKERS = {"High": "🔴", "Medium": "🟡", "Low": "🟢"}
RISK_MARKER_DEFAULT = "⚪"
QUALITY_GATE_F1 = 0.70

# --- FIXED VALUES: messages, labels and formats of the outputs ---------------
CHECK_NOT_NULL = "not_nullable"
CHECK_ISIN = "isin([{values}])"
CHECK_IN_RANGE = "in_range({lo}, {hi})"
METHOD_DIRECT = "direct_historical_match"
METHOD_NO_DATA = "no_data_available"
METHOD_NO_CATEGORY_DATA = "no_similar_category_data"
METHOD_FALLBACK = "category_fallback (borrowed from {mode})"
CONFIDENCE_DIRECT = "high"
CONFIDENCE_NONE = "none"
CONFIDENCE_FALLBACK = "low - verify with engineer before acting"
UNCLASSIFIED_KEY = "unclassified_anomaly"
LIMIT_MESSAGE = "{limit} capacity ({capacity} bpd) is FULLY UTILIZED - this is the limiting factor for total output"
LIMIT_NAMES = ["Pipeline", "Compressor"]
WELL_MESSAGE = "{well} is producing at its FULL safe capacity ({capacity} bpd) - {status}"
SIMULATED_STATUS = "SIMULATED - Further Degraded"
WORK_ORDER_ID = "WO-%05d"
CORRECTIVE = ("corrective", "Repair for {mode}", "Addressed {mode}. Downtime: {hours} hours.")
PREVENTIVE = ("preventive", "Routine scheduled inspection", "No issues found. Lubrication checked.")
DRIFT_ADVICE = "investigate drifted sensors and consider retraining if drift persists across multiple monitoring cycles"
NO_DRIFT_ADVICE = "no significant drift detected - model remains valid"
