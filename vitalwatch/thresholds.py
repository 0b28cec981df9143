"""Detection parameters.

The numbers below are fixed values: they must equal the deployed job's
constants for the flags to agree, so they are stated plainly, together, in
metric order. Operators take a :class:`Thresholds` instance, so a caller can
pass other bounds or add a metric without touching any plan code.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class RangeRule:
    """Flag when ``value < lo`` or ``value > hi`` (strict; ``None`` = no bound).

    ``message`` is a ``format_string`` pattern taking (value, lo, hi), or
    (value, hi) when there is no lower bound.
    """

    metric: str
    lo: float | None
    hi: float | None
    message: str


@dataclass(frozen=True)
class TrendRule:
    """Flag when the value departs from the mean of the last ``history`` values.

    ``kind`` is one of ``"mul_above"`` (x > avg * amount), ``"add_above"``
    (x > avg + amount) and ``"mul_below"`` (x < avg * amount). ``message``
    takes (value, avg).
    """

    metric: str
    kind: str
    amount: float
    message: str


# ---- fixed values (must match the reference job) --------------------------
# Range bounds, in metric order:
#   heart_rate 50.0-120.0 bpm, temperature 35.0-39.5 C, systolic 80.0-150.0,
#   diastolic 40.0-100.0, oxygen saturation 90.0-100.0, respiration 10.0-25.0,
#   blood glucose 60.0-180.0, stress level above 6.0 only.
# Trend thresholds against the mean of the last 10 non-null values:
#   heart rate x > avg * 1.15, temperature x > avg + 1.0,
#   systolic x > avg * 1.10, diastolic x > avg * 1.10,
#   oxygen saturation x < avg * 0.97, respiration x > avg + 5.0,
#   blood glucose x > avg + 30.0, stress x > avg + 3.0.
# History length 10; alert cooldown 60 s per device.
HISTORY_SIZE = 10
COOLDOWN_SECONDS = 60

# Alert texts, one per rule, in metric order (Java/Spark %.1f rounds half up).
RANGE_RULES: tuple[RangeRule, ...] = (
    RangeRule("heart_rate", 50.0, 120.0,
              "Heart rate of %.1f bpm is outside normal range (%.1f-%.1f)."),
    RangeRule("temperature", 35.0, 39.5,
              "Temperature of %.1f°C is outside normal range (%.1f-%.1f)."),
    RangeRule("systolic_pressure", 80.0, 150.0,
              "Systolic pressure of %.1f mmHg is outside normal range (%.1f-%.1f)."),
    RangeRule("diastolic_pressure", 40.0, 100.0,
              "Diastolic pressure of %.1f mmHg is outside normal range (%.1f-%.1f)."),
    RangeRule("oxygen_saturation", 90.0, 100.0,
              "Oxygen saturation of %.1f%% is outside normal range (%.1f-%.1f)."),
    RangeRule("respiration_rate", 10.0, 25.0,
              "Respiration rate of %.1f breaths/min is outside normal range (%.1f-%.1f)."),
    RangeRule("blood_glucose", 60.0, 180.0,
              "Blood glucose of %.1f mg/dL is outside normal range (%.1f-%.1f)."),
    RangeRule("stress_level", None, 6.0,
              "Stress level of %.1f is unusually high (>%.1f)."),
)

TREND_RULES: tuple[TrendRule, ...] = (
    TrendRule("heart_rate", "mul_above", 1.15,
              "Gradual heart rate increase detected! Current: %.1f bpm, Average: %.1f bpm."),
    TrendRule("temperature", "add_above", 1.0,
              "Gradual temperature increase detected! Current: %.1f°C, Average: %.1f°C."),
    TrendRule("systolic_pressure", "mul_above", 1.10,
              "Gradual systolic pressure increase detected! Current: %.1f mmHg, Average: %.1f mmHg."),
    TrendRule("diastolic_pressure", "mul_above", 1.10,
              "Gradual diastolic pressure increase detected! Current: %.1f mmHg, Average: %.1f mmHg."),
    TrendRule("oxygen_saturation", "mul_below", 0.97,
              "Gradual oxygen saturation drop detected! Current: %.1f%%, Average: %.1f%%."),
    TrendRule("respiration_rate", "add_above", 5.0,
              "Gradual respiration rate increase detected! Current: %.1f breaths/min, Average: %.1f breaths/min."),
    TrendRule("blood_glucose", "add_above", 30.0,
              "Gradual blood glucose increase detected! Current: %.1f mg/dL, Average: %.1f mg/dL."),
    TrendRule("stress_level", "add_above", 3.0,
              "Gradual stress level increase detected! Current: %.1f, Average: %.1f."),
)

# Alert mail: subject prefix and body text around the message bullets.
ALERT_SUBJECT = "Urgent Health Alert for "
ALERT_BODY_HEAD = ("Dear User,\n\n"
                   "We've detected unusual activity from your health sensors at {ts}.\n\n"
                   "Please review the following:\n\n")
ALERT_BULLET = "- {msg}\n"
ALERT_BODY_TAIL = ("\nIt's important to pay attention to these changes and consider taking action.\n\n"
                   "Your well-being is our priority. This is an automated alert and not medical advice. "
                   "Always consult a qualified healthcare professional for any health concerns.")

# Normal-range clamp of the device simulator, re-used as a cleaning operator:
#   heart_rate 55-105, temperature 36.0-38.0, systolic 85-135, diastolic 55-85,
#   oxygen saturation 94-100, respiration 10-22, blood glucose 65-120, stress 0-5.
CLAMP_BOUNDS: tuple[tuple[str, float, float], ...] = (
    ("heart_rate", 55.0, 105.0),
    ("temperature", 36.0, 38.0),
    ("systolic_pressure", 85.0, 135.0),
    ("diastolic_pressure", 55.0, 85.0),
    ("oxygen_saturation", 94.0, 100.0),
    ("respiration_rate", 10.0, 22.0),
    ("blood_glucose", 65.0, 120.0),
    ("stress_level", 0.0, 5.0),
)

# Hour-of-day activity bands of the simulator (start hour inclusive):
#   0-5 sleep, 6-7 wake, 8-17 active, 18-21 evening, 22-23 late.
HOUR_BANDS: tuple[tuple[int, str], ...] = (
    (0, "sleep"),
    (6, "wake"),
    (8, "active"),
    (18, "evening"),
    (22, "late"),
)

# Dashboard: relative ranges offered by the time picker, default "5m";
# value bands: the anomaly flag turns red from 1, a metric panel from 80.
RANGE_PRESETS: tuple[str, ...] = ("5m", "15m", "1h", "6h", "12h", "24h", "2d", "7d", "30d")
FLAG_RED_FROM = 1.0
METRIC_RED_FROM = 80.0
RECENT_LIMIT = 100
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Thresholds:
    rules: tuple[RangeRule, ...] = RANGE_RULES
    trends: tuple[TrendRule, ...] = TREND_RULES
    history: int = HISTORY_SIZE
    cooldown_seconds: float = COOLDOWN_SECONDS
    clamp: tuple[tuple[str, float, float], ...] = field(default=CLAMP_BOUNDS)

    @property
    def rule_metrics(self) -> list[str]:
        return [r.metric for r in self.rules]

    @property
    def trend_metrics(self) -> list[str]:
        return [t.metric for t in self.trends]


DEFAULT = Thresholds()
