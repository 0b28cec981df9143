"""The metrics of a reading."""

from __future__ import annotations

# Metrics in message order. steps_count is the only integer metric.
METRICS: tuple[str, ...] = (
    "heart_rate",
    "temperature",
    "systolic_pressure",
    "diastolic_pressure",
    "oxygen_saturation",
    "respiration_rate",
    "blood_glucose",
    "steps_count",
    "calories_burned",
    "stress_level",
)
