"""Table sources: the given parquet tables and the ``readings`` view over ``events``.

``readings`` turns each row of ``events`` into one device reading (see
FIXTURES.md section 3). The same SQL text runs in Spark and in DuckDB, so it is
kept here as one template; only the name of the string type differs.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Fixed values of the fixture view: metric formulas and the event_id moduli
# that turn a value into a missing reading (FIXTURES.md section 3).
READINGS_SQL = """
SELECT event_id,{extra}
       concat('device_', cast(user_id AS {str})) AS device_id,
       ts AS reading_ts,
       CASE WHEN event_id % 13 = 0 THEN NULL ELSE cast(60 + floor(value/2.5) AS double) END AS heart_rate,
       CASE WHEN event_id % 17 = 0 THEN NULL ELSE cast(36.0 + floor(value/20)*0.25 AS double) END AS temperature,
       CASE WHEN event_id % 19 = 0 THEN NULL ELSE cast(105 + floor(value/4) AS double) END AS systolic_pressure,
       CASE WHEN event_id % 23 = 0 THEN NULL ELSE cast(65 + floor(value/5) AS double) END AS diastolic_pressure,
       CASE WHEN event_id % 29 = 0 THEN NULL ELSE cast(99 - floor(value/18) AS double) END AS oxygen_saturation,
       CASE WHEN event_id % 31 = 0 THEN NULL ELSE cast(12 + floor(value/12) AS double) END AS respiration_rate,
       CASE WHEN event_id % 37 = 0 THEN NULL ELSE cast(58 + floor(value*0.75) AS double) END AS blood_glucose,
       cast(event_id % 61 AS int) AS steps_count,
       cast(0.75 + (event_id % 11)*0.25 AS double) AS calories_burned,
       CASE WHEN event_id % 41 = 0 THEN NULL ELSE cast(floor(value/25) AS double) END AS stress_level
FROM events
"""


def readings_sql(dialect: str = "spark", extra: str = "") -> str:
    """The view text; ``extra`` adds more ``events`` columns after ``event_id``."""
    return READINGS_SQL.format(str="string" if dialect == "spark" else "varchar",
                               extra=(" " + extra + ",") if extra else "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def readings(spark: SparkSession, sf_dir: str, extra: str = "") -> DataFrame:
    """Device readings derived from ``events``; one row per event, whole table."""
    events = table(spark, sf_dir, "events")
    # a per-folder view name keeps frames over different folders apart
    view = "events_" + str(abs(hash(os.path.abspath(sf_dir))))
    events.createOrReplaceTempView(view)
    return spark.sql(readings_sql("spark", extra).replace("FROM events", f"FROM {view}"))


# Skew fixture: every third event is given to one device, so that device holds
# a third of all readings (the hot-key case the batch operators must split).
HOT_DEVICE = "device_hot"


def skewed_readings_sql(dialect: str = "spark") -> str:
    cols = ("reading_ts, heart_rate, temperature, systolic_pressure, diastolic_pressure, "
            "oxygen_saturation, respiration_rate, blood_glucose, steps_count, calories_burned, "
            "stress_level")
    return (f"SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '{HOT_DEVICE}' ELSE device_id END "
            f"AS device_id, {cols} FROM ({readings_sql(dialect)}) r")


def skewed_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings with one device holding a third of them (whole table)."""
    from pyspark.sql import functions as F

    r = readings(spark, sf_dir)
    dev = F.when(F.col("event_id") % 3 == 0, F.lit(HOT_DEVICE)).otherwise(F.col("device_id"))
    return r.select("event_id", dev.alias("device_id"), *[c for c in r.columns
                                                          if c not in ("event_id", "device_id")])
