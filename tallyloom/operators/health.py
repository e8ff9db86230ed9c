"""Wearable readings: alerts, roll-ups and comparisons between days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.functions.measures import Measure, aggregate
from tallyloom.functions.times import add_bucket, instant, interval, shifted, time_type, trailing
from tallyloom.operators.dimensions import aggregate_by_attribute, join_dimension

DAILY = [
    Measure("avg_heart_rate", "avg", "heart_rate"),
    Measure("min_heart_rate", "min", "heart_rate"),
    Measure("max_heart_rate", "max", "heart_rate"),
    Measure("avg_bp_systolic", "avg", "blood_pressure_systolic"),
    Measure("avg_bp_diastolic", "avg", "blood_pressure_diastolic"),
    Measure("avg_spo2", "avg", "spo2"),
    Measure("avg_temperature", "avg", "body_temperature"),
    Measure("total_steps", "max", "steps_count"),
    Measure("avg_sleep_quality", "avg", "sleep_quality_score"),
    Measure("readings_count", "count"),
]
HOURLY = [
    Measure("avg_heart_rate", "avg", "heart_rate"),
    Measure("avg_bp_systolic", "avg", "blood_pressure_systolic"),
    Measure("avg_bp_diastolic", "avg", "blood_pressure_diastolic"),
    Measure("avg_spo2", "avg", "spo2"),
    Measure("avg_temp", "avg", "body_temperature"),
]
ACTIVITY = [
    Measure("total_steps", "max", "steps_count"),
    Measure("avg_heart_rate", "avg", "heart_rate"),
    Measure("avg_sleep_quality", "avg", "sleep_quality_score"),
]
PRESSURE = [
    Measure("avg_systolic", "avg", "blood_pressure_systolic"),
    Measure("avg_diastolic", "avg", "blood_pressure_diastolic"),
    Measure("max_systolic", "max", "blood_pressure_systolic"),
    Measure("max_diastolic", "max", "blood_pressure_diastolic"),
]


def owners(users: DataFrame, devices: DataFrame) -> DataFrame:
    """Each user with each of their devices."""
    return (users.join(devices.select("user_id", "device_type", "device_model"), users.id == F.col("user_id"))
            .select("name", "age", "device_type", "device_model"))


def latest_readings(data: DataFrame, k: int = 10) -> DataFrame:
    return data.orderBy(F.col("time").desc_nulls_first(), "device_id").limit(k)


def recent_rows(data: DataFrame, as_of, span: str = "5 minutes") -> DataFrame:
    return trailing(data, "time", as_of, span)


# The labels of heart rates and alerts, here and in `alert_status`.
def heart_rate_condition(rate: Column) -> Column:
    return F.when(rate > 99, "Tachycardia").when(rate < 60, "Bradycardia")


def abnormal_heart_rate(data: DataFrame, as_of, span: str = "1 day", strict: bool = False) -> DataFrame:
    """Heart rates above 99 at any time, and below 60 in the trailing window.

    The time bound covers the low readings only, as the query is written;
    `strict` applies it to both.
    """
    recent = F.col("time") >= instant(as_of, time_type(data, "time")) - interval(span)
    high, low = F.col("heart_rate") > 99, F.col("heart_rate") < 60
    wanted = ((high | low) & recent) if strict else (high | (low & recent))
    return data.where(wanted).select(
        "time", "device_id", "heart_rate", heart_rate_condition(F.col("heart_rate")).alias("condition")).orderBy(
        F.col("time").desc_nulls_first(), "device_id")


def hourly_vitals(data: DataFrame, as_of, span: str = "1 day", k: int = 24) -> DataFrame:
    hourly = aggregate(add_bucket(trailing(data, "time", as_of, span), "1 hour", "time", "period"),
                       ["period"], HOURLY)
    return hourly.orderBy(F.col("period").desc_nulls_first()).limit(k)


def _owned(devices: DataFrame, users: DataFrame, *columns: str) -> DataFrame:
    """Device ids with their owner's name; devices nobody owns are absent."""
    return devices.select(F.col("id").alias("device_id"), "user_id", *columns).join(
        users.select(F.col("id").alias("user_id"), "name"), "user_id").drop("user_id")


def _daily_by_user(data: DataFrame, devices: DataFrame, users: DataFrame, measures: list[Measure]) -> DataFrame:
    """Daily measures per user name."""
    return aggregate_by_attribute(add_bucket(data, "1 day", "time", "date"), _owned(devices, users), "device_id",
                                  ["date"], ["name"], measures)


def daily_activity(data: DataFrame, devices: DataFrame, users: DataFrame, as_of, span: str = "7 days") -> DataFrame:
    """Steps, heart rate and sleep per user and day.

    `total_steps` is the maximum, since the counter is cumulative over the day.
    """
    return _daily_by_user(trailing(data, "time", as_of, span), devices, users, ACTIVITY).orderBy(
        F.col("date").desc_nulls_first(), "name")


def blood_pressure_trend(data: DataFrame, devices: DataFrame, users: DataFrame,
                         condition: str = "Hypertension") -> DataFrame:
    """Daily blood pressure of the users whose conditions mention `condition`."""
    patients = users.where(F.col("medical_conditions").contains(condition))
    return _daily_by_user(data, devices, patients, PRESSURE).orderBy(F.col("date").desc_nulls_first(), "name")


def is_alert() -> Column:
    return (F.col("heart_rate") > 99) | (F.col("blood_pressure_systolic") > 140) | (F.col("spo2") < 95)


def alert_status() -> Column:
    return (F.when(F.col("heart_rate") > 120, "Critical: High Heart Rate")
            .when(F.col("blood_pressure_systolic") > 140, "Warning: High BP")
            .when(F.col("spo2") < 95, "Critical: Low Oxygen")
            .otherwise("Normal"))


def label_alerts(data: DataFrame, devices: DataFrame, users: DataFrame) -> DataFrame:
    """Readings worth an alert, with owner, device type and status (batch or stream)."""
    return join_dimension(data.where(is_alert()), _owned(devices, users, "device_type"), "device_id").select(
        "time", "name", "device_type", "heart_rate", "blood_pressure_systolic", "blood_pressure_diastolic",
        "spo2", alert_status().alias("alert_status"))


def health_alerts(data: DataFrame, devices: DataFrame, users: DataFrame, as_of, span: str = "1 hour") -> DataFrame:
    return label_alerts(trailing(data, "time", as_of, span), devices, users).orderBy(
        F.col("time").desc_nulls_first(), "name", "device_type")


def daily_summary(data: DataFrame, as_of=None, span: str = "14 days") -> DataFrame:
    if as_of is not None:
        data = trailing(data, "time", as_of, span)
    return aggregate(add_bucket(data, "1 day", "time", "day"), ["day", "device_id"], DAILY).orderBy("day", "device_id")


def activity_vs_heart_rate(data: DataFrame, as_of, span: str = "7 days") -> DataFrame:
    """Mean heart rate and oxygen per activity level."""
    measures = [Measure("avg_heart_rate", "avg", "heart_rate"), Measure("avg_spo2", "avg", "spo2"),
                Measure("sample_count", "count")]
    return (aggregate(trailing(data, "time", as_of, span), ["activity_level"], measures)
            .orderBy(F.col("avg_heart_rate").desc_nulls_first()))


def heart_rate_variability(data: DataFrame, as_of=None, span: str = "24 hours") -> DataFrame:
    if as_of is not None:
        data = trailing(data, "time", as_of, span)
    return add_bucket(data, "1 hour", "time", "hour").groupBy("hour", "device_id").agg(
        F.avg("heart_rate").alias("avg_hr"),
        F.stddev("heart_rate").alias("hr_variability"),
        (F.max("heart_rate") - F.min("heart_rate")).alias("hr_range")).orderBy(F.col("hour").desc_nulls_first(), "device_id")


def sleep_and_next_day(data: DataFrame, as_of=None, span: str = "30 days") -> DataFrame:
    """A day's sleep score beside the heart rate of the day after.

    One pass over the readings gives one row per device and day; the following row
    of the device is then looked up, and counts if it is the next calendar day. A
    device has at most one row per day there, however many readings it sent.
    """
    if as_of is not None:
        # a day at or after the bound has all its readings there, so the scan can skip the rest
        data = trailing(data, "time", as_of, span)
    known = F.col("time").isNotNull() & F.col("device_id").isNotNull()
    per_day = aggregate(add_bucket(data.where(known), "1 day", "time", "day"), ["day", "device_id"],
                        [Measure("sleep_score", "avg", "sleep_quality_score"),
                         Measure("rate", "avg", "heart_rate")])
    following = Window.partitionBy("device_id").orderBy("day")
    paired = (per_day.withColumn("_next", F.lead("day").over(following))
              .withColumn("next_day_avg_hr", F.lead("rate").over(following))
              .where(F.col("sleep_score").isNotNull() & (F.col("_next") == shifted("day", "1 day"))))
    if as_of is not None:
        paired = paired.where(F.col("day") >= instant(as_of, time_type(data, "time")) - interval(span))
    return paired.select(F.col("day").alias("sleep_day"), "device_id", "sleep_score", "next_day_avg_hr").orderBy(
        F.col("sleep_day").desc_nulls_first(), "device_id")
