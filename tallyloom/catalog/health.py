"""Queries over wearable readings."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.catalog.registry import AS_OF, query, rounded
from tallyloom.functions.measures import Measure
from tallyloom.functions.times import latest_instant, time_range
from tallyloom.operators import checks, health
from tallyloom.plans.rollup import Rollup
from tallyloom.plans.timetable import TimeTable
from tallyloom.session import scratch_path
from tallyloom.sources import views
from tallyloom.streaming.alerts import start_alerts

HEALTH_SCHEMA = """time timestamp_ntz, device_id int, heart_rate int, blood_pressure_systolic int,
    blood_pressure_diastolic int, spo2 double, body_temperature double, steps_count int,
    sleep_quality_score double, activity_level string"""
ALL_THREE = ("health_data", "users", "wearable_devices")
OWNED = """health_data JOIN (SELECT wearable_devices.id AS device_id, device_type, name, medical_conditions
    FROM users JOIN wearable_devices ON users.id = user_id) AS owned USING (device_id)"""
NEWEST = "(SELECT MAX(time) FROM health_data)"

DAILY_SQL = """SELECT time_bucket(INTERVAL '1 day', time) AS day, device_id,
    ROUND(AVG(heart_rate), 6) AS avg_heart_rate, MIN(heart_rate) AS min_heart_rate, MAX(heart_rate) AS max_heart_rate,
    ROUND(AVG(blood_pressure_systolic), 6) AS avg_bp_systolic,
    ROUND(AVG(blood_pressure_diastolic), 6) AS avg_bp_diastolic, ROUND(AVG(spo2), 6) AS avg_spo2,
    ROUND(AVG(body_temperature), 6) AS avg_temperature, MAX(steps_count) AS total_steps,
    ROUND(AVG(sleep_quality_score), 6) AS avg_sleep_quality, COUNT(*) AS readings_count
FROM health_data {where} GROUP BY 1, 2"""
LAST_14_DAYS = f"WHERE time >= TIMESTAMP '{AS_OF}' - INTERVAL '14 days'"

# The labels.
ALERT_CASE = """CASE WHEN heart_rate > 120 THEN 'Critical: High Heart Rate'
    WHEN blood_pressure_systolic > 140 THEN 'Warning: High BP'
    WHEN spo2 < 95 THEN 'Critical: Low Oxygen' ELSE 'Normal' END AS alert_status"""
ALERT_TEST = "(heart_rate > 99 OR blood_pressure_systolic > 140 OR spo2 < 95)"
ALERT_COLUMNS = """time, name, device_type, heart_rate, blood_pressure_systolic, blood_pressure_diastolic,
    ROUND(spo2, 6) AS spo2"""


def _all_three(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return views.health_data(spark, root), views.wearable_devices(spark, root), views.users(spark, root)


@query("latest_readings", "SELECT * FROM health_data ORDER BY time DESC, device_id LIMIT 10", ("health_data",))
def latest_readings(spark: SparkSession, root: str) -> DataFrame:
    return health.latest_readings(views.health_data(spark, root))


@query("device_owners", """WITH owner AS (SELECT id AS user_id, name, age FROM users)
SELECT name, age, device_type, device_model FROM wearable_devices JOIN owner USING (user_id)""", ("users", "wearable_devices"))
def device_owners(spark: SparkSession, root: str) -> DataFrame:
    return health.owners(views.users(spark, root), views.wearable_devices(spark, root))


def _abnormal_sql(where: str) -> str:
    return f"""SELECT time, device_id, heart_rate, CASE WHEN heart_rate > 99 THEN 'Tachycardia'
    WHEN heart_rate < 60 THEN 'Bradycardia' END AS condition FROM health_data WHERE {where}"""


@query("abnormal_hr", _abnormal_sql(
    f"heart_rate > 99 OR heart_rate < 60 AND time >= TIMESTAMP '{AS_OF}' - INTERVAL '1 day'"), ("health_data",))
def abnormal_hr(spark: SparkSession, root: str) -> DataFrame:
    return health.abnormal_heart_rate(views.health_data(spark, root), AS_OF)


@query("abnormal_hr_strict", _abnormal_sql(
    f"(heart_rate > 99 OR heart_rate < 60) AND time >= TIMESTAMP '{AS_OF}' - INTERVAL '1 day'"), ("health_data",))
def abnormal_hr_strict(spark: SparkSession, root: str) -> DataFrame:
    return health.abnormal_heart_rate(views.health_data(spark, root), AS_OF, strict=True)


@query("hourly_vitals", f"""SELECT time_bucket(INTERVAL '1 hour', time) AS period,
    ROUND(AVG(heart_rate), 6) AS avg_heart_rate, ROUND(AVG(blood_pressure_systolic), 6) AS avg_bp_systolic,
    ROUND(AVG(blood_pressure_diastolic), 6) AS avg_bp_diastolic, ROUND(AVG(spo2), 6) AS avg_spo2,
    ROUND(AVG(body_temperature), 6) AS avg_temp
FROM health_data WHERE time >= TIMESTAMP '{AS_OF}' - INTERVAL '1 day' GROUP BY 1 ORDER BY 1 DESC LIMIT 24""",
       ("health_data",))
def hourly_vitals(spark: SparkSession, root: str) -> DataFrame:
    return rounded(health.hourly_vitals(views.health_data(spark, root), AS_OF))


@query("daily_activity", f"""SELECT time_bucket(INTERVAL '1 day', time) AS date, name, MAX(steps_count) AS total_steps,
    ROUND(AVG(heart_rate), 6) AS avg_heart_rate, ROUND(AVG(sleep_quality_score), 6) AS avg_sleep_quality
FROM {OWNED} WHERE time >= TIMESTAMP '{AS_OF}' - INTERVAL '7 days' GROUP BY 1, 2""", ALL_THREE)
def daily_activity(spark: SparkSession, root: str) -> DataFrame:
    return rounded(health.daily_activity(*_all_three(spark, root), AS_OF))


@query("hypertensive_bp", f"""SELECT time_bucket(INTERVAL '1 day', time) AS date, name,
    ROUND(AVG(blood_pressure_systolic), 6) AS avg_systolic, ROUND(AVG(blood_pressure_diastolic), 6) AS avg_diastolic,
    MAX(blood_pressure_systolic) AS max_systolic, MAX(blood_pressure_diastolic) AS max_diastolic
FROM {OWNED} WHERE medical_conditions LIKE '%Hypertension%' GROUP BY 1, 2""", ALL_THREE)
def hypertensive_bp(spark: SparkSession, root: str) -> DataFrame:
    return rounded(health.blood_pressure_trend(*_all_three(spark, root)))


@query("health_alerts", f"""SELECT {ALERT_COLUMNS}, {ALERT_CASE} FROM {OWNED}
WHERE time >= {NEWEST} - INTERVAL '1 hour' AND {ALERT_TEST}""", ALL_THREE)
def health_alerts(spark: SparkSession, root: str) -> DataFrame:
    data, devices, users = _all_three(spark, root)
    return rounded(health.health_alerts(data, devices, users, latest_instant(data, "time")))


@query("health_alerts_stream", f"SELECT {ALERT_COLUMNS}, {ALERT_CASE} FROM {OWNED} WHERE {ALERT_TEST}", ALL_THREE)
def health_alerts_stream(spark: SparkSession, root: str) -> DataFrame:
    """Alerts over the whole history, raised by the streaming job."""
    events = views.table(spark, root, "events")
    source = spark.readStream.schema(events.schema).parquet(f"{root.rstrip('/')}/events.parque[t]")
    path = scratch_path(spark, "alerts")
    start_alerts(views.as_health_data(source), views.wearable_devices(spark, root), views.users(spark, root),
                 path).awaitTermination()
    return rounded(spark.read.parquet(f"{path}/alerts").withColumn("time", F.col("time").cast("timestamp_ntz")))


@query("daily_health_summary", DAILY_SQL.format(where=LAST_14_DAYS), ("health_data",))
def daily_health_summary(spark: SparkSession, root: str) -> DataFrame:
    return rounded(health.daily_summary(views.health_data(spark, root), AS_OF))


@query("daily_health_summary_all", DAILY_SQL.format(where=""), ("health_data",))
def daily_health_summary_all(spark: SparkSession, root: str) -> DataFrame:
    return rounded(health.daily_summary(views.health_data(spark, root)))


@query("daily_health_summary_compacted", DAILY_SQL.format(where=LAST_14_DAYS), ("health_data",))
def daily_health_summary_compacted(spark: SparkSession, root: str) -> DataFrame:
    table = TimeTable("health_data", scratch_path(spark, "health"), HEALTH_SCHEMA, "time", ("device_id",),
                      ("time DESC",), bloom=("body_temperature", "heart_rate")).load(views.health_data(spark, root))
    table.compact(spark)
    return rounded(health.daily_summary(table.read(spark), AS_OF))


@query("health_from_rollup", f"""SELECT * FROM ({DAILY_SQL.format(where='')})
WHERE day >= TIMESTAMP '{AS_OF}' - INTERVAL '14 days'""", ("health_data",))
def health_from_rollup(spark: SparkSession, root: str) -> DataFrame:
    """A roll-up built early, refreshed once over the 7-to-1-day range, and read live."""
    data = views.health_data(spark, root)
    rollup = Rollup(scratch_path(spark, "daily"), "1 day", ("device_id",), tuple(health.DAILY), bucket="day")
    rollup.create(time_range(data, "time", hi="2024-01-20"))
    as_of = datetime.fromisoformat(AS_OF)
    rollup.refresh(data, as_of, timedelta(days=7), timedelta(days=1))
    return rounded(rollup.read(data, lo=as_of - timedelta(days=14)))


@query("recent_rows", f"SELECT * FROM health_data WHERE time >= {NEWEST} - INTERVAL '5 minutes'", ("health_data",))
def recent_rows(spark: SparkSession, root: str) -> DataFrame:
    data = views.health_data(spark, root)
    return health.recent_rows(data, latest_instant(data, "time"))


@query("activity_vs_hr", f"""SELECT activity_level, ROUND(AVG(heart_rate), 6) AS avg_heart_rate,
    ROUND(AVG(spo2), 6) AS avg_spo2, COUNT(*) AS sample_count
FROM health_data WHERE time >= TIMESTAMP '{AS_OF}' - INTERVAL '7 days' GROUP BY 1""", ("health_data",))
def activity_vs_hr(spark: SparkSession, root: str) -> DataFrame:
    return rounded(health.activity_vs_heart_rate(views.health_data(spark, root), AS_OF))


VARIABILITY_SQL = """SELECT time_bucket(INTERVAL '1 hour', time) AS hour, device_id,
    ROUND(AVG(heart_rate), 6) AS avg_hr, ROUND(STDDEV(heart_rate), 6) AS hr_variability,
    MAX(heart_rate) - MIN(heart_rate) AS hr_range FROM health_data {where} GROUP BY 1, 2"""


@query("hr_variability", VARIABILITY_SQL.format(
    where=f"WHERE time >= TIMESTAMP '{AS_OF}' - INTERVAL '24 hours'"), ("health_data",))
def hr_variability(spark: SparkSession, root: str) -> DataFrame:
    return rounded(health.heart_rate_variability(views.health_data(spark, root), AS_OF))


@query("hr_variability_all", VARIABILITY_SQL.format(where=""), ("health_data",))
def hr_variability_all(spark: SparkSession, root: str) -> DataFrame:
    return rounded(health.heart_rate_variability(views.health_data(spark, root)))


@query("hr_variability_from_rollup", """SELECT time_bucket(INTERVAL '1 day', time) AS day, device_id,
    ROUND(AVG(heart_rate), 6) AS avg_hr, ROUND(STDDEV(heart_rate), 6) AS hr_variability FROM health_data GROUP BY 1, 2""",
       ("health_data",))
def hr_variability_from_rollup(spark: SparkSession, root: str) -> DataFrame:
    """Partials stored by the hour, read for whole days."""
    data = views.health_data(spark, root)
    rollup = Rollup(scratch_path(spark, "hourly"), "1 hour", ("device_id",),
                    (Measure("avg_hr", "avg", "heart_rate"), Measure("hr_variability", "stddev", "heart_rate")), bucket="day")
    rollup.create(data)
    stored = spark.read.parquet(f"{rollup.path}/store").drop("day_day")
    return rounded(rollup.widen(stored, "1 day"))


@query("sleep_next_day_hr", f"""WITH days AS (SELECT time_bucket(INTERVAL '1 day', time) AS day, device_id,
    AVG(sleep_quality_score) AS sleep_score, AVG(heart_rate) AS rate FROM health_data GROUP BY 1, 2)
SELECT s.day AS sleep_day, s.device_id, ROUND(s.sleep_score, 6) AS sleep_score, ROUND(n.rate, 6) AS next_day_avg_hr
FROM days s JOIN days n ON s.device_id = n.device_id AND n.day = s.day + INTERVAL '1 day'
WHERE s.sleep_score IS NOT NULL AND s.day >= TIMESTAMP '{AS_OF}' - INTERVAL '30 days'""", ("health_data",))
def sleep_next_day_hr(spark: SparkSession, root: str) -> DataFrame:
    return rounded(health.sleep_and_next_day(views.health_data(spark, root), AS_OF))


def _count_sql(test: str) -> str:
    return f"SELECT COUNT(*) AS row_count FROM health_data WHERE {test}"


@query("count_point", _count_sql("heart_rate = 80"), ("health_data",))
def count_point(spark: SparkSession, root: str) -> DataFrame:
    return checks.count_where(views.health_data(spark, root), F.col("heart_rate") == 80)


@query("count_between", _count_sql("heart_rate BETWEEN 90 AND 95"), ("health_data",))
def count_between(spark: SparkSession, root: str) -> DataFrame:
    return checks.count_where(views.health_data(spark, root), F.col("heart_rate").between(90, 95))


@query("count_key_range", _count_sql("device_id BETWEEN 10 AND 40"), ("health_data",))
def count_key_range(spark: SparkSession, root: str) -> DataFrame:
    return checks.count_where(views.health_data(spark, root), F.col("device_id").between(10, 40))


@query("count_exclusion", _count_sql("device_id > 100"), ("health_data",))
def count_exclusion(spark: SparkSession, root: str) -> DataFrame:
    return checks.count_where(views.health_data(spark, root), F.col("device_id") > 100)


@query("null_violations", """SELECT time, device_id, 'sleep_quality_score' AS null_column FROM health_data
WHERE sleep_quality_score IS NULL""", ("health_data",))
def null_violations(spark: SparkSession, root: str) -> DataFrame:
    return checks.null_violations(views.health_data(spark, root), ["time", "sleep_quality_score"]).select(
        "time", "device_id", "null_column")
