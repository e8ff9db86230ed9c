"""Queries over sensor readings."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.catalog.registry import AS_OF, SENSOR, query, rounded
from tallyloom.functions.measures import Measure
from tallyloom.functions.times import add_bucket, time_range
from tallyloom.operators import checks, sensors
from tallyloom.operators.dimensions import aggregate_by_attribute
from tallyloom.plans.rollup import Rollup
from tallyloom.plans.timetable import TimeTable
from tallyloom.session import scratch_path
from tallyloom.sources import grid, views

SENSOR_SCHEMA = "time timestamp_ntz, sensor_id int, temperature double, cpu double"

MEASURES = """ROUND(AVG(temperature), 6) AS avg_temp, ROUND(arg_max_null(temperature, time), 6) AS last_temp,
    ROUND(AVG(cpu), 6) AS avg_cpu"""


def summary_sql(width: str, where: str = "", keys: str = "") -> str:
    return f"""SELECT time_bucket(INTERVAL '{width}', time) AS period{keys and ', ' + keys}, {MEASURES}
FROM sensor_data {where} GROUP BY 1{keys and ', ' + keys}"""


def one_sensor(span: str) -> str:
    return f"WHERE sensor_id = {SENSOR} AND time >= TIMESTAMP '{AS_OF}' - INTERVAL '{span}'"


@query("sensor_30m", """SELECT time_bucket(INTERVAL '30 minutes', time) AS period,
    ROUND(AVG(temperature), 6) AS avg_temp, ROUND(AVG(cpu), 6) AS avg_cpu FROM sensor_data GROUP BY 1""",
       ("sensor_data",))
def sensor_30m(spark: SparkSession, root: str) -> DataFrame:
    return rounded(sensors.averages(views.sensor_data(spark, root)))


@query("sensor_30m_last", summary_sql("30 minutes"), ("sensor_data",))
def sensor_30m_last(spark: SparkSession, root: str) -> DataFrame:
    return rounded(sensors.summary(views.sensor_data(spark, root)))


@query("sensor_by_location", f"""SELECT location, time_bucket(INTERVAL '30 minutes', time) AS period, {MEASURES}
FROM sensor_data JOIN sensors ON sensor_id = id GROUP BY 1, 2""", ("sensor_data", "sensors"))
def sensor_by_location(spark: SparkSession, root: str) -> DataFrame:
    return rounded(sensors.summary_by_location(views.sensor_data(spark, root), views.sensors(spark, root)))


@query("stddev_by_location", """SELECT location, time_bucket(INTERVAL '1 day', time) AS period,
    ROUND(STDDEV(temperature + 1000000), 6) AS spread, ROUND(AVG(cpu), 6) AS avg_cpu, COUNT(*) AS row_count
FROM sensor_data JOIN sensors ON sensor_id = id GROUP BY 1, 2""", ("sensor_data", "sensors"))
def stddev_by_location(spark: SparkSession, root: str) -> DataFrame:
    """Spread of values far from zero, merged from one partial row per sensor and day."""
    data = views.sensor_data(spark, root).withColumn("shifted", F.col("temperature") + 1000000)
    located = views.sensors(spark, root).select(F.col("id").alias("sensor_id"), "location")
    measures = [Measure("spread", "stddev", "shifted"), Measure("avg_cpu", "avg", "cpu"), Measure("row_count", "count")]
    return rounded(aggregate_by_attribute(add_bucket(data, "1 day", "time", "period"), located, "sensor_id",
                                          ["period"], ["location"], measures))


@query("sensor_30m_one", summary_sql("30 minutes", one_sensor("14 days")), ("sensor_data",))
def sensor_30m_one(spark: SparkSession, root: str) -> DataFrame:
    return rounded(sensors.summary_of_sensor(views.sensor_data(spark, root), SENSOR, AS_OF, "14 days", "30 minutes"))


@query("sensor_1d_one", summary_sql("1 day", one_sensor("30 days")), ("sensor_data",))
def sensor_1d_one(spark: SparkSession, root: str) -> DataFrame:
    return rounded(sensors.summary_of_sensor(views.sensor_data(spark, root), SENSOR, AS_OF, "30 days", "1 day"))


@query("sensor_1d_one_compacted", summary_sql("1 day", one_sensor("30 days")), ("sensor_data",))
def sensor_1d_one_compacted(spark: SparkSession, root: str) -> DataFrame:
    table = TimeTable("sensor_data", scratch_path(spark, "sensors"), SENSOR_SCHEMA, "time", ("sensor_id",),
                      ("time DESC",)).load(views.sensor_data(spark, root))
    table.compact(spark)
    return rounded(sensors.summary_of_sensor(table.read(spark), SENSOR, AS_OF, "30 days", "1 day"))


@query("sensor_1d_summary", summary_sql("1 day", keys="sensor_id"), ("sensor_data",))
def sensor_1d_summary(spark: SparkSession, root: str) -> DataFrame:
    return rounded(sensors.summary_per_sensor(views.sensor_data(spark, root)))


@query("sensor_from_rollup", f"""SELECT * FROM ({summary_sql('1 day', keys='sensor_id')})
WHERE sensor_id = {SENSOR} AND period >= TIMESTAMP '{AS_OF}' - INTERVAL '14 days'""", ("sensor_data",))
def sensor_from_rollup(spark: SparkSession, root: str) -> DataFrame:
    data = views.sensor_data(spark, root)
    rollup = Rollup(scratch_path(spark, "summary"), "1 day", ("sensor_id",), tuple(sensors.SUMMARY),
                    bucket="period").create(time_range(data, "time", hi="2024-01-24"))
    recent = rollup.read(data, lo=datetime.fromisoformat(AS_OF) - timedelta(days=14))
    return rounded(recent.where(F.col("sensor_id") == SENSOR))


@query("sensor_rows_sorted", "SELECT * FROM sensor_data ORDER BY time", ("sensor_data",))
def sensor_rows_sorted(spark: SparkSession, root: str) -> DataFrame:
    return views.sensor_data(spark, root).orderBy(F.col("time").asc_nulls_last())


@query("sensor_gaps", """WITH slots AS (SELECT DISTINCT sensor_id, time_bucket(INTERVAL '1 hour', time) AS slot FROM sensor_data),
paired AS (SELECT *, lead(slot) OVER (PARTITION BY sensor_id ORDER BY slot) AS next FROM slots)
SELECT sensor_id, slot + INTERVAL '1 hour' AS gap_start, next - INTERVAL '1 hour' AS gap_end, date_diff('hour', slot, next) - 1 AS slots
FROM paired WHERE next > slot + INTERVAL '1 hour'""", ("sensor_data",))
def sensor_gaps(spark: SparkSession, root: str) -> DataFrame:
    """Hours without a reading, as one row per run of them."""
    return grid.gaps(views.sensor_data(spark, root), "time", "sensor_id", timedelta(hours=1))


@query("time_grid", """WITH slots AS (SELECT DISTINCT time_bucket(INTERVAL '1 hour', time) AS time,
        CAST(sensor_id AS BIGINT) AS sensor_id FROM sensor_data),
    edges AS (SELECT MIN(time) AS lo, MAX(time) AS hi, MAX(sensor_id) AS keys FROM slots),
    hours AS (SELECT unnest(generate_series(lo, hi, INTERVAL '1 hour')) AS time FROM edges),
    ids AS (SELECT unnest(generate_series(1, keys)) AS sensor_id FROM edges)
SELECT time, sensor_id FROM hours, ids EXCEPT SELECT time, sensor_id FROM slots""", ("sensor_data",))
def time_grid(spark: SparkSession, root: str) -> DataFrame:
    """Hours in which a sensor sent nothing: the full grid without the occupied slots."""
    return grid.empty_slots(views.sensor_data(spark, root), "time", "sensor_id", timedelta(hours=1))


@query("sensor_orphans", """SELECT time, sensor_id, temperature, cpu FROM sensor_data
WHERE sensor_id IS NOT NULL AND sensor_id NOT IN (SELECT id FROM sensors WHERE type <> 'MACHINERY')""",
       ("sensor_data", "sensors"))
def sensor_orphans(spark: SparkSession, root: str) -> DataFrame:
    """Readings whose sensor is missing from a sensor list without one type."""
    listed = views.sensors(spark, root).where(F.col("type") != "MACHINERY")
    return checks.orphan_rows(views.sensor_data(spark, root), "sensor_id", listed, "id").select(
        "time", "sensor_id", "temperature", "cpu")
