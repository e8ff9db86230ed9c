"""Sensor readings rolled up by time, by sensor and by location."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyloom.functions.measures import Measure, aggregate
from tallyloom.functions.times import add_bucket, trailing
from tallyloom.operators.dimensions import aggregate_by_attribute

AVERAGES = [Measure("avg_temp", "avg", "temperature"), Measure("avg_cpu", "avg", "cpu")]
SUMMARY = [Measure("avg_temp", "avg", "temperature"), Measure("last_temp", "last", "temperature", "time"),
           Measure("avg_cpu", "avg", "cpu")]


def averages(data: DataFrame, width: str = "30 minutes") -> DataFrame:
    return aggregate(add_bucket(data, width, "time", "period"), ["period"], AVERAGES).orderBy("period")


def summary(data: DataFrame, width: str = "30 minutes") -> DataFrame:
    return aggregate(add_bucket(data, width, "time", "period"), ["period"], SUMMARY).orderBy("period")


def summary_per_sensor(data: DataFrame, width: str = "1 day") -> DataFrame:
    return aggregate(add_bucket(data, width, "time", "period"), ["period", "sensor_id"], SUMMARY).orderBy("period", "sensor_id")


def summary_of_sensor(data: DataFrame, sensor_id: int, as_of, span: str, width: str) -> DataFrame:
    """One sensor's trailing window; grouped by the sensor but without showing it."""
    data = trailing(data.where(F.col("sensor_id") == int(sensor_id)), "time", as_of, span)
    return summary_per_sensor(data, width).drop("sensor_id")


def summary_by_location(data: DataFrame, sensors: DataFrame, width: str = "30 minutes") -> DataFrame:
    """Summary per location of the sensors."""
    located = sensors.select(F.col("id").alias("sensor_id"), "location")
    return aggregate_by_attribute(add_bucket(data, width, "time", "period"), located, "sensor_id",
                                  ["period"], ["location"], SUMMARY).orderBy("period", "location")
