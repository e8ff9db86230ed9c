"""Health alerts raised as readings arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tallyloom.operators.health import label_alerts
from tallyloom.streaming.rollup import with_event_time


def alert_stream(readings: DataFrame, devices: DataFrame, users: DataFrame) -> DataFrame:
    """Stream of labelled alerts; devices and users are read again for each micro-batch."""
    return label_alerts(with_event_time(readings, "time"), devices, users)


def start_alerts(readings: DataFrame, devices: DataFrame, users: DataFrame, path: str,
                 available_now: bool = True, every: str = "10 seconds") -> StreamingQuery:
    """Append alerts to a Parquet folder, each reading exactly once."""
    writer = (alert_stream(readings, devices, users).writeStream.outputMode("append").format("parquet")
              .option("checkpointLocation", f"{path}/checkpoint").option("path", f"{path}/alerts"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    return writer.start()
