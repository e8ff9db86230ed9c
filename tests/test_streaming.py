from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tallyloom.functions.measures import Measure, aggregate
from tallyloom.functions.times import add_bucket
from tallyloom.operators import health, market
from tallyloom.streaming.alerts import start_alerts
from tallyloom.streaming.rollup import StreamRollup
from tests.test_health import T0, readings
from tests.test_rollup import ticks


def test_stream_equals_batch_over_several_files_and_restarts(spark, tmp_path, rows):
    data, inbox = ticks(spark, 6), str(tmp_path / "in")
    rollup = StreamRollup(str(tmp_path / "out"), "1 day", ("symbol",), tuple(market.CANDLE))
    for half in range(3):
        part = data.where(F.floor((F.dayofmonth("time") - 1) / 2) == half)
        part.coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(data.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
        rollup.start(stream).awaitTermination()
        if half != 1:
            rollup.consolidate(spark)
    assert not list((tmp_path / "out" / "changes").glob("batch=*")) and len(list((tmp_path / "out" / "base").iterdir())) == 1
    got = rollup.read(spark).withColumn("bucket", F.col("bucket").cast("timestamp_ntz"))
    assert rows(got) == rows(market.candles(data))


def test_a_bucket_fed_twice_keeps_its_newest_state(spark, tmp_path):
    data, inbox = ticks(spark, 1), str(tmp_path / "in")
    rollup = StreamRollup(str(tmp_path / "out"), "1 day", ("symbol",), tuple(market.CANDLE))
    for part in (data.where("hour(time) < 12"), data.where("hour(time) >= 12")):
        part.coalesce(1).write.mode("append").parquet(inbox)
        rollup.start(spark.readStream.schema(data.schema).parquet(inbox)).awaitTermination()
    assert spark.read.parquet(f"{rollup.path}/changes").count() == 4
    assert rollup.read(spark).count() == 2


def test_rows_that_come_sixty_days_late_count(spark, tmp_path, rows):
    """Late rows in old buckets and in buckets of their own, before and after the changes are folded; a null time drops out."""
    data, inbox = ticks(spark, 6), str(tmp_path / "in")
    newer = data.withColumn("time", F.col("time") + F.expr("interval 60 days"))
    late = newer.where("hour(time) = 3").withColumn("price", F.col("price") + 1).unionByName(data)
    late = late.unionByName(data.limit(1).withColumn("time", F.lit(None).cast(data.schema["time"].dataType)))
    measures = (*market.CANDLE, Measure("mean_price", "avg", "price"), Measure("spread", "stddev", "price"), Measure("n", "count"))
    rollup = StreamRollup(str(tmp_path / "out"), "1 day", ("symbol",), measures)
    for part in (newer.where("hour(time) <> 3"), late):
        part.coalesce(1).write.mode("append").parquet(inbox)
        rollup.start(spark.readStream.schema(data.schema).parquet(inbox)).awaitTermination()
        if part is not late:
            rollup.consolidate(spark)

    def plain(df):
        return rows(df.select("bucket", "symbol", *[F.round(m.name, 6) if m.kind in ("avg", "stddev") else m.name for m in measures]))

    whole = spark.read.schema(data.schema).parquet(inbox).where("time is not null")
    want = plain(aggregate(add_bucket(whole, "1 day", "time", "bucket"), ["bucket", "symbol"], list(measures)))
    for _ in range(2):
        assert plain(rollup.read(spark).withColumn("bucket", F.col("bucket").cast("timestamp_ntz"))) == want
        rollup.consolidate(spark)


def test_alert_stream_equals_batch(spark, tmp_path, rows):
    data = readings(spark, (0, 1, 130, 150, 90.0, None), (1, 2, 80, 120, 99.0, None), (2, 2, 80, 150, 99.0, None),
                    (3, 99, 130, 150, 90.0, None))
    devices = spark.createDataFrame([(1, 7, "ring"), (2, 7, "patch")], "id int, user_id int, device_type string")
    users = spark.createDataFrame([(7, "u7")], "id int, name string")
    inbox = str(tmp_path / "in")
    for minutes in (0, 2):
        lo = F.lit(str(T0 + timedelta(minutes=minutes))).cast("timestamp_ntz")
        hi = F.lit(str(T0 + timedelta(minutes=minutes + 2))).cast("timestamp_ntz")
        data.where((F.col("time") >= lo) & (F.col("time") < hi)).write.mode("append").parquet(inbox)
        start_alerts(spark.readStream.schema(data.schema).parquet(inbox), devices, users, str(tmp_path / "out")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out" / "alerts")).withColumn("time", F.col("time").cast("timestamp_ntz"))
    assert rows(got) == rows(health.label_alerts(data, devices, users)) and got.count() == 2
    assert datetime(2024, 1, 1) == T0
