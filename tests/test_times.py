from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tallyloom.functions.times import add_bucket, latest_instant, shifted, time_range, trailing
from tallyloom.sources import grid as grid_module
from tallyloom.sources.grid import empty_runs, empty_slots, time_grid


def frame(spark, *texts, kind="timestamp_ntz"):
    return spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t").cast(kind).alias("time"))


def starts(df, width, shift=None):
    return [r.b for r in add_bucket(df, width, "time", "b", shift).select(F.col("b").cast("string").alias("b")).collect()]


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_buckets_are_aligned_to_the_epoch(spark, kind):
    df = frame(spark, "2024-01-03 10:29:59.999999", "2024-01-03 10:30:00", "1969-12-31 23:59:59", None, kind=kind)
    assert starts(df, "30 minutes") == ["2024-01-03 10:00:00", "2024-01-03 10:30:00", "1969-12-31 23:30:00", None]
    assert starts(df, "1 day") == ["2024-01-03 00:00:00", "2024-01-03 00:00:00", "1969-12-31 00:00:00", None]
    assert starts(df, "7 days")[0] == "2023-12-28 00:00:00"
    assert starts(df, "7 days", "4 days")[0] == "2024-01-01 00:00:00"
    assert starts(df, "1 month") == ["2024-01-01 00:00:00", "2024-01-01 00:00:00", "1969-12-01 00:00:00", None]
    assert starts(df, "1 year")[2] == "1969-01-01 00:00:00"


def test_buckets_ignore_the_session_zone(spark):
    df = frame(spark, "2024-01-03 10:31:00").withColumn("time", F.col("time"))
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        assert starts(df, "1 day") == ["2024-01-03 00:00:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_trailing_includes_its_lower_edge(spark):
    df = frame(spark, "2024-01-01 00:00:00", "2023-12-31 23:59:59.999999", "2024-01-15 00:00:00", "2030-01-01 00:00:00", None)
    assert trailing(df, "time", "2024-01-15 00:00:00", "14 days").count() == 3
    assert time_range(df, "time", "2024-01-01", "2024-01-15").count() == 1


def test_latest_and_shift(spark):
    df = frame(spark, "2024-02-28 05:00:00", None)
    assert latest_instant(df, "time") == datetime(2024, 2, 28, 5)
    assert df.where("time is not null").select(shifted("time", "1 day")).first()[0] == datetime(2024, 2, 29, 5)
    assert latest_instant(df.limit(0), "time") is None


def test_grid_includes_both_ends(spark):
    grid = time_grid(spark, datetime(2024, 1, 1), datetime(2024, 1, 31), timedelta(seconds=5), 4)
    edge = grid.agg(F.count("*").alias("n"), F.min("time").alias("lo"), F.max("time").alias("hi"),
                    F.countDistinct("key").alias("k"), F.countDistinct("time").alias("t")).first()
    assert tuple(edge) == (2_073_604, datetime(2024, 1, 1), datetime(2024, 1, 31), 4, 518_401)
    assert time_grid(spark, datetime(2024, 1, 2), datetime(2024, 1, 1), timedelta(1), 3).count() == 0
    fine = time_grid(spark, datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 1), timedelta(milliseconds=250), 1)
    assert [r.time.microsecond for r in fine.orderBy("time").collect()] == [0, 250000, 500000, 750000, 0]


def test_empty_slots(spark):
    df = frame(spark, "2024-01-01 00:10:00", "2024-01-01 02:50:00").withColumn("key", F.lit(2))
    got = {(r.time.hour, r.key) for r in empty_slots(df, "time", "key", timedelta(hours=1)).collect()}
    assert got == {(0, 1), (1, 1), (2, 1), (1, 2)}
    assert empty_slots(df.limit(0), "time", "key", timedelta(hours=1)).count() == 0


def test_a_key_of_a_billion_costs_one_row(spark):
    df = frame(spark, "2024-01-01 00:10:00", "2024-01-01 02:50:00").withColumn("key", F.lit(2))
    df = df.union(frame(spark, "2024-01-01 01:00:00").withColumn("key", F.lit(1_000_000_000)))
    df = df.union(frame(spark, None).withColumn("key", F.lit(5))).union(frame(spark, "2024-01-01 01:00:00").withColumn("key", F.lit(None).cast("int")))
    got = sorted((r.key_from, r.key_to, r.gap_start.hour, r.slots) for r in empty_runs(df, "time", "key", timedelta(hours=1)).collect())
    assert got == [(1, 1, 0, 3), (2, 2, 1, 1), (3, 999_999_999, 0, 3), (1_000_000_000, 1_000_000_000, 0, 1), (1_000_000_000, 1_000_000_000, 2, 1)]
    assert empty_runs(df.limit(0), "time", "key", timedelta(hours=1)).count() == 0


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_empty_slots_are_the_grid_without_the_taken_ones(spark, monkeypatch, kind):
    monkeypatch.setattr(grid_module, "PIECE", 7)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # clocks change on 10 March
        at = F.lit(1_710_028_800) + F.col("id") * 37 % 101 * 3600 + 1200
        time = F.timestamp_seconds(at) if kind == "timestamp" else F.lit("1970-01-01").cast(kind) + F.make_dt_interval(secs=at)
        rows = spark.range(60).select(time.alias("time"), (F.col("id") % 5 * 2 + 1).alias("key"))
        hours = F.unix_seconds("time") if kind == "timestamp" else F.unix_date(F.col("time").cast("date")) * 86400 + F.hour("time") * 3600
        found = [(r.s // 3600, r.key) for r in empty_slots(rows, "time", "key", timedelta(hours=1)).select(hours.alias("s"), "key").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    first = int(datetime(2024, 3, 10, tzinfo=timezone.utc).timestamp()) // 3600
    taken = {(first + i * 37 % 101, i % 5 * 2 + 1) for i in range(60)}
    lo, hi = min(h for h, _ in taken), max(h for h, _ in taken)
    want = {(h, k) for h in range(lo, hi + 1) for k in range(1, 10)} - taken
    assert len(found) == len(want) and set(found) == want
