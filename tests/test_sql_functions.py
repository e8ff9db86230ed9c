from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tallyloom.functions.sql import register
from tallyloom.operators import market
from tallyloom.sources import views
from tests.conftest import DATA


def test_sql_functions(spark):
    assert "time_bucket" in register(spark)
    row = spark.sql("""SELECT cast(time_bucket(INTERVAL '30' MINUTE, TIMESTAMP '2024-01-03 10:59:59.9') AS string) AS a,
        cast(time_bucket(INTERVAL '1' DAY, TIMESTAMP '1969-12-31 10:00:00') AS string) AS b,
        cosine_distance(array(1D, 2D), array(2D, 1D)) AS c, cosine_distance(array(0D), array(1D)) AS d,
        cosine_distance(array(0D), array(1D, 2D)) AS e, sphere_metres(0, 0, 1, 0) AS f, rounded_int(2.5D) AS g,
        segment_key('abcd', 2) AS h""").first()
    assert (row.a, row.b, row.g, row.h) == ("2024-01-03 10:30:00", "1969-12-31 00:00:00", 2, "cd")
    assert row.c == pytest.approx(0.2) and math.isnan(row.d) and row.e is None
    assert row.f == pytest.approx(111195.08, abs=0.1)


def test_candles_in_sql(spark, rows):
    register(spark)
    views.ticks(spark, DATA).createOrReplaceTempView("ticks")
    got = spark.sql("""SELECT time_bucket(INTERVAL '1' DAY, time) AS bucket, symbol, min_by(price, time) AS open,
        max(price) AS high, min(price) AS low, max_by(price, time) AS close, max_by(day_volume, time) AS day_volume
        FROM ticks GROUP BY ALL""")
    want = market.candles(views.ticks(spark, DATA))
    assert rows(got.withColumn("bucket", F.col("bucket").cast("timestamp_ntz"))) == rows(want)
