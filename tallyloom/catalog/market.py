"""Queries over price ticks."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.catalog.registry import AS_OF, SYMBOL, query
from tallyloom.functions.times import time_range
from tallyloom.operators import market
from tallyloom.plans.rollup import Rollup
from tallyloom.plans.timetable import TimeTable
from tallyloom.session import scratch_path
from tallyloom.sources import views
from tallyloom.sources.readers import read_csv
from tallyloom.streaming.rollup import StreamRollup

TICK_SCHEMA = "time timestamp_ntz, symbol string, price double, day_volume decimal(18,2)"

CANDLES_SQL = """SELECT time_bucket(INTERVAL '1 day', time) AS bucket, symbol,
    arg_min_null(price, time) AS open, MAX(price) AS high, MIN(price) AS low,
    arg_max_null(price, time) AS close, arg_max_null(day_volume, time) AS day_volume
FROM ticks {where} GROUP BY 1, 2"""
ONE_SYMBOL = f"WHERE symbol = '{SYMBOL}' AND time >= TIMESTAMP '{AS_OF}' - INTERVAL '14 days'"


def tick_table(spark: SparkSession, root: str) -> TimeTable:
    """The ticks, written as a time table in the shared scratch folder."""
    spec = TimeTable("ticks", scratch_path(spark, "ticks"), TICK_SCHEMA, "time", ("symbol",), ("time DESC",))
    return spec.load(views.ticks(spark, root))


def candle_rollup(spark: SparkSession) -> Rollup:
    return Rollup(scratch_path(spark, "candles"), "1 day", ("symbol",), tuple(market.CANDLE))


@query("scan_preview", "SELECT * FROM ticks ORDER BY time, symbol, price LIMIT 10", ("ticks",))
def scan_preview(spark: SparkSession, root: str) -> DataFrame:
    return views.ticks(spark, root).orderBy("time", "symbol", "price").limit(10)


@query("ticks_with_asset", """SELECT t.time, t.symbol, t.price, t.day_volume, a.name
FROM ticks t JOIN assets a ON t.symbol = a.symbol ORDER BY t.time DESC, t.symbol, t.price LIMIT 10""",
       ("ticks", "assets"))
def ticks_with_asset(spark: SparkSession, root: str) -> DataFrame:
    return market.ticks_with_asset(views.ticks(spark, root), views.assets(spark, root))


@query("candles_1d", CANDLES_SQL.format(where=ONE_SYMBOL), ("ticks",))
def candles_1d(spark: SparkSession, root: str) -> DataFrame:
    return market.candles(views.ticks(spark, root), "1 day", SYMBOL, AS_OF, "14 days")


@query("candles_1d_all", CANDLES_SQL.format(where=""), ("ticks",))
def candles_1d_all(spark: SparkSession, root: str) -> DataFrame:
    return market.candles(views.ticks(spark, root))


@query("candles_1d_compacted", CANDLES_SQL.format(where=ONE_SYMBOL), ("ticks",))
def candles_1d_compacted(spark: SparkSession, root: str) -> DataFrame:
    """The flagship on compacted chunks."""
    table = tick_table(spark, root)
    table.compact(spark)
    return market.candles(table.read(spark), "1 day", SYMBOL, AS_OF, "14 days")


@query("candles_1d_tiered", CANDLES_SQL.format(where=""), ("ticks",))
def candles_1d_tiered(spark: SparkSession, root: str) -> DataFrame:
    """All candles, read over both tiers after moving chunks older than 7 days."""
    table = tick_table(spark, root)
    table.tier(spark, timedelta(days=7), datetime.fromisoformat(AS_OF))
    return market.candles(table.read(spark))


@query("candles_1d_hot_only", CANDLES_SQL.format(
    where=f"WHERE time >= TIMESTAMP '{AS_OF}' - INTERVAL '7 days'"), ("ticks",))
def candles_1d_hot_only(spark: SparkSession, root: str) -> DataFrame:
    """The same with tiered reads switched off."""
    table = tick_table(spark, root)
    table.tier(spark, timedelta(days=7), datetime.fromisoformat(AS_OF))
    return market.candles(table.read(spark, include_tiered=False))


@query("candles_from_rollup", f"""SELECT * FROM ({CANDLES_SQL.format(where='')})
WHERE symbol = '{SYMBOL}' AND bucket >= TIMESTAMP '{AS_OF}' - INTERVAL '14 days'""", ("ticks",))
def candles_from_rollup(spark: SparkSession, root: str) -> DataFrame:
    """Stored candles of the days up to the 24th, and the newer days from the ticks."""
    ticks = views.ticks(spark, root)
    edge = datetime.fromisoformat(AS_OF) - timedelta(days=7)
    rollup = candle_rollup(spark).create(time_range(ticks, "time", hi=edge))
    return rollup.read(ticks, lo=datetime.fromisoformat(AS_OF) - timedelta(days=14)).where(F.col("symbol") == SYMBOL)


@query("candles_refreshed_rollup", CANDLES_SQL.format(
    where=f"WHERE time < TIMESTAMP '{AS_OF}' - INTERVAL '1 day'"), ("ticks",))
def candles_refreshed_rollup(spark: SparkSession, root: str) -> DataFrame:
    """A roll-up built early, brought forward by one refresh, and read without live rows."""
    ticks = views.ticks(spark, root)
    rollup = candle_rollup(spark).create(time_range(ticks, "time", hi="2024-01-20"))
    rollup.refresh(ticks, datetime.fromisoformat(AS_OF), timedelta(days=3), timedelta(days=1))
    return rollup.read(materialized_only=True)


@query("candles_from_stream", CANDLES_SQL.format(where=""), ("ticks",))
def candles_from_stream(spark: SparkSession, root: str) -> DataFrame:
    """All candles, kept by a streaming job over the same files."""
    events = views.table(spark, root, "events")
    source = spark.readStream.schema(events.schema).parquet(f"{root.rstrip('/')}/events.parque[t]")
    rollup = StreamRollup(scratch_path(spark, "stream"), "1 day", ("symbol",), tuple(market.CANDLE))
    rollup.start(views.as_ticks(source)).awaitTermination()
    return rollup.read(spark).withColumn("bucket", F.col("bucket").cast("timestamp_ntz"))


@query("candles_from_csv", CANDLES_SQL.format(where=""), ("ticks",))
def candles_from_csv(spark: SparkSession, root: str) -> DataFrame:
    """The ticks written as gzip CSV with a header, loaded into the declared schema."""
    path = scratch_path(spark, "csv")
    text = views.ticks(spark, root).withColumn("time", F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    text.write.option("header", True).option("compression", "gzip").csv(path)
    return market.candles(read_csv(spark, path, TICK_SCHEMA, partitions=8))


@query("order_tags", """SELECT o_orderkey, 3 AS n_tags, o_orderstatus AS first_tag, o_orderpriority || ', or so' AS second_tag,
    CAST(NULL AS VARCHAR) AS third_tag FROM orders""")
def order_tags(spark: SparkSession, root: str) -> DataFrame:
    """An array column loaded from CSV literals with quoted items and nulls."""
    path = scratch_path(spark, "csv")
    tags = F.concat(F.lit("{"), "o_orderstatus", F.lit(',"'), "o_orderpriority", F.lit(', or so",NULL}'))
    views.table(spark, root, "orders").select("o_orderkey", tags.alias("tags")).write.option("header", True).option("escape", '"').csv(path)
    got = read_csv(spark, path, "o_orderkey long, tags array<string>")
    return got.select("o_orderkey", F.size("tags").alias("n_tags"), *[F.get("tags", F.lit(i)).alias(f"{name}_tag")
                                                                        for i, name in enumerate(("first", "second", "third"))])


@query("candles_live_after_insert", CANDLES_SQL.format(where=""), ("ticks",))
def candles_live_after_insert(spark: SparkSession, root: str) -> DataFrame:
    """A roll-up over a table, rows inserted afterwards, and a read that shows them at once."""
    ticks = views.ticks(spark, root)
    edge = datetime.fromisoformat(AS_OF) - timedelta(days=5)
    table = TimeTable("ticks", scratch_path(spark, "ticks"), TICK_SCHEMA, "time", ("symbol",), ("time DESC",)).load(
        time_range(ticks, "time", hi=edge))
    rollup = candle_rollup(spark).create(table.read(spark))
    table.append(time_range(ticks, "time", lo=edge))
    return rollup.read(table.read(spark))


@query("candles_other_layout", CANDLES_SQL.format(where=""), ("ticks",))
def candles_other_layout(spark: SparkSession, root: str) -> DataFrame:
    """A compacted table whose layout is changed, expanded and compacted anew."""
    table = tick_table(spark, root)
    table.compact(spark)
    table.expand(spark)
    other = table.with_layout(("day_volume",), ("price ASC",))
    other.compact(spark)
    return market.candles(other.read(spark))


@query("bucket_counts", """SELECT time_bucket(INTERVAL '30 minutes', time) AS half_hour,
    time_bucket(INTERVAL '1 hour', time) AS hour, time_bucket(INTERVAL '1 day', time) AS day, COUNT(*) AS row_count
FROM ticks GROUP BY 1, 2, 3""", ("ticks",))
def bucket_counts(spark: SparkSession, root: str) -> DataFrame:
    """Several bucket widths in one pass."""
    return market.bucket_counts(views.ticks(spark, root), {"half_hour": "30 minutes", "hour": "1 hour", "day": "1 day"})


@query("chunk_list", """SELECT 'ticks_' || strftime(day, '%Y%m%d') AS chunk_name, CAST(day AS TIMESTAMP) AS range_start,
    CAST(day + 1 AS TIMESTAMP) AS range_end, day < DATE '2024-01-30' AS is_compressed
FROM (SELECT DISTINCT CAST(time AS DATE) AS day FROM ticks)""", ("ticks",))
def chunk_list(spark: SparkSession, root: str) -> DataFrame:
    """Chunks after the policy that compacts what is older than one day."""
    table = tick_table(spark, root)
    table.compact_older_than(spark, timedelta(days=1), datetime.fromisoformat(AS_OF))
    return table.chunks(spark).drop("tier")


@query("tiered_chunks", """SELECT 'ticks_' || strftime(day, '%Y%m%d') AS chunk_name, CAST(day AS TIMESTAMP) AS range_start,
    CAST(day + 1 AS TIMESTAMP) AS range_end, TRUE AS is_compressed
FROM (SELECT DISTINCT CAST(time AS DATE) AS day FROM ticks) WHERE day + 1 <= DATE '2024-01-24'""", ("ticks",))
def tiered_chunks(spark: SparkSession, root: str) -> DataFrame:
    table = tick_table(spark, root)
    table.tier(spark, timedelta(days=7), datetime.fromisoformat(AS_OF))
    return table.tiered_chunks(spark)


@query("queued_for_tiering", """SELECT 'ticks_' || strftime(day, '%Y%m%d') AS chunk_name,
    CAST(day AS TIMESTAMP) AS range_start, CAST(day + 1 AS TIMESTAMP) AS range_end, FALSE AS is_compressed
FROM (SELECT DISTINCT CAST(time AS DATE) AS day FROM ticks) WHERE day + 1 <= DATE '2024-01-24'""", ("ticks",))
def queued_for_tiering(spark: SparkSession, root: str) -> DataFrame:
    return tick_table(spark, root).queued_for_tiering(spark, timedelta(days=7), datetime.fromisoformat(AS_OF))


@query("retained_rows", """SELECT CAST(time AS DATE) AS day, COUNT(*) AS row_count FROM ticks
WHERE time >= TIMESTAMP '2024-01-10' GROUP BY 1""", ("ticks",))
def retained_rows(spark: SparkSession, root: str) -> DataFrame:
    """Rows per day after the 21-day retention policy ran."""
    table = tick_table(spark, root)
    table.add_policy(spark, "retain", timedelta(days=21))
    table.apply_policies(spark, datetime.fromisoformat(AS_OF))
    return table.read(spark).groupBy(F.col("time_day").alias("day")).agg(F.count("*").alias("row_count"))


@query("expanded_rows", "SELECT * FROM ticks", ("ticks",))
def expanded_rows(spark: SparkSession, root: str) -> DataFrame:
    """Every row again, after compaction was undone."""
    table = tick_table(spark, root)
    table.compact(spark)
    table.expand(spark)
    return table.read(spark).drop("time_day")


@query("compaction_stats")
def compaction_stats(spark: SparkSession, root: str) -> DataFrame:
    table = tick_table(spark, root)
    table.compact(spark)
    return table.compaction_stats(spark)
