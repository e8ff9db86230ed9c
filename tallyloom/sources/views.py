"""The library's input shapes, derived from the given Parquet tables.

Each function is a lazy projection (or one join) over whole tables. The same
shapes are written as SQL in `tallyloom.catalog.view_sql`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MONEY = "decimal(18,2)"


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def _prop_k() -> Column:
    """Member k of the properties.

    A document holding nothing but that number is read with a pattern, four times
    faster than parsing it; any other one is parsed.
    """
    only_k = F.nullif(F.regexp_extract("props", r'^\{"k": ?(-?\d+)\}$', 1), F.lit(""))
    return F.coalesce(only_k, F.get_json_object("props", "$.k")).cast("int")


def ticks(spark: SparkSession, root: str) -> DataFrame:
    return as_ticks(table(spark, root, "events"))


def as_ticks(events: DataFrame) -> DataFrame:
    """Ticks from an events table or stream."""
    return events.select(
        F.col("ts").alias("time"), F.col("event_type").alias("symbol"), F.col("value").alias("price"),
        _prop_k().cast(MONEY).alias("day_volume"))


def assets(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "events").select(
        F.col("event_type").alias("symbol"), F.upper("event_type").alias("name")).distinct()


def sensor_data(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "events").select(
        F.col("ts").alias("time"), F.col("user_id").cast("int").alias("sensor_id"),
        F.col("value").alias("temperature"), (_prop_k().cast("double") / 100).alias("cpu"))


def sensors(spark: SparkSession, root: str) -> DataFrame:
    customer, nation = table(spark, root, "customer"), table(spark, root, "nation")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").cast("int").alias("id"), F.col("c_mktsegment").alias("type"),
        F.col("n_name").alias("location"))


def health_data(spark: SparkSession, root: str) -> DataFrame:
    return as_health_data(table(spark, root, "events"))


def as_health_data(events: DataFrame) -> DataFrame:
    """Readings from an events table or stream."""
    def spread(factor: int, size: int) -> Column:
        return (F.col("event_id") * factor) % size

    kind = F.col("event_type")
    return events.select(
        F.col("ts").alias("time"),
        F.col("user_id").cast("int").alias("device_id"),
        (spread(7, 75) + 55).cast("int").alias("heart_rate"),
        (spread(11, 45) + 105).cast("int").alias("blood_pressure_systolic"),
        (spread(13, 30) + 65).cast("int").alias("blood_pressure_diastolic"),
        (spread(17, 80).cast("double") / 10 + 92).alias("spo2"),
        (F.lit(36.1) + spread(19, 12).cast("double") / 10).alias("body_temperature"),
        spread(31, 15000).cast("int").alias("steps_count"),
        F.when(F.col("event_id") % 10 != 0, spread(37, 1001).cast("double") / 10).alias("sleep_quality_score"),
        F.when(kind == "view", "sedentary").when(kind == "click", "light")
        .when(kind == "purchase", "moderate").otherwise("vigorous").alias("activity_level"))


def users(spark: SparkSession, root: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, root, "customer").select(
        key.cast("int").alias("id"), F.col("c_name").alias("name"), (key % 60 + 20).cast("int").alias("age"),
        F.when(key % 2 == 0, "Female").otherwise("Male").alias("gender"),
        F.when(key % 3 == 0, "None").when(key % 3 == 1, "Hypertension").otherwise("Diabetes Type 2")
        .alias("medical_conditions"))


def wearable_devices(spark: SparkSession, root: str) -> DataFrame:
    key = F.col("c_custkey").cast("int")
    return table(spark, root, "customer").select(
        key.alias("id"), key.alias("user_id"), F.col("c_mktsegment").alias("device_type"),
        F.concat(F.col("c_mktsegment"), F.lit(" v"), (F.col("c_custkey") % 9).cast("string")).alias("device_model"))


def _height() -> Column:
    return F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date")).cast("long")


def blocks(spark: SparkSession, root: str) -> DataFrame:
    return (table(spark, root, "orders").groupBy(F.col("o_orderdate").alias("timestamp"))
            .agg(F.sum(F.col("o_totalprice").cast(MONEY)).alias("value"), F.count("*").cast("int").alias("ntx"))
            .select(F.datediff(F.col("timestamp").cast("date"), F.lit("1995-01-01").cast("date")).cast("long")
                    .alias("height"), "timestamp", "value", "ntx"))


def transactions(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "orders").select(
        F.col("o_orderkey").cast("string").alias("txid"), F.col("o_orderdate").alias("timestamp"),
        _height().alias("block_height"), F.col("o_totalprice").cast(MONEY).alias("value"),
        (F.col("o_orderkey") % 50 == 0).alias("coinbase"))


def tx_vinout(spark: SparkSession, root: str) -> DataFrame:
    """Ledger rows; `l_partkey` is kept because (txid, n) repeats in the given data."""
    lineitem, orders = table(spark, root, "lineitem"), table(spark, root, "orders")
    return lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey).select(
        F.col("o_orderdate").alias("timestamp"),
        F.when(F.col("l_returnflag") == "R", "vin").otherwise("vout").alias("type"),
        F.col("l_suppkey").cast("string").alias("address"),
        F.col("l_extendedprice").cast(MONEY).alias("value"),
        F.col("l_orderkey").cast("string").alias("txid"),
        F.col("l_linenumber").alias("n"),
        (F.col("l_orderkey") % 50 == 0).alias("coinbase"),
        _height().alias("block_height"),
        "l_partkey")


def reports(spark: SparkSession, root: str) -> DataFrame:
    documents, embeddings = table(spark, root, "documents"), table(spark, root, "embeddings")
    return documents.join(embeddings, documents.doc_id == embeddings.vec_id).select(
        F.col("doc_id").alias("id"), F.col("text").alias("description"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 90).cast("int")).alias("date"),
        F.concat(F.lit("Station_"), (F.col("doc_id") % 90 + 1).cast("string")).alias("station_code"),
        "embedding")


def stations(spark: SparkSession, root: str) -> DataFrame:
    """Every customer as a station, spread over a square degree or two around the airport."""
    key = F.col("c_custkey")
    return table(spark, root, "customer").select(
        key.alias("id"), F.col("c_name").alias("station_name"),
        F.concat(F.lit("Station_"), (key + 1).cast("string")).alias("station_code"),
        (F.lit(-73.79) + ((key * 7919) % 2000 - 1000).cast("double") / 1000).alias("longitude"),
        (F.lit(40.641) + ((key * 104729) % 2000 - 1000).cast("double") / 1000).alias("latitude"))
