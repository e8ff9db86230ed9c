"""Regular time grids, and the slots of a grid that have no data."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tallyloom.functions.times import add_bucket, instant, time_type
from tallyloom.operators.checks import assign_ids

PIECE = 65_536  # empty slots that are made from one row
DAY_US = 86_400_000_000


def time_grid(spark: SparkSession, lo: datetime, hi: datetime, step: timedelta, keys: int,
              time_col: str = "time", key_col: str = "key", dtype: T.DataType | None = None) -> DataFrame:
    """Every instant from `lo` to `hi` (both ends included) for each key 1..keys.

    One range split over all tasks; the pair is unpacked from the row number, so
    there is no join and no single task that expands the series.
    """
    points = (hi - lo) // step + 1 if hi >= lo else 0
    width = step // timedelta(microseconds=1)
    dtype = dtype or T.TimestampNTZType()
    return spark.range(points * keys).select(
        _after(instant(lo, dtype), F.floor(F.col("id") / keys).cast("long") * width, dtype).alias(time_col),
        (F.col("id") % keys + 1).alias(key_col))


def _after(start: Column, micros: Column, dtype: T.DataType) -> Column:
    """The instant some microseconds later; a day has 24 hours, whatever the session's zone is."""
    if not isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_micros(F.unix_micros(start) + micros)
    return start + F.make_dt_interval(F.floor(micros / DAY_US).cast("int"), F.lit(0), F.lit(0),
                                      (F.pmod(micros, F.lit(DAY_US)) / F.lit(1_000_000)).cast("decimal(18,6)"))


def _micros(time: Column, dtype: T.DataType) -> Column:
    """Microseconds since the epoch, for both kinds of time, whatever the session's zone is."""
    if not isinstance(dtype, T.TimestampNTZType):
        return F.unix_micros(time)
    clock = F.hour(time).cast("long") * 3600 + F.minute(time) * 60
    return (F.unix_date(time.cast("date")).cast("long") * DAY_US + clock * 1_000_000
            + (F.extract(F.lit("SECOND"), time) * 1_000_000).cast("long"))


def empty_runs(df: DataFrame, time_col: str, key_col: str, step: timedelta) -> DataFrame:
    """The slots of the full grid without a row, packed: key_from, key_to, gap_start, slots.

    The grid goes from the first to the last bucket and over the keys 1 to the largest. A run of
    slots of one key is a row, and so is a run of keys without any row: one key of a billion adds one. The work
    grows with the occupied slots; neither the grid nor the keys are ever made or sorted in one task.
    """
    dtype, width = time_type(df, time_col), step // timedelta(microseconds=1)
    slots = add_bucket(df, f"{int(step.total_seconds())} seconds", time_col, "slot").where("slot is not null")
    first, end, keys = slots.agg(_micros(F.min("slot"), dtype), _micros(F.max("slot"), dtype), F.max(key_col).cast("long")).first()
    if first is None or keys is None:
        return df.sparkSession.createDataFrame([], f"key_from long, key_to long, gap_start {dtype.simpleString()}, slots long")
    lo, last = instant(datetime(1970, 1, 1) + timedelta(microseconds=first), dtype), (end - first) // width + 1
    place = F.floor((_micros(F.col("slot"), dtype) - first) / width).cast("long")
    taken = slots.select(F.col(key_col).cast("long").alias("key"), place.alias("i")).where("key >= 1").distinct()
    own = Window.partitionBy("key").orderBy("i")
    before, after = F.coalesce(F.lag("i").over(own), F.lit(-1)), F.coalesce(F.lead("i").over(own), F.lit(last))
    found = taken.select("key", "i", before.alias("before"), after.alias("after"))
    runs = F.array(F.struct((F.col("before") + 1).alias("first"), (F.col("i") - F.col("before") - 1).alias("slots")),
                   F.struct((F.col("i") + 1).alias("first"), F.when(F.col("after") == last, last - F.col("i") - 1).otherwise(0).alias("slots")))
    found = found.select(F.col("key").alias("key_from"), F.col("key").alias("key_to"), F.inline(runs))
    ranked = assign_ids(taken.select("key").distinct().union(df.sparkSession.range(1)), [F.asc("key")]).select("id", "key")
    following = ranked.select((F.col("id") - 1).alias("id"), F.col("key").alias("next"))
    absent = ranked.join(following, "id").where("next > key + 1").select(
        F.col("key") + 1, F.col("next") - 1, F.lit(0).cast("long"), F.lit(last).cast("long"))
    return found.union(absent).where("slots > 0").select("key_from", "key_to", _after(lo, F.col("first") * width, dtype).alias("gap_start"), "slots")


def empty_slots(df: DataFrame, time_col: str, key_col: str, step: timedelta) -> DataFrame:
    """Slots of the full grid (first to last bucket, keys 1 to the largest) without a row, one row each.

    They are unpacked from `empty_runs` in pieces of equal size, spread over all tasks; the grid itself is neither
    generated nor shuffled.
    """
    width, dtype = step // timedelta(microseconds=1), time_type(df, time_col)
    cells = (F.col("key_to") - F.col("key_from") + 1) * F.col("slots")
    pieces = empty_runs(df, time_col, key_col, step).select("*", cells.alias("cells"), F.explode(
        F.sequence(F.lit(0).cast("long"), cells - 1, F.lit(PIECE).cast("long"))).alias("piece"))
    spread = pieces.repartition(max(df.sparkSession.sparkContext.defaultParallelism, 2), "key_from", "gap_start", "piece")
    each = spread.select("*", F.explode(F.sequence(F.col("piece"), F.least(F.col("piece") + PIECE, F.col("cells")) - 1)).alias("cell"))
    return each.select(_after(F.col("gap_start"), F.col("cell") % F.col("slots") * width, dtype).alias(time_col),
                       (F.col("key_from") + F.floor(F.col("cell") / F.col("slots")).cast("long")).alias(key_col))


def gaps(df: DataFrame, time_col: str, key_col: str, step: timedelta) -> DataFrame:
    """Runs of empty slots of each key that has rows: key, gap_start, gap_end (its last empty slot) and slots.

    Between the first and the last row of the key; the work grows with the occupied
    slots, however sparse the keys are.
    """
    width = f"{int(step.total_seconds())} seconds"
    taken = add_bucket(df, width, time_col, "slot").where(F.col("slot").isNotNull() & F.col(key_col).isNotNull()).select(key_col, "slot").distinct()
    following = F.lead("slot").over(Window.partitionBy(key_col).orderBy("slot"))
    dtype = time_type(df, time_col)
    seconds = _micros(F.col("next"), dtype) - _micros(F.col("slot"), dtype)
    one = F.lit(step // timedelta(microseconds=1)).cast("long")
    found = taken.withColumn("next", following).withColumn("slots", F.floor(seconds / (int(step.total_seconds()) * 1_000_000)).cast("long") - 1)
    return found.where("slots > 0").select(key_col, _after(F.col("slot"), one, dtype).alias("gap_start"), _after(F.col("next"), -one, dtype).alias("gap_end"), "slots")
