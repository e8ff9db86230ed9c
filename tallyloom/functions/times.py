"""Time buckets, time filters and instants.

Every function works on both `timestamp` and `timestamp_ntz` columns and gives
the same result under any session time zone: buckets and days are counted from
the UTC epoch (or from the wall clock of an NTZ column), and an instant given
without an offset is UTC.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F, types as T

DAY_SUFFIX = "_day"


def day_column(time_col: str) -> str:
    """Name of the partition column derived from `time_col`."""
    return f"{time_col}{DAY_SUFFIX}"


def time_type(df: DataFrame, time_col: str) -> T.DataType:
    dtype = df.schema[time_col].dataType
    if not isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        raise TypeError(f"{time_col} must be a timestamp, found {dtype.simpleString()}")
    return dtype


def instant(value: str | datetime | Column, dtype: T.DataType) -> Column:
    """Constant of the column's own type, so that comparisons reach the scan.

    Comparing an NTZ column with a zoned literal would cast the column instead
    and lose the pushed-down filter.
    """
    if isinstance(value, Column):
        return value.cast(dtype)
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    if value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(value.isoformat(sep=" ") + ("" if isinstance(dtype, T.TimestampNTZType) else "Z")).cast(dtype)


def fetch_instant(df: DataFrame, col: Column, dtype: T.DataType) -> datetime | None:
    """Value of `col` in the first row, in UTC, without an offset."""
    if isinstance(dtype, T.TimestampNTZType):
        return df.select(col.alias("t")).first()["t"]
    micros = df.select(F.unix_micros(col).alias("t")).first()["t"]
    return None if micros is None else datetime(1970, 1, 1) + timedelta(microseconds=micros)


def interval(text: str) -> Column:
    """Interval constant from text such as ``14 days``."""
    return F.expr(f"INTERVAL '{text}'")


def utc_day(col: Column, dtype: T.DataType) -> Column:
    """Calendar day of an instant, independent of the session time zone."""
    if isinstance(dtype, T.TimestampNTZType):
        return col.cast("date")
    return F.date_from_unix_date(F.floor(F.unix_micros(col) / F.lit(86_400_000_000)).cast("int"))


def time_bucket(width: str, col: Column | str, origin_shift: str | None = None) -> Column:
    """Start of the tumbling bucket holding `col`; rows without a time drop out.

    Buckets are aligned to the epoch; `origin_shift` moves the alignment, e.g.
    ``4 days`` makes 7-day buckets start on Mondays. This is the form streaming
    needs (the watermark is kept). Batch code uses `add_bucket`.
    """
    return F.window(col, width, width, origin_shift).getField("start")


def _months(width: str) -> int | None:
    parts = width.lower().split()
    if len(parts) == 2 and parts[1].rstrip("s") in ("month", "year"):
        return int(parts[0]) * (12 if parts[1].startswith("year") else 1)
    return None


def add_bucket(df: DataFrame, width: str, time_col: str, name: str,
               origin_shift: str | None = None) -> DataFrame:
    """Add the bucket start as column `name`; rows without a time keep a null bucket."""
    dtype = time_type(df, time_col)
    months = _months(width)
    if months is not None:
        day = utc_day(F.col(time_col), dtype)
        index = (F.year(day) - 1970) * 12 + F.month(day) - 1
        start = F.add_months(F.lit("1970-01-01").cast("date"), (index - F.pmod(index, F.lit(months))).cast("int"))
        return df.withColumn(name, start.cast("timestamp_ntz").cast(dtype))
    # window() removes rows with a null time, so it never sees one here
    known = F.coalesce(F.col(time_col), instant("1970-01-01 00:00:00", dtype))
    bucket = F.window(known, width, width, origin_shift).getField("start")
    return df.withColumn(name, F.when(F.col(time_col).isNotNull(), bucket))


def time_range(df: DataFrame, time_col: str, lo: str | datetime | Column | None = None,
               hi: str | datetime | Column | None = None) -> DataFrame:
    """Rows with ``lo <= time < hi``.

    If the table is partitioned by the day of `time_col`, the same bounds go on
    the partition column too, so that whole partitions are skipped.
    """
    dtype = time_type(df, time_col)
    day = day_column(time_col)
    if lo is not None:
        start = instant(lo, dtype)
        df = df.where(F.col(time_col) >= start)
        if day in df.columns:
            df = df.where(F.col(day) >= utc_day(start, dtype))
    if hi is not None:
        end = instant(hi, dtype)
        df = df.where(F.col(time_col) < end)
        if day in df.columns:
            df = df.where(F.col(day) <= utc_day(end, dtype))
    return df


def trailing(df: DataFrame, time_col: str, as_of: str | datetime | Column, span: str) -> DataFrame:
    """Rows of the last `span` before `as_of`: ``time >= as_of - span``, open at the top."""
    start = instant(as_of, time_type(df, time_col)) - interval(span)
    return time_range(df, time_col, lo=start)


def latest_instant(df: DataFrame, time_col: str) -> datetime | None:
    """Newest time in the table: one aggregate row, usable as `as_of`."""
    return fetch_instant(df.agg(F.max(time_col).alias("t")), F.col("t"), time_type(df, time_col))


def shifted(col: Column | str, span: str) -> Column:
    """Time plus an interval."""
    return (F.col(col) if isinstance(col, str) else col) + interval(span)
