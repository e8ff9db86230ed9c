"""Price ticks: joins to the asset table and candles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyloom.functions.measures import Measure, aggregate
from tallyloom.functions.times import add_bucket, trailing

CANDLE = [
    Measure("open", "first", "price", "time"),
    Measure("high", "max", "price"),
    Measure("low", "min", "price"),
    Measure("close", "last", "price", "time"),
    Measure("day_volume", "last", "day_volume", "time"),
]


def ticks_with_asset(ticks: DataFrame, assets: DataFrame, k: int = 10) -> DataFrame:
    """Newest `k` ticks with the name of their asset.

    The join carries no hint; the k newest rows are kept by each task and merged, so
    nothing is sorted as a whole and a hot symbol is no burden.
    """
    return (ticks.join(assets, "symbol").select("time", "symbol", "price", "day_volume", "name")
            .orderBy(F.col("time").desc_nulls_first(), "symbol", "price").limit(k))


def candles(ticks: DataFrame, width: str = "1 day", symbol: str | None = None,
            as_of=None, span: str | None = None) -> DataFrame:
    """Open, high, low, close and last volume per bucket and symbol.

    With `symbol` and `as_of`/`span`, only that symbol's trailing window is read.
    Ordered by bucket.
    """
    if symbol is not None:
        ticks = ticks.where(F.col("symbol") == symbol)
    if as_of is not None:
        ticks = trailing(ticks, "time", as_of, span or "14 days")
    return aggregate(add_bucket(ticks, width, "time", "bucket"), ["bucket", "symbol"], CANDLE).orderBy("bucket", "symbol")


def bucket_counts(ticks: DataFrame, widths: dict[str, str]) -> DataFrame:
    """Rows per combination of several bucket widths, counted in one pass."""
    for name, width in widths.items():
        ticks = add_bucket(ticks, width, "time", name)
    return ticks.groupBy(*widths).agg(F.count("*").alias("row_count"))
