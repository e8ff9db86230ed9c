"""Stored roll-ups that stay in step with a growing table.

A roll-up keeps *partial* aggregates per bucket and key (sum and count for an
average, value and time for first/last), partitioned by the day of the bucket. Its
watermark is a bucket edge: buckets below it are read from the store, rows at or
above it are aggregated live, so no bucket is counted in both. The newest bucket of
the first build may still be filling, so the watermark starts at its lower edge.

A row that arrives late, below the watermark, is seen once a refresh covers its
bucket.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyloom.functions.measures import Measure, finalize, merge_partials, partial_aggregate
from tallyloom.functions.times import (
    add_bucket, fetch_instant, instant, interval, latest_instant, time_range, time_type, utc_day)
from tallyloom.sources.files import Folder
from tallyloom.sources.readers import small_frame

LOG_SCHEMA = "at timestamp, action string, edge string, stored string"


def _day(at: datetime) -> datetime:
    return at.replace(hour=0, minute=0, second=0, microsecond=0)


@dataclass(frozen=True)
class Rollup:
    """Definition: one time bucket, grouping keys, measures, and where it is stored."""

    path: str
    width: str
    keys: tuple[str, ...]
    measures: tuple[Measure, ...]
    time_col: str = "time"
    bucket: str = "bucket"

    @property
    def _bucket_day(self) -> str:
        return f"{self.bucket}_day"

    @property
    def _group(self) -> list[str]:
        return [self.bucket, *self.keys]

    def _partials(self, rows: DataFrame) -> DataFrame:
        return partial_aggregate(add_bucket(rows, self.width, self.time_col, self.bucket), self._group,
                                 list(self.measures))

    # -- log: a refresh first lowers the watermark, then raises it -------------

    def _record(self, spark: SparkSession, action: str, edge: datetime | None, stored: datetime | None) -> None:
        row = (datetime.now(timezone.utc), action, *[at.isoformat(sep=" ") if at else None for at in (edge, stored)])
        small_frame(spark, [row], LOG_SCHEMA).write.mode("append").parquet(f"{self.path}/log")

    def _edges(self, spark: SparkSession, done_only: bool = False) -> tuple[datetime | None, datetime | None]:
        """Watermark and end of the stored buckets, as of the last (finished) action."""
        log = spark.read.schema(LOG_SCHEMA).parquet(f"{self.path}/log")
        last = (log.where("action = 'done'") if done_only else log).orderBy(F.desc("at")).first()
        return tuple(datetime.fromisoformat(at) if at else None for at in (last.edge, last.stored))

    def watermark(self, spark: SparkSession) -> datetime | None:
        """Edge below which the store is complete; while a refresh runs, its lower edge."""
        return self._edges(spark)[0]

    # -- writing ------------------------------------------------------------

    def _store(self, partials: DataFrame, dtype: T.DataType) -> None:
        (partials.withColumn(self._bucket_day, utc_day(F.col(self.bucket), dtype))
         .hint("rebalance", F.col(self._bucket_day))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(self._bucket_day).parquet(f"{self.path}/store"))

    def _edge(self, spark: SparkSession, at: datetime, dtype: T.DataType, up: bool = False) -> datetime:
        """Bucket edge at or before `at`, or with `up` the one at or after it."""
        one = add_bucket(spark.range(1).select(instant(at, dtype).alias("t")), self.width, "t", "b")
        start = fetch_instant(one, F.col("b"), dtype)
        return fetch_instant(one, F.col("b") + interval(self.width), dtype) if up and start != at else start

    def create(self, source: DataFrame) -> "Rollup":
        """Build the store from the whole source."""
        spark, dtype = source.sparkSession, time_type(source, self.time_col)
        if Folder(spark, f"{self.path}/log").exists():
            raise FileExistsError(self.path)
        self._store(self._partials(source.where(F.col(self.time_col).isNotNull())), dtype)
        newest, after = None, None
        if Folder(spark, f"{self.path}/store").names():
            newest = latest_instant(spark.read.parquet(f"{self.path}/store"), self.bucket)
            after = self._edge(spark, newest + timedelta(microseconds=1), dtype, up=True)
        self._record(spark, "done", newest, after)
        return self

    def refresh(self, source: DataFrame, as_of: datetime, start_offset: timedelta, end_offset: timedelta) -> None:
        """Recompute the buckets inside ``[as_of - start_offset, as_of - end_offset)``.

        The range is widened down to the watermark, so that no bucket is left out,
        and to whole days, since day partitions are what gets replaced. The
        watermark is lowered before and raised after the write: a refresh cut short
        leaves reads on the raw rows until the next one.
        """
        spark, dtype = source.sparkSession, time_type(source, self.time_col)
        lo = self._edge(spark, as_of - start_offset, dtype, up=True)
        hi = self._edge(spark, as_of - end_offset, dtype)
        mark = self.watermark(spark)
        top, stored = self._edges(spark, done_only=True)
        if mark is None:
            first = fetch_instant(source.agg(F.min(self.time_col).alias("t")), F.col("t"), dtype)
            lo = min(lo, self._edge(spark, first, dtype)) if first else lo
        else:
            lo = min(lo, mark)
        if hi <= lo:
            return
        day_lo, day_hi = _day(lo), _day(hi) if hi == _day(hi) else _day(hi) + timedelta(days=1)
        # every bucket starting on these days, from all of its rows
        rows = time_range(source, self.time_col, lo=day_lo, hi=instant(day_hi, dtype) + interval(self.width))
        partials = self._partials(rows).where(
            (F.col(self.bucket) >= instant(day_lo, dtype)) & (F.col(self.bucket) < instant(day_hi, dtype)))
        lowered = min(mark, self._edge(spark, day_lo, dtype, up=True)) if mark else None
        self._record(spark, "begin", lowered, lowered)
        self._store(partials, dtype)
        self._drop_empty_days(spark, rows, day_lo, day_hi, dtype)
        self._record(spark, "done", max(hi, top) if top else hi, max(hi, stored) if stored else hi)

    def _drop_empty_days(self, spark: SparkSession, rows: DataFrame, lo: datetime, hi: datetime,
                         dtype: T.DataType) -> None:
        """Remove stored days of the range whose raw rows are all gone."""
        prefix = f"{self._bucket_day}="
        stored = {date.fromisoformat(n[len(prefix):]) for n in Folder(spark, f"{self.path}/store").names(prefix)}
        inside = {d for d in stored if lo.date() <= d < hi.date()}
        if inside:
            days = add_bucket(rows, self.width, self.time_col, "b").select(utc_day(F.col("b"), dtype).alias("d"))
            for day in inside - {r.d for r in days.distinct().collect()}:
                Folder(spark, f"{self.path}/store/{prefix}{day.isoformat()}").delete()

    # -- reading ------------------------------------------------------------

    def read(self, source: DataFrame | None = None, lo=None, materialized_only: bool = False) -> DataFrame:
        """Final values per bucket and key, from `lo` on if given.

        With a source, buckets at or above the watermark are computed from its rows;
        `materialized_only` leaves them out.
        """
        if source is None and not materialized_only:
            raise ValueError("a live read needs the source table")
        spark = source.sparkSession if source is not None else SparkSession.active()
        mark, stored = self._edges(spark)
        end = stored if materialized_only else mark
        parts = []
        if end is not None and Folder(spark, f"{self.path}/store").names():
            kept = time_range(spark.read.parquet(f"{self.path}/store"), self.bucket, lo=lo, hi=end)
            parts.append(kept.drop(self._bucket_day))
        if not materialized_only:
            live = source
            dtype = time_type(source, self.time_col)
            for edge in (mark, lo):
                if edge is not None:
                    live = time_range(live, self.time_col, lo=edge)
            partials = self._partials(live)
            if lo is not None:
                partials = partials.where(F.col(self.bucket) >= instant(lo, dtype))
            parts.append(partials)
        if not parts:
            raise ValueError("nothing is stored yet")
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return finalize(rows, self._group, list(self.measures))

    def widen(self, partials: DataFrame, width: str) -> DataFrame:
        """Merge stored partials into wider buckets (a multiple of the stored width)."""
        moved = add_bucket(partials, width, self.bucket, "_wide").drop(self.bucket).withColumnRenamed("_wide", self.bucket)
        return finalize(merge_partials(moved, self._group, list(self.measures)), self._group, list(self.measures))
