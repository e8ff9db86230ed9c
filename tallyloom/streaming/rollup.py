"""A roll-up fed by a stream."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tallyloom.functions.measures import Measure, finalize, merge_partials, partial_aggregate
from tallyloom.functions.times import add_bucket
from tallyloom.sources.files import Folder


def with_event_time(stream: DataFrame, time_col: str) -> DataFrame:
    """Event time as a zoned timestamp; NTZ values are read as UTC."""
    if not isinstance(stream.schema[time_col].dataType, T.TimestampNTZType):
        return stream
    zone = stream.sparkSession.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "GMT"):
        raise ValueError("streams over timestamp_ntz need spark.sql.session.timeZone=UTC")
    return stream.withColumn(time_col, F.col(time_col).cast("timestamp"))


@dataclass(frozen=True)
class StreamRollup:
    """Buckets kept up to date by a stream, stored as the partial aggregates of each micro-batch.

    A micro-batch combines its rows to one partial aggregate per bucket and key, and is one partition of the store, overwritten if
    the batch is replayed, so a restart leaves no doubles. A read merges the partials of each bucket and key. So a row counts
    however late it comes, without a watermark, and the stream holds no state between batches; `consolidate` keeps the
    store small.
    """

    path: str
    width: str
    keys: tuple[str, ...]
    measures: tuple[Measure, ...]
    time_col: str = "time"
    bucket: str = "bucket"

    @property
    def _group(self) -> list[str]:
        return [self.bucket, *self.keys]

    def partials(self, rows: DataFrame) -> DataFrame:
        """One row per bucket and key; rows without a time drop out."""
        timed = add_bucket(rows.where(F.col(self.time_col).isNotNull()), self.width, self.time_col, self.bucket)
        return partial_aggregate(timed, self._group, list(self.measures))

    def start(self, stream: DataFrame, available_now: bool = True, every: str = "1 minute") -> StreamingQuery:
        def keep(rows: DataFrame, batch: int) -> None:
            (self.partials(rows).withColumn("batch", F.lit(batch)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{self.path}/changes"))

        writer = (with_event_time(stream, self.time_col).writeStream.foreachBatch(keep)
                  .option("checkpointLocation", f"{self.path}/checkpoint"))
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
        return writer.start()

    def _base(self, spark: SparkSession) -> int | None:
        """Last batch folded into the newest complete base."""
        names = Folder(spark, f"{self.path}/base").names("upto=")
        done = [n for n in names if Folder(spark, f"{self.path}/base/{n}").has("_SUCCESS")]
        return max((int(n.removeprefix("upto=")) for n in done), default=None)

    def consolidate(self, spark: SparkSession) -> None:
        """Fold all changes so far into one base table, while the stream is stopped.

        The folded batches are removed once the base is complete; a batch replayed
        later brings partials that the base already holds and is not read.
        """
        batches = [int(n.removeprefix("batch=")) for n in Folder(spark, f"{self.path}/changes").names("batch=")]
        base = self._base(spark)
        if not batches or (base is not None and max(batches) <= base):
            return
        self._merged(spark).write.mode("overwrite").parquet(f"{self.path}/base/upto={max(batches)}")
        for batch in batches:
            Folder(spark, f"{self.path}/changes/batch={batch}").delete()
        if base is not None:
            Folder(spark, f"{self.path}/base/upto={base}").delete()

    def _merged(self, spark: SparkSession) -> DataFrame:
        """One row of partials per bucket and key."""
        base = self._base(spark)
        if base is None:
            parts = spark.read.parquet(f"{self.path}/changes").drop("batch")
        else:
            parts = spark.read.parquet(f"{self.path}/base/upto={base}")
            if Folder(spark, f"{self.path}/changes").names("batch="):
                schema = T.StructType([*parts.schema.fields, T.StructField("batch", T.IntegerType())])
                later = spark.read.schema(schema).parquet(f"{self.path}/changes").where(F.col("batch") > base)
                parts = parts.unionByName(later.drop("batch"))
        return merge_partials(parts, self._group, list(self.measures))

    def read(self, spark: SparkSession) -> DataFrame:
        """Newest state of every bucket and key."""
        return finalize(self._merged(spark), self._group, list(self.measures))
