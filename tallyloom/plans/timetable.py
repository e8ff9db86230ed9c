"""Tables partitioned by the day of a time column, and their life cycle.

A table is a folder of Parquet day partitions ("chunks")::

    <path>/hot/<time>_day=2024-01-31/     the rows of a day; compacted files end in .zstd.parquet
    <cold>/<time>_day=.../                days moved to the cold tier
    <path>/staged/job=<job>/              a copy of the days that a job is replacing
    <path>/log/                           policies, dependants and sizes; never needed to read rows

A job that rewrites days writes a copy of them first, then puts it in place by Spark's dynamic
partition overwrite. Once the copy is complete it is marked, and until it is deleted readers take those
days from it; a job cut short is finished by the next one (`recover`). Jobs and appends on one table must not run
at the same time. A query that was planned before a rewrite reads files that are gone and has to be repeated.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyloom.functions.scalars import percent_saved, size_pretty
from tallyloom.functions.times import day_column, instant, utc_day
from tallyloom.sources.files import Folder
from tallyloom.sources.readers import small_frame

LOG_SCHEMA = "at timestamp, action string, chunk date, detail string, bytes long"
PACKED, PLAIN = "zstd", "snappy"
READY = "_ready"
POLICIES = ("compact", "tier", "retain")


@dataclass(frozen=True)
class TimeTable:
    """Definition of a table: columns, time column, and layout inside a chunk.

    `order_by` holds SQL order terms such as ``time DESC``. `bloom` names columns
    that get a Bloom filter when chunks are compacted; minimum and maximum are
    always kept by Parquet.
    """

    name: str
    path: str
    schema: str
    time_col: str
    segment_by: tuple[str, ...] = ()
    order_by: tuple[str, ...] = ()
    bloom: tuple[str, ...] = ()
    cold_path: str | None = None

    # -- definition ---------------------------------------------------------

    @property
    def day_col(self) -> str:
        return day_column(self.time_col)

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromDDL(self.schema)

    @property
    def _stored(self) -> T.StructType:
        return self.struct.add(self.day_col, T.DateType())

    @property
    def hot(self) -> str:
        return f"{self.path}/hot"

    @property
    def cold(self) -> str:
        return f"{self.cold_path}/{self.name}" if self.cold_path else f"{self.path}/cold"

    @property
    def staged(self) -> str:
        return f"{self.path}/staged"

    def create(self, spark: SparkSession) -> "TimeTable":
        """Make the empty table; an existing one is not touched."""
        if Folder(spark, self.path).names() or Folder(spark, self.path).files():
            raise FileExistsError(self.path)
        for root in (self.hot, self.cold):
            Folder(spark, root).make()
        self._record(spark, [("create", None, self.name, None)])
        return self

    def with_layout(self, segment_by: tuple[str, ...], order_by: tuple[str, ...]) -> "TimeTable":
        """The table with another chunk layout, used from its next compaction on."""
        return replace(self, segment_by=tuple(segment_by), order_by=tuple(order_by))

    def drop(self, spark: SparkSession) -> None:
        """Delete the table and the roll-ups built on it, if they exist.

        Only folders whose own log says that this library made them are deleted.
        """
        if not Folder(spark, f"{self.path}/log").exists():
            return
        for row in self.log(spark).where("action = 'dependant'").select("detail").distinct().collect():
            if Folder(spark, f"{row.detail}/log").exists():
                Folder(spark, row.detail).delete()
        Folder(spark, self.cold).delete()
        Folder(spark, self.path).delete()

    # -- log ----------------------------------------------------------------

    def _record(self, spark: SparkSession, entries: list[tuple]) -> None:
        if entries:
            now = datetime.now(timezone.utc)
            rows = [(now, *entry) for entry in entries]
            small_frame(spark, rows, LOG_SCHEMA).write.mode("append").parquet(f"{self.path}/log")

    def log(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(LOG_SCHEMA).parquet(f"{self.path}/log")

    def add_dependant(self, spark: SparkSession, path: str) -> None:
        self._record(spark, [("dependant", None, path, None)])

    # -- data ---------------------------------------------------------------

    def append(self, df: DataFrame) -> None:
        """Add rows, cast to the table's types; columns may be in any order.

        Rows are regrouped by day, so that each chunk gets few files; adaptive
        execution splits a day that is too big for one task.
        """
        typed = df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in self.struct.fields])
        missing = F.raise_error(F.lit(f"{self.time_col} must not be null"))
        typed = typed.withColumn(self.time_col, F.coalesce(
            F.col(self.time_col), missing.cast(self.struct[self.time_col].dataType)))
        self.recover(df.sparkSession)
        self._write(self._with_day(typed).hint("rebalance", F.col(self.day_col)), self.hot, "append")

    def load(self, df: DataFrame) -> "TimeTable":
        """Turn an existing plain table into this one."""
        self.create(df.sparkSession).append(df)
        return self

    def _with_day(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.day_col, utc_day(F.col(self.time_col), self.struct[self.time_col].dataType))

    def _write(self, df: DataFrame, path: str, mode: str, packed: bool = False) -> None:
        """Write day partitions; `overwrite` replaces the days that `df` holds and no others."""
        writer = df.write.mode(mode).partitionBy(self.day_col).option("compression", PACKED if packed else PLAIN)
        if mode == "overwrite":
            writer = writer.option("partitionOverwriteMode", "dynamic")
        if packed:
            # version 2 pages store sorted times as differences
            writer = writer.option("parquet.writer.version", "v2")
            for column in self.bloom:
                writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer.parquet(path)

    def _stored_rows(self, spark: SparkSession, path: str) -> DataFrame:
        return spark.read.schema(self._stored).parquet(path)

    def _replacing(self, spark: SparkSession) -> tuple[str, list[date]] | None:
        """The job that was cut short after its copy was complete, and the days it replaces."""
        for name in Folder(spark, self.staged).names("job="):
            if Folder(spark, f"{self.staged}/{name}").has(READY):
                return name[len("job="):], self._days(spark, f"{self.staged}/{name}")
        return None

    def read(self, spark: SparkSession, include_tiered: bool = True) -> DataFrame:
        """All rows with their day column; `times.time_range` and `times.trailing` prune by it."""
        hot, cold = self._stored_rows(spark, self.hot), self._stored_rows(spark, self.cold)
        replacing = self._replacing(spark)
        if replacing is not None:
            job, days = replacing
            others, copy = ~F.col(self.day_col).isin(days), self._stored_rows(spark, f"{self.staged}/job={job}")
            if job == "tier":
                hot, cold = hot.where(others), cold.where(others).unionByName(copy)
            else:
                hot = hot.where(others).unionByName(copy)
        return hot.unionByName(cold) if include_tiered and (replacing or Folder(spark, self.cold).names()) else hot

    # -- chunks -------------------------------------------------------------

    def _days(self, spark: SparkSession, path: str) -> list[date]:
        prefix = f"{self.day_col}="
        return [date.fromisoformat(n[len(prefix):]) for n in Folder(spark, path).names(prefix)]

    def _chunk(self, spark: SparkSession, root: str, day: date) -> Folder:
        return Folder(spark, f"{root}/{self.day_col}={day.isoformat()}")

    def _files(self, spark: SparkSession, root: str) -> DataFrame:
        """(chunk, path, length) of every data file; no file is opened."""
        found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(root)
        chunk = F.regexp_extract("path", f"{self.day_col}=([0-9-]+)/[^/]*$", 1).cast("date").alias("chunk")
        return found.select(chunk, "path", "length")

    def _sizes(self, spark: SparkSession, root: str) -> DataFrame:
        """(chunk, bytes, is_compressed, files) with one row per chunk; `files` tells whether the chunk has changed."""
        packed = F.bool_and(F.col("path").endswith(f".{PACKED}.parquet")).alias("is_compressed")
        return self._files(spark, root).groupBy("chunk").agg(F.sum("length").alias("bytes"), packed,
                                                            F.sum(F.xxhash64("path").cast("decimal(38,0)")).alias("files"))

    def chunks(self, spark: SparkSession) -> DataFrame:
        """One row per chunk and tier: name, time range, whether it is compacted, and its tier; read from the file listing."""
        hot, cold = (self._sizes(spark, root).withColumn("tier", F.lit(tier)) for root, tier in ((self.hot, "hot"), (self.cold, "cold")))
        time = self.struct[self.time_col].dataType
        zone = F.lit(" 00:00:00" if isinstance(time, T.TimestampNTZType) else " 00:00:00Z")
        return hot.unionByName(cold).select(
            F.concat(F.lit(f"{self.name}_"), F.date_format("chunk", "yyyyMMdd")).alias("chunk_name"),
            F.concat(F.col("chunk").cast("string"), zone).cast(time).alias("range_start"),
            F.concat(F.date_add("chunk", 1).cast("string"), zone).cast(time).alias("range_end"), "is_compressed", "tier")

    def tiered_chunks(self, spark: SparkSession) -> DataFrame:
        return self.chunks(spark).where("tier = 'cold'").drop("tier")

    def queued_for_tiering(self, spark: SparkSession, older_than: timedelta, as_of: datetime) -> DataFrame:
        edge = instant(as_of - older_than, self.struct[self.time_col].dataType)
        return self.chunks(spark).where((F.col("tier") == "hot") & (F.col("range_end") <= edge)).drop("tier")

    def _hot_before(self, spark: SparkSession, older_than: timedelta, as_of: datetime) -> list[date]:
        """Chunks that end at or before ``as_of - older_than``."""
        return self._ended(self._days(spark, self.hot), as_of - older_than)

    @staticmethod
    def _ended(days: list[date], edge: datetime) -> list[date]:
        return [d for d in days if datetime.combine(d, datetime.min.time()) + timedelta(days=1) <= edge]

    # -- rewriting ----------------------------------------------------------

    def _arranged(self, df: DataFrame) -> DataFrame:
        return df.sortWithinPartitions(F.col(self.day_col), *[F.col(c) for c in self.segment_by],
                                       *[_order(term) for term in self.order_by])

    def compact(self, spark: SparkSession, days: list[date] | None = None) -> list[date]:
        """Rewrite chunks sorted by segment and order, zstd, few files. Returns the chunks done."""
        return self._rewrite(spark, "compact", days, "NOT is_compressed")

    def compact_older_than(self, spark: SparkSession, older_than: timedelta, as_of: datetime) -> list[date]:
        return self.compact(spark, self._hot_before(spark, older_than, as_of))

    def expand(self, spark: SparkSession, days: list[date] | None = None) -> list[date]:
        """Undo compaction: the same rows as plain files."""
        return self._rewrite(spark, "expand", days, "is_compressed")

    def tier(self, spark: SparkSession, older_than: timedelta, as_of: datetime) -> list[date]:
        """Move old chunks to the cold tier, which may be on another file system.

        Late rows of a day that is cold already join it there.
        """
        return self._rewrite(spark, "tier", self._hot_before(spark, older_than, as_of), "true")

    def _rewrite(self, spark: SparkSession, job: str, days: list[date] | None, which: str) -> list[date]:
        """Replace hot chunks by way of a marked copy; a chunk that changed while it was copied is left as it is."""
        self.recover(spark)
        before = {r.chunk: r for r in self._sizes(spark, self.hot).where(which).collect() if days is None or r.chunk in days}
        if not before:
            return []
        copy, chosen = f"{self.staged}/job={job}", F.col(self.day_col).isin(sorted(before))
        rows = self._stored_rows(spark, self.hot).where(chosen)
        if job == "tier":
            rows = rows.unionByName(self._stored_rows(spark, self.cold).where(chosen))
        self._copy(rows, copy)
        now = {r.chunk: r.files for r in self._sizes(spark, self.hot).collect()}
        done = sorted(d for d, r in before.items() if now.get(d) == r.files)
        for day in set(before) - set(done):
            self._chunk(spark, copy, day).delete()
        if job == "compact":
            self._record(spark, [(job, d, None, before[d].bytes) for d in done])
        if done:
            Folder(spark, copy).mark(READY)
        self.recover(spark)
        return done

    def _copy(self, rows: DataFrame, path: str) -> None:
        self._write(rows, path, "append")

    def recover(self, spark: SparkSession) -> None:
        """Put a complete copy in place, and delete copies that are not complete. Repeating it changes nothing."""
        replacing = self._replacing(spark)
        if replacing is not None:
            job, days = replacing
            rows = self._stored_rows(spark, f"{self.staged}/job={job}")
            if job == "expand":
                self._write(rows.hint("rebalance", F.col(self.day_col)), self.hot, "overwrite")
            else:
                self._write(self._arranged(rows.hint("rebalance", F.col(self.day_col))),
                            self.cold if job == "tier" else self.hot, "overwrite", True)
            if job == "tier":
                for day in days:
                    self._chunk(spark, self.hot, day).delete()
            Folder(spark, f"{self.staged}/job={job}").unmark(READY)
        if Folder(spark, self.staged).exists():
            Folder(spark, self.staged).delete()

    # -- retention ----------------------------------------------------------

    def drop_older_than(self, spark: SparkSession, older_than: timedelta, as_of: datetime) -> list[date]:
        """Drop whole chunks, hot and cold, that end at or before ``as_of - older_than``."""
        self.recover(spark)
        every = {*self._days(spark, self.hot), *self._days(spark, self.cold)}
        gone = sorted(self._ended(list(every), as_of - older_than))
        for day in gone:
            self._chunk(spark, self.hot, day).delete()
            self._chunk(spark, self.cold, day).delete()
        return gone

    # -- policies -----------------------------------------------------------

    def policies(self, spark: SparkSession) -> dict[str, timedelta]:
        rows = self.log(spark).where("action LIKE 'policy:%'").select("action", "detail").collect()
        return {r.action.split(":")[1]: timedelta(seconds=float(r.detail)) for r in rows}

    def add_policy(self, spark: SparkSession, kind: str, older_than: timedelta) -> None:
        """Remember an age rule; a table has at most one of each kind."""
        if kind not in POLICIES:
            raise ValueError(f"unknown policy {kind}")
        if kind in self.policies(spark):
            raise ValueError(f"{self.name} already has a {kind} policy")
        self._record(spark, [(f"policy:{kind}", None, str(older_than.total_seconds()), None)])

    def apply_policies(self, spark: SparkSession, as_of: datetime) -> dict[str, list[date]]:
        """Run every remembered rule once; the schedule is the caller's."""
        jobs = {"retain": self.drop_older_than, "tier": self.tier, "compact": self.compact_older_than}
        rules = self.policies(spark)
        return {kind: job(spark, rules[kind], as_of) for kind, job in jobs.items() if kind in rules}

    # -- sizes --------------------------------------------------------------

    def compaction_stats(self, spark: SparkSession) -> DataFrame:
        """Bytes before and after compaction over the compacted chunks, and the share saved."""
        measured = self.log(spark).where("action = 'compact'").groupBy("chunk").agg(F.max_by("bytes", "at").alias("before"))
        sizes = self._sizes(spark, self.hot).where("is_compressed").join(measured, "chunk").agg(
            F.coalesce(F.sum("before"), F.lit(0)).alias("before_bytes"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("after_bytes"))
        before, after = F.col("before_bytes"), F.col("after_bytes")
        return sizes.select(before, after, size_pretty(before).alias("before"), size_pretty(after).alias("after"),
                            percent_saved(before, after).alias("compression_ratio_percent"))


def _order(term: str):
    """``time DESC`` as a sort column."""
    name, _, direction = term.strip().partition(" ")
    return F.col(name).desc() if direction.strip().lower() == "desc" else F.col(name).asc()
