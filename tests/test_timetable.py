from __future__ import annotations

from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyloom.functions.times import trailing
from tallyloom.operators import market
from tallyloom.plans.rollup import Rollup
from tallyloom.plans.timetable import TimeTable
from tallyloom.sources.readers import literal_rows
from tallyloom.catalog.market import TICK_SCHEMA

START = datetime(2024, 1, 1)
DAYS = 6


@pytest.fixture
def ticks(spark):
    """48 ticks per symbol and day."""
    return spark.range(DAYS * 48 * 3).select(
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins=F.floor(F.col("id") / 3).cast("int") * 30)).alias("time"),
        F.concat(F.lit("S"), F.col("id") % 3).alias("symbol"), (F.col("id") * 7919 % 100003).cast("double").alias("price"),
        (F.col("id") % 13).cast("decimal(18,2)").alias("day_volume"))


@pytest.fixture
def table(spark, tmp_path, ticks):
    spec = TimeTable("ticks", str(tmp_path / "t"), TICK_SCHEMA, "time", ("symbol",), ("time DESC",), bloom=("price",),
                     cold_path=str(tmp_path / "cold"))
    return spec.load(ticks)


def files(table, sub="hot"):
    return sorted(p for p in Path(table.path, sub).rglob("*.parquet"))


def test_rows_and_chunks(spark, table, ticks, rows):
    assert rows(table.read(spark).drop("time_day")) == rows(ticks)
    chunks = table.chunks(spark).orderBy("range_start").collect()
    assert len(chunks) == DAYS and not any(c.is_compressed for c in chunks)
    assert chunks[0].chunk_name == "ticks_20240101" and chunks[0].range_end == START + timedelta(days=1)
    with pytest.raises(FileExistsError):
        table.create(spark)


def test_null_time_is_refused(spark, table):
    bad = literal_rows(spark, [(None, "S1", 1.0, 1)], TICK_SCHEMA)
    with pytest.raises(Exception, match="must not be null"):
        table.append(bad)


def test_time_filter_prunes_partitions(spark, table):
    plan = trailing(table.read(spark), "time", START + timedelta(days=DAYS), "2 days")._jdf.queryExecution().toString()
    scan = next(line for line in plan.splitlines() if "PartitionFilters: [" in line and "isnotnull(time_day" in line)
    assert ">= 2024-01-05" in scan.replace("19727", "2024-01-05") and "GreaterThanOrEqual(time" in scan


def test_compaction_sorts_shrinks_and_can_be_undone(spark, table, ticks, rows):
    before = rows(market.candles(table.read(spark), "1 day", "S1", START + timedelta(days=DAYS), "3 days"))
    assert len(table.compact(spark)) == DAYS
    assert len(files(table)) == DAYS and all("zstd" in p.name for p in files(table))
    assert rows(table.read(spark).drop("time_day")) == rows(ticks)
    assert rows(market.candles(table.read(spark), "1 day", "S1", START + timedelta(days=DAYS), "3 days")) == before
    one = spark.read.parquet(str(files(table)[0])).collect()
    assert one == sorted(sorted(one, key=lambda r: r.time, reverse=True), key=lambda r: r.symbol)
    assert table.chunks(spark).where("is_compressed").count() == DAYS
    assert table.compact(spark) == []
    stats = table.compaction_stats(spark).first()
    assert stats.before_bytes > 0 and stats.after_bytes == sum(p.stat().st_size for p in files(table))
    assert len(table.expand(spark)) == DAYS
    assert rows(table.read(spark).drop("time_day")) == rows(ticks)
    assert table.chunks(spark).where("is_compressed").count() == 0


def test_append_reopens_one_chunk(spark, table):
    table.compact(spark)
    table.append(literal_rows(spark, [("2024-01-03 12:00:00", "S9", "1.5", "4")], TICK_SCHEMA))
    state = {c.chunk_name: c.is_compressed for c in table.chunks(spark).collect()}
    assert not state["ticks_20240103"] and sum(state.values()) == DAYS - 1
    assert table.compact(spark) == [date(2024, 1, 3)]
    assert table.read(spark).where("symbol = 'S9'").count() == 1


def test_layout_change_is_used_by_the_next_compaction(spark, table):
    other = table.with_layout(("day_volume",), ("time ASC",))
    other.compact(spark)
    one = spark.read.parquet(str(files(table)[0])).collect()
    assert one == sorted(one, key=lambda r: (r.day_volume, r.time))


def test_age_policy(spark, table):
    as_of = START + timedelta(days=DAYS)
    assert len(table.compact_older_than(spark, timedelta(days=2), as_of)) == DAYS - 2


class _Cut(Exception):
    pass


@pytest.mark.parametrize("job", ["compact", "expand", "tier"])
def test_a_job_cut_short_anywhere_loses_nothing(spark, table, ticks, rows, monkeypatch, job):
    """Stops before every write, mark, log row and deletion in turn."""
    from tallyloom.plans import timetable
    want, as_of = rows(ticks), START + timedelta(days=DAYS)
    if job == "expand":
        table.compact(spark)
    run = {"compact": lambda: table.compact(spark), "expand": lambda: table.expand(spark),
           "tier": lambda: table.tier(spark, timedelta(days=4), as_of)}[job]
    steps, limit = 0, 0

    def cut(do):
        def wrapped(*args, **kwargs):
            nonlocal steps
            steps += 1
            if steps == limit:
                raise _Cut
            return do(*args, **kwargs)
        return wrapped

    originals = {(owner, n): getattr(owner, n) for owner, names in ((timetable.TimeTable, ("_write", "_record")),
                                                                    (timetable.Folder, ("delete", "mark", "unmark"))) for n in names}
    for limit in range(1, 9):
        steps = 0
        for (owner, name), do in originals.items():
            monkeypatch.setattr(owner, name, cut(do))
        try:
            run()
        except _Cut:
            pass
        monkeypatch.undo()
        assert rows(table.read(spark).drop("time_day")) == want
    run()
    assert not Path(table.staged).exists()
    assert rows(table.read(spark).drop("time_day")) == want


def test_rows_appended_during_a_rewrite_stay(spark, table, ticks, monkeypatch):
    from tallyloom.plans import timetable
    late = literal_rows(spark, [("2024-01-03 12:00:00", "S9", "1.5", "4")], TICK_SCHEMA)
    copied = timetable.TimeTable._copy

    def slow(self, *args):
        copied(self, *args)
        self._write(self._with_day(late), self.hot, "append")

    monkeypatch.setattr(timetable.TimeTable, "_copy", slow)
    assert date(2024, 1, 3) not in table.compact(spark)
    assert table.read(spark).count() == ticks.count() + 1


def test_tiering(spark, table, ticks, rows):
    as_of = START + timedelta(days=DAYS)
    assert table.queued_for_tiering(spark, timedelta(days=4), as_of).count() == 2
    assert table.tier(spark, timedelta(days=4), as_of) == [date(2024, 1, 1), date(2024, 1, 2)]
    assert table.tiered_chunks(spark).count() == 2 and table.queued_for_tiering(spark, timedelta(days=4), as_of).count() == 0
    assert rows(table.read(spark).drop("time_day")) == rows(ticks)
    assert table.read(spark, include_tiered=False).count() == (DAYS - 2) * 48 * 3
    # a late row of a tiered day is kept, and follows to the cold tier
    table.append(literal_rows(spark, [("2024-01-01 12:00:00", "S9", "1.5", "4")], TICK_SCHEMA))
    assert table.read(spark).count() == ticks.count() + 1
    table.tier(spark, timedelta(days=4), as_of)
    assert table.read(spark).count() == ticks.count() + 1 and table.tiered_chunks(spark).count() == 2


def test_an_unmarked_copy_is_not_read(spark, table, ticks):
    spark.read.parquet(f"{table.path}/hot").write.partitionBy("time_day").parquet(f"{table.staged}/job=compact")
    assert table.read(spark).count() == ticks.count()
    table.recover(spark)
    assert not Path(table.staged).exists() and table.read(spark).count() == ticks.count()


def test_a_marked_copy_stands_for_its_days_until_it_is_in_place(spark, table, ticks, rows):
    """As after a job that was lost while Spark put the files in place."""
    copy = f"{table.staged}/job=tier"
    spark.read.parquet(f"{table.path}/hot").where("time_day < '2024-01-03'").write.partitionBy("time_day").parquet(copy)
    Path(copy, "_ready").touch()
    for day in ("2024-01-01", "2024-01-02"):
        for part in Path(table.hot, f"time_day={day}").glob("*"):
            part.unlink()
    assert rows(table.read(spark).drop("time_day")) == rows(ticks)
    assert table.read(spark, include_tiered=False).count() == (DAYS - 2) * 48 * 3
    table.append(literal_rows(spark, [("2024-01-01 12:00:00", "S9", "1.5", "4")], TICK_SCHEMA))
    assert table.read(spark).count() == ticks.count() + 1 and table.tiered_chunks(spark).count() == 2


def test_a_read_of_an_untiered_table_runs_no_job(spark, table):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("read", "read")
    try:
        table.read(spark)
        assert not tracker.getJobIdsForGroup("read")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_retention_drops_hot_and_cold(spark, table):
    as_of = START + timedelta(days=DAYS)
    table.tier(spark, timedelta(days=4), as_of)
    table.add_policy(spark, "retain", timedelta(days=3))
    with pytest.raises(ValueError, match="already has"):
        table.add_policy(spark, "retain", timedelta(days=700))
    assert len(table.apply_policies(spark, as_of)["retain"]) == DAYS - 3
    assert table.read(spark).agg(F.min("time")).first()[0] == START + timedelta(days=DAYS - 3)


def test_drop_takes_dependants_and_nothing_else(spark, table, tmp_path):
    rollup = Rollup(str(tmp_path / "r"), "1 day", ("symbol",), tuple(market.CANDLE)).create(table.read(spark))
    table.add_dependant(spark, rollup.path)
    foreign = tmp_path / "foreign"
    foreign.mkdir()
    table.add_dependant(spark, str(foreign))
    table.tier(spark, timedelta(days=4), START + timedelta(days=DAYS))
    table.drop(spark)
    assert not Path(table.path).exists() and not Path(rollup.path).exists() and foreign.exists()
    assert not Path(table.cold).exists()
    table.drop(spark)


def test_bloom_filter_is_written(spark, table):
    with_bloom = table.compact(spark) and sum(p.stat().st_size for p in files(table))
    table.expand(spark)
    from dataclasses import replace
    replace(table, bloom=()).compact(spark)
    assert sum(p.stat().st_size for p in files(table)) < with_bloom


def test_zoned_times_use_utc_days_under_any_session_zone(spark, tmp_path, rows):
    spec = TimeTable("z", str(tmp_path / "z"), "time timestamp, v int", "time")
    data = spark.range(48).select(F.timestamp_seconds(F.col("id") * 3600 + 1704067200).alias("time"), F.col("id").cast("int").alias("v"))
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        spec.load(data)
        assert [c.chunk_name for c in spec.chunks(spark).orderBy("chunk_name").collect()] == ["z_20240101", "z_20240102"]
        kept = trailing(spec.read(spark), "time", datetime(2024, 1, 1, 19), "1 hour")
        assert kept.count() == 30
        ends = [r.e for r in spec.chunks(spark).orderBy("chunk_name").select(F.unix_seconds("range_end").alias("e")).collect()]
        assert ends == [1704067200 + 86400, 1704067200 + 2 * 86400]
        spec.compact(spark)
        assert spec.read(spark).count() == 48
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
