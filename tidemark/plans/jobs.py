"""Whole jobs: read, compute, write, and move the watermark at the end."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.fixed_values import CHANGE_COUNTERS
from tidemark.plans.lifecycle import lifecycle_log
from tidemark.plans.lookups import active_modules, conversion_source, publish_log
from tidemark.plans.ownership import month_end_owner
from tidemark.plans.setup import SetupSources, master_data_setup
from tidemark.plans.statistics import (
    DIVISION,
    changes_since,
    daily_changes,
    daily_statistics,
    last_rows,
    summary_news,
    summary_upsert,
    zero_glitch_repair,
)
from tidemark.sources.buckets import BucketedTable
from tidemark.sources.publish import recover, replace_partition
from tidemark.sources.sinks import (
    VersionedTable,
    Watermarks,
    write_if_any,
    write_partitions,
    write_table,
)
from tidemark.sources.tables import days_between, newest_day, on_day

DAY = ("Year", "Month", "Day")
SUMMARY_ITEM = "DivisionStatistics_Summary"
CHANGES_ITEM = "DivisionStatistics_DailyChanges"


def _day_values(day: date) -> dict[str, int]:
    return {"Year": day.year, "Month": day.month, "Day": day.day}


def run_daily_statistics(
    raw: DataFrame, path: str, ingestion_day: date, tie_breakers: Sequence[str] = ()
) -> None:
    """Store the statistics of one ingestion day under the day before."""
    snapshot_date = ingestion_day - timedelta(days=1)
    rows = daily_statistics(raw, ingestion_day, snapshot_date, tie_breakers)
    parts = {name: F.lit(value) for name, value in _day_values(snapshot_date).items()}
    write_partitions(rows.withColumns(parts), path, DAY)


def run_glitch_repair(spark: SparkSession, path: str, newest_day: date, staging: str) -> None:
    """Remove one-day zero glitches from the day before the newest one."""
    recover(spark, staging)
    daily = spark.read.parquet(path)
    middle = newest_day - timedelta(days=1)
    around = [newest_day, middle, middle - timedelta(days=1)]
    days = on_day(daily, around[0], DAY)
    for day in around[1:]:
        days = days.unionByName(on_day(daily, day, DAY))
    repaired = zero_glitch_repair(on_day(daily, middle, DAY), days)
    replace_partition(spark, path, repaired, _day_values(middle), staging)


def run_daily_changes(daily: DataFrame, path: str) -> None:
    """Store the changes of the newest day in its partition."""
    write_partitions(daily_changes(daily).withColumnRenamed("date", "Date"), path, ["Date"])


def run_newest_changes(
    spark: SparkSession,
    daily_path: str,
    changes_path: str,
    state: BucketedTable,
    watermarks: Watermarks,
    counters: Sequence[str] = CHANGE_COUNTERS,
) -> date | None:
    """Store the changes of the newest day; reads that day and the last row of each key.

    The newest day is told by the folder names. Days that were skipped go into the state first, in
    one scan; the first run fills it from the whole history. Returns the day, or None if it is done already.
    """
    newest, after = newest_day(spark, daily_path, DAY), watermarks.get(CHANGES_ITEM)
    if newest is None or (after is not None and after >= newest):
        return None
    daily = spark.read.parquet(daily_path)
    skipped = days_between(daily, after, newest - timedelta(days=1), DAY)
    if not skipped.isEmpty():
        state.upsert(last_rows(skipped, counters))
    today = on_day(daily, newest, DAY)
    last = state.read()
    if last is None:
        last = last_rows(today, counters).limit(0)
    changes = changes_since(today, last, counters)
    write_partitions(changes.withColumnRenamed("date", "Date"), changes_path, ["Date"])
    state.upsert(last_rows(today, counters))
    watermarks.store({CHANGES_ITEM: newest})
    return newest


def changes_state(spark: SparkSession, root: str, buckets: int = 64) -> BucketedTable:
    """The last row of each division, for ``run_newest_changes``."""
    return BucketedTable(spark, root, DIVISION, buckets)


def run_summary(raw: DataFrame, summary: VersionedTable, watermarks: Watermarks, until: date) -> None:
    """Bring the summary up to date with all pending ingestion days."""
    after = watermarks.get(SUMMARY_ITEM)
    summary.publish(summary_upsert(raw, summary.read(), after, until))
    watermarks.store({SUMMARY_ITEM: until})


def run_summary_buckets(raw: DataFrame, summary: BucketedTable, watermarks: Watermarks, until: date) -> list[int]:
    """The same for a summary in buckets: only those of divisions with news are read and written."""
    touched = summary.upsert(summary_news(raw, watermarks.get(SUMMARY_ITEM), until))
    watermarks.store({SUMMARY_ITEM: until})
    return touched


def run_lifecycle_log(raw_divisions: DataFrame, path: str, today: date, tie_breakers: Sequence[str] = ()) -> None:
    """Store the lifecycle log of all divisions."""
    write_table(lifecycle_log(raw_divisions, today, tie_breakers), path)


def run_month_end_owner(
    raw_accounts: DataFrame, calendar: DataFrame, path: str, today: date, tie_breakers: Sequence[str] = ()
) -> bool:
    """Store the owners at month ends, unless there are none."""
    return write_if_any(month_end_owner(raw_accounts, calendar, today, tie_breakers), path)


def run_publish_log(raw_clients: DataFrame, path: str, **options) -> None:
    """Store the log of published apps."""
    write_table(publish_log(raw_clients, **options), path)


def run_conversion_source(*sources: DataFrame, path: str, **options) -> None:
    """Store what conversions came from."""
    write_table(conversion_source(*sources, **options), path)


def run_active_modules(*sources: DataFrame, path: str, **options) -> None:
    """Store the modules in use."""
    write_table(active_modules(*sources, **options), path)


def run_setup(setup: VersionedTable, sources: SetupSources, tie_breakers: Sequence[str] = ()) -> None:
    """Run the setup rules over the stored table and publish the result."""
    setup.publish(master_data_setup(setup.read(), sources, tie_breakers))
