"""Daily ingestion of source tables from several environments."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.fixed_values import ENVIRONMENTS, INGESTED_TABLES, SOURCE_FOLDERS
from tidemark.sources.drift import unite
from tidemark.sources.files import path_exists, read_text
from tidemark.sources.sinks import write_partitions
from tidemark.sources.tables import tag


@dataclass(frozen=True)
class SourceTable:
    """A table to ingest; ``folder`` is its source folder if named differently."""

    table_name: str
    folder: str | None = None
    is_enabled: bool = True

    @property
    def source_folder(self) -> str:
        return self.folder or self.table_name


def default_tables() -> list[SourceTable]:
    return [SourceTable(name, SOURCE_FOLDERS.get(name)) for name in INGESTED_TABLES]


def tables_from_settings(spark: SparkSession, path: str) -> list[SourceTable]:
    """Read ``{"settings": [{"table_name", "folder_name"?, "is_enabled"}]}``."""
    return [
        SourceTable(entry["table_name"], entry.get("folder_name"), entry["is_enabled"])
        for entry in json.loads(read_text(spark, path))["settings"]
    ]


def day_folders(
    spark: SparkSession,
    root: str,
    folder: str,
    day: date,
    environments: Iterable[str] = ENVIRONMENTS,
) -> dict[str, str]:
    """The day folder of each environment that delivered one."""
    paths = {env: f"{root}/environment={env}/{folder}/{day:%Y/%m/%d}" for env in environments}
    return {env: path for env, path in paths.items() if path_exists(spark, path)}


def stamp(df: DataFrame, copied_at: datetime) -> DataFrame:
    """Add the copy time and the processed mark as text; drop a source ``timestamp``."""
    return tag(df.drop("timestamp"), {"cigcopytime": str(copied_at), "cigprocessed": "False"})


def snapshot(frames: dict[str, DataFrame], copied_at: datetime) -> DataFrame:
    """Unite the frames of several environments, tagged and stamped; they may differ in columns and types."""
    return stamp(unite([tag(df, {"environment": env}) for env, df in frames.items()]), copied_at)


def ingest_table(
    spark: SparkSession,
    table: SourceTable,
    source_root: str,
    destination_root: str,
    copied_at: datetime,
    environments: Iterable[str] = ENVIRONMENTS,
) -> bool:
    """Copy one day of a table from all environments into its ingestion partition."""
    day = copied_at.date()
    folders = day_folders(spark, source_root, table.source_folder, day, environments)
    if not folders:
        return False
    frames = {env: spark.read.parquet(path) for env, path in folders.items()}
    parts = {"IngestionYear": day.year, "IngestionMonth": day.month, "IngestionDay": day.day}
    stamped = snapshot(frames, copied_at).withColumns({n: F.lit(v) for n, v in parts.items()})
    write_partitions(stamped, f"{destination_root}/{table.table_name}", list(parts))
    return True


@dataclass
class IngestReport:
    """What became of each table of a run."""

    done: list[str] = field(default_factory=list)
    without_data: list[str] = field(default_factory=list)
    failed: dict[str, Exception] = field(default_factory=dict)


class IngestionError(RuntimeError):
    """Some tables failed; the others were ingested. ``report`` names them all."""

    def __init__(self, report: IngestReport):
        causes = "; ".join(f"{name}: {type(e).__name__}: {str(e).splitlines()[0]}" for name, e in report.failed.items())
        super().__init__(f"{len(report.failed)} of the tables failed: {causes}")
        self.report = report


def ingest_report(
    spark: SparkSession,
    tables: Sequence[SourceTable],
    source_root: str,
    destination_root: str,
    copied_at: datetime,
    environments: Iterable[str] = ENVIRONMENTS,
    *,
    at_once: int = 8,
) -> IngestReport:
    """Ingest every enabled table, some at once, and report on each.

    A thread of the driver submits the jobs of one table; each has a scheduler pool of its own, so
    under Spark's fair scheduling a large table doesn't hold up the small ones. A table that
    fails neither stops nor hides the others.
    """
    wanted = [table for table in tables if table.is_enabled]
    environments = list(environments)

    @inheritable_thread_target(spark)
    def one(table: SourceTable) -> bool:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"ingest-{table.table_name}")
        try:
            return ingest_table(spark, table, source_root, destination_root, copied_at, environments)
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    report = IngestReport()
    with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
        for table, job in [(table, pool.submit(one, table)) for table in wanted]:
            try:
                (report.done if job.result() else report.without_data).append(table.table_name)
            except Exception as error:  # noqa: BLE001 - reported below
                report.failed[table.table_name] = error
    return report


def ingest_all(
    spark: SparkSession,
    tables: Sequence[SourceTable],
    source_root: str,
    destination_root: str,
    copied_at: datetime,
    environments: Iterable[str] = ENVIRONMENTS,
    *,
    at_once: int = 8,
) -> list[str]:
    """Ingest every enabled table; returns the names that had data, or raises once all were tried."""
    report = ingest_report(
        spark, tables, source_root, destination_root, copied_at, environments, at_once=at_once
    )
    if report.failed:
        raise IngestionError(report)
    return report.done
