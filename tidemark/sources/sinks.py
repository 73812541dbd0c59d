"""Parquet sinks, versioned publishing and the watermark table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.files import child_names, path_exists, remove_folder, touch


def write_table(df: DataFrame, path: str, files: int | None = None) -> None:
    """Overwrite a parquet folder.

    Without a file count Spark's adaptive execution sizes the output; a count
    costs one shuffle and limits the write to that many tasks.
    """
    (df if files is None else df.repartition(files)).write.mode("overwrite").parquet(path)


def write_partitions(df: DataFrame, path: str, parts: Sequence[str]) -> None:
    """Overwrite only the partitions that occur in the data."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .parquet(path)
    )


def write_if_any(df: DataFrame, path: str, files: int | None = None) -> bool:
    """Write unless the result is empty, so that old output survives an empty run."""
    if df.isEmpty():
        return False
    write_table(df, path, files)
    return True


class VersionedTable:
    """A table that a job may read and replace in one run.

    Every publish writes a new folder and then a marker file inside it; readers
    use the newest folder that has its marker. A failed write stays invisible.
    """

    MARKER = "_PUBLISHED"

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _versions(self) -> list[str]:
        return [n for n in child_names(self.spark, self.root) if n.startswith("version=")]

    def _published(self) -> list[str]:
        return [
            name
            for name in self._versions()
            if path_exists(self.spark, f"{self.root}/{name}/{self.MARKER}")
        ]

    def exists(self) -> bool:
        return bool(self._published())

    def read(self) -> DataFrame:
        published = self._published()
        if not published:
            raise FileNotFoundError(f"no published version under {self.root}")
        return self.spark.read.parquet(f"{self.root}/{published[-1]}")

    def publish(self, df: DataFrame, files: int | None = None) -> str:
        """Write and expose a new version; older ones stay for their readers."""
        numbers = [int(name.split("=")[1]) for name in self._versions()]
        name = f"version={max(numbers, default=0) + 1:012d}"
        sized = df if files is None else df.repartition(files)
        sized.write.mode("errorifexists").parquet(f"{self.root}/{name}")
        touch(self.spark, f"{self.root}/{name}/{self.MARKER}")
        return name

    def vacuum(self, keep: int = 2) -> None:
        """Remove all but the newest versions, once nobody reads them any more."""
        for old in self._published()[:-keep]:
            remove_folder(self.spark, f"{self.root}/{old}")


class Watermarks:
    """Last processed day per item, in a small versioned table.

    Store a watermark after the data it stands for is published.
    """

    SCHEMA = "item string, last_updated date"

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.table = VersionedTable(spark, root)

    def _current(self) -> DataFrame:
        if self.table.exists():
            return self.table.read()
        return self.spark.createDataFrame([], self.SCHEMA)

    def get(self, item: str) -> date | None:
        row = self._current().where(F.col("item") == item).first()
        return row["last_updated"] if row else None

    def get_all(self, items: Sequence[str]) -> dict[str, date | None]:
        rows = self._current().where(F.col("item").isin(*items)).collect()
        found = {row["item"]: row["last_updated"] for row in rows}
        return {item: found.get(item) for item in items}

    def store(self, values: Mapping[str, date | None]) -> None:
        """Set several watermarks at once; items without a day stay as they are."""
        known = [(item, day) for item, day in values.items() if day is not None]
        if not known:
            return
        fresh = self.spark.createDataFrame(known, self.SCHEMA)
        kept = self._current().join(fresh, "item", "left_anti")
        self.table.publish(kept.unionByName(fresh), files=1)
