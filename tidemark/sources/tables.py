"""Scans: whole tables, pruned partitions, pruned columns, row provenance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.files import child_names

INGESTION_DAY = ("ingestionyear", "ingestionmonth", "ingestionday")
FOLDER = "_folder"


def read_table(
    spark: SparkSession,
    source: str,
    *,
    columns: Sequence[str] = (),
    where: Column | str | None = None,
) -> DataFrame:
    """Read a catalog table by name or a parquet folder by path.

    A condition on partition columns prunes folders; the column list prunes the
    parquet read.
    """
    is_path = "/" in source or source.endswith(".parquet")
    df = spark.read.parquet(source) if is_path else spark.table(source)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def day_of(parts: Sequence[str] = INGESTION_DAY) -> Column:
    """The day that three partition columns stand for, zero-padded or not."""
    year, month, day = (F.col(p).try_cast("int") for p in parts)
    return F.make_date(year, month, day)


def days_between(
    df: DataFrame, after: date | None, until: date, parts: Sequence[str] = INGESTION_DAY
) -> DataFrame:
    """All days after the watermark up to and including ``until``, in one scan.

    The condition uses partition columns only, so other folders are not read.
    """
    condition = day_of(parts) <= F.lit(until)
    if after is not None:
        condition &= day_of(parts) > F.lit(after)
    return df.where(condition)


def on_day(df: DataFrame, day: date, parts: Sequence[str] = INGESTION_DAY) -> DataFrame:
    """One partition day."""
    year, month, number = parts
    return df.where(
        (F.col(year) == day.year) & (F.col(month) == day.month) & (F.col(number) == day.day)
    )


def newest_day(spark: SparkSession, path: str, parts: Sequence[str] = INGESTION_DAY) -> date | None:
    """The last day that a stored table has a folder for, from the folder names alone."""

    def last(folder: str, left: Sequence[str]) -> tuple[int, ...] | None:
        if not left:
            return ()
        pairs = [(*name.partition("=")[::2], name) for name in child_names(spark, folder)]
        found = [(int(value), name) for key, value, name in pairs if key.lower() == left[0].lower() and value.isdigit()]
        for number, name in sorted(found, reverse=True):
            rest = last(f"{folder}/{name}", left[1:])
            if rest is not None:
                return (number, *rest)
        return None

    found = last(path.rstrip("/"), parts)
    return date(*found) if found else None


def with_file_path(df: DataFrame, name: str = "path") -> DataFrame:
    """Add the file each row was read from."""
    return df.withColumn(name, F.col("_metadata.file_path"))


def tag(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Add constant columns, such as the environment of a folder."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; columns that a frame lacks become NULL."""
    if not frames:
        raise ValueError("nothing to unite")
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def with_folder(df: DataFrame) -> DataFrame:
    """Append the folder of each row's file, as it is stored."""
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return df.withColumn(FOLDER, F.regexp_replace(path, "/[^/]*$", ""))
