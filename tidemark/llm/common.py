"""Small helpers that the operators of this package share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import checkpoint_folder
from tidemark.sources.files import remove_folder

# Rows that Spark hands to a Python task at once. Texts are cut into slabs afterwards, so
# this only bounds one transfer.
ROWS_PER_BATCH = 1_000
BYTES_PER_BATCH = 32 << 20


def prepared(spark: SparkSession) -> None:
    """Session settings of the operators: bounded transfers, and shuffle files that go when a
    query ends (what is needed again is written to the shared folder)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_PER_BATCH))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


_scratch: list[str] = []


def new_folder(spark: SparkSession) -> str:
    """A folder that doesn't exist yet, in the shared checkpoint folder."""
    root = _scratch[-1] if _scratch else checkpoint_folder(spark)
    return f"{root}/tidemark-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is stored inside is removed at the end; results have to be written elsewhere before."""
    root = f"{checkpoint_folder(spark)}/tidemark-scratch-{uuid.uuid4().hex}"
    _scratch.append(root)
    try:
        yield
    finally:
        _scratch.remove(root)
        remove_folder(spark, root)


def stored(df: DataFrame, *partitions: str) -> DataFrame:
    """Write a table to the shared checkpoint folder and read it back: lineage ends there."""
    spark = df.sparkSession
    path = new_folder(spark)
    df.write.partitionBy(*partitions).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_fold(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds (null id: 0)."""
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(folds)), F.lit(0))
