"""The few file-system calls the jobs need, through Spark's own Hadoop client.

They work on any storage Spark can read; nothing here touches table data.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    system, jvm_path = _open(spark, path)
    return bool(system.exists(jvm_path))


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; empty if it does not exist."""
    system, jvm_path = _open(spark, path)
    if not system.exists(jvm_path):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(jvm_path))


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file in one step."""
    system, jvm_path = _open(spark, path)
    system.create(jvm_path, False).close()


def remove_folder(spark: SparkSession, path: str) -> None:
    system, jvm_path = _open(spark, path)
    system.delete(jvm_path, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder within one file system; the target must not exist."""
    system, jvm_target = _open(spark, target)
    if system.exists(jvm_target):
        raise FileExistsError(target)
    system.mkdirs(jvm_target.getParent())
    if not system.rename(spark._jvm.org.apache.hadoop.fs.Path(source), jvm_target):
        raise OSError(f"could not rename {source} to {target}; both must lie in one file system")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that is there as a whole or not at all."""
    draft = f"{path}.draft"
    system, jvm_draft = _open(spark, draft)
    stream = system.create(jvm_draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    move(spark, draft, path)


def read_text(spark: SparkSession, path: str) -> str:
    """A small settings file as one string."""
    row = spark.read.text(path, wholetext=True).first()
    return row[0] if row else ""
