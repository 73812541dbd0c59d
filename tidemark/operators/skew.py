"""Finding and splitting keys that hold a large share of a table."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expressions import same_keys
from tidemark.session import checkpoint_folder

# Rows that one task should handle; a key with more is hot.
TASK_ROWS = 5_000_000

ROWS = "_rows"
HOT = "_hot_"
SALT = "_salt"


class HotKeys:
    """The hot keys of a table: all keys with more rows than a task should handle.

    They are a small stored table, so Spark knows its size and broadcasts it or not.
    """

    def __init__(self, frame: DataFrame, keys: Sequence[str], rows: int, largest: int, task_rows: int):
        self.frame = frame
        self.keys = list(keys)
        self.rows = rows
        self.largest = largest
        self.task_rows = task_rows

    def __bool__(self) -> bool:
        return self.rows > 0

    @property
    def pieces(self) -> int:
        """Tasks needed for all hot rows."""
        return max(2, ceil(self.rows / self.task_rows))

    @property
    def pieces_per_key(self) -> int:
        """Tasks needed for the largest key."""
        return max(2, ceil(self.largest / self.task_rows))

    def only(self, df: DataFrame) -> DataFrame:
        """Rows of the hot keys."""
        return df.join(self.frame, same_keys(df, self.frame, self.keys, HOT), "left_semi")

    def without(self, df: DataFrame) -> DataFrame:
        """Rows of all other keys."""
        return df.join(self.frame, same_keys(df, self.frame, self.keys, HOT), "left_anti")


def hot_keys(df: DataFrame, keys: Sequence[str], task_rows: int = TASK_ROWS) -> HotKeys:
    """Count the rows per key and store the hot ones in the shared folder.

    Reads the key columns only and counts inside the map tasks first. However many
    keys are hot, only their total and their largest count reach the driver. Keys that
    are not hot are handled the plain way, so nothing is left out.
    """
    spark = df.sparkSession
    counted = df.select(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS)).where(F.col(ROWS) > task_rows)
    counted = counted.select([F.col(k).alias(HOT + k) for k in keys] + [ROWS])
    path = f"{checkpoint_folder(spark)}/hot-keys-{uuid.uuid4().hex}"
    counted.write.parquet(path)
    found = spark.read.schema(counted.schema).parquet(path)
    size = found.agg(F.sum(ROWS).alias("rows"), F.max(ROWS).alias("largest")).first()
    return HotKeys(found.drop(ROWS), keys, size["rows"] or 0, size["largest"] or 0, task_rows)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    *,
    sizes: DataFrame | None = None,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Join whose hot left keys are spread over several tasks.

    Meant for a large left side and a right side with few rows per key. Left rows of a hot key
    are dealt one after the other by their place in their partition and stored with it, so rows that are alike
    spread as well and a repeated task finds the same ones; right rows of a hot key are repeated once per
    salt. Other rows are joined the plain way. The keys are counted in ``sizes`` if given: a stored
    table with the same hot keys is cheaper to count than a derived left side.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        # Right rows are repeated per salt, so unmatched ones would surface more than once.
        raise ValueError(f"a salted join can't be {how}")
    hot = hot_keys(left if sizes is None else sizes, keys, task_rows)
    if not hot:
        return left.join(right, list(keys), how)
    salts = F.lit(hot.pieces_per_key)
    dealt = hot.only(left).withColumn(SALT, F.pmod(F.monotonically_increasing_id(), salts))
    path = f"{checkpoint_folder(left.sparkSession)}/salted-{uuid.uuid4().hex}"
    dealt.write.parquet(path)
    salted_left = left.sparkSession.read.schema(dealt.schema).parquet(path)
    every_salt = F.sequence(F.lit(0).cast("bigint"), (salts - 1).cast("bigint"))
    salted_right = hot.only(right).withColumn(SALT, F.explode(every_salt))
    spread = salted_left.join(salted_right, [*keys, SALT], how).drop(SALT)
    plain = hot.without(left).join(right, list(keys), how)
    return plain.unionByName(spread)
