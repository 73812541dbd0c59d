"""Privacy operators: erase history, mask columns, find files with stale rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.fixed_values import MASK
from tidemark.functions.expressions import same_keys
from tidemark.operators.latest import latest_record

LISTED = "_listed"
KEY = "_key"


def listed_rows(df: DataFrame, id_column: str, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose id is in a one-column list, or not in it (``left_anti``)."""
    wanted = ids.select(F.col(ids.columns[0]).alias(id_column))
    return df.join(wanted, id_column, how)


def rows_of_keys(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows whose key is in a one-column list; NULL is a key like any other."""
    wanted = keys.select(F.col(keys.columns[0]).alias(KEY)).distinct()
    return df.join(wanted, df[key].eqNullSafe(wanted[KEY]), "left_semi")


def erase_history(
    df: DataFrame,
    key: str,
    ids: DataFrame,
    order: Sequence[str],
    id_column: str | None = None,
) -> DataFrame:
    """Drop all but the latest record per key of the listed ids.

    ``id_column`` is the column the list refers to if it is not the key. Rows
    that are not listed pass without being ranked or shuffled by key.
    """
    id_column = id_column or key
    untouched = listed_rows(df, id_column, ids, "left_anti")
    if id_column == key:
        kept = latest_record(listed_rows(df, key, ids), [key], order)
    else:
        # The latest record of a key may be one that is not listed.
        touched = listed_rows(df, id_column, ids).select(key)
        marks = ids.select(F.col(ids.columns[0]).alias(id_column)).distinct()
        ranked = latest_record(rows_of_keys(df, key, touched), [key], order)
        kept = ranked.join(marks, id_column, "left_semi")
    return untouched.unionByName(kept)


def mask_columns(
    df: DataFrame, owner: str, ids: DataFrame, columns: Sequence[str], mask: str = MASK
) -> DataFrame:
    """Replace columns by a mask in the rows of listed owners; all rows stay."""
    marks = ids.select(F.col(ids.columns[0]).alias(owner)).distinct().withColumn(LISTED, F.lit(True))
    flagged = df.join(marks, owner, "left")
    masked = {c: F.when(F.col(LISTED), F.lit(mask)).otherwise(F.col(c)) for c in columns}
    return flagged.withColumns(masked).select(*df.columns)


def stale_files(
    df: DataFrame,
    key: str,
    ids: DataFrame,
    order: Sequence[str],
    id_column: str | None = None,
    path: str = "path",
) -> DataFrame:
    """The files that hold listed rows other than the latest record of their key.

    Works on one summary row per key and file. A file is stale for a key if it
    holds listed rows and these are more than the latest record alone.
    """
    id_column = id_column or key
    marks = ids.select(F.col(ids.columns[0]).alias(id_column)).distinct().withColumn(LISTED, F.lit(True))
    touched = listed_rows(df, id_column, ids).select(key)
    rows = rows_of_keys(df, key, touched).join(marks, id_column, "left")
    needed = dict.fromkeys([key, path, LISTED, *(term.partition(" ")[0] for term in order)])
    latest = latest_record(rows.select(*needed), [key], order)
    counts = rows.groupBy(key, path).agg(F.count(LISTED).alias("listed"))
    latest_here = latest.select(
        F.col(key).alias(KEY + key), F.col(path).alias(KEY + path), F.when(F.col(LISTED), 1).otherwise(0).alias("latest")
    )
    return (
        counts.join(latest_here, same_keys(counts, latest_here, [key, path], KEY), "left")
        .where(F.col("listed") > F.coalesce("latest", F.lit(0)))
        .select(path)
        .distinct()
    )
