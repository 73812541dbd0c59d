"""Privacy jobs: deletion logs, erasure per table, masking of divisions."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.fixed_values import CRM_ACCOUNT_COLUMN, MASKED_COLUMNS
from tidemark.functions.columns import cast_columns
from tidemark.operators.erasure import erase_history, listed_rows, mask_columns, rows_of_keys, stale_files
from tidemark.session import checkpoint_folder
from tidemark.sources.drift import FILE, GROUP, MARKERS, ROW, DriftingTable
from tidemark.sources.file_index import FileIndex, indexed_files
from tidemark.sources.publish import numbered, recover, replace_folders
from tidemark.sources.sinks import Watermarks, write_partitions
from tidemark.sources.tables import FOLDER, INGESTION_DAY, days_between, with_file_path

LOG_DAY = ("year", "month", "day")
NEWEST_COPY = ("cigcopytime desc",)


def deletion_log(raw: DataFrame, name: str, after: date | None, until: date) -> DataFrame:
    """Ids anonymised on each ingestion day after the watermark, in one scan."""
    mark = F.col("isanonymized")
    if not isinstance(raw.schema["isanonymized"].dataType, T.BooleanType):
        mark = mark.cast("string") == "1"
    pending = days_between(raw, after, until).where(mark)
    days = [F.col(part).try_cast("int").alias(to) for part, to in zip(INGESTION_DAY, LOG_DAY)]
    return pending.select(F.col("id").alias(name), *days)


def update_deletion_log(
    raw: DataFrame, name: str, path: str, watermarks: Watermarks, item: str, until: date
) -> None:
    """Write the pending days of a deletion log, then move the watermark."""
    log = deletion_log(raw, name, watermarks.get(item), until)
    write_partitions(log, path, LOG_DAY)
    watermarks.store({item: until})


def pending_ids(log: DataFrame, after: date | None, until: date) -> DataFrame:
    """Ids in the deletion log since the last run, each once."""
    return days_between(log, after, until, LOG_DAY).drop(*LOG_DAY).distinct()


def user_ids(person_ids: DataFrame, users: DataFrame) -> DataFrame:
    """The users of the listed persons."""
    return listed_rows(users.select("personid", "userid"), "personid", person_ids).select("userid").distinct()


def _erase(
    raw: DataFrame, ids: DataFrame, id_column: str, ties: Sequence[str], times: Sequence[str] = ("cigcopytime",)
) -> DataFrame:
    """Erase by the newest of some times; stored columns keep their types and values."""
    derived = {f"_order_{name}": F.col(name) for name in times}
    marked = cast_columns(raw.withColumns(derived), {"timestamp": list(derived)})
    order = [*(f"{name} desc" for name in derived), *ties]
    return erase_history(marked, "id", ids, order, id_column).select(*raw.columns)


def erase_accounts(raw: DataFrame, account_ids: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """Account history without all but the latest record of erased accounts."""
    return _erase(raw, account_ids, "id", ties)


def mask_divisions(raw: DataFrame, account_ids: DataFrame) -> DataFrame:
    """Division history with the contact details of erased accounts masked."""
    return mask_columns(raw, "customer", account_ids, MASKED_COLUMNS)


def erase_crm_accounts(
    raw: DataFrame,
    account_ids: DataFrame,
    id_column: str = CRM_ACCOUNT_COLUMN,
    ties: Sequence[str] = (),
) -> DataFrame:
    """The same for the CRM accounts, found by the account id they refer to."""
    return _erase(raw, account_ids, id_column, ties, ("etlinserttime", "lastmodifieddate"))


def erase_persons(raw: DataFrame, person_ids: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """Person history without all but the latest record of erased persons."""
    return _erase(raw, person_ids, "id", ties)


def erase_users(raw: DataFrame, person_ids: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """User history likewise, found by the person of the user."""
    return _erase(raw, person_ids, "person", ties)


def erase_crm_users(
    raw: DataFrame, person_ids: DataFrame, users: DataFrame, ties: Sequence[str] = ()
) -> DataFrame:
    """CRM users (or contacts) likewise, found by the user they refer to."""
    return _erase(raw, user_ids(person_ids, users), "userid__c", ties)


erase_crm_contacts = erase_crm_users


def stale_history_files(
    raw: DataFrame, ids: DataFrame, id_column: str = "id", ties: Sequence[str] = ()
) -> DataFrame:
    """The files an erasure has to rewrite."""
    return stale_files(with_file_path(raw), "id", ids, [*NEWEST_COPY, *ties], id_column)


def rewrite_history(
    spark: SparkSession,
    path: str,
    ids: DataFrame,
    id_column: str,
    change: Callable[[DataFrame, DataFrame], DataFrame],
    staging: str,
    *,
    key: str = "id",
    index: FileIndex | None = None,
) -> None:
    """Apply an erasure or masking to a stored table, in the folders that hold listed ids.

    ``change`` is one of the functions above, such as ``erase_accounts``; it gets the whole history of
    every ``key`` that has a listed row, files of all kinds united. All other rows of a touched folder
    are copied as they are stored, with the columns and types of their files, and other folders aren't
    read beyond the ids and keys. With an index only files that may hold a listed id or key are opened.
    An interrupted run is finished or discarded first.
    """
    recover(spark, staging)
    table = DriftingTable(spark, path)
    kind = table.schema[id_column].dataType
    listed_ids = ids.select(F.col(ids.columns[0]).cast("string").try_cast(kind).alias("listed")).distinct()
    wanted = _kept(listed_ids.where(F.col("listed").isNotNull()))
    listed = listed_rows(table.rows(indexed_files(index, table, wanted, id_column)), id_column, wanted)
    key = key if key in table.schema.fieldNames() else id_column
    marks = _kept(listed.select(F.col(key).alias("key"), FOLDER))
    folders = sorted(r[0] for r in marks.select(FOLDER).distinct().collect())
    if not folders:
        return
    keys = marks.select("key").distinct()
    # Rows with a NULL key may lie in any file: no index holds them.
    nowhere = None if index is None or not keys.where(F.col("key").isNull()).isEmpty() else index
    history = _kept(rows_of_keys(table.rows(indexed_files(nowhere, table, keys, key)), key, keys))
    changed = _kept(change(history, wanted))
    touched = set(folders)
    frames = []
    for number, group in enumerate(table.groups):
        here = [f for f in group.files if f.rsplit("/", 1)[0] in touched]
        stored = table.stored_rows(number, here) if here else None
        if stored is None:
            continue
        others = stored.join(history.select(FILE, ROW), [FILE, ROW], "left_anti")
        own = table.returned(changed.where(F.col(GROUP) == number), number)
        rows = numbered(spark, others.unionByName(own), folders)
        frames.append(rows.drop(FOLDER, *MARKERS, *[f.name for f in table.partitions]))
    replace_folders(spark, frames, folders, staging)


def _kept(df: DataFrame) -> DataFrame:
    """A small intermediate result in the shared folder, read more than once."""
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/erasure-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def run_erasure(
    spark: SparkSession,
    path: str,
    log: DataFrame,
    id_column: str,
    change: Callable[[DataFrame, DataFrame], DataFrame],
    watermarks: Watermarks,
    item: str,
    until: date,
    staging: str,
    index: FileIndex | None = None,
) -> None:
    """Erase the ids logged since the last run from a table, then move the watermark.

    What an interrupted run has staged is dealt with even if nothing new is logged.
    """
    recover(spark, staging)
    ids = pending_ids(log, watermarks.get(item), until)
    if not ids.isEmpty():
        rewrite_history(spark, path, ids, id_column, change, staging, index=index)
        if index is not None:
            index.update(DriftingTable(spark, path))
    watermarks.store({item: until})
