"""Replacing folders of a stored table so that a crash at any step loses nothing.

The new contents are staged first. A manifest, written last and in one step, lists the folders and
makes the new state the valid one: from then on an interrupted run is finished, before it is
discarded. Publishing renames staged folders one by one, so each step can be repeated.

A reader that lists the table while folders are being published may see some old and some new ones.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.files import child_names, move, path_exists, read_text, remove_folder, write_text
from tidemark.sources.tables import FOLDER

MANIFEST = "manifest.json"
NUMBER = "_number"


def recover(spark: SparkSession, staging: str) -> str | None:
    """Finish or discard what an interrupted run left in a staging folder.

    Returns ``"finished"``, ``"discarded"`` or, if there is nothing, None.
    """
    if not path_exists(spark, staging):
        return None
    if not path_exists(spark, f"{staging}/{MANIFEST}"):
        remove_folder(spark, staging)
        return "discarded"
    _publish(spark, staging)
    return "finished"


def _publish(spark: SparkSession, staging: str) -> None:
    """Put the staged folders in place; what an earlier run has moved already stays."""
    folders = json.loads(read_text(spark, f"{staging}/{MANIFEST}"))
    for number, entry in folders.items():
        staged = f"{staging}/folders/{number}"
        if not entry["filled"]:
            remove_folder(spark, entry["folder"])
        elif path_exists(spark, staged):
            # The old folder goes while the new one is safe in the staging folder.
            remove_folder(spark, entry["folder"])
            move(spark, staged, entry["folder"])
    # Without its manifest the rest of the staging folder means nothing.
    remove_folder(spark, f"{staging}/{MANIFEST}")
    remove_folder(spark, staging)


def replace_folders(
    spark: SparkSession, frames: Sequence[DataFrame], folders: Sequence[str], staging: str
) -> None:
    """Replace some folders by the rows of the frames, even by none.

    The column ``NUMBER`` of a frame is the place of the row's folder in ``folders``. Frames may
    differ in their columns; the files of each keep its own. ``staging`` lies in the same file
    system and belongs to one run at a time.
    """
    recover(spark, staging)
    if not folders:
        return
    filled: set[int] = set()
    for place, frame in enumerate(frames):
        rows = f"{staging}/rows/{place}"
        frame.write.mode("overwrite").partitionBy(NUMBER).parquet(rows)
        for name in child_names(spark, rows):
            if not name.startswith(f"{NUMBER}="):
                continue
            number = int(name.split("=")[1])
            filled.add(number)
            for file in child_names(spark, f"{rows}/{name}"):
                move(spark, f"{rows}/{name}/{file}", f"{staging}/folders/{number}/{place}-{file}")
    manifest = {str(k): {"folder": folder, "filled": k in filled} for k, folder in enumerate(folders)}
    write_text(spark, f"{staging}/{MANIFEST}", json.dumps(manifest))
    _publish(spark, staging)


def rewrite_folders(
    spark: SparkSession, result: DataFrame, touched: DataFrame, parts: Sequence[str], staging: str
) -> None:
    """Replace the touched folders of a table by rows that were computed from it.

    ``result`` and ``touched`` name folders by their stored path in the column ``FOLDER``, so the
    spelling of partition names and values, padded or null, plays no role. Folders without a row go.
    """
    recover(spark, staging)
    folders = sorted(row[0] for row in touched.select(FOLDER).distinct().collect())
    replace_folders(spark, [numbered(spark, result, folders).drop(FOLDER, *parts)], folders, staging)


def numbered(spark: SparkSession, rows: DataFrame, folders: Sequence[str]) -> DataFrame:
    """The rows of the listed folders, with the place of their folder in the list."""
    listed = spark.createDataFrame([(f, k) for k, f in enumerate(folders)], f"{FOLDER} string, {NUMBER} int")
    return rows.join(listed, FOLDER)


def replace_partition(
    spark: SparkSession, path: str, rows: DataFrame, values: Mapping[str, object], staging: str
) -> None:
    """Replace one partition by rows computed from the table, even by none."""
    folder = "/".join([path.rstrip("/"), *(f"{name}={value}" for name, value in values.items())])
    replace_folders(spark, [rows.drop(*values).withColumn(NUMBER, F.lit(0))], [folder], staging)
