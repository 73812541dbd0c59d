"""Which files may hold an id: a digest of the ids of each file, kept beside the table.

The index has one row per file, column and distinct id, the id as a 64-bit hash, sorted by hash. Two
ids of one hash only open a file too many. Files that the index doesn't know, such as those written
since its last update, count as holding everything, so a result never depends on its age.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.drift import FILE, DriftingTable
from tidemark.sources.files import child_names, path_exists, remove_folder
from tidemark.sources.sinks import VersionedTable

KNOWN = "_indexed"


def _digest(column: str):
    # Ids are compared as text, so a column that changed its type keeps its hashes.
    return F.xxhash64(F.col(f"`{column}`").cast("string")).alias("hash")


class FileIndex:
    """An index over some columns of a stored table.

    Each update adds a folder with the files that are new, and the folders are merged now and then.
    """

    SCHEMA = "file string, name string, hash bigint"

    def __init__(self, spark: SparkSession, root: str, columns: Sequence[str]):
        self.spark, self.root, self.columns = spark, root.rstrip("/"), list(columns)
        self.merged = VersionedTable(spark, f"{self.root}/merged")
        self.recent = f"{self.root}/recent"

    def entries(self) -> DataFrame:
        found = self.spark.createDataFrame([], self.SCHEMA)
        if self.merged.exists():
            found = found.unionByName(self.merged.read())
        if path_exists(self.spark, self.recent) and child_names(self.spark, self.recent):
            found = found.unionByName(self.spark.read.schema(self.SCHEMA).parquet(self.recent))
        return found

    def _known(self) -> DataFrame:
        return self.entries().where(F.col("name") == KNOWN).select("file").distinct()

    def _listing(self, table: DriftingTable) -> DataFrame:
        """The files of the table, by the name that their rows carry."""
        return self.spark.createDataFrame([(uri, path) for path, uri in table.uris.items()], "file string, path string")

    def update(self, table: DriftingTable) -> int:
        """Read the indexed columns of new files only; returns how many there were."""
        new = self._listing(table).join(self._known(), "file", "left_anti").collect()
        if not new:
            return 0
        rows = table.rows([r["path"] for r in new])
        held = [c for c in self.columns if c.lower() in {name.lower() for name in rows.columns}]
        entries = [
            rows.where(F.col(f"`{c}`").isNotNull()).select(F.col(FILE).alias("file"), F.lit(c).alias("name"), _digest(c)).distinct()
            for c in held
        ]
        # A file counts as known once its marker is written, which is in the same step as its ids.
        entries.append(self.spark.createDataFrame([(r["file"], KNOWN, 0) for r in new], self.SCHEMA))
        found = entries[0]
        for entry in entries[1:]:
            found = found.unionByName(entry)
        found.repartitionByRange("name", "hash").sortWithinPartitions("name", "hash").write.mode("append").parquet(self.recent)
        return len(new)

    def merge(self, table: DriftingTable) -> None:
        """One sorted table of all folders, without the files that are gone."""
        current = self.entries().join(self._listing(table).select("file"), "file", "left_semi").distinct()
        self.merged.publish(current.repartitionByRange("name", "hash").sortWithinPartitions("name", "hash"))
        # Entries that are in both places until here are harmless: they say the same.
        remove_folder(self.spark, self.recent)

    def candidates(self, table: DriftingTable, ids: DataFrame, column: str) -> list[str]:
        """Paths of the files that may hold a listed id (the list may be keys, NULL among them)."""
        if column not in self.columns:
            return list(table.files)
        wanted = ids.select(_digest(ids.columns[0])).distinct()
        hits = self.entries().where(F.col("name") == column).join(wanted, "hash", "left_semi").select("file").distinct()
        listing = self._listing(table)
        unknown = listing.join(self._known(), "file", "left_anti")
        found = listing.join(hits, "file", "left_semi").unionByName(unknown)
        return sorted({r["path"] for r in found.collect()})


def indexed_files(index: FileIndex | None, table: DriftingTable, ids: DataFrame, column: str) -> Iterable[str] | None:
    """Files to open for a list of ids; None stands for all."""
    return None if index is None else index.candidates(table, ids, column)
