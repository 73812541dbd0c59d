"""Tables whose files differ in their columns and types.

Files are grouped so that the footers of a group agree. Spark merges the footers of all files in one
distributed job; where types clash it merges those of each folder, some folders at once, and those of
a folder's files where they clash within it. A group is read in its own types, brought to the common ones
and united with the others, so columns that only some days have are kept and no value is lost.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.tables import with_folder

FILE = "_file"
ROW = "_row"
GROUP = "_group"
MARKERS = (FILE, ROW, GROUP)
# Folders whose footers are merged at once where types clash.
FOLDERS_AT_ONCE = 8

_CLASHES = ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE")
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NESTED = (T.StructType, T.ArrayType, T.MapType)


@dataclass(frozen=True)
class FileGroup:
    """Files whose columns agree."""

    files: tuple[str, ...]
    schema: T.StructType


def common_type(types: Iterable[T.DataType]) -> T.DataType:
    """A type that holds the values of all; each can be cast to it and back without loss.

    Times with a zone pass through text in the zone of the session, which should be UTC.
    """
    distinct = list(dict.fromkeys(types))
    if len(distinct) == 1:
        return distinct[0]
    if all(isinstance(t, _WHOLE) for t in distinct):
        return T.LongType()
    if all(isinstance(t, (T.FloatType, T.DoubleType)) for t in distinct):
        return T.DoubleType()
    if any(isinstance(t, T.BinaryType) for t in distinct):
        return T.BinaryType()
    return T.StringType()


def converted(value: Column, found: T.DataType, wanted: T.DataType) -> Column:
    """Cast between a type and the common one, either way."""
    if found == wanted:
        return value
    if isinstance(found, _NESTED):
        return F.to_json(value) if isinstance(wanted, T.StringType) else F.to_json(value).cast(wanted)
    if isinstance(wanted, _NESTED):
        return F.from_json(value.cast("string"), wanted)
    if isinstance(wanted, T.BinaryType) or isinstance(found, T.BinaryType):
        # Bytes and text of the same bytes are told apart by their type alone.
        return value.cast("string").cast(wanted)
    return value.cast(wanted)


def _agree(a: T.StructType, b: T.StructType) -> bool:
    kinds = {f.name.lower(): f.dataType for f in a}
    return all(kinds.get(f.name.lower(), f.dataType) == f.dataType for f in b)


def _union(a: T.StructType, b: T.StructType) -> T.StructType:
    known = {f.name.lower() for f in a}
    return T.StructType([*a.fields, *[f for f in b if f.name.lower() not in known]])


class DriftingTable:
    """A parquet folder, its files grouped by their columns."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        found = spark.read.parquet(path)
        # Names as rows carry them in their metadata, and the paths they stand for.
        self.uris = {unquote(uri): uri for uri in (f.replace("file:///", "file:/", 1) for f in found.inputFiles())}
        self.files = sorted(self.uris)
        root = self.path.rsplit("/", 1)[-1]
        below = self.files[0].rsplit(f"/{root}/", 1)[-1].split("/")[:-1] if self.files else []
        names = {part.split("=", 1)[0] for part in below if "=" in part}
        self.partitions = [f for f in found.schema if f.name in names]
        folders: dict[str, list[str]] = {}
        for file in self.files:
            folders.setdefault(file.rsplit("/", 1)[0], []).append(file)
        self.groups = self._grouped(folders)

    def _read(self, paths: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
        reader = self.spark.read.option("basePath", self.path).option("mergeSchema", schema is None)
        if schema is not None:
            reader = reader.schema(T.StructType([*schema.fields, *self.partitions]))
        return reader.parquet(*paths)

    def _merged(self, paths: Sequence[str]) -> T.StructType | None:
        """The columns of all files, or None if types clash."""
        try:
            schema = self._read(paths).schema
        except (PySparkException, Py4JJavaError) as error:
            if any(clash in str(error) for clash in _CLASHES):
                return None
            raise
        own = {f.name for f in self.partitions}
        return T.StructType([f for f in schema if f.name not in own])

    def _grouped(self, folders: dict[str, list[str]]) -> list[FileGroup]:
        if not folders:
            return []
        whole = self._merged(sorted(folders))
        if whole is not None:
            return [FileGroup(tuple(self.files), whole)]
        with ThreadPoolExecutor(FOLDERS_AT_ONCE) as pool:
            merged = dict(zip(folders, pool.map(lambda folder: self._merged([folder]), folders)))
        found: list[FileGroup] = []
        for folder, files in folders.items():
            schema = merged[folder]
            parts = [(files, schema)] if schema is not None else [([f], self._merged([f])) for f in files]
            for own, kind in parts:
                if kind is None:
                    raise ValueError(f"the footer of {own[0]} can't be read")
                same = next((k for k, g in enumerate(found) if _agree(g.schema, kind)), None)
                if same is None:
                    found.append(FileGroup(tuple(own), kind))
                else:
                    found[same] = FileGroup((*found[same].files, *own), _union(found[same].schema, kind))
        return found

    @property
    def schema(self) -> T.StructType:
        """All columns that any file has, in order of appearance, in common types."""
        kinds: dict[str, list[T.DataType]] = {}
        names: dict[str, str] = {}
        for group in self.groups:
            for field in group.schema:
                names.setdefault(field.name.lower(), field.name)
                kinds.setdefault(field.name.lower(), []).append(field.dataType)
        own = [T.StructField(names[k], common_type(types)) for k, types in kinds.items()]
        return T.StructType([*own, *self.partitions])

    def stored_rows(self, number: int, files: Iterable[str] | None = None) -> DataFrame | None:
        """Rows of one group in the types they are stored in, with their folder, file and place."""
        group = self.groups[number]
        wanted = group.files if files is None else sorted(set(group.files) & set(files))
        if not wanted:
            return None
        marked = with_folder(self._read(wanted, group.schema))
        return marked.withColumns(
            {FILE: F.col("_metadata.file_path"), ROW: F.col("_metadata.row_index"), GROUP: F.lit(number)}
        )

    def brought(self, rows: DataFrame, number: int) -> DataFrame:
        """Rows of one group in the common types; columns it lacks are NULL."""
        own = {f.name.lower(): f for f in self.groups[number].schema}
        columns = []
        for field in self.schema.fields:
            held = own.get(field.name.lower())
            if field in self.partitions:
                columns.append(F.col(f"`{field.name}`"))
            elif held is None:
                columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            else:
                columns.append(converted(F.col(f"`{held.name}`"), held.dataType, field.dataType).alias(field.name))
        extra = [c for c in rows.columns if c in MARKERS or c == "_folder"]
        return rows.select(*columns, *extra)

    def returned(self, rows: DataFrame, number: int) -> DataFrame:
        """Rows in the common types brought back to the columns and types of a group."""
        common = {f.name.lower(): f for f in self.schema}
        columns = [
            converted(F.col(f"`{common[f.name.lower()].name}`"), common[f.name.lower()].dataType, f.dataType).alias(f.name)
            for f in self.groups[number].schema
        ]
        return rows.select(*columns, *[f.name for f in self.partitions], *[c for c in rows.columns if c in MARKERS or c == "_folder"])

    def rows(self, files: Iterable[str] | None = None) -> DataFrame:
        """All rows, or those of some files, in the common types, with the markers."""
        wanted = None if files is None else set(files)
        parts = [(k, self.stored_rows(k, wanted)) for k in range(len(self.groups))]
        frames = [self.brought(rows, k) for k, rows in parts if rows is not None]
        if not frames:
            kinds = [T.StructField("_folder", T.StringType()), T.StructField(FILE, T.StringType())]
            kinds += [T.StructField(ROW, T.LongType()), T.StructField(GROUP, T.IntegerType())]
            return self.spark.createDataFrame([], T.StructType([*self.schema.fields, *kinds]))
        result = frames[0]
        for frame in frames[1:]:
            result = result.unionByName(frame)
        return result


def unite(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name of frames that may differ in columns and types, as ``read_drifting`` does it."""
    if not frames:
        raise ValueError("nothing to unite")
    names: dict[str, str] = {}
    kinds: dict[str, list[T.DataType]] = {}
    for frame in frames:
        for field in frame.schema:
            names.setdefault(field.name.lower(), field.name)
            kinds.setdefault(field.name.lower(), []).append(field.dataType)
    common = {key: common_type(types) for key, types in kinds.items()}

    def brought(frame: DataFrame) -> DataFrame:
        own = {field.name.lower(): field for field in frame.schema}
        return frame.select(
            [
                converted(F.col(f"`{own[key].name}`"), own[key].dataType, kind).alias(names[key])
                if key in own
                else F.lit(None).cast(kind).alias(names[key])
                for key, kind in common.items()
            ]
        )

    result = brought(frames[0])
    for frame in frames[1:]:
        result = result.unionByName(brought(frame))
    return result


def read_drifting(spark: SparkSession, path: str) -> DataFrame:
    """A parquet folder whose files differ in columns or types, as one frame.

    Columns that some files lack are NULL there. Where types clash whole numbers become long, floats
    double, and anything else text (bytes, if some of it is bytes); conditions on partition
    columns still prune folders.
    """
    table = DriftingTable(spark, path)
    if len(table.groups) == 1:
        return table._read([table.path], table.groups[0].schema)
    return table.rows().drop("_folder", *MARKERS)
