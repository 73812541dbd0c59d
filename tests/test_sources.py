import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.frames import frame, rows
from tidemark.plans.privacy import erase_accounts, erase_persons, erase_users, mask_divisions, rewrite_history, run_erasure, update_deletion_log
from tidemark.sources import publish
from tidemark.sources.drift import DriftingTable, common_type, read_drifting
from tidemark.sources.file_index import FileIndex
from tidemark.sources.files import write_text
from tidemark.sources.ingest import (
    IngestionError,
    SourceTable,
    day_folders,
    default_tables,
    ingest_all,
    ingest_report,
    ingest_table,
    snapshot,
    tables_from_settings,
)
from tidemark.sources.publish import recover, replace_partition, rewrite_folders
from tidemark.sources.sinks import VersionedTable, Watermarks, write_if_any, write_partitions
from tidemark.sources.tables import days_between, on_day, read_table, union_by_name, with_folder

COPIED = datetime(2024, 2, 3, 6, 0)


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ingest_unites_delivering_environments(spark, tmp_path):
    source, target = str(tmp_path / "source"), str(tmp_path / "raw")
    frame(spark, "id string, timestamp string", ("1", "x")).write.parquet(
        f"{source}/environment=NL/CIG_Contracts/2024/02/03"
    )
    frame(spark, "extra int, id string", (7, "2")).write.parquet(
        f"{source}/environment=BE/CIG_Contracts/2024/02/03"
    )
    frame(spark, "id string", ("3",)).write.parquet(f"{source}/environment=FR/CIG_Contracts/2024/02/02")
    table = SourceTable("Contracts", "CIG_Contracts")
    assert list(day_folders(spark, source, table.source_folder, COPIED.date())) == ["NL", "BE"]
    assert ingest_table(spark, table, source, target, COPIED)
    df = spark.read.parquet(f"{target}/Contracts")
    assert "timestamp" not in df.columns
    assert rows(df, "id", "environment", "extra", "cigcopytime", "cigprocessed", "IngestionDay") == [
        ("1", "NL", None, "2024-02-03 06:00:00", "False", 3),
        ("2", "BE", 7, "2024-02-03 06:00:00", "False", 3),
    ]
    assert not ingest_table(spark, SourceTable("Absent"), source, target, COPIED)


def test_ingest_again_replaces_one_day_only(spark, tmp_path):
    source, target = str(tmp_path / "source"), str(tmp_path / "raw")
    for day in ("02", "03"):
        frame(spark, "id string", (day,)).write.parquet(f"{source}/environment=NL/Users/2024/02/{day}")
    tables = [SourceTable("Users"), SourceTable("Items", is_enabled=False), SourceTable("Units")]
    for moment in (datetime(2024, 2, 2), COPIED, COPIED):
        assert ingest_all(spark, tables, source, target, moment) == ["Users"]
    assert rows(spark.read.parquet(f"{target}/Users"), "id") == [("02",), ("03",)]


def test_settings(spark, tmp_path):
    path = tmp_path / "settings.json"
    entries = [
        {"table_name": "Users", "is_enabled": True},
        {"table_name": "Requests", "folder_name": "R", "is_enabled": False},
    ]
    path.write_text(json.dumps({"settings": entries}))
    assert tables_from_settings(spark, str(path)) == [SourceTable("Users"), SourceTable("Requests", "R", False)]
    assert len(default_tables()) == 60
    assert sum(t.folder is not None for t in default_tables()) == 4


def test_partition_pruning_and_column_pruning(spark, tmp_path):
    path = str(tmp_path / "raw")
    days = spark.range(40).select(
        "id",
        F.lit("x").alias("unused"),
        F.lit(2024).alias("ingestionyear"),
        F.when(F.col("id") < 31, 1).otherwise(2).alias("ingestionmonth"),
        (F.col("id") % 31 + 1).alias("ingestionday"),
    )
    write_partitions(days, path, ["ingestionyear", "ingestionmonth", "ingestionday"])
    raw = read_table(spark, path, columns=["id", "ingestionyear", "ingestionmonth", "ingestionday"])
    pending = days_between(raw, date(2024, 1, 30), date(2024, 2, 2))
    assert rows(pending, "id") == [(30,), (31,), (32,)]
    plan = scans(pending)
    assert "PartitionFilters: [isnotnull" in plan or "PartitionFilters: [(make_date" in plan
    assert "ReadSchema: struct<id:bigint>" in plan
    assert rows(on_day(raw, date(2024, 2, 1)), "id") == [(31,)]
    assert days_between(raw, None, date(2024, 1, 5)).count() == 5


def test_write_partitions_leaves_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitions(frame(spark, "v int, d int", (1, 1), (2, 2)), path, ["d"])
    write_partitions(frame(spark, "v int, d int", (9, 2)), path, ["d"])
    assert rows(spark.read.parquet(path), "v", "d") == [(1, 1), (9, 2)]


def test_write_if_any(spark, tmp_path):
    path = str(tmp_path / "t")
    df = frame(spark, "v int", (1,))
    assert write_if_any(df, path)
    assert not write_if_any(df.where("v > 5"), path)
    assert spark.read.parquet(path).count() == 1


def test_versioned_table_reads_and_replaces_itself(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert not table.exists()
    with pytest.raises(FileNotFoundError):
        table.read()
    table.publish(frame(spark, "v int", (1,)))
    for _ in range(3):
        table.publish(table.read().withColumn("v", F.col("v") + 1))
    assert rows(table.read(), "v") == [(4,)]
    # An unfinished write stays invisible and its number is not used again.
    frame(spark, "v int", (99,)).write.parquet(f"{table.root}/version={9:012d}")
    assert rows(table.read(), "v") == [(4,)]
    assert table.publish(frame(spark, "v int", (5,))) == f"version={10:012d}"
    assert rows(table.read(), "v") == [(5,)]


def test_watermarks(spark, tmp_path):
    marks = Watermarks(spark, str(tmp_path / "marks"))
    assert marks.get("a") is None
    marks.store({"a": date(2024, 1, 1), "b": date(2024, 1, 2), "c": None})
    marks.store({"a": date(2024, 1, 5)})
    assert marks.get_all(["a", "b", "c"]) == {"a": date(2024, 1, 5), "b": date(2024, 1, 2), "c": None}


def test_deletion_log_catches_up_and_moves_the_watermark(spark, tmp_path):
    raw = frame(
        spark,
        "id string, isanonymized string, ingestionyear string, ingestionmonth string, ingestionday string",
        ("a", "1", "2024", "1", "1"),
        ("b", "1", "2024", "1", "2"),
        ("c", "0", "2024", "1", "2"),
        ("d", "1", "2024", "1", "3"),
        ("e", "1", "2024", "1", "4"),
    )
    marks = Watermarks(spark, str(tmp_path / "marks"))
    marks.store({"log": date(2024, 1, 1)})
    path = str(tmp_path / "log")
    update_deletion_log(raw, "accountid", path, marks, "log", date(2024, 1, 3))
    assert rows(spark.read.parquet(path), "accountid", "day") == [("b", 2), ("d", 3)]
    update_deletion_log(raw, "accountid", path, marks, "log", date(2024, 1, 4))
    assert rows(spark.read.parquet(path), "accountid", "day") == [("b", 2), ("d", 3), ("e", 4)]
    assert marks.get("log") == date(2024, 1, 4)


def test_rewrite_partitions_of_the_table_that_is_read(spark, tmp_path):
    path, staging = str(tmp_path / "t"), str(tmp_path / "staging")
    write_partitions(frame(spark, "v int, d int", (1, 1), (2, 2), (3, 2), (3, 3)), path, ["d"])
    df = with_folder(spark.read.parquet(path))
    untouched = (tmp_path / "t" / "d=1").stat().st_mtime_ns
    rewrite_folders(spark, df.where("v <> 3"), df.where("v = 3"), ["d"], staging)
    assert not (tmp_path / "staging").exists()
    assert rows(spark.read.parquet(path), "v", "d") == [(1, 1), (2, 2)]
    assert (tmp_path / "t" / "d=1").stat().st_mtime_ns == untouched
    assert not (tmp_path / "t" / "d=3").exists()


def test_replace_partition_by_no_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitions(frame(spark, "v int, d int", (1, 1), (2, 2)), path, ["d"])
    none = spark.read.parquet(path).where("d = 2 and v > 5")
    replace_partition(spark, path, none, {"d": 2}, str(tmp_path / "staging"))
    assert rows(spark.read.parquet(path), "v", "d") == [(1, 1)]


INGESTED = "id string, customer string, description string, cigcopytime string, ingestionyear int, ingestionmonth int, ingestionday int"


def ingested(spark, path):
    data = [
        ("a", "c1", "one", "2024-01-01 05:00:00", 2024, 1, 1),
        ("a", "c1", "two", "2024-01-02 05:00:00", 2024, 1, 2),
        ("b", "c2", "three", "2024-01-02 05:00:00", 2024, 1, 2),
        ("b", "c2", "four", "2024-01-03 05:00:00", 2024, 1, 3),
    ]
    write_partitions(frame(spark, INGESTED, *data), path, ["ingestionyear", "ingestionmonth", "ingestionday"])


def test_erasure_of_a_stored_table(spark, tmp_path):
    path, marks = str(tmp_path / "raw"), Watermarks(spark, str(tmp_path / "marks"))
    ingested(spark, path)
    log = frame(spark, "accountid string, year int, month int, day int", ("a", 2024, 2, 1), ("b", 2024, 3, 1))
    run = (log, "id", erase_accounts, marks, "erase", date(2024, 2, 10))
    run_erasure(spark, path, *run, str(tmp_path / "s1"))
    kept = [("a", "two", "2024-01-02 05:00:00"), ("b", "four", "2024-01-03 05:00:00"), ("b", "three", "2024-01-02 05:00:00")]
    assert rows(spark.read.parquet(path), "id", "description", "cigcopytime") == kept
    assert marks.get("erase") == date(2024, 2, 10)
    # Nothing is logged since, so nothing is staged.
    run_erasure(spark, path, *run, str(tmp_path / "s2"))
    assert not (tmp_path / "s2").exists()


@pytest.mark.parametrize("change", [erase_accounts, erase_persons])
def test_erasure_keeps_folders_types_and_other_rows(spark, tmp_path, change):
    path, marks = tmp_path / "raw", Watermarks(spark, str(tmp_path / "marks"))
    days = {
        "IngestionYear=2024/IngestionMonth=01/IngestionDay=01": [("a", "2024-01-01"), ("b", "no time")],
        "IngestionYear=2024/IngestionMonth=01/IngestionDay=02": [("a", "2024-01-02"), ("b", "2024-01-02")],
        "IngestionYear=2024/IngestionMonth=01/IngestionDay=__HIVE_DEFAULT_PARTITION__": [("a", "2023-12-31"), ("c", None)],
        "IngestionYear=2024/IngestionMonth=01/IngestionDay=03": [("b", "2024-01-03")],
    }
    for folder, data in days.items():
        frame(spark, "id string, cigcopytime string", *data).coalesce(1).write.parquet(str(path / folder))
    before = (path / "IngestionYear=2024/IngestionMonth=01/IngestionDay=03").stat().st_mtime_ns
    log = frame(spark, "accountid string, year int, month int, day int", ("a", 2024, 2, 1))
    run_erasure(spark, str(path), log, "id", change, marks, "erase", date(2024, 2, 10), str(tmp_path / "s"))
    left = rows(spark.read.parquet(str(path)), "id", "cigcopytime")
    assert left == rows(
        frame(spark, "id string, cigcopytime string", ("a", "2024-01-02"), ("b", "no time"), ("b", "2024-01-02"), ("b", "2024-01-03"), ("c", None)),
        "id", "cigcopytime",
    )
    assert (path / "IngestionYear=2024/IngestionMonth=01/IngestionDay=03").stat().st_mtime_ns == before
    assert not (tmp_path / "s").exists() and sorted(p.name for p in path.iterdir()) == ["IngestionYear=2024"]


def test_masking_of_a_stored_table(spark, tmp_path):
    path = str(tmp_path / "raw")
    ingested(spark, path)
    ids = frame(spark, "accountid string", ("c2",))

    def mask(raw, listed):
        absent = ["chamberofcommerce", "city", "postcode", "dunsnumber", "website"]
        return mask_divisions(raw.withColumns({n: F.lit("x") for n in absent}), listed).drop(*absent)

    rewrite_history(spark, path, ids, "customer", mask, str(tmp_path / "s"))
    assert rows(spark.read.parquet(path), "id", "description") == [("a", "one"), ("a", "two"), ("b", "####"), ("b", "####")]


def test_union_by_name(spark):
    left, right = frame(spark, "a int, b int", (1, 2)), frame(spark, "b int, c int", (3, 4))
    assert rows(union_by_name([left, right]), "a", "b", "c") == [(None, 3, 4), (1, 2, None)]
    with pytest.raises(ValueError):
        union_by_name([])


class Killed(Exception):
    pass


def killed_at(monkeypatch, step):
    """Let the run die before or after its n-th change of the file system; returns the steps seen."""
    seen = []

    def watched(action):
        def run(*args):
            seen.append(action.__name__)
            if len(seen) == (step + 1) // 2 and step % 2:
                raise Killed
            action(*args)
            if len(seen) == step // 2 and not step % 2:
                raise Killed

        return run

    for name in ("move", "remove_folder", "write_text"):
        monkeypatch.setattr(publish, name, watched(getattr(publish, name)))
    return seen


def test_a_rerun_mends_a_rewrite_that_died_at_any_step(spark, tmp_path, monkeypatch):
    wanted = [(1, 1), (2, 2)]
    data = frame(spark, "v int, d int", (1, 1), (2, 2), (3, 2), (3, 3)).coalesce(1)
    outcomes = []
    for step in range(1, 100):
        path, staging = str(tmp_path / f"t{step}"), str(tmp_path / f"staging{step}")
        write_partitions(data, path, ["d"])

        def erase(path=path, staging=staging):
            df = with_folder(spark.read.parquet(path))
            rewrite_folders(spark, df.where("v <> 3"), df.where("v = 3"), ["d"], staging)

        with monkeypatch.context() as patch:
            killed_at(patch, step)
            try:
                erase()
                break
            except Killed:
                pass
        # What the table lacks now is in the staging folder.
        outcomes.append(recover(spark, staging))
        if outcomes[-1] == "finished":
            assert rows(spark.read.parquet(path), "v", "d") == wanted, step
        else:
            assert rows(spark.read.parquet(path), "v", "d") in ([*wanted, (3, 2), (3, 3)], wanted), step
            erase()
        assert rows(spark.read.parquet(path), "v", "d") == wanted, step
        assert not (tmp_path / f"staging{step}").exists()
    assert outcomes.count("finished") >= 6 and outcomes.count("discarded") >= 2


@pytest.mark.parametrize("step", [3, 9, 12])
def test_a_rerun_mends_an_erasure(spark, tmp_path, monkeypatch, step):
    path, staging = str(tmp_path / "raw"), str(tmp_path / "staging")
    ingested(spark, path)
    ids = frame(spark, "id string", ("a",))
    with monkeypatch.context() as patch:
        killed_at(patch, step)
        with pytest.raises(Killed):
            rewrite_history(spark, path, ids, "id", erase_accounts, staging)
    rewrite_history(spark, path, ids, "id", erase_accounts, staging)
    assert rows(spark.read.parquet(path), "id", "description") == [("a", "two"), ("b", "four"), ("b", "three")]


def test_a_replaced_partition_has_all_rows_or_the_old_ones(spark, tmp_path, monkeypatch):
    path, staging = str(tmp_path / "t"), str(tmp_path / "staging")
    write_partitions(frame(spark, "v int, d int", (1, 1), (2, 2), (3, 3)).coalesce(1), path, ["d"])
    assert recover(spark, staging) is None
    for step in (1, 4, 6, 8):
        old = {d: v for v, d in rows(spark.read.parquet(path), "v", "d")}
        with monkeypatch.context() as patch:
            killed_at(patch, step)
            with pytest.raises(Killed):
                replace_partition(spark, path, spark.read.parquet(path).where("d = 2").selectExpr("v + 1 as v", "d"), {"d": 2}, staging)
        outcome = recover(spark, staging)
        assert {d: v for v, d in rows(spark.read.parquet(path), "v", "d")} == {**old, 2: old[2] + (outcome == "finished")}


def test_a_text_file_is_there_as_a_whole_or_not_at_all(spark, tmp_path):
    path = str(tmp_path / "m.json")
    write_text(spark, path, "zwölf")
    assert (tmp_path / "m.json").read_text() == "zwölf" and not (tmp_path / "m.json.draft").exists()
    with pytest.raises(FileExistsError):
        write_text(spark, path, "x")


def drifting(spark, path):
    """Days with other columns and types: numbers, then text and a new column, then bytes, then both in one day."""
    def day_of(number, schema, *data):
        frame(spark, schema, *data).coalesce(1).write.mode("append").parquet(f"{path}/IngestionYear=2024/IngestionMonth=01/IngestionDay=0{number}")

    day_of(1, "id string, cigcopytime string, size int", ("a", "2024-01-01", 1), ("b", "2024-01-01", 2), (None, "2024-01-01", 3))
    day_of(2, "id string, cigcopytime string, size string, newcol string", ("a", "2024-01-02", "x", "na"), ("b", "2024-01-02", "07", "nb"))
    day_of(3, "id string, size binary, cigcopytime string", ("a", bytearray(b"\xff\x00"), "2024-01-03"), ("c", None, "2024-01-03"))
    day_of(4, "id string, cigcopytime string, size long", ("a", "2024-01-04", 1 << 40))
    day_of(4, "id string, cigcopytime string, size string, newcol int", ("b", "2024-01-04", "t", 5), (None, "2024-01-05", "n", 6))
    return path


def test_files_that_differ_are_read_as_one_table(spark, tmp_path):
    path = drifting(spark, str(tmp_path / "raw"))
    table = DriftingTable(spark, path)
    assert len(table.groups) == 5 and len(table.files) == 5
    found = read_drifting(spark, path)
    assert found.columns == ["id", "cigcopytime", "size", "newcol", "IngestionYear", "IngestionMonth", "IngestionDay"]
    assert [(r.id, r.size and bytes(r.size), r.newcol) for r in found.orderBy("IngestionDay", "cigcopytime", "id").collect()] == [
        (None, b"3", None), ("a", b"1", None), ("b", b"2", None), ("a", b"x", "na"), ("b", b"07", "nb"), ("a", b"\xff\x00", None),
        ("c", None, None), ("a", str(1 << 40).encode(), None), ("b", b"t", "5"), (None, b"n", "6"),
    ]
    assert read_drifting(spark, path).where("IngestionDay = 2").count() == 2


def test_columns_are_brought_to_common_types_and_back(spark, tmp_path):
    assert common_type([T.IntegerType(), T.LongType()]) == T.LongType()
    assert common_type([T.FloatType(), T.DoubleType()]) == T.DoubleType()
    assert common_type([T.IntegerType(), T.DoubleType()]) == T.StringType()
    assert common_type([T.StringType(), T.BinaryType(), T.LongType()]) == T.BinaryType()
    path = str(tmp_path / "t")
    kinds = ["array<int>", "struct<x: int>", "double", "date", "boolean", "decimal(5,2)", "timestamp_ntz", "binary", "string"]
    values = ["array(1, null)", "named_struct('x', 3)", "1e-7", "date'2024-02-29'", "true", "1.50", "timestamp_ntz'2024-01-01 00:00:00.000001'", "x'ff00'", "'t'"]
    for number, (kind, value) in enumerate(zip(kinds, values)):
        spark.sql(f"select cast({value} as {kind}) as v, cast(null as {kind}) as n").write.parquet(f"{path}/d={number}")
    table = DriftingTable(spark, path)
    assert len(table.groups) == len(kinds)
    whole = table.rows()
    for number, group in enumerate(table.groups):
        back = table.returned(whole.where(f"_group = {number}"), number)
        stored = table.stored_rows(number)
        assert back.select("v", "n", "d").schema == stored.select("v", "n", "d").schema
        assert back.select("v", "n", "d").collect() == stored.select("v", "n", "d").collect()


def test_erasure_keeps_columns_and_types_of_each_file(spark, tmp_path):
    path, marks = drifting(spark, str(tmp_path / "raw")), Watermarks(spark, str(tmp_path / "marks"))
    log = frame(spark, "accountid string, year int, month int, day int", ("a", 2024, 2, 1))
    index = FileIndex(spark, str(tmp_path / "index"), ["id"])
    assert index.update(DriftingTable(spark, path)) == 5
    run_erasure(spark, path, log, "id", erase_accounts, marks, "erase", date(2024, 2, 10), str(tmp_path / "s"), index)
    table = DriftingTable(spark, path)
    kinds = {tuple(f.simpleString() for f in g.schema if f.name in ("size", "newcol")) for g in table.groups}
    assert kinds == {("size:int",), ("size:string", "newcol:string"), ("size:binary",), ("size:bigint",), ("size:string", "newcol:int")}
    found = sorted(((r.id or "", bytes(r.size or b""), r.newcol or "") for r in table.rows().collect()))
    assert found == [("", b"3", ""), ("", b"n", "6"), ("a", str(1 << 40).encode(), ""), ("b", b"07", "nb"), ("b", b"2", ""), ("b", b"t", "5"), ("c", b"", "")]


def test_erasure_by_another_column_keeps_the_latest_of_rows_without_a_key(spark, tmp_path):
    path = str(tmp_path / "raw")
    schema = "id string, person string, cigcopytime string, ingestionday int"
    data = [(None, "p", "2024-01-01", 1), (None, "p", "2024-01-02", 2), ("k", "p", "2024-01-01", 1), ("k", "q", "2024-01-03", 3), ("z", "q", "2024-01-01", 1)]
    for index in (None, FileIndex(spark, str(tmp_path / "index"), ["id", "person"])):
        frame(spark, schema, *data).write.mode("overwrite").partitionBy("ingestionday").parquet(path)
        if index is not None:
            index.update(DriftingTable(spark, path))
        rewrite_history(spark, path, frame(spark, "personid string", ("p",)), "person", erase_users, str(tmp_path / "s"), index=index)
        assert rows(spark.read.parquet(path), "id", "person", "ingestionday") == [(None, "p", 2), ("k", "q", 3), ("z", "q", 1)]


def test_an_index_opens_few_files(spark, tmp_path):
    path = str(tmp_path / "raw")
    days = spark.range(4_000).select((F.col("id") % 1_000).cast("string").alias("id"), F.col("id").cast("string").alias("cigcopytime"), (F.col("id") % 40).alias("d"))
    days.repartition("d").write.partitionBy("d").parquet(path)
    table = DriftingTable(spark, path)
    index = FileIndex(spark, str(tmp_path / "index"), ["id"])
    assert index.update(table) == 40 and index.update(table) == 0
    ids = frame(spark, "id string", ("5",), ("17",), ("absent",))
    found = index.candidates(table, ids, "id")
    assert sorted(f.split("/d=")[1].split("/")[0] for f in found) == ["17", "5"]
    assert index.candidates(table, ids, "other") == table.files
    # Files the index doesn't know are opened, and merging it changes nothing.
    frame(spark, "id string, cigcopytime string", ("9", "1")).coalesce(1).write.parquet(f"{path}/d=1000")
    grown = DriftingTable(spark, path)
    for _ in range(2):
        assert len(index.candidates(grown, ids, "id")) == 3
        index.merge(grown)
    erased = rows(spark.read.parquet(path).where("id in ('5', '17')"), "id", "cigcopytime")
    untouched = {f: f.stat().st_mtime_ns for f in (tmp_path / "raw").rglob("*.parquet") if f.parent.name not in ("d=5", "d=17")}
    rewrite_history(spark, path, ids, "id", erase_accounts, str(tmp_path / "s"), index=index)
    assert len(erased) == 8 and rows(spark.read.parquet(path).where("id in ('5', '17')"), "id", "cigcopytime") == [("17", "3017"), ("5", "3005")]
    assert {f: f.stat().st_mtime_ns for f in untouched} == untouched and spark.read.parquet(path).count() == 3_995


def test_environments_may_differ_in_types(spark):
    frames = {
        "NL": frame(spark, "id int, timestamp string, price float", (1, "x", 0.5)),
        "BE": frame(spark, "ID string, note binary", ("b", bytearray(b"n"))),
        "FR": frame(spark, "id long, note string, price double", (1 << 40, "t", 0.25)),
    }
    united = snapshot(frames, COPIED)
    assert united.columns == ["id", "price", "environment", "note", "cigcopytime", "cigprocessed"]
    found = sorted((r.environment, r.id, r.price, r.note and bytes(r.note)) for r in united.collect())
    assert found == [("BE", "b", None, b"n"), ("FR", str(1 << 40), 0.25, b"t"), ("NL", "1", 0.5, None)]
    with pytest.raises(ValueError):
        snapshot({}, COPIED)


def test_a_failing_table_neither_stops_nor_hides_the_others(spark, tmp_path):
    source, target = str(tmp_path / "source"), str(tmp_path / "raw")
    for name in ("Users", "Items", "Units"):
        frame(spark, "id string", (name,)).write.parquet(f"{source}/environment=NL/{name}/2024/02/03")
    broken = tmp_path / "source" / "environment=NL" / "Items" / "2024" / "02" / "03"
    for file in broken.glob("*.parquet"):
        file.write_bytes(b"no parquet")
    tables = [SourceTable(n) for n in ("Items", "Users", "Absent", "Units")]
    report = ingest_report(spark, tables, source, target, COPIED, at_once=3)
    assert (report.done, report.without_data, list(report.failed)) == (["Users", "Units"], ["Absent"], ["Items"])
    with pytest.raises(IngestionError, match="1 of the tables failed: Items") as failure:
        ingest_all(spark, tables, source, target, COPIED)
    assert failure.value.report.done == ["Users", "Units"]
    assert rows(spark.read.parquet(f"{target}/Units"), "id") == [("Units",)]
