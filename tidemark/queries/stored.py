"""Sinks, ingestion, erasure and incremental jobs on the test tables, through stored tables.

Each query stores what it derives from the given tables in a folder of its own in the shared checkpoint
folder, runs the job on it, and reads the result back.
"""

from __future__ import annotations

import json
import uuid
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.skew import salted_join
from tidemark.plans.jobs import changes_state, run_newest_changes, run_summary_buckets
from tidemark.plans.key_events import EventSources, advance_firsts, counter_conditions, firsts_table, key_events
from tidemark.plans.ownership import month_end_owner
from tidemark.plans.privacy import erase_accounts, mask_divisions, rewrite_history, stale_history_files
from tidemark.plans.requests import latest_requests, request_table, requests_from_settings
from tidemark.queries.events import BOUNDS, EVERY_EVENT, EVENT_VIEWS, TODAY
from tidemark.queries.history import (
    COMPARED,
    EVENTS_DAY,
    ORACLES as HISTORY_SQL,
    ORDERS_TODAY,
    SUMMARY_UNTIL,
    raw_for_summary,
    summary_before,
)
from tidemark.queries.views import oracle, table, view
from tidemark.session import checkpoint_folder
from tidemark.sources.buckets import BucketedTable
from tidemark.sources.drift import DriftingTable, read_drifting
from tidemark.sources.file_index import FileIndex
from tidemark.sources.files import write_text
from tidemark.sources.ingest import ingest_report, tables_from_settings
from tidemark.sources.publish import replace_partition
from tidemark.sources.sinks import VersionedTable, Watermarks, write_if_any, write_partitions, write_table
from tidemark.sources.tables import days_between, newest_day, read_table

INGESTED = ["ingestionyear", "ingestionmonth", "ingestionday"]
DAY_PARTS = ["Year", "Month", "Day"]


def scratch(spark: SparkSession) -> str:
    """A new folder that all executors share."""
    return f"{checkpoint_folder(spark)}/query-{uuid.uuid4().hex}"


def overwritten_table(spark, sf_dir):
    path = f"{scratch(spark)}/t"
    write_table(table(spark, sf_dir, "orders").select("o_orderkey"), path)
    write_table(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), path, files=3)
    return spark.read.parquet(path)


def overwritten_partition(spark, sf_dir):
    """All orders by status; the open ones are replaced by those of priority one, computed from the table itself."""
    root = scratch(spark)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    write_partitions(orders, f"{root}/t", ["o_orderstatus"])
    urgent = spark.read.parquet(f"{root}/t").where("o_orderstatus = 'O' and o_orderpriority = '1-URGENT'")
    replace_partition(spark, f"{root}/t", urgent, {"o_orderstatus": "O"}, f"{root}/staging")
    write_partitions(orders.where("o_orderstatus = 'P'").withColumn("o_orderpriority", F.lit("none")), f"{root}/t", ["o_orderstatus"])
    return spark.read.parquet(f"{root}/t")


def published_versions(spark, sf_dir):
    """A table read and replaced by the same job, twice."""
    versions = VersionedTable(spark, scratch(spark))
    versions.publish(table(spark, sf_dir, "part").select("p_partkey", "p_size"))
    for _ in range(2):
        versions.publish(versions.read().withColumn("p_size", F.col("p_size") + 1))
    versions.vacuum(keep=1)
    return versions.read()


def written_if_any(spark, sf_dir):
    """An empty result leaves the old output."""
    path = f"{scratch(spark)}/t"
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    first = write_if_any(suppliers, path)
    second = write_if_any(suppliers.where("s_acctbal is null and s_acctbal > 0"), path)
    return spark.read.parquet(path).withColumns({"first": F.lit(first), "second": F.lit(second)})


def stored_watermarks(spark, sf_dir):
    """The newest day of each kind of event, advanced in two steps."""
    marks = Watermarks(spark, scratch(spark))
    events = table(spark, sf_dir, "events")
    for until in (date(2024, 1, 10), date(2024, 12, 31)):
        days = events.where(F.to_date("ts") <= F.lit(until)).groupBy("event_type").agg(F.max(F.to_date("ts")))
        marks.store({kind: day for kind, day in days.collect()})
    return marks.table.read()


def catalog_scan(spark, sf_dir):
    """A table read by its name, pruned to two columns and a condition."""
    name = f"customers_{uuid.uuid4().hex}"
    table(spark, sf_dir, "customer").createOrReplaceTempView(name)
    return read_table(spark, name, columns=["c_custkey", "c_mktsegment"], where="c_acctbal > 0")


ENVIRONMENT_OF_REGION = {0: "NL", 1: "US", 2: "BE"}


def ingested_environments(spark, sf_dir):
    """Tables named by a settings file, some delivered by a few environments only, one not at all."""
    root, copied = scratch(spark), datetime(2024, 3, 5, 6)
    nations = table(spark, sf_dir, "nation")
    for region, environment in ENVIRONMENT_OF_REGION.items():
        rows = nations.where(F.col("n_regionkey") == region).select("n_nationkey", "n_name")
        rows = rows.withColumn("extra", F.col("n_nationkey") * 2) if environment == "BE" else rows
        rows.write.parquet(f"{root}/source/environment={environment}/CIG_Nations/2024/03/05")
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("n_nationkey"), F.col("s_name").alias("n_name"))
    suppliers.write.parquet(f"{root}/source/environment=US/Suppliers/2024/03/05")
    suppliers.write.parquet(f"{root}/source/environment=NL/Suppliers/2024/03/04")
    entries = [("Nations", "CIG_Nations", True), ("Suppliers", None, True), ("Absent", None, True), ("Off", None, False)]
    settings = [{"table_name": n, "is_enabled": on, **({"folder_name": f} if f else {})} for n, f, on in entries]
    write_text(spark, f"{root}/settings.json", json.dumps({"settings": settings}))
    wanted = tables_from_settings(spark, f"{root}/settings.json")
    report = ingest_report(spark, wanted, f"{root}/source", f"{root}/raw", copied)
    if report.failed:
        raise next(iter(report.failed.values()))
    frames = [spark.read.parquet(f"{root}/raw/{name}").withColumn("table", F.lit(name)) for name in sorted(report.done)]
    return frames[0].unionByName(frames[1], allowMissingColumns=True)


def requests_by_settings(spark, sf_dir):
    """Two kinds of requests as a settings file describes them."""
    root = scratch(spark)
    kind = {"columns_to_drop": [], "timestamp_columns": [], "integer_columns": ["urgency"], "double_cols": ["total"], "date_columns": ["created"], "boolean_cols": []}
    wanted = ["id", "requestcode", "urgency", "total", "created"]
    settings = [
        {"name": name, "filter_condition": f"status = '{status}'", "columns_to_select": wanted, "columns_to_rename": {"amount": "total"}, "s3_destination": f"{root}/{name}", **kind}
        for name, status in (("closed", "F"), ("open", "O"))
    ]
    write_text(spark, f"{root}/settings.json", json.dumps({"settings": settings}))
    raw = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderkey").cast("string").alias("requesthid"),
        F.substring("o_orderpriority", 1, 1).alias("urgency"),
        F.concat(F.lit(" "), F.col("o_totalprice").cast("string")).alias("amount"),
        F.to_date("o_orderdate").cast("string").alias("created"),
        F.format_string("%012d", "o_orderkey").alias("cigcopytime"),
        F.lit("NL").alias("environment"),
    )
    tables = requests_from_settings(spark, f"{root}/settings.json")
    latest = latest_requests(raw, tables)
    frames = [request_table(latest, t).withColumn("kind", F.lit(t.name)) for t in tables]
    return frames[0].unionByName(frames[1])


def _day_parts(moment) -> dict:
    return dict(zip(INGESTED, (F.year(moment), F.month(moment), F.dayofmonth(moment))))


def _stored_event_days(spark, sf_dir) -> str:
    """Events by day in files that differ: early days have whole numbers as values and no source,
    later ones text, the last ones bytes of text."""
    path = f"{scratch(spark)}/raw"
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    rows = events.select(
        F.col("user_id").alias("id"), "event_id", F.col("ts").cast("string").alias("cigcopytime"), "day",
        F.concat(F.lit("c"), (F.col("user_id") % 30).cast("string")).alias("customer"),
        F.col("event_id").cast("int").alias("note"), "event_type", *[v.alias(n) for n, v in _day_parts("day").items()],
    )
    early, middle = F.col("day") < F.lit(date(2024, 1, 10)), F.col("day") < F.lit(date(2024, 1, 20))
    parts = (
        rows.where(early).drop("event_type", "day"),
        rows.where(~early & middle).withColumn("note", F.col("note").cast("string")).drop("day"),
        rows.where(~middle).withColumn("note", F.col("note").cast("string").cast("binary")).drop("day"),
    )
    for part in parts:
        part.repartition(*INGESTED).write.mode("append").partitionBy(*INGESTED).parquet(path)
    return path


def _as_text(rows: DataFrame) -> DataFrame:
    return rows.withColumn("note", F.col("note").cast("string")).drop(*INGESTED)


def drifting_days(spark, sf_dir):
    """Days whose files differ in columns and types, as one table."""
    return _as_text(read_drifting(spark, _stored_event_days(spark, sf_dir)))


def _toxic_ids(spark, sf_dir):
    return table(spark, sf_dir, "labels").where("toxic = 1").select((F.col("doc_id") % 150).alias("id"))


def erased_in_place(spark, sf_dir):
    """Erasure of a stored table whose files differ, by an index of the ids of each file."""
    path = _stored_event_days(spark, sf_dir)
    index = FileIndex(spark, f"{path}.index", ["id"])
    index.update(DriftingTable(spark, path))
    ids = _toxic_ids(spark, sf_dir)
    rewrite_history(spark, path, ids, "id", lambda raw, listed: erase_accounts(raw, listed, ["event_id desc"]), f"{path}.staging", index=index)
    return _as_text(read_drifting(spark, path))


def masked_in_place(spark, sf_dir):
    path = _stored_event_days(spark, sf_dir)
    owners = table(spark, sf_dir, "labels").where("toxic = 1").select(F.concat(F.lit("c"), (F.col("doc_id") % 30).cast("string")))

    def mask(raw, listed):
        absent = ["description", "chamberofcommerce", "city", "postcode", "dunsnumber", "website"]
        added = raw.withColumns({n: F.lit("x") for n in absent if n not in raw.columns} | {"description": F.coalesce("event_type", F.lit("x"))})
        masked = mask_divisions(added, listed)
        return masked.withColumn("event_type", F.when(F.col("description") == "####", F.col("description")).otherwise(F.col("event_type"))).select(*raw.columns)

    rewrite_history(spark, path, owners, "customer", mask, f"{path}.staging")
    return _as_text(read_drifting(spark, path))


def stale_day_files(spark, sf_dir):
    """The day folders with rows that an erasure has to remove."""
    path = f"{scratch(spark)}/raw"
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    rows = events.select(F.col("user_id").alias("id"), "event_id", F.col("ts").alias("cigcopytime"), "day")
    rows.repartition("day").write.partitionBy("day").parquet(path)
    files = stale_history_files(spark.read.parquet(path), _toxic_ids(spark, sf_dir), ties=["event_id desc"])
    return files.select(F.regexp_extract("path", "day=([0-9-]+)/", 1).alias("day")).distinct()


def _stored_daily(spark, rows: DataFrame, delivered=None) -> str:
    """Rows in the folder of the day they were delivered on, their own day unless it is given."""
    path = f"{scratch(spark)}/daily"
    day = F.col("date") if delivered is None else delivered
    parts = dict(zip(DAY_PARTS, (F.year(day), F.month(day), F.dayofmonth(day))))
    rows.withColumns(parts).repartition(*DAY_PARTS).write.partitionBy(*DAY_PARTS).parquet(path)
    return path


def changes_of_newest_day(spark, sf_dir):
    """Day by day changes from the newest partition and the stored last rows: a first run on the
    days but the last two, then one that has a day to catch up on."""
    daily = view(spark, sf_dir, "d_statistics").select(
        "environment", F.col("division").alias("divisioncode"), F.to_date("cigcopytime").alias("date"), *COMPARED
    )
    path = _stored_daily(spark, daily)
    newest = newest_day(spark, path, DAY_PARTS)
    state = changes_state(spark, f"{path}.state", 8)
    marks = Watermarks(spark, f"{path}.marks")
    early = f"{path}.early"
    cut = newest - timedelta(days=2)
    days_between(spark.read.parquet(path), None, cut, DAY_PARTS).repartition(*DAY_PARTS).write.partitionBy(*DAY_PARTS).parquet(early)
    run_newest_changes(spark, early, f"{path}.changes", state, marks, COMPARED)
    run_newest_changes(spark, path, f"{path}.changes", state, marks, COMPARED)
    return spark.read.parquet(f"{path}.changes").where(F.col("Date") == F.lit(newest)).withColumnRenamed("Date", "date")


def summary_in_buckets(spark, sf_dir):
    """The summary upsert on a table in buckets."""
    root = scratch(spark)
    summary = BucketedTable(spark, f"{root}/summary", ["environment", "divisioncode"], 8)
    summary.replace(summary_before(spark, sf_dir))
    marks = Watermarks(spark, f"{root}/marks")
    marks.store({"DivisionStatistics_Summary": SUMMARY_UNTIL})
    run_summary_buckets(raw_for_summary(spark, sf_dir), summary, marks, EVENTS_DAY)
    return summary.read()


def events_from_stored_firsts(spark, sf_dir):
    """All key events, the counters from stored first moments that were brought up to date in three
    steps; the rows of a month are delivered at its end."""
    path = _stored_daily(spark, view(spark, sf_dir, "d_daily"), F.last_day("date"))
    firsts = firsts_table(spark, f"{path}.firsts", 8)
    daily, after = spark.read.parquet(path), None
    for until in (date(2013, 6, 30), date(2015, 1, 31), BOUNDS.until.date()):
        advance_firsts(firsts, days_between(daily, after, until, DAY_PARTS), "date", counter_conditions())
        after = until
    sources = EventSources(daily, *[view(spark, sf_dir, name) for name in EVENT_VIEWS[1:]])
    return key_events(sources, BOUNDS, TODAY, firsts.read())


def owner_at_week_end(spark, sf_dir):
    """Owners at the last day of every week of the calendar."""
    orders = table(spark, sf_dir, "orders")
    day = F.to_date("o_orderdate")
    history = orders.select(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("accountant"), F.col("o_orderdate").alias("cigcopytime"), "o_orderkey")
    calendar = orders.agg(F.explode(F.sequence(F.min(day), F.max(day))).alias("calendardate"))
    calendar = calendar.withColumn("week", F.trunc("calendardate", "week"))
    return month_end_owner(history, calendar, ORDERS_TODAY, ["o_orderkey"], period="week")


def orders_with_customer_salted(spark, sf_dir):
    """Customers with over ten orders are spread over several tasks."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    owners = customer.withColumnRenamed("c_custkey", "o_custkey").select("o_custkey", "c_mktsegment")
    return salted_join(orders.select("o_custkey", "o_orderkey", "o_totalprice"), owners, ["o_custkey"], task_rows=10)


QUERIES = {
    "overwrite_table": overwritten_table,
    "overwrite_partition": overwritten_partition,
    "publish_versions": published_versions,
    "write_if_any": written_if_any,
    "watermarks": stored_watermarks,
    "catalog_scan": catalog_scan,
    "ingest_environments": ingested_environments,
    "requests_by_settings": requests_by_settings,
    "drifting_days": drifting_days,
    "erase_in_place": erased_in_place,
    "mask_in_place": masked_in_place,
    "stale_day_files": stale_day_files,
    "daily_changes_newest": changes_of_newest_day,
    "summary_in_buckets": summary_in_buckets,
    "key_events_incremental": events_from_stored_firsts,
    "week_end_owner": owner_at_week_end,
    "salted_join_hot": orders_with_customer_salted,
}

_DRIFTED = """(select user_id as id, event_id, cast(ts as varchar) as cigcopytime, 'c' || (user_id % 30) as customer,
    cast(event_id as varchar) as note, case when cast(ts as date) >= date '2024-01-10' then event_type end as event_type,
    row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) d"""
_DRIFT_COLUMNS = "id, event_id, cigcopytime, customer, note"
_TOXIC = "(select doc_id % {n} from labels where toxic = 1)"

ORACLES = {
    "overwrite_table": "select c_custkey, c_name from customer",
    "overwrite_partition": """
        select o_orderkey, case when o_orderstatus = 'P' then 'none' else o_orderpriority end as o_orderpriority, o_orderstatus
        from orders where o_orderstatus <> 'O' or o_orderpriority = '1-URGENT'""",
    "publish_versions": "select p_partkey, p_size + 2 as p_size from part",
    "write_if_any": "select s_suppkey, s_acctbal, true as first, false as second from supplier",
    "watermarks": "select event_type as item, max(cast(ts as date)) as last_updated from events group by event_type",
    "catalog_scan": "select c_custkey, c_mktsegment from customer where c_acctbal > 0",
    "ingest_environments": """
        with delivered as (
            select n_nationkey, n_name, case n_regionkey when 0 then 'NL' when 1 then 'US' else 'BE' end as environment,
                   case when n_regionkey = 2 then n_nationkey * 2 end as extra, 'Nations' as "table"
            from nation where n_regionkey < 3
            union all
            select s_suppkey, s_name, 'US', null, 'Suppliers' from supplier)
        select *, '2024-03-05 06:00:00' as cigcopytime, 'False' as cigprocessed,
               2024 as "IngestionYear", 3 as "IngestionMonth", 5 as "IngestionDay" from delivered""",
    "requests_by_settings": """
        select cast(o_custkey as varchar) as id,
               substring(lpad(cast(o_orderkey as varchar), 8, '0'), 1, 2) || '.' || substring(lpad(cast(o_orderkey as varchar), 8, '0'), 3, 3)
               || '.' || substring(lpad(cast(o_orderkey as varchar), 8, '0'), 6, 3) as requestcode,
               cast(substring(o_orderpriority, 1, 1) as integer) as urgency, o_totalprice as total,
               cast(o_orderdate as date) as created, case o_orderstatus when 'F' then 'closed' else 'open' end as kind
        from orders where o_orderstatus in ('F', 'O')
        qualify row_number() over (partition by o_custkey, o_orderstatus order by o_orderkey desc) = 1""",
    "drifting_days": f"select {_DRIFT_COLUMNS}, event_type from {_DRIFTED}",
    "erase_in_place": f"select {_DRIFT_COLUMNS}, event_type from {_DRIFTED} where rn = 1 or id not in {_TOXIC.format(n=150)}",
    "mask_in_place": f"""select {_DRIFT_COLUMNS}, case when cast(cigcopytime as date) < date '2024-01-10' then null
        when customer in (select 'c' || (doc_id % 30) from labels where toxic = 1) then '####' else event_type end as event_type
        from {_DRIFTED}""",
    "stale_day_files": f"""
        select distinct cast(cast(ts as date) as varchar) as day from (
            select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) r
        where rn > 1 and user_id in {_TOXIC.format(n=150)}""",
    "daily_changes_newest": HISTORY_SQL["daily_changes"],
    "summary_in_buckets": HISTORY_SQL["summary_upsert"],
    "key_events_incremental": EVERY_EVENT,
    "week_end_owner": HISTORY_SQL["month_end_owner"].replace("date_trunc('month', d)", "date_trunc('week', d)"),
    "salted_join_hot": """select o_custkey, o_orderkey, o_totalprice, c_mktsegment
        from orders join customer on o_custkey = c_custkey""",
}
