"""Key events: the first time something happened to an account or division.

All events are found in a few scans, united, and merged into the store once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.fixed_values import (
    CONSULT_ITEM_PATTERN,
    CONSULT_REQUEST_EXCLUDED_STATUS,
    COUNTER_EVENTS,
    FIRST_ACCOUNTANT_LINKED,
    FIRST_CONSULT,
    FIRST_CONSULT_REQUESTED,
    FIRST_MOBILE_USE,
    FIRST_SALES_INVOICE,
    LEGISLATION_STARTUP_TYPE,
    LEGISLATION_TEMPLATE,
    LINKED_STATUS,
    MOBILE_ACTIVITY,
    SUMMED_EVENTS,
)
from tidemark.functions.columns import cast_columns
from tidemark.functions.expressions import ntz, same_keys, zero_if_null
from tidemark.operators.latest import latest_record
from tidemark.sources.buckets import BucketedTable
from tidemark.sources.tables import days_between, union_by_name

DIVISION = ["environment", "divisioncode"]
DAY = ("Year", "Month", "Day")
FIRSTS_ITEM = "KeyEvents_Firsts"
EVENT_KEY = ["accountid", "environment", "key_event", "divisioncode"]
STORE_COLUMNS = [
    "accountid",
    "environment",
    "divisioncode",
    "userid",
    "key_event",
    "key_event_timestamp",
    "inserteddatetime",
]
COUNTER_EVENT_NAMES = tuple(COUNTER_EVENTS)
ALL_EVENTS = (
    *COUNTER_EVENT_NAMES,
    FIRST_CONSULT,
    FIRST_CONSULT_REQUESTED,
    FIRST_MOBILE_USE,
    FIRST_SALES_INVOICE,
    FIRST_ACCOUNTANT_LINKED,
    LEGISLATION_TEMPLATE,
)


@dataclass(frozen=True)
class Bounds:
    """The half-open time window of new events: per event after its watermark,
    up to and including ``until``. An event without watermark has no lower end."""

    until: datetime
    after: Mapping[str, date | datetime | None]

    def hold(self, event: str, moment: Column) -> Column:
        inside = moment <= ntz(self.until)
        start = self.after.get(event)
        return inside if start is None else inside & (moment > ntz(start))


def contract_accounts(summary: DataFrame, accounts: DataFrame) -> DataFrame:
    """Accounts that have a contract summary and still exist."""
    known = accounts.select("accountid")
    return summary.select("environment", "accountcode", "accountid").join(known, "accountid", "left_semi")


def earliest_copy(raw_statistics: DataFrame) -> datetime | None:
    """The first copy time of the raw statistics, the usual upper bound."""
    typed = cast_columns(raw_statistics.select("cigcopytime"), {"timestamp": ["cigcopytime"]})
    return typed.agg(F.min("cigcopytime")).first()[0]


def _counter_condition(event: str, counters: Sequence[str]) -> Column:
    if event in SUMMED_EVENTS:
        return reduce(add, [zero_if_null(c) for c in counters]) > 0
    return reduce(or_, [F.col(c) > 0 for c in counters])


def first_times(
    df: DataFrame, keys: Sequence[str], moment: str, conditions: Mapping[str, Column]
) -> DataFrame:
    """First moment per key and event, for many conditions in one aggregation.

    The columns are keys, ``key_event`` and ``first_time``; events that never
    happened to a key are left out.
    """
    numbered = list(conditions.items())
    firsts = df.groupBy(*keys).agg(
        *[F.min(F.when(c, F.col(moment))).alias(f"_first{i}") for i, (_, c) in enumerate(numbered)]
    )
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("key_event"), F.col(f"_first{i}").alias("first_time"))
            for i, (name, _) in enumerate(numbered)
        ]
    )
    return firsts.select(*keys, F.inline(pairs)).where(F.col("first_time").isNotNull())


def advance_firsts(firsts: BucketedTable, pending: DataFrame, moment: str, conditions: Mapping[str, Column]) -> None:
    """Bring the stored first moments up to date with rows that came since.

    The state has one row per division and event. Only divisions with something earlier than
    known are written.
    """
    new = first_times(pending, DIVISION, moment, conditions)
    known = firsts.read()
    if known is not None:
        keys = [*DIVISION, "key_event"]
        old = known.select(*[F.col(c).alias(f"_old_{c}") for c in (*keys, "first_time")])
        joined = new.join(old, same_keys(new, old, keys, "_old_"), "left")
        earlier = F.col("_old_first_time").isNull() | (F.col("first_time") < F.col("_old_first_time"))
        new = joined.where(earlier).select(new.columns)
    firsts.upsert(new)


def firsts_table(spark: SparkSession, root: str, buckets: int = 64) -> BucketedTable:
    """The stored first moments of divisions."""
    return BucketedTable(spark, root, [*DIVISION, "key_event"], buckets)


def within(firsts: DataFrame, bounds: Bounds, events: Sequence[str]) -> DataFrame:
    """Keep the firsts that lie in the window of their event."""
    name, moment = F.col("key_event"), F.col("first_time")
    inside = [(name == event) & bounds.hold(event, moment) for event in events]
    return firsts.where(reduce(or_, inside))


def _store_rows(events: DataFrame, today: date) -> DataFrame:
    """Bring events to the columns of the store, one row per event."""
    have = set(events.columns)
    absent = {
        name: F.lit(None).cast("string")
        for name in ("environment", "divisioncode", "userid")
        if name not in have
    }
    return (
        events.withColumns(absent)
        .withColumns({"divisioncode": F.col("divisioncode").cast("string"), "inserteddatetime": F.lit(today)})
        .select(*STORE_COLUMNS)
        .distinct()
    )


def division_events(
    firsts: DataFrame,
    events: Sequence[str],
    divisions: DataFrame,
    contracts: DataFrame,
    bounds: Bounds,
    today: date,
) -> DataFrame:
    """First moments of divisions as events of the contract accounts that own them.

    ``firsts`` has one row per division and event; an account with very many divisions is split by
    Spark's handling of skewed joins.
    """
    owned = within(firsts, bounds, events).join(divisions.select(*DIVISION, "accountid"), DIVISION).select(
        "accountid", "divisioncode", "key_event", F.col("first_time").alias("key_event_timestamp")
    )
    owners = contracts.select("accountid", "environment").distinct()
    return _store_rows(owned.join(owners, "accountid"), today)


def counter_conditions() -> dict[str, Column]:
    """When a daily row counts for an event."""
    return {event: _counter_condition(event, counters) for event, counters in COUNTER_EVENTS.items()}


def counter_events(
    daily: DataFrame,
    divisions: DataFrame,
    contracts: DataFrame,
    bounds: Bounds,
    today: date,
    firsts: DataFrame | None = None,
) -> DataFrame:
    """All events taken from positive daily counters: in one scan, or from stored first moments.

    The statistics shrink to one row per division before any join.
    """
    if firsts is None:
        firsts = first_times(daily, DIVISION, "date", counter_conditions())
    return division_events(firsts, COUNTER_EVENT_NAMES, divisions, contracts, bounds, today)


def sales_invoice_events(
    summary: DataFrame, divisions: DataFrame, contracts: DataFrame, bounds: Bounds, today: date
) -> DataFrame:
    """First sales invoice, as the summary table states it."""
    stated = {FIRST_SALES_INVOICE: F.col("salesinvoicefirstdate").isNotNull()}
    firsts = first_times(summary, DIVISION, "salesinvoicefirstdate", stated)
    return division_events(firsts, [FIRST_SALES_INVOICE], divisions, contracts, bounds, today)


def consult_events(
    time_entries: DataFrame,
    items: DataFrame,
    accounts: DataFrame,
    contracts: DataFrame,
    bounds: Bounds,
    today: date,
    pattern: str = CONSULT_ITEM_PATTERN,
) -> DataFrame:
    """First time entry per account on a consultancy item."""
    wanted = items.where(F.col("itemcode").like(pattern)).select("itemid")
    per_item = time_entries.groupBy("itemid", "accountid").agg(F.min("date").alias("date"))
    firsts = (
        per_item.join(wanted, "itemid", "left_semi")
        .groupBy("accountid")
        .agg(F.min("date").alias("first_time"))
    )
    located = firsts.join(accounts.select("accountid", "environment").distinct(), "accountid")
    named = within(located.withColumn("key_event", F.lit(FIRST_CONSULT)), bounds, [FIRST_CONSULT])
    owners = contracts.select("accountid", "environment").distinct()
    events = named.join(owners, ["accountid", "environment"], "left_semi")
    return _store_rows(events.withColumnRenamed("first_time", "key_event_timestamp"), today)


def consult_request_events(requests: DataFrame, contracts: DataFrame, today: date) -> DataFrame:
    """First consultancy request per account that was not cancelled; no time window."""
    firsts = (
        requests.where(F.col("status") != CONSULT_REQUEST_EXCLUDED_STATUS)
        .groupBy("environment", "accountid")
        .agg(F.min("created").alias("key_event_timestamp"))
    )
    owners = contracts.select("accountid", "environment").distinct()
    events = firsts.join(owners, ["accountid", "environment"], "left_semi")
    return _store_rows(events.withColumn("key_event", F.lit(FIRST_CONSULT_REQUESTED)), today)


def mobile_use_events(
    activity: DataFrame, contracts: DataFrame, today: date, activity_id: str = MOBILE_ACTIVITY
) -> DataFrame:
    """First day with the mobile activity per account; no time window."""
    firsts = (
        activity.where(F.col("activityid") == activity_id)
        .groupBy("accountid")
        .agg(F.min("date").alias("key_event_timestamp"))
    )
    events = firsts.join(contracts.select("accountid"), "accountid", "left_semi")
    return _store_rows(events.withColumn("key_event", F.lit(FIRST_MOBILE_USE)), today)


def accountant_linked_events(
    links: DataFrame, contracts: DataFrame, today: date, status: str = LINKED_STATUS
) -> DataFrame:
    """First day an accountant was linked per account; no time window."""
    firsts = (
        links.where(F.col("linkstatus") == status)
        .groupBy("environment", "accountcode")
        .agg(F.min("date").alias("first_time"))
    )
    codes = contracts.select("environment", "accountcode", "accountid").distinct()
    events = (
        firsts.join(codes, ["environment", "accountcode"])
        .groupBy("accountid")
        .agg(F.min("first_time").alias("key_event_timestamp"))
    )
    return _store_rows(events.withColumn("key_event", F.lit(FIRST_ACCOUNTANT_LINKED)), today)


def legislation_events(
    divisions: DataFrame,
    summary: DataFrame,
    bounds: Bounds,
    today: date,
    startup_type: str = LEGISLATION_STARTUP_TYPE,
    tie_breakers: Sequence[str] = ("divisioncode desc", "environment"),
) -> DataFrame:
    """Accounts whose newest division started from a legislation template.

    The newest division is chosen first and tested afterwards.
    """
    known = divisions.select(*DIVISION, "accountid", "syscreated").join(
        summary.select(*DIVISION, "startuptype"), DIVISION
    )
    newest = latest_record(known, ["accountid"], ["syscreated desc", *tie_breakers])
    events = newest.where(
        (F.col("startuptype") == startup_type)
        & bounds.hold(LEGISLATION_TEMPLATE, F.col("syscreated"))
    )
    return _store_rows(
        events.select(
            "accountid",
            *DIVISION,
            F.lit(LEGISLATION_TEMPLATE).alias("key_event"),
            F.col("syscreated").alias("key_event_timestamp"),
        ),
        today,
    )


def merge_events(
    store: DataFrame,
    new: DataFrame,
    events: Sequence[str] = ALL_EVENTS,
    keep: str = "latest",
) -> DataFrame:
    """Add new events to the store and leave one row per key of the named events.

    Rows of other events pass unchanged and unshuffled. ``keep="first"`` holds
    on to the earliest time instead of the latest.
    """
    named = F.col("key_event").isin(*events)
    others = store.where(~named | F.col("key_event").isNull())
    united = store.where(named).unionByName(new)
    time = F.col("key_event_timestamp").desc() if keep == "latest" else F.col("key_event_timestamp").asc()
    merged = latest_record(united, EVENT_KEY, [time, "inserteddatetime", "userid"])
    return others.unionByName(merged)


def event_watermarks(store: DataFrame, events: Sequence[str] = ALL_EVENTS) -> dict[str, date | None]:
    """The day of the newest time per event; events without rows have no entry."""
    rows = (
        store.where(F.col("key_event").isin(*events))
        .groupBy("key_event")
        .agg(F.to_date(F.max("key_event_timestamp")).alias("day"))
        .collect()
    )
    return {row["key_event"]: row["day"] for row in rows}


@dataclass(frozen=True)
class EventSources:
    """The tables that key events are found in."""

    daily: DataFrame
    summary: DataFrame
    divisions: DataFrame
    accounts: DataFrame
    contract_summary: DataFrame
    time_entries: DataFrame
    items: DataFrame
    consult_requests: DataFrame
    activity: DataFrame
    accountant_links: DataFrame


def key_events(
    sources: EventSources, bounds: Bounds, today: date, firsts: DataFrame | None = None
) -> DataFrame:
    """All new key events.

    With ``firsts``, the stored first moments that ``advance_firsts`` keeps, the daily table isn't read.
    """
    s = sources
    contracts = contract_accounts(s.contract_summary, s.accounts)
    return union_by_name(
        [
            counter_events(s.daily, s.divisions, contracts, bounds, today, firsts),
            sales_invoice_events(s.summary, s.divisions, contracts, bounds, today),
            consult_events(s.time_entries, s.items, s.accounts, contracts, bounds, today),
            consult_request_events(s.consult_requests, contracts, today),
            mobile_use_events(s.activity, contracts, today),
            accountant_linked_events(s.accountant_links, contracts, today),
            legislation_events(s.divisions, s.summary, bounds, today),
        ]
    )


def update_store(
    store, watermarks, sources: EventSources, until: datetime, today: date, firsts: BucketedTable | None = None
) -> None:
    """Find, merge and publish new events, then advance the watermarks.

    ``store`` is the versioned table of events, ``watermarks`` the watermark table. With ``firsts`` only
    the days of the daily table since the last run are read: its day columns are ``DAY``.
    """
    bounds = Bounds(until, watermarks.get_all(list(ALL_EVENTS)))
    known = None
    if firsts is not None:
        pending = days_between(sources.daily, watermarks.get(FIRSTS_ITEM), until.date(), DAY)
        advance_firsts(firsts, pending, "date", counter_conditions())
        known = firsts.read()
    store.publish(merge_events(store.read(), key_events(sources, bounds, today, known)))
    watermarks.store({**event_watermarks(store.read()), **({FIRSTS_ITEM: until.date()} if firsts is not None else {})})
