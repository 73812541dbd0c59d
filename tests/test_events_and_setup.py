from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.frames import day, frame, rows, time
from tidemark.plans import setup as rules
from tidemark.plans.key_events import (
    ALL_EVENTS,
    Bounds,
    EventSources,
    STORE_COLUMNS,
    advance_firsts,
    contract_accounts,
    counter_conditions,
    counter_events,
    earliest_copy,
    event_watermarks,
    first_times,
    firsts_table,
    legislation_events,
    merge_events,
    update_store,
)
from tidemark.sources.sinks import VersionedTable, Watermarks
from tidemark.sources.tables import days_between

TODAY = date(2024, 6, 1)
STORE = (
    "accountid string, environment string, divisioncode string, userid string, key_event string,"
    " key_event_timestamp timestamp_ntz, inserteddatetime date"
)
COUNTERS = (
    "accountcount ingbankaccounts rabobankaccounts abnamrobankaccounts bankentrycountmanual automaticbanklink"
    " banktransactionsimport opportunitycount projecttypefixedprice projecttypetimeandmaterial"
    " projecttypenonbillable projecttypeprepaidhtb projecttypeprepaidretainer projectsalesinvoices"
    " purchaseentrycount projecttotaltimeentries"
).split()


def daily(spark, *data):
    """Rows of (division, day, counters by name)."""
    schema = "environment string, divisioncode int, date date, " + ", ".join(f"{c} int" for c in COUNTERS)
    return frame(spark, schema, *[("NL", d, day(t), *[v.get(c) for c in COUNTERS]) for d, t, v in data])


@pytest.fixture
def divisions(spark):
    return frame(
        spark,
        "environment string, divisioncode int, accountid string, syscreated timestamp_ntz",
        ("NL", 1, "a", time("2024-01-01")),
        ("NL", 2, "a", time("2024-02-01")),
        ("NL", 3, "b", time("2024-01-01")),
    )


@pytest.fixture
def contracts(spark):
    summary = frame(
        spark,
        "environment string, accountcode string, accountid string",
        ("NL", "ca", "a"),
        ("BE", "ca2", "a"),
        ("NL", "cc", "gone"),
    )
    accounts = frame(spark, "accountid string, environment string", ("a", "NL"), ("a", "BE"), ("b", "NL"))
    return contract_accounts(summary, accounts)


def test_counter_events_are_bounded_per_event(spark, divisions, contracts):
    table = daily(
        spark,
        (1, "2024-01-05", {"accountcount": 1, "ingbankaccounts": 0, "abnamrobankaccounts": 2}),
        (1, "2024-01-01", {"accountcount": 0, "rabobankaccounts": None}),
        (2, "2024-01-03", {"accountcount": 1}),
        (2, "2024-03-01", {"projecttypenonbillable": 1}),
        (3, "2024-01-05", {"accountcount": 1}),
    )
    bounds = Bounds(datetime(2024, 2, 1), {"First Account Card": date(2024, 1, 3)})
    found = counter_events(table, divisions, contracts, bounds, TODAY)
    assert found.columns == STORE_COLUMNS
    assert rows(found, "key_event", "accountid", "environment", "divisioncode", "key_event_timestamp") == [
        ("First Account Card", "a", "BE", "1", day("2024-01-05")),
        ("First Account Card", "a", "NL", "1", day("2024-01-05")),
        ("First Bank Account", "a", "BE", "1", day("2024-01-05")),
        ("First Bank Account", "a", "NL", "1", day("2024-01-05")),
    ]


def test_project_counters_are_added_up(spark, divisions, contracts):
    table = daily(
        spark,
        (1, "2024-01-05", {"projecttypefixedprice": 1, "projecttypenonbillable": -1}),
        (2, "2024-01-06", {"projecttypefixedprice": None, "projecttypeprepaidhtb": 1}),
    )
    found = counter_events(table, divisions, contracts, Bounds(datetime(2024, 2, 1), {}), TODAY)
    assert rows(found.where("environment = 'NL'"), "key_event", "divisioncode") == [("First Project", "2")]


def test_newest_division_is_chosen_before_it_is_tested(spark, divisions):
    summary = frame(
        spark,
        "environment string, divisioncode int, startuptype string",
        ("NL", 1, "X"),
        ("NL", 2, "E"),
        ("NL", 3, "X"),
    )
    found = legislation_events(divisions, summary, Bounds(datetime(2024, 3, 1), {}), TODAY)
    assert rows(found, "accountid", "divisioncode") == [("b", "3")]


def stored(account, event, moment, division=None):
    return (account, "NL", division, None, event, time(moment), TODAY)


def test_merge_keeps_the_latest_of_named_events_only(spark):
    store = frame(
        spark,
        STORE,
        stored("a", "First Consult", "2024-01-01"),
        stored("a", "Other", "2024-01-01"),
        stored("a", "Other", "2024-01-02"),
        stored("a", None, "2024-01-02"),
    )
    new = frame(spark, STORE, stored("a", "First Consult", "2024-02-01"), stored("b", "First Consult", "2024-02-02"))
    merged = merge_events(store, new)
    assert rows(merged.where("key_event = 'First Consult'"), "accountid", "key_event_timestamp") == [
        ("a", time("2024-02-01")),
        ("b", time("2024-02-02")),
    ]
    assert merged.where("key_event = 'Other'").count() == 2
    assert merged.where("key_event is null").count() == 1
    first = merge_events(store, new, keep="first").where("accountid = 'a' and key_event = 'First Consult'")
    assert first.first().key_event_timestamp == time("2024-01-01")
    assert event_watermarks(merged) == {"First Consult": date(2024, 2, 2)}


def test_earliest_copy(spark):
    raw = frame(spark, "cigcopytime string", ("2024-01-02",), ("bad",), ("2024-01-01 05:00:00",))
    assert earliest_copy(raw) == time("2024-01-01 05:00:00")


def event_sources(spark, divisions, counts):
    text = {"linkstatus": "Accountant Linked", "activityid": "8", "status": "P"}
    return EventSources(
        daily=daily(spark, *counts),
        summary=frame(
            spark,
            "environment string, divisioncode int, startuptype string, salesinvoicefirstdate timestamp_ntz",
            ("NL", 1, "X", time("2024-01-09")),
            ("NL", 2, "X", None),
        ),
        divisions=divisions,
        accounts=frame(spark, "accountid string, environment string", ("a", "NL")),
        contract_summary=frame(
            spark, "environment string, accountcode string, accountid string", ("NL", "ca", "a")
        ),
        time_entries=frame(
            spark, "itemid int, accountid string, date timestamp_ntz", (1, "a", time("2024-01-04")), (2, "a", time("2024-01-01"))
        ),
        items=frame(spark, "itemid int, itemcode string", (1, "X-EOLCONSULT-1"), (2, "OTHER")),
        consult_requests=frame(
            spark,
            "environment string, accountid string, status string, created timestamp_ntz",
            ("NL", "a", "S", time("2023-01-01")),
            ("NL", "a", text["status"], time("2023-02-01")),
        ),
        activity=frame(
            spark, "accountid string, activityid string, date timestamp_ntz", ("a", text["activityid"], time("2023-03-01"))
        ),
        accountant_links=frame(
            spark,
            "environment string, accountcode string, linkstatus string, date date",
            ("NL", "ca", text["linkstatus"], day("2023-04-01")),
            ("NL", "ca", text["linkstatus"], day("2023-03-01")),
        ),
    )


def test_store_is_updated_and_watermarks_move(spark, tmp_path, divisions):
    store, marks = VersionedTable(spark, str(tmp_path / "store")), Watermarks(spark, str(tmp_path / "marks"))
    store.publish(frame(spark, STORE, stored("z", "Other", "2020-01-01")))
    counts = [(1, "2024-01-05", {"accountcount": 1})]
    sources = event_sources(spark, divisions, counts)
    update_store(store, marks, sources, datetime(2024, 2, 15), TODAY)
    found = {row.key_event: row for row in store.read().collect()}
    assert set(found) == {
        "Other",
        "First Account Card",
        "First Consult",
        "First Consult Requested",
        "First Sales Invoice",
        "First Time Accountant Linked",
        "First Time Mobile App Used",
        "Legislation Template Created",
    }
    assert found["First Consult"].key_event_timestamp == time("2024-01-04")
    assert found["First Consult Requested"].key_event_timestamp == time("2023-02-01")
    assert found["First Time Accountant Linked"].key_event_timestamp == time("2023-03-01")
    assert found["Legislation Template Created"].divisioncode == "2"
    assert marks.get("First Account Card") == date(2024, 1, 5)
    assert marks.get("First Project") is None
    # A second run adds nothing.
    update_store(store, marks, sources, datetime(2024, 2, 15), TODAY)
    assert store.read().count() == len(found)
    assert len(ALL_EVENTS) == 16


SETUP = (
    "environment string, divisioncode int, accountcode string, divisionstartuptypecode string,"
    " divisioncreated timestamp_ntz, templatedivisioncode int, notes string, accountid string,"
    " divisionfirstaccessed timestamp_ntz, eventstarttime timestamp_ntz, eventlatesttime timestamp_ntz,"
    " masterdatasetuptype string, masterdatasetupstatus string"
)
CREATED = time("2024-01-02")


def division(code, kind=None, status=None, startup="E", account="a", accessed=None, created=CREATED):
    return ("NL", code, f"c{account}", startup, created, None, None, account, accessed, None, None, kind, status)


def activity(spark, *data):
    """Rows of (division, activity, day, quantity)."""
    schema = "environment string, accountid string, accountcode string, divisioncode int, activityid string, date timestamp_ntz, quantity int"
    return frame(spark, schema, *[("NL", "a", "ca", d, a, time(t), q) for d, a, t, q in data])


def test_add_divisions(spark):
    setup = frame(spark, SETUP, division(1))
    divisions = frame(
        spark,
        "environment string, divisioncode int, accountid string, syscreated timestamp_ntz",
        ("NL", 1, "a", CREATED),
        ("NL", 2, "a", CREATED),
        ("NL", 3, "old", time("2016-01-01")),
        ("NL", 4, "trial", time("2016-01-01")),
        ("NL", 5, "no contract", CREATED),
    )
    statistics = frame(
        spark,
        "environment string, divisioncode int, startuptype string, templatedivision string",
        *[("NL", n, "X", "77") for n in range(1, 6)],
    )
    contracts = frame(
        spark,
        "accountid string, accountcode string, hadtrial int, firsttrialstartdate timestamp_ntz, firstcommstartdate timestamp_ntz",
        ("a", "ca", 0, None, None),
        ("old", "co", 0, time("2018-01-01"), time("2016-01-01")),
        ("trial", "ct", 1, time("2018-01-01"), time("2016-01-01")),
    )
    found = rules.add_divisions(setup, divisions, statistics, contracts)
    assert rows(found, "divisioncode", "accountcode", "templatedivisioncode", "masterdatasetuptype") == [
        (1, "ca", None, None),
        (2, "ca", 77, None),
        (4, "ct", 77, None),
    ]


def test_refresh_owner(spark):
    setup = frame(spark, SETUP, division(1), division(2), division(3, account=None), division(4))
    divisions = frame(
        spark,
        "environment string, divisioncode int, accountid string",
        ("NL", 1, "new"),
        ("NL", 2, None),
        ("NL", 3, "new"),
    )
    assert rows(rules.refresh_owner(setup, divisions), "divisioncode", "accountid") == [
        (1, "new"),
        (2, "a"),
        (3, None),
    ]


def test_first_access_counts_from_the_creation_day_and_stays(spark):
    seen = time("2024-01-20")
    setup = frame(spark, SETUP, division(1), division(2, accessed=seen), division(3))
    log = activity(
        spark,
        (1, "1", "2024-01-01", 1),
        (1, "1", "2024-01-02", 1),
        (1, "1", "2024-01-03", 1),
        (2, "1", "2024-01-05", 1),
        (3, "9", "2024-01-05", 1),
    )
    found = rules.first_accessed(rules.with_activity_facts(setup, log))
    assert rows(found, "divisioncode", "divisionfirstaccessed") == [(1, CREATED), (2, seen), (3, None)]


def test_temporary_divisions(spark):
    setup = frame(spark, SETUP, division(1), division(2), division(3, kind="Demo"))
    raw = frame(
        spark,
        "environment string, code string, blockingstatus string, cigcopytime string",
        ("NL", "1", "0", "2024-01-01"),
        ("NL", "1", "100", "2024-01-02"),
        ("NL", "2", "101", "2024-01-01"),
        ("NL", "2", "0", "2024-01-02"),
        ("NL", "3", "101", "2024-01-02"),
    )
    found = rules.temporary_divisions(setup, raw)
    assert rows(found, "divisioncode", "masterdatasetuptype") == [(1, "TemporaryDivision"), (2, None), (3, "Demo")]


def test_conversions(spark):
    setup = frame(
        spark,
        SETUP,
        division(1),
        division(2, kind="Conversion"),
        division(3, kind="Conversion", status="Success"),
        division(4, kind="Demo"),
        division(11),
    )
    conversion = frame(
        spark,
        "environment string, divisioncode int, conversionstatusdescription string, syscreated timestamp_ntz, sysmodified timestamp_ntz",
        ("NL", 11, "csReady", CREATED, time("2024-01-03")),
        ("NL", 21, "csHandedOver", CREATED, time("2024-01-04")),
        ("NL", 12, "csHandoverFailed", CREATED, CREATED),
        ("NL", 13, "csReady", CREATED, CREATED),
        ("NL", 14, "csReady", CREATED, CREATED),
    )
    divisions = frame(
        spark,
        "environment string, divisioncode int, linkeddivision string",
        ("NL", 11, "1"),
        ("NL", 21, "1"),
        ("NL", 12, "2"),
        ("NL", 13, "3"),
        ("NL", 14, "4"),
    )
    found = rules.conversions(setup, conversion, divisions)
    assert rows(found, "divisioncode", "masterdatasetuptype", "masterdatasetupstatus") == [
        (1, "Conversion", "Success"),
        (2, "Conversion", "Failure"),
        (3, "Conversion", "Success"),
        (4, "Demo", None),
    ]


def test_transfers(spark):
    setup = frame(spark, SETUP, *[division(n) for n in (1, 2, 3, 4)], division(5, kind="DivisionTransfer", status="Rejected"))
    asked = frame(
        spark,
        "requestid string, environment string, status int, created timestamp_ntz, realized timestamp_ntz",
        *[(f"r{n}", "NL", 5 if n == 3 else 1, CREATED, None) for n in range(1, 6)],
        ("later", "NL", 1, time("2024-03-01"), None),
    )
    start, end = time("2024-01-03"), time("2024-01-04")
    done = frame(
        spark,
        "relatedrequest string, requestcomments string, description string, created timestamp_ntz, realized timestamp_ntz",
        ("r1", "division 1 : x", "Request To Transfer", start, end),
        ("later", "division 1 : x", "Error on Transfer", start, end),
        ("r2", "division 2: x", None, start, None),
        ("r3", "division 3: x", "odd", start, None),
        ("r4", "division 4 without colon", "Request To Transfer", start, end),
        ("r5", "division 5: x", "Request To Transfer", start, end),
    )
    found = rules.transfers(setup, asked, done)
    assert rows(found, "divisioncode", "masterdatasetuptype", "masterdatasetupstatus", "eventstarttime", "eventlatesttime") == [
        (1, "DivisionTransfer", "Success", start, end),
        (2, "DivisionTransfer", "In Progress", start, None),
        (3, "DivisionTransfer", "Rejected", start, CREATED),
        (4, None, None, None, None),
        (5, "DivisionTransfer", "Rejected", None, None),
    ]


def test_imports(spark):
    setup = frame(
        spark,
        SETUP,
        division(1),
        division(2, kind="Empty", status="NoChanges"),
        division(3, kind="Demo"),
        division(4, kind="XML/CSV_Import", status="Success"),
        division(5, kind="XML/CSV_Import"),
        division(6),
    )
    log = activity(
        spark,
        (1, "5304", "2024-01-05", 1),
        (2, "5335", "2024-01-05", 1),
        (2, "5334202", "2024-01-06", 1),
        (2, "5304202", "2024-01-07", 1),
        *[(n, "5304", "2024-01-05", 1) for n in (3, 4, 5)],
        (6, "5304", "2024-01-01", 1),
    )
    found = rules.imports(rules.with_activity_facts(setup, log))
    assert rows(found, "divisioncode", "masterdatasetuptype", "masterdatasetupstatus", "eventlatesttime") == [
        (1, "XML/CSV_Import", "Started", None),
        (2, "XML/CSV_Import", "Success", time("2024-01-07")),
        (3, "Demo", None, None),
        (4, "XML/CSV_Import", "Success", None),
        (5, "XML/CSV_Import", "Started", None),
        (6, None, None, None),
    ]


@pytest.mark.parametrize("piece_rows", [1, 1_000_000])
def test_save_moments(spark, piece_rows):
    log = activity(
        spark,
        # Exactly five is not beyond the threshold; other activities count as well.
        (1, "511006", "2024-01-01", 3),
        (1, "511006", "2024-01-02", 2),
        (2, "9", "2024-01-01", 5),
        (2, "511006", "2024-01-02", 1),
        # Two rows of one day share the total.
        (3, "511006", "2024-01-01", 3),
        (3, "511006", "2024-01-01", 3),
        (4, "9", "2024-01-01", 9),
    )
    found = rules.save_moments(log, piece_rows=piece_rows)
    assert rows(found, "divisioncode", "firstsave", "fifthsave") == [
        (1, time("2024-01-01"), None),
        (2, time("2024-01-02"), time("2024-01-02")),
        (3, time("2024-01-01"), time("2024-01-01")),
    ]


def test_startup_rules(spark):
    setup = frame(
        spark,
        SETUP,
        division(1, startup="X"),
        division(2, startup="X"),
        division(3, startup="X", kind="XML/CSV_Import", status="Started"),
        division(4, startup="X", kind="XML/CSV_Import", status="Success"),
        division(5, startup="E"),
        division(6, startup="A"),
        division(7, startup="D", kind="Demo"),
    )
    log = activity(spark, (1, "511006", "2024-01-05", 9), (2, "511006", "2024-01-05", 1))
    with_saves = rules.with_save_moments(setup, rules.save_moments(log))
    found = rules.empty_divisions(rules.template_divisions(with_saves))
    found = rules.by_startup_type(rules.by_startup_type(found, "A", "AccountantTemplate"), "D", "DivisionCopy")
    assert rows(found, "divisioncode", "masterdatasetuptype", "masterdatasetupstatus") == [
        (1, "ExactTemplate", "GLChangesMade"),
        (2, "ExactTemplate", "GLChangesStarted"),
        (3, "ExactTemplate", "StandardTemplate"),
        (4, "XML/CSV_Import", "Success"),
        (5, "Empty", "NoChanges"),
        (6, "AccountantTemplate", None),
        (7, "Demo", None),
    ]


def test_one_pass_over_the_activity_gives_all_facts(spark):
    """The same access, imports and saves as the two operators that read the activity each."""
    setup = frame(
        spark, SETUP,
        *[division(n) for n in range(1, 9)], division(9, account="other"), division(10, account=None),
    )
    kinds = ("1", "5304", "5335", "5304202", "5334202", "511006", "9")
    log = activity(
        spark,
        *[(n, kinds[(n * i) % 7], f"2024-01-{1 + i % 20:02d}", i % 3) for n in range(1, 11) for i in range(1, 25)],
    )
    two = rules.with_save_moments(rules.with_activity_facts(setup, log), rules.save_moments(log))
    one = rules.with_all_activity(setup, log)
    names = ["divisioncode", *rules.FACT_COLUMNS, *rules.SAVE_COLUMNS]
    assert rows(one, *names) == rows(two, *names) and one.count() == setup.count()
    assert one.where("fifthsave is not null").count() > 2


def test_the_cascade_reads_the_activity_once(spark, tmp_path):
    from tidemark.queries.setup import setup_sources

    setup, sources = setup_sources(spark, "/root/testdata/sf0.001")
    sources.activity.write.parquet(str(tmp_path / "activity"))
    stored = replace(sources, activity=spark.read.parquet(str(tmp_path / "activity")))
    spark.sparkContext.setJobGroup("cascade", "cascade")
    try:
        result = rules.master_data_setup(setup, stored)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("cascade")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert sum("FileScan parquet" in line and "activityid#" in line for line in plan.splitlines()) == 1


def test_stored_first_moments_give_the_events_of_the_whole_history(spark, tmp_path, divisions, contracts):
    """Days in three portions, one of them late and out of order, against one scan of everything."""
    history = daily(
        spark,
        *[(n, f"2024-0{m}-{d:02d}", {"accountcount": (n * d) % 3, "opportunitycount": (m * d * n) % 5 // 3, "bankentrycountmanual": None})
          for n in (1, 2, 3) for m in (2, 3, 4) for d in (1, 9, 17)],
    )
    bounds = Bounds(datetime(2024, 4, 10), {"First Account Card": date(2024, 1, 1)})
    firsts = firsts_table(spark, str(tmp_path / "firsts"), 4)
    month = F.month("date")
    for portion in (history.where(month == 3), history.where(month == 2), history.where((month == 4) & (F.dayofmonth("date") <= 10))):
        advance_firsts(firsts, portion, "date", counter_conditions())
    whole = counter_events(history, divisions, contracts, bounds, TODAY)
    stored = counter_events(history.limit(0), divisions, contracts, bounds, TODAY, firsts.read())
    assert rows(stored, *STORE_COLUMNS) == rows(whole, *STORE_COLUMNS) and whole.count() > 3
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "firsts").rglob("*.parquet")}
    advance_firsts(firsts, history.where(month <= 4), "date", counter_conditions())
    assert {f: f.stat().st_mtime_ns for f in (tmp_path / "firsts").rglob("*.parquet")} == before


def test_the_store_reads_new_days_only(spark, tmp_path, divisions, contracts):
    history = daily(spark, (1, "2024-02-01", {"accountcount": 1}), (2, "2024-03-01", {"accountcount": 1}), (3, "2024-04-01", {"accountcount": 1}))
    path = str(tmp_path / "daily")
    parts = {"Year": F.year("date"), "Month": F.month("date"), "Day": F.dayofmonth("date")}
    history.withColumns(parts).write.partitionBy(*parts).parquet(path)
    stored = spark.read.parquet(path)
    pending = days_between(stored, date(2024, 2, 15), date(2024, 3, 15), ("Year", "Month", "Day"))
    firsts = first_times(pending, ["environment", "divisioncode"], "date", counter_conditions())
    assert rows(firsts, "divisioncode") == [(2,)]
    plan = firsts._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "make_date" in plan.split("PartitionFilters: ")[1].split("]")[0]
