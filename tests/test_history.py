from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.frames import day, frame, rows, time
from tidemark.fixed_values import CHANGE_COUNTERS, STATISTICS_ADDED, STATISTICS_COUNTERS, STATISTICS_FLOATS, STATISTICS_MOMENTS
from tidemark.plans.jobs import (
    changes_state,
    run_daily_changes,
    run_daily_statistics,
    run_glitch_repair,
    run_lifecycle_log,
    run_month_end_owner,
    run_newest_changes,
    run_summary,
    run_summary_buckets,
)
from tidemark.plans.lifecycle import lifecycle_log
from tidemark.plans.ownership import month_end_owner
from tidemark.plans.statistics import (
    daily_changes,
    daily_statistics,
    statistics_types,
    summary_upsert,
    zero_glitch_repair,
    zero_glitch_rows,
)
from tidemark.sources.buckets import BucketedTable
from tidemark.sources.sinks import VersionedTable, Watermarks
from tidemark.sources.tables import newest_day

RAW_STATISTICS = (
    "environment string, division string, cigcopytime string, banklinkscount string, rabobanklinks long,"
    " abnamrobanklinks long, ingbanklinks long, gltransactionscount string, cashentryavglines string,"
    " freeintfield_01 int, lastlogin string, ingestionyear int, ingestionmonth int, ingestionday int"
)


def raw_row(division, copied, counter, links=None, environment="NL"):
    parts = date.fromisoformat(copied[:10])
    return (environment, division, copied, None, links, None, None, counter, "1.5", 1, None, parts.year, parts.month, parts.day)


def test_only_listed_statistics_are_typed():
    columns = (
        "environment mail2eolpurchaseemail mail2eolpurchaseemaillastusage CashEntryAvgLines divisioncode"
        " psnaveragesubscriptioninvoiceamount inconsistentbalancedate lastlogin syscreated syscreator"
        " smartmatchingwriteoffboundarysetting batchesperpaymentfileavgcount salesinvoicefirstdate knabbankaccounts"
    ).split()
    types = statistics_types(columns)
    assert set(types["float"]) == {
        "CashEntryAvgLines",
        "psnaveragesubscriptioninvoiceamount",
        "smartmatchingwriteoffboundarysetting",
        "batchesperpaymentfileavgcount",
    }
    assert set(types["timestamp"]) == {"mail2eolpurchaseemaillastusage", "lastlogin", "syscreated", "salesinvoicefirstdate"}
    assert set(types["long"]) == {"divisioncode", "inconsistentbalancedate", "knabbankaccounts"}
    assert "knabbankaccounts" not in statistics_types(columns, STATISTICS_ADDED)["long"]
    listed = [*STATISTICS_FLOATS, *STATISTICS_COUNTERS, *STATISTICS_MOMENTS]
    assert len(listed) == len(set(listed)) == 343


def test_texts_with_names_like_counters_stay(spark):
    raw = frame(spark, RAW_STATISTICS, raw_row("1", "2024-01-02 01:00:00", "5"))
    names = ("projectmanager", "sourcename", "payrollnote", "linkedaccounts", "storedfiles", "vatsetting", "companydescription")
    raw = raw.withColumns({n: F.lit(f"{n} text") for n in names})
    empty = frame(spark, "environment string, divisioncode long", ("NL", 9))
    for found in (daily_statistics(raw, date(2024, 1, 2), date(2024, 1, 1)), summary_upsert(raw, empty).where("divisioncode = 1")):
        assert rows(found, *names) == [tuple(f"{n} text" for n in names)]


def test_daily_statistics(spark):
    raw = frame(
        spark,
        RAW_STATISTICS,
        raw_row("1", "2024-01-02 01:00:00", "5"),
        raw_row("1", "2024-01-02 02:00:00", "6", links=1),
        raw_row("2", "2024-01-01 02:00:00", "7"),
        raw_row("3", "2024-01-02 02:00:00", "x"),
    )
    found = daily_statistics(raw, date(2024, 1, 2), date(2024, 1, 1))
    assert rows(found, "divisioncode", "gltransactionscount", "automaticbanklink", "date") == [
        (1, 6, 1, day("2024-01-01")),
        (3, None, 0, day("2024-01-01")),
    ]
    assert not {"freeintfield_01", "lastlogin", "cigcopytime", "ingestionday"} & set(found.columns)
    assert dict(found.dtypes)["cashentryavglines"] == "float"


def test_daily_jobs(spark, tmp_path):
    path = str(tmp_path / "daily")
    counts = {"1": (5, 0, 5), "2": (5, 1, 5)}
    data = [
        raw_row(division, f"2024-01-0{number + 2} 01:00:00", str(count)) + (None, 0)
        for division, values in counts.items()
        for number, count in enumerate(values)
    ]
    raw = frame(spark, RAW_STATISTICS + ", vattransactions long, accountcount long", *data)
    for number in (2, 3, 4):
        run_daily_statistics(raw, path, date(2024, 1, number))
    assert spark.read.parquet(path).count() == 6
    run_glitch_repair(spark, path, date(2024, 1, 3), str(tmp_path / "staging"))
    daily = spark.read.parquet(path)
    assert rows(daily.where("date = date '2024-01-02'"), "divisioncode", "Day") == [(2, 2)]
    assert daily.count() == 5
    all_counters = {c: F.lit(None).cast("bigint") for c in CHANGE_COUNTERS if c not in daily.columns}
    run_daily_changes(daily.withColumns(all_counters), str(tmp_path / "changes"))
    changes = spark.read.parquet(str(tmp_path / "changes"))
    assert rows(changes, "divisioncode", "gltransactionscount", "Date") == [
        (1, 0, day("2024-01-03")),
        (2, 4, day("2024-01-03")),
    ]


def test_summary_job(spark, tmp_path):
    summary, marks = VersionedTable(spark, str(tmp_path / "s")), Watermarks(spark, str(tmp_path / "m"))
    schema = "environment string, divisioncode long, gltransactionscount long"
    summary.publish(frame(spark, schema, ("NL", 1, 1), ("NL", 3, 3)))
    marks.store({"DivisionStatistics_Summary": date(2024, 1, 1)})
    raw = frame(
        spark,
        RAW_STATISTICS,
        raw_row("1", "2024-01-02 05:00:00", "5"),
        raw_row("3", "2024-01-01 05:00:00", "6"),
    )
    for _ in range(2):
        run_summary(raw, summary, marks, date(2024, 1, 2))
        assert rows(summary.read(), "divisioncode", "gltransactionscount") == [(1, 5), (3, 3)]
    assert marks.get("DivisionStatistics_Summary") == date(2024, 1, 2)


DAILY = "environment string, divisioncode long, date date, gltransactionscount long, vattransactions long, accountcount long"


def three_days(division, counts, vat=None, accounts=None):
    """Counts of the oldest day first."""
    return [
        ("NL", division, day(f"2024-01-0{i + 1}"), count, vat, accounts) for i, count in enumerate(counts)
    ]


def test_zero_glitches(spark):
    data = [
        *three_days(1, (5, 0, 5)),
        *three_days(2, (5, None, 5), accounts=0),
        *three_days(3, (5, 0, 0)),
        *three_days(4, (0, 0, 5)),
        *three_days(5, (5, 0, 5), vat=1),
        *three_days(6, (5, 0, 5), accounts=3),
        *three_days(7, (5, 1, 5)),
        *three_days(8, (5, 0, None)),
    ]
    days = frame(spark, DAILY, *data)
    found = zero_glitch_rows(days)
    assert rows(found, "divisioncode", "date") == [(1, day("2024-01-02")), (2, day("2024-01-02"))]
    middle = days.where("date = date '2024-01-02'")
    assert rows(zero_glitch_repair(middle, days), "divisioncode") == [(n,) for n in range(3, 9)]


def test_daily_changes(spark):
    counters = ["a", "b"]
    daily = frame(
        spark,
        "environment string, divisioncode string, date date, a int, b int",
        (" nl", "1", day("2024-01-01"), 1, 1),
        ("NL", "1", day("2024-01-03"), 2, None),
        ("NL", "1", day("2024-01-09"), 5, 7),
        ("NL", "2", day("2024-01-09"), 3, None),
        ("NL", "3", day("2024-01-03"), 3, 3),
    )
    assert rows(daily_changes(daily, counters), "environment", "divisioncode", "date", "a", "b") == [
        ("NL", 1, day("2024-01-09"), 3, 7),
        ("NL", 2, day("2024-01-09"), 3, 0),
    ]
    assert len(CHANGE_COUNTERS) == 47


def test_summary_upsert_takes_the_newest_of_all_pending_days(spark):
    raw = frame(
        spark,
        RAW_STATISTICS,
        raw_row("1", "2024-01-02 05:00:00", "5", environment=" nl"),
        raw_row("1", "2024-01-03 01:00:00", "6", links=2),
        raw_row("2", "2024-01-01 02:00:00", "7"),
        raw_row("4", "2024-01-02 02:00:00", "8"),
        raw_row("4", "2024-01-04 02:00:00", "9"),
    )
    summary = frame(
        spark,
        "environment string, divisioncode long, gltransactionscount long, kept string",
        ("NL", 1, 1, "old"),
        ("NL", 2, 2, "old"),
        ("NL", 3, 3, "old"),
    )
    raw = raw.withColumn("vatnumber", F.lit("B01"))
    found = summary_upsert(raw, summary, date(2024, 1, 1), date(2024, 1, 3))
    assert rows(found, "divisioncode", "gltransactionscount", "automaticbanklink", "kept") == [
        (1, 6, 1, None),
        (2, 2, None, "old"),
        (3, 3, None, "old"),
        (4, 8, 0, None),
    ]
    assert "freeintfield_01" not in found.columns
    assert rows(found, "divisioncode", "vatnumber") == [(1, "B01"), (2, None), (3, None), (4, "B01")]
    assert "knabbanklinksbgwsftp" in found.columns


DIVISIONS = (
    "code string, environment string, blockingstatus string, status string, deleted string, enddate string,"
    " syscreated string, sysmodified string, cigcopytime string"
)


def copy(code, copied, blocking="0", status="0", deleted=None, end=None, env="NL"):
    return (code, env, blocking, status, deleted, end, "2015-01-01", f"{copied} 12:00:00", copied)


@pytest.mark.parametrize("piece_rows", [1, 1_000_000])
def test_lifecycle(spark, piece_rows):
    raw = frame(
        spark,
        DIVISIONS,
        # Blocked at the third copy, archived at the fourth.
        copy(" 1", "2016-11-15"),
        copy("1", "2017-01-01"),
        copy("1", "2017-02-01", blocking="101"),
        copy("1", "2017-03-01", blocking="101", status="1"),
        # A single copy, blocked at once.
        copy("2", "2017-01-01", blocking="101"),
        # Deleted at the second copy.
        copy("3", "2017-01-01"),
        copy("3", "2017-02-01", blocking="101", deleted="2017-01-20"),
        # Ended in the past at the second copy.
        copy("4", "2017-01-01", env=" us"),
        copy("4", "2017-02-01", end="2017-01-31", env="US"),
        # Second copy on the US start day: event and date follow their own rules.
        copy("5", "2016-11-13", env="US"),
        copy("5", "2016-11-14", blocking="101", deleted="2016-11-10", env="US"),
        # From partly blocked to fully blocked later on.
        copy("6", "2017-01-01"),
        copy("6", "2017-02-01"),
        copy("6", "2017-03-01", blocking="100"),
        copy("6", "2017-04-01", blocking="101", deleted="2017-03-30"),
    )
    log = lifecycle_log(raw, date(2020, 1, 1), piece_rows=piece_rows)
    found = {row.divisioncode: row for row in log.collect()}
    start = time("2015-01-01")
    assert all(found[n].startdate == start and found[n].yearmonthstarted == 201501 for n in range(1, 7))
    assert found[1].blocked == time("2017-02-01 12:00:00") and found[1].yearmonthblocked == 201702
    assert found[1].archived == time("2017-03-01")
    assert found[1].deleted is None and found[1].yearmonthdeleted is None
    assert (found[2].blocked, found[2].deleted) == (None, None)
    assert found[3].deleted == time("2017-01-20")
    assert (found[4].environment, found[4].ended) == ("US", time("2017-01-31"))
    assert found[5].deleted == time("2016-11-14 12:00:00")
    assert found[6].blockedanddeleted == time("2017-03-30")


def test_lifecycle_has_all_columns_without_events(spark):
    log = lifecycle_log(frame(spark, DIVISIONS, copy("1", "2017-01-01")), date(2020, 1, 1))
    assert {"archived", "blocked", "blockedanddeleted", "deleted", "ended", "startdate"} < set(log.columns)
    assert log.count() == 1


def calendar(spark, first, last):
    return spark.sql(
        f"select explode(sequence(date '{first}', date '{last}')) as calendardate"
    ).selectExpr("calendardate", "date_format(calendardate, 'yyyyMM') as yearmonth")


def test_month_end_owner(spark):
    accounts = frame(
        spark,
        "ID string, Accountant string, CIGCopyTime string",
        ("a", "x", "2024-01-05"),
        ("a", "y", "2024-01-20"),
        ("a", "z", "2024-04-02"),
        ("b", "x", "2024-05-10"),
        ("c", None, "2023-12-31"),
    )
    days = calendar(spark, "2024-01-01", "2024-05-20")
    found = month_end_owner(accounts, days, date(2024, 5, 20))
    assert rows(found, "accountid", "date", "accountantid") == [
        ("a", day("2024-01-31"), "y"),
        ("a", day("2024-02-29"), "y"),
        ("a", day("2024-03-31"), "y"),
        ("a", day("2024-04-30"), "z"),
        ("c", day("2024-01-31"), None),
        ("c", day("2024-02-29"), None),
        ("c", day("2024-03-31"), None),
        ("c", day("2024-04-30"), None),
    ]


def test_month_end_owner_with_a_calendar_cut_inside_a_month(spark):
    accounts = frame(spark, "id string, accountant string, cigcopytime string", ("a", "x", "2024-01-05"))
    days = calendar(spark, "2024-01-01", "2024-02-10")
    found = month_end_owner(accounts, days, date(2024, 3, 1))
    assert rows(found, "date") == [(day("2024-01-31"),), (day("2024-02-10"),)]


@pytest.mark.parametrize("period", ["yyyyMM", "week", "day"])
def test_owner_on_any_calendar_equals_a_range_join(spark, period):
    moments = F.date_add(F.lit(day("2023-01-01")), (F.col("id") * 53 % 400).cast("int"))
    accounts = spark.range(80).select((F.col("id") % 7).alias("id"), (F.col("id") % 5).alias("accountant"), moments.cast("string").alias("cigcopytime"))
    days = calendar(spark, "2023-02-03", "2024-03-09")
    if period == "yyyyMM":
        days = days.withColumn("part", F.col("yearmonth"))
    else:
        days = days.withColumn("part", F.trunc("calendardate", "week") if period == "week" else F.col("calendardate"))
    found = month_end_owner(accounts, days, date(2024, 3, 1), period="part")
    plain = spark.sql(
        """with h as (select id, accountant, last_day(cast(cigcopytime as date)) as start, row_number() over (
                        partition by id, last_day(cast(cigcopytime as date)) order by cigcopytime desc, accountant desc) as rn from {a}),
           held as (select *, date_sub(lead(start, 1, date '2024-03-01') over (partition by id order by start), 1) as last from h where rn = 1),
           ends as (select max(calendardate) as d from {c} group by part)
           select id as accountid, d as date, accountant as accountantid from held join ends on d between start and last""",
        a=accounts, c=days,
    )
    assert rows(found, "accountid", "date") == rows(plain, "accountid", "date") and plain.count() > 50
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()


def test_changes_of_the_newest_day_read_that_day_and_the_state(spark, tmp_path):
    path, marks = str(tmp_path / "daily"), Watermarks(spark, str(tmp_path / "marks"))
    state = changes_state(spark, str(tmp_path / "state"), 4)
    counters = ["gltransactionscount", "vattransactions"]
    data = [("NL", n, day(f"2024-01-{d:02d}"), n * d % 7, None if n % 2 else d) for n in range(1, 9) for d in range(1, 8) if (n + d) % 3]
    schema = "environment string, divisioncode long, date date, gltransactionscount long, vattransactions long"
    history = frame(spark, schema, *data)
    parts = {"Year": F.year("date"), "Month": F.month("date"), "Day": F.dayofmonth("date")}
    for last in (3, 4, 7):
        days = history.where(F.dayofmonth("date") <= last)
        days.withColumns(parts).write.mode("overwrite").partitionBy(*parts).parquet(path)
        assert newest_day(spark, path, tuple(parts)) == date(2024, 1, last)
        run = (spark, path, str(tmp_path / "changes"), state, marks, counters)
        assert run_newest_changes(*run) == date(2024, 1, last) and run_newest_changes(*run) is None
        found = spark.read.parquet(str(tmp_path / "changes")).where(F.col("Date") == day(f"2024-01-0{last}"))
        names = ["environment", "divisioncode", *counters]
        assert rows(found, *names) == rows(daily_changes(days, counters), *names)
    # Earlier days may go: the newest one is told from the state alone.
    history.where("date = date '2024-01-07'").withColumn("date", F.lit(day("2024-01-08"))).withColumns(parts).write.mode("overwrite").partitionBy(*parts).parquet(path)
    assert run_newest_changes(*run) == date(2024, 1, 8)
    found = spark.read.parquet(str(tmp_path / "changes")).where("Date = date '2024-01-08'")
    assert rows(found.selectExpr("coalesce(gltransactionscount, 0) + coalesce(vattransactions, 0) as x").distinct(), "x") == [(0,)]


def test_newest_day_of_odd_folders(spark, tmp_path):
    assert newest_day(spark, str(tmp_path / "none")) is None
    for folder in ("ingestionyear=2024/ingestionmonth=02/ingestionday=9", "IngestionYear=2024/IngestionMonth=1/IngestionDay=31", "ingestionyear=2024/ingestionmonth=None/ingestionday=3", "ingestionyear=2025/other=1"):
        (tmp_path / "t" / folder).mkdir(parents=True)
    assert newest_day(spark, str(tmp_path / "t")) == date(2024, 2, 9)


def test_upsert_leaves_other_buckets_alone(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), ["k"], 8)
    assert table.read() is None
    table.replace(frame(spark, "k long, v string", *[(n, "old") for n in range(100)], (None, "old")))
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "t").rglob("*.parquet")}
    touched = table.upsert(frame(spark, "k int, v string, w int", (5, "new", 1), (500, "new", 2), (None, "new", 3)))
    assert 1 <= len(touched) <= 3 and table.upsert(frame(spark, "k int, v string")) == []
    left = {f: f.stat().st_mtime_ns for f in (tmp_path / "t").rglob("*.parquet")}
    assert {f for f in before if left.get(f) != before[f]} == {f for f in before if int(f.parent.name.split("=")[1]) in touched}
    found = rows(table.read(), "k", "v", "w")
    assert len(found) == 102 and [r for r in found if r[1] == "new"] == [(None, "new", 3), (5, "new", 1), (500, "new", 2)]


def test_summary_in_buckets_equals_the_whole_upsert(spark, tmp_path):
    summary, marks = BucketedTable(spark, str(tmp_path / "s"), ["environment", "divisioncode"], 4), Watermarks(spark, str(tmp_path / "m"))
    old = frame(spark, "environment string, divisioncode long, gltransactionscount long", *[("NL", n, n) for n in range(30)])
    summary.replace(old)
    marks.store({"DivisionStatistics_Summary": date(2024, 1, 1)})
    raw = frame(spark, RAW_STATISTICS, raw_row("1", "2024-01-02 05:00:00", "50"), raw_row("1", "2024-01-02 06:00:00", "51", environment=" nl"), raw_row("77", "2024-01-02 05:00:00", "9"))
    touched = run_summary_buckets(raw, summary, marks, date(2024, 1, 2))
    assert len(touched) <= 2
    whole = summary_upsert(raw, old, date(2024, 1, 1), date(2024, 1, 2))
    assert rows(summary.read(), "divisioncode", "gltransactionscount") == rows(whole, "divisioncode", "gltransactionscount")


def test_log_jobs(spark, tmp_path):
    run_lifecycle_log(frame(spark, DIVISIONS, copy("1", "2017-01-01")), str(tmp_path / "log"), date(2020, 1, 1))
    assert rows(spark.read.parquet(str(tmp_path / "log")), "divisioncode", "yearmonthstarted") == [(1, 201501)]
    accounts = frame(spark, "id string, accountant string, cigcopytime string", ("a", "x", "2024-01-05"))
    run = (calendar(spark, "2024-01-01", "2024-02-10"), str(tmp_path / "owner"), date(2024, 3, 1))
    assert run_month_end_owner(accounts, *run) and not run_month_end_owner(accounts.limit(0), *run)
    assert spark.read.parquet(str(tmp_path / "owner")).count() == 2
