import json

from tests.frames import frame, rows, time
from tidemark.plans.loaders import (
    CONTRACT_VIEW_COLUMNS,
    LOADERS,
    contact_free_view,
    contract_view,
    current_state,
    load,
    typed_log,
)
from tidemark.plans.lookups import conversion_source, latest_negative_answer, publish_log, startup_types
from tidemark.plans.requests import RequestTable, requests_from_settings, write_requests


def test_there_is_a_loader_per_table():
    assert len(LOADERS) == 42


def test_columns_without_a_type_come_through(spark):
    often = {"syscreated", "sysmodified", "startdate", "enddate", "division", "descriptiontermid", "cigprocessed"}
    for name, loader in LOADERS.items():
        typed = {column for group in loader.types.values() for column in group}
        selected = set(loader.select) - set(loader.rename.values())
        named = [*loader.keys, *loader.rename, *selected, *loader.drop, "cigcopytime", "environment", "id"]
        columns = sorted(typed | often | {c.lower() for c in named} | {"isnewish", "freedatefield_09", "remark"})
        raw = spark.createDataFrame([("1",) * len(columns)], ", ".join(f"`{c}` string" for c in columns))
        types = dict(current_state(raw, loader).dtypes)
        for column in (often | {"isnewish", "freedatefield_09", "remark"}) - typed:
            new = loader.rename.get(column, column)
            assert types.get(new, "string") == "string", (name, column)
            if not loader.select and new not in loader.drop:
                assert new in types, (name, column)


def test_text_without_a_type_is_kept(spark):
    raw = frame(
        spark,
        "id string, environment string, division string, syscreated string, isnewish string, cigcopytime string",
        ("a", "nl", "12x", "never", "maybe", "2020-01-01"),
    )
    assert rows(current_state(raw, LOADERS["itemrelations"]), "division", "syscreated", "isnewish") == [
        (None, "never", "maybe")
    ]
    assert rows(current_state(raw, LOADERS["users"]), "division", "syscreated", "isnewish") == [("12x", None, "maybe")]


def test_users(spark):
    raw = frame(
        spark,
        "id string, environment string, customer string, person string, hid string, blocked string,"
        " cigcopytime string, username string, cigprocessed string, ingestionday int",
        (" u1", "nl", " c", "p", "5", "True", "2020-01-01", "n", "False", 1),
        ("U1 ", "NL", "c2", "p", "abc", "0", "2020-01-03", "n", "False", 3),
        ("u1", "NL", "c3", "p", "7", "", "2020-01-02", "n", "False", 2),
        ("u2", "NL", "c4", "p", "7", "", None, "n", "False", 2),
    )
    users = current_state(raw, LOADERS["users"])
    assert users.columns == ["userid", "environment", "accountid", "personid", "hid", "blocked", "cigcopytime"]
    assert rows(users, "userid", "accountid", "hid", "blocked", "cigcopytime") == [
        ("U1", "c2", None, False, time("2020-01-03")),
        ("U2", "c4", 7, None, None),
    ]


def test_cut_off_after_the_choice_of_the_latest(spark):
    raw = frame(
        spark,
        "id string, account string, division string, cigcopytime string",
        ("a", "x", "1", "2018-10-04 23:59:59"),
        ("b", "x", "1", "2018-10-05"),
        ("c", "x", "1", "2019-01-01"),
        ("c", "x", "1", "2018-01-01"),
    )
    found = current_state(raw, LOADERS["paymentterms"])
    assert rows(found, "paymenttermsid", "accountid", "divisioncode") == [("B", "x", 1), ("C", "x", 1)]


def test_type_filter_before_the_choice_of_the_latest(spark):
    raw = frame(
        spark,
        "id string, type string, cigcopytime string, sysmodified string, account string",
        ("a", "193", "2020-01-01", "2020-01-01", "old"),
        ("a", "7", "2020-01-02", "2020-01-02", "new"),
        ("b", "193", "2020-01-01", "2020-01-01", "first"),
        ("b", "193", "2020-01-01", "2020-01-05", "second"),
        ("c", "7", "2020-01-01", "2020-01-01", "none"),
    )
    found = current_state(raw, LOADERS["saleshandoverdocument"])
    assert rows(found, "documentid", "accountid") == [("A", "old"), ("B", "second")]
    assert "type" not in found.columns and "cigcopytime" not in found.columns


def test_blocking_status_of_one_environment(spark):
    raw = frame(
        spark,
        "id string, environment string, description string, cigcopytime string",
        (" 100", "nl ", "dutch", "2020-01-01"),
        ("100", "BE", "belgian", "2020-01-02"),
        ("x", "NL", "odd", "2020-01-01"),
    )
    found = current_state(raw, LOADERS["blockingstatus"])
    assert rows(found, "blockingstatuscode", "blockingstatusdescription") == [(None, "odd"), (100, "dutch")]
    assert "environment" not in found.columns


def test_divisions_drop_only_the_columns_that_were_not_renamed(spark):
    raw = frame(
        spark,
        "code string, environment string, account string, customer string, description string, hid string,"
        " sector string, activitysector string, cigcopytime string",
        ("12", "nl", "acc", "cust", "d", "h", "s", "act", "2020-01-01"),
    )
    found = current_state(raw, LOADERS["divisions"])
    assert found.columns == ["divisioncode", "environment", "accountid", "divisiondescription", "sectorid", "cigcopytime"]
    assert found.first()[:5] == (12, "NL", "cust", "d", "act")


def test_untyped_loader_orders_by_text(spark):
    columns = LOADERS["oauthclients"].select
    schema = ", ".join(f"{'id' if c == 'applicationid' else c} string" for c in columns)
    values = {"id": "a", "cigcopytime": "2020-01-02", "account": "new"}
    names = ["id" if c == "applicationid" else c for c in columns]
    new = tuple(values.get(n) for n in names)
    old = tuple({**values, "cigcopytime": "2020-01-01", "account": "old"}.get(n) for n in names)
    found = current_state(frame(spark, schema, old, new), LOADERS["oauthclients"])
    assert found.columns == list(columns)
    assert found.first().account == "new"


def test_load_writes_the_stated_number_of_files(spark, tmp_path):
    raw = frame(spark, "id string, cigcopytime string", *[(str(i), "2020-01-01") for i in range(50)])
    path = tmp_path / "units"
    load(raw, "units", str(path), files=1)
    assert len(list(path.glob("*.parquet"))) == 1
    assert spark.read.parquet(str(path)).count() == 50


def test_views_and_logs(spark):
    accounts = frame(spark, "id string, Email string, PhoneSales string, name string", ("a", "e", "p", "n"))
    assert contact_free_view(accounts).columns == ["id", "name"]
    history = frame(spark, ", ".join(f"{c} string" for c in (*CONTRACT_VIEW_COLUMNS, "more")), *[("x",) * 19] * 2)
    assert contract_view(history).columns == list(CONTRACT_VIEW_COLUMNS)
    assert contract_view(history).count() == 2
    log = frame(spark, "logdatetime string, activitytype string", ("2020-01-01 10:00:00", "3"), ("bad", "x"))
    assert rows(typed_log(log, "scan_upload"), "activitytype") == [(None,), (3,)]


def test_publish_log(spark):
    clients = frame(
        spark,
        "id string, publishdate string, sysmodified string",
        ("a", "2020-01-05", "2020-01-09 10:00:00"),
        ("a", "2020-01-05", "2020-01-07 10:00:00"),
        ("b", None, "2020-02-02 10:00:00"),
        ("c", None, None),
    )
    assert rows(publish_log(clients), "oauthclientid", "publishdate", "event") == [
        ("a", "2020-01-05", "Published"),
        ("b", "2020-02-02", "Unpublished"),
        ("c", None, "Unpublished"),
    ]


def test_only_the_newest_survey_row_counts(spark):
    results = frame(
        spark,
        "accountid string, questioncode int, objectiveanswer int, createddate string, surveyresultid string",
        (" a", 0, 1, "2020-01-01", "1"),
        ("A", 1, 1, "2020-01-02", "2"),
        ("b", 1, 1, "2020-01-01", "3"),
        ("b", 0, 4, "2020-01-02", "4"),
        ("c", 0, 6, "2020-01-02", "5"),
    )
    found = latest_negative_answer(results)
    assert rows(found, "accountid", "objectiveanswerdescription") == [("B", "Other reasons"), ("C", None)]
    assert "submitteddate" in found.columns and "surveyresultid" not in found.columns


def test_conversion_source(spark):
    status = frame(
        spark,
        "environment string, division string, status string, conversionsource string, idkey string, userid string,"
        " document string, dirpath string, syscreated string, sysmodified string, cigcopytime string",
        ("nl", "1", "30", "5", "k", "u", "d", "p", None, None, "2020-01-01"),
        ("NL", "1", "40", "5", "k", "u", "d", "p", None, None, "2020-01-02"),
        ("NL", "2", "7", "5", "k", "u", "d", "p", None, None, "2020-01-02"),
        ("BE", "3", "38", "6", "k", "u", "d", "p", None, None, "2020-01-02"),
    )
    sources = frame(
        spark,
        "id string, environment string, descriptionsuffix string, cigcopytime string",
        ("5", "NL", "five", "2020-01-01"),
        ("5", "BE", "cinq", "2020-01-02"),
        ("6", "BE", "six", "2020-01-01"),
    )
    found = conversion_source(status, sources)
    assert rows(found, "divisioncode", "conversionstatusdescription", "conversionsourcedescription") == [
        (1, "csHandedOver", "five"),
        (2, None, "five"),
    ]


def test_startup_types(spark):
    assert startup_types(spark).count() == 8


def test_requests_are_written_per_type_if_there_are_any(spark, tmp_path):
    settings = [
        {
            "name": name,
            "filter_condition": f"type = '{kind}'",
            "columns_to_rename": {"hid": "requesthid"},
            "columns_to_select": ["id", "requestcode", "created"],
            "columns_to_drop": ["noise"],
            "timestamp_columns": ["created"],
            "integer_columns": [],
            "date_columns": [],
            "double_cols": [],
            "boolean_cols": [],
            "s3_destination": str(tmp_path / name),
        }
        for name, kind in (("transfer", "T"), ("none", "N"))
    ]
    path = tmp_path / "settings.json"
    path.write_text(json.dumps({"settings": settings}))
    tables = requests_from_settings(spark, str(path))
    assert isinstance(tables[0], RequestTable)
    raw = frame(
        spark,
        "id string, type string, hid string, created string, cigcopytime string, noise string",
        (" r1", "t", "1234567", "2020-01-01", "2020-01-01", "x"),
        ("R1", "T", "1234567", "2020-01-02", "2020-01-02", "x"),
        ("R2", "other", "1", "2020-01-01", "2020-01-01", "x"),
    )
    assert write_requests(raw, tables) == ["transfer"]
    written = spark.read.parquet(str(tmp_path / "transfer"))
    assert rows(written, "id", "requestcode", "created") == [("R1", "01.234.567", time("2020-01-02"))]
    assert not (tmp_path / "none").exists()
