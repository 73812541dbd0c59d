from pyspark.sql import functions as F

from tests.frames import day, frame, rows, time
from tidemark.functions.columns import (
    add_missing_columns,
    cast_columns,
    clean_columns,
    drop_columns,
    rename_columns,
    suffix_columns,
    trim_text,
    upper_trim,
)
from tidemark.functions.expressions import (
    any_flag,
    dotted_code,
    lookup,
    not_among,
    number_before_colon,
    year_month,
)


def test_casts_give_null_for_unreadable_values(spark):
    df = frame(
        spark,
        "i string, b string, d string, t string, f string",
        ("12", "True", "2020-01-02", "2020-01-02 03:04:05", "1.5"),
        ("abc", "", "n/a", "yesterday", "-"),
        ("12.9", "0", "2020-02-30", "2020-01-02", "1e3"),
        (" -7 ", " YES ", None, None, None),
        ("99999999999", "no", None, None, None),
        (None, "2", None, None, None),
    )
    groups = {"integer": ["i"], "boolean": ["b"], "date": ["d"], "timestamp": ["t"], "double": ["f"]}
    cast = cast_columns(df, groups)
    assert [t for _, t in cast.dtypes] == ["int", "boolean", "date", "timestamp_ntz", "double"]
    assert [r.i for r in cast.collect()] == [12, None, 12, -7, None, None]
    assert [r.b for r in cast.collect()] == [True, None, False, True, False, None]
    assert [r.d for r in cast.collect()][:3] == [day("2020-01-02"), None, None]
    assert [r.t for r in cast.collect()][:3] == [time("2020-01-02 03:04:05"), None, time("2020-01-02")]
    assert [r.f for r in cast.collect()][:3] == [1.5, None, 1000.0]


def test_column_in_two_groups_gets_both_casts_in_order(spark):
    df = frame(spark, "a string", ("2020-01-02 03:04:05",))
    cast = cast_columns(df, {"date": ["a"], "timestamp": ["a"]})
    assert cast.dtypes == [("a", "date")]
    assert cast.first().a == day("2020-01-02")


def test_patterns_and_case(spark):
    df = frame(spark, "FreeDate_01 string, freedate_02 string, other string", ("2020-01-01", "x", "y"))
    cast = cast_columns(df, {"date": ["freedate_*"]})
    assert [t for _, t in cast.dtypes] == ["date", "date", "string"]
    assert drop_columns(df, ["freedate_*", "absent"]).columns == ["other"]


def test_clean_turns_all_columns_into_trimmed_text(spark):
    df = frame(spark, "id string, n int, ok boolean", (" ab ", 1, True), (None, None, None))
    cleaned = clean_columns(df, ["ID"])
    assert [t for _, t in cleaned.dtypes] == ["string"] * 3
    assert rows(cleaned, "id", "n", "ok") == [(None, None, None), ("AB", "1", "true")]


def test_trim_text_keeps_types(spark):
    df = frame(spark, "e string, n int", (" nl ", 1))
    assert trim_text(df, ["e"]).first() == ("NL", 1)
    assert trim_text(df, ["e"]).dtypes == df.dtypes


def test_rename_add_suffix(spark):
    df = frame(spark, "a int, b int", (1, 2))
    assert rename_columns(df, {"a": "x", "absent": "y"}).columns == ["x", "b"]
    widened = add_missing_columns(df, ["B", "c"], "bigint")
    assert widened.dtypes == [("a", "int"), ("b", "int"), ("c", "bigint")]
    assert suffix_columns(df, "_older").columns == ["a_older", "b_older"]
    assert upper_trim(frame(spark, "e string", (" nl ",)), ["e", "absent"]).first().e == "NL"


def test_expressions(spark):
    df = frame(
        spark,
        "code string, text string, day date, x int, y int",
        ("1234567", "division 12 : moved", day("2024-02-29"), None, 1),
        ("123456789", "12 without colon", None, 0, None),
        ("5", "no digits: at all", day("1999-12-31"), None, None),
    )
    found = df.select(
        dotted_code(F.col("code")).alias("code"),
        number_before_colon(F.col("text")).alias("number"),
        year_month(F.col("day")).alias("month"),
        any_flag("x", "y").alias("flag"),
        lookup(F.col("x"), {0: "zero"}).alias("name"),
    ).collect()
    assert [r.code for r in found] == ["01.234.567", "12.345.678", "00.000.005"]
    assert [r.number for r in found] == [12, None, None]
    assert [r.month for r in found] == [202402, None, 199912]
    assert [r.flag for r in found] == [1, 0, 0]
    assert [r.name for r in found] == [None, "zero", None]


def test_not_among_holds_for_null(spark):
    df = frame(spark, "s string", ("Success",), (None,), ("Other",))
    assert rows(df.where(not_among(F.col("s"), ["Success"])), "s") == [(None,), ("Other",)]
