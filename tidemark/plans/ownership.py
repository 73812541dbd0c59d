"""Log of a slowly changing owner at the ends of calendar periods."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import cast_columns
from tidemark.operators.intervals import interval_join


def month_end_owner(
    accounts: DataFrame,
    calendar: DataFrame,
    today: date,
    tie_breakers: Sequence[str] = (),
    *,
    period: str = "yearmonth",
) -> DataFrame:
    """The owner of each account at the last day of every period of the calendar.

    An owner holds from the end of the month of the copy to the day before the
    next change, the newest one to yesterday. The history is reduced to the last
    owner of each month before it is ordered, so an account never has more rows
    than there are months. The calendar may have periods of any length: months, weeks, or days.
    """
    history = cast_columns(
        accounts.select("id", "accountant", "cigcopytime", *tie_breakers),
        {"timestamp": ["cigcopytime"]},
    )
    per_month = (
        history.where(F.col("cigcopytime").isNotNull())
        .groupBy("id", F.last_day("cigcopytime").alias("start"))
        .agg(F.max_by(F.struct("accountant"), F.struct("cigcopytime", *tie_breakers)).alias("owner"))
    )
    in_order = Window.partitionBy("id").orderBy("start")
    held = per_month.select(
        F.col("id").alias("accountid"),
        F.col("owner.accountant").alias("accountantid"),
        "start",
        F.date_add(F.coalesce(F.lead("start", 1).over(in_order), F.lit(today)), -1).alias("end"),
    )
    days = cast_columns(calendar.select("calendardate", period), {"date": ["calendardate"]})
    ends = days.groupBy(period).agg(F.max("calendardate").alias("date")).select("date")
    return interval_join(held, ends, "start", "end", "date").select("accountid", "date", "accountantid")
