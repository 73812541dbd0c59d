"""Lifecycle log of divisions: when each one started, was blocked, ended and so on."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.fixed_values import (
    EARLIEST_REAL_TIME,
    HISTORY_START,
    HISTORY_START_US,
    NO_NEIGHBOUR_CODE,
    NO_NEIGHBOUR_TIME,
)
from tidemark.functions.columns import cast_columns, upper_trim
from tidemark.functions.expressions import ntz, year_month
from tidemark.operators.ordered import PIECE_ROWS, with_neighbours

EVENTS = ("archived", "blocked", "blockedanddeleted", "deleted", "ended", "startdate")
BLOCKED = 101
OPEN = 0
PARTLY_BLOCKED = 100


def first_match(*arms: tuple[Column, Column]) -> Column:
    """The value of the first condition that holds, or NULL."""
    value = F
    for condition, result in arms:
        value = value.when(condition, result)
    return value


def _with_history(raw: DataFrame, tie_breakers: Sequence[str], piece_rows: int) -> DataFrame:
    typed = cast_columns(
        raw,
        {
            "timestamp": ["cigcopytime", "deleted", "enddate", "syscreated", "sysmodified"],
            "integer": ["blockingstatus", "status"],
        },
    )
    typed = upper_trim(typed, ["environment"]).withColumn("code", F.trim(F.col("code").cast("string")))
    code, time = F.lit(NO_NEIGHBOUR_CODE), ntz(NO_NEIGHBOUR_TIME)
    return with_neighbours(
        typed,
        ["code", "environment"],
        ["cigcopytime", *tie_breakers],
        position="position",
        previous={
            "blocking_before": ("blockingstatus", code),
            "status_before": ("status", code),
            "deleted_before": ("deleted", time),
            "end_before": ("enddate", time),
        },
        following={
            "status_after": ("status", code),
            "deleted_after": ("deleted", time),
            "end_after": ("enddate", time),
        },
        piece_rows=piece_rows,
    )


def _is_change() -> Column:
    """Rows at which something begins or turns, and the first two of a history."""
    no_row, no_time = F.lit(NO_NEIGHBOUR_CODE), ntz(NO_NEIGHBOUR_TIME)
    blocking, blocking_before = F.col("blockingstatus"), F.col("blocking_before")
    status, status_before = F.col("status"), F.col("status_before")

    def set_for_good(name: str, before: str, after: str) -> Column:
        return F.col(name).isNotNull() & F.col(before).isNull() & F.col(after).isNotNull()

    return (
        ((blocking == BLOCKED) & (blocking_before <= PARTLY_BLOCKED))
        | ((blocking == OPEN) & (blocking_before == no_row))
        | ((status == 1) & (status_before == 0) & (F.col("status_after") != 0))
        | (status.isin(0, 1) & (status_before == no_row))
        | set_for_good("deleted", "deleted_before", "deleted_after")
        | (F.col("deleted").isNull() & (F.col("deleted_before") == no_time))
        | set_for_good("enddate", "end_before", "end_after")
        | (F.col("enddate").isNull() & (F.col("end_before") == no_time))
        | F.col("position").isin(1, 2)
    )


def classified_changes(
    raw: DataFrame,
    today: date,
    tie_breakers: Sequence[str] = (),
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Changes in the history of each division with their event and its date.

    The event and its date follow separate rules; arms that an earlier arm
    always catches are left out.
    """
    rows = _with_history(raw, tie_breakers, piece_rows).where(_is_change())

    position = F.col("position")
    copied = F.to_date("cigcopytime")
    started_us = (copied == F.lit(HISTORY_START_US)) & (F.col("environment") == "US")
    after_start = copied > F.lit(HISTORY_START)
    after_or_us = after_start | started_us

    real = ntz(EARLIEST_REAL_TIME)
    is_blocked = F.col("blockingstatus") == BLOCKED
    newly_blocked = is_blocked & (F.col("blocking_before") == OPEN)
    fully_blocked = is_blocked & (F.col("blocking_before") == PARTLY_BLOCKED)
    deleted, ended = F.col("deleted"), F.col("enddate")
    was_deleted = F.col("deleted_before").isNotNull()
    had_end = F.col("end_before").isNotNull()
    has_ended = ended.isNotNull() & (ended < F.lit(today))
    archived_now = (F.col("status") == 1) & (F.col("status_before") == 0)
    archived = (F.col("status") == 1) & F.col("status_before").isin(1, NO_NEIGHBOUR_CODE)

    event = first_match(
        ((position == 1) & copied.isNotNull(), F.lit("startdate")),
        ((position == 2) & after_or_us & is_blocked & deleted.isNotNull(), F.lit("deleted")),
        ((position == 2) & after_or_us & has_ended, F.lit("ended")),
        ((position == 2) & after_or_us & is_blocked, F.lit("blocked")),
        ((position == 3) & after_start & is_blocked, F.lit("blocked")),
        (newly_blocked & (deleted > real) & ~(was_deleted & had_end), F.lit("blockedanddeleted")),
        (fully_blocked & (deleted > real), F.lit("blockedanddeleted")),
        (newly_blocked, F.lit("blocked")),
        (archived_now | archived, F.lit("archived")),
        ((deleted > real) & ~was_deleted, F.lit("deleted")),
        ((ended > real) & ~had_end, F.lit("ended")),
    )
    event_date = first_match(
        ((position == 1) & copied.isNotNull(), F.col("syscreated")),
        ((position == 2) & after_start & is_blocked & deleted.isNotNull(), deleted),
        ((position == 2) & after_start & has_ended, ended),
        ((position == 2) & after_or_us & is_blocked, F.col("sysmodified")),
        ((position == 3) & after_start & is_blocked, F.col("sysmodified")),
        (newly_blocked & (deleted > real) & ~was_deleted, deleted),
        (newly_blocked & (ended > real) & ~had_end, ended),
        (fully_blocked & (deleted > real), deleted),
        (newly_blocked | archived_now, F.col("cigcopytime")),
        (archived, F.col("sysmodified")),
        ((deleted > real) & ~was_deleted, deleted),
        ((ended > real) & ~had_end, ended),
    )
    return (
        rows.withColumns({"event": event, "eventdate": event_date})
        .where(F.col("event").isNotNull())
        .select("code", "environment", "event", "eventdate")
    )


def lifecycle_log(
    raw: DataFrame,
    today: date,
    tie_breakers: Sequence[str] = (),
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """One row per division with the first date of each event and its year-month."""
    changes = classified_changes(raw, today, tie_breakers, piece_rows)
    pivoted = (
        changes.groupBy("code", "environment")
        .pivot("event", list(EVENTS))
        .agg(F.min("eventdate"))
        .withColumnRenamed("code", "divisioncode")
    )
    log = cast_columns(pivoted, {"integer": ["divisioncode"]})
    labels = {name: "started" if name == "startdate" else name for name in EVENTS}
    return log.withColumns({f"yearmonth{labels[n]}": year_month(F.col(n)) for n in EVENTS})
