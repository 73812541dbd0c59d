"""Division statistics: daily rows, glitch repair, day-to-day changes, summary."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.fixed_values import (
    BANK_LINK_COUNTERS,
    CHANGE_COUNTERS,
    DAILY_DROPPED,
    LATER_COUNTERS,
    STATISTICS_ADDED,
    STATISTICS_COUNTERS,
    STATISTICS_FLOATS,
    STATISTICS_MOMENTS,
)
from tidemark.functions.columns import (
    add_missing_columns,
    cast_columns,
    drop_columns,
    upper_trim,
)
from tidemark.functions.expressions import any_flag, same_keys, zero_if_null
from tidemark.operators.latest import latest_record
from tidemark.sources.tables import INGESTION_DAY, days_between, on_day

DIVISION = ("environment", "divisioncode")

DERIVED_COUNTERS = ("divisioncode", "automaticbanklink")


def statistics_types(columns: Sequence[str], untyped: Sequence[str] = ()) -> dict[str, list[str]]:
    """The listed columns among these by type; all others, and the ``untyped`` ones, stay as they are."""
    present = {name.lower(): name for name in columns}
    listed = {
        "float": STATISTICS_FLOATS,
        "timestamp": STATISTICS_MOMENTS,
        "long": (*STATISTICS_COUNTERS, *DERIVED_COUNTERS),
    }
    return {kind: [present[n] for n in names if n in present and n not in untyped] for kind, names in listed.items()}


def with_bank_link(df: DataFrame) -> DataFrame:
    """Add the flag for any automatic bank link."""
    return df.withColumn("automaticbanklink", any_flag(*BANK_LINK_COUNTERS))


def daily_statistics(
    raw: DataFrame, ingestion_day: date, snapshot_date: date, tie_breakers: Sequence[str] = ()
) -> DataFrame:
    """The statistics ingested on one day, as rows of ``snapshot_date``."""
    day = cast_columns(on_day(raw, ingestion_day), {"timestamp": ["cigcopytime"]})
    newest = latest_record(day, ["environment", "division"], ["cigcopytime desc", *tie_breakers])
    flagged = with_bank_link(newest.withColumnRenamed("division", "divisioncode"))
    kept = drop_columns(flagged, DAILY_DROPPED)
    typed = cast_columns(kept, statistics_types(kept.columns, STATISTICS_ADDED))
    return typed.withColumn("date", F.lit(snapshot_date))


def zero_glitch_rows(
    days: DataFrame,
    keys: Sequence[str] = DIVISION,
    day: str = "date",
    counter: str = "gltransactionscount",
) -> DataFrame:
    """Days on which a counter drops to zero although it is positive before and after.

    NULL counts as zero. The input holds one row per key and day and only the
    days to look at (three for the daily repair), so a key has few rows.
    """
    newest_first = Window.partitionBy(*keys).orderBy(F.col(day).desc())
    return (
        days.withColumn(counter, zero_if_null(counter))
        .withColumns(
            {
                "later": F.lag(counter).over(newest_first),
                "earlier": F.lead(counter).over(newest_first),
            }
        )
        .where(
            (F.col(counter) == 0)
            & (F.col("later") > 0)
            & (F.col("earlier") > 0)
            & F.col("vattransactions").isNull()
            & (zero_if_null("accountcount") == 0)
        )
        .drop("later", "earlier")
    )


def zero_glitch_repair(
    partition: DataFrame, days: DataFrame, keys: Sequence[str] = DIVISION, day: str = "date"
) -> DataFrame:
    """The rows of ``partition`` without those that are glitches within ``days``."""
    needed = [*keys, day, "gltransactionscount", "vattransactions", "accountcount"]
    glitches = zero_glitch_rows(days.select(*needed), keys, day).select(*keys, day)
    return partition.join(glitches, [*keys, day], "left_anti")


def daily_changes(
    daily: DataFrame, counters: Sequence[str] = CHANGE_COUNTERS
) -> DataFrame:
    """Each counter of the newest day minus that of the key's last earlier day.

    Two candidate rows per key are picked by one aggregation, which runs inside
    the map tasks first; keys without a row on the newest day are left out, and
    a missing earlier row counts as zeros.
    """
    keys = list(DIVISION)
    day = F.col("date")
    rows = upper_trim(daily.select(*keys, "date", *counters), ["environment"])
    newest = daily.agg(F.max("date")).scalar()
    values = F.struct(*counters)
    picked = (
        rows.withColumn("newest", newest)
        .groupBy(*keys)
        .agg(
            F.max_by(values, F.when(day == F.col("newest"), day)).alias("recent"),
            F.max_by(values, F.when(day < F.col("newest"), day)).alias("older"),
            F.max("newest").alias("newest"),
            F.max("date").alias("date"),
        )
        .where(F.col("date") == F.col("newest"))
    )
    changes = [
        (zero_if_null(f"recent.{c}") - zero_if_null(f"older.{c}")).cast("bigint").alias(c)
        for c in counters
    ]
    return picked.select("environment", F.col("divisioncode").try_cast("bigint").alias("divisioncode"), "date", *changes)


def changes_since(
    newest: DataFrame, last: DataFrame, counters: Sequence[str] = CHANGE_COUNTERS
) -> DataFrame:
    """The same from the rows of the newest day and the last earlier row of each key.

    ``last`` is the state that ``last_rows`` gives, so no other day is read.
    """
    rows = upper_trim(newest.select(*DIVISION, "date", *counters), ["environment"]).dropDuplicates(list(DIVISION))
    older = last.select(*[F.col(c).alias(f"_old_{c}") for c in (*DIVISION, *counters)])
    joined = rows.join(older, same_keys(rows, older, DIVISION, "_old_"), "left")
    changes = [(zero_if_null(c) - zero_if_null(f"_old_{c}")).cast("bigint").alias(c) for c in counters]
    return joined.select("environment", F.col("divisioncode").try_cast("bigint").alias("divisioncode"), "date", *changes)


def last_rows(daily: DataFrame, counters: Sequence[str] = CHANGE_COUNTERS) -> DataFrame:
    """The last row of each key: the state from which the changes of a later day are told."""
    rows = upper_trim(daily.select(*DIVISION, "date", *counters), ["environment"])
    return latest_record(rows, DIVISION, ["date desc"])


def summary_news(
    raw: DataFrame, after: date | None = None, until: date | None = None, tie_breakers: Sequence[str] = ()
) -> DataFrame:
    """The newest raw row of every division with news, typed: what an upsert puts into the summary.

    With ``until`` the raw table is cut to the ingestion days after the last
    update first, and all of them are handled in one pass: a later ingestion day
    beats an earlier one, then the later copy time decides.
    """
    order = ["cigcopytime desc", *tie_breakers]
    if until is not None:
        raw = days_between(raw, after, until)
        order = [F.make_date(*[F.col(p).try_cast("int") for p in INGESTION_DAY]).desc(), *order]
    # Only what the choice depends on is typed in all rows, the rest in one per division.
    raw = upper_trim(add_missing_columns(raw, LATER_COUNTERS, "bigint"), ["environment"])
    raw = cast_columns(raw, {"timestamp": ["cigcopytime"], "long": ["division"]})
    newest = latest_record(raw, ["environment", "division"], order)
    newest = drop_columns(newest, [name for name in DAILY_DROPPED if name.startswith("free")])
    newest = cast_columns(newest, statistics_types(newest.columns))
    return with_bank_link(newest.withColumnRenamed("division", "divisioncode"))


def summary_upsert(
    raw: DataFrame,
    summary: DataFrame,
    after: date | None = None,
    until: date | None = None,
    tie_breakers: Sequence[str] = (),
) -> DataFrame:
    """The summary with the newest raw row per division put in place of the old one.

    The summary holds one row per division; rows without news pass unchanged, without a ranking. A
    summary stored in buckets takes ``summary_news`` and leaves the other buckets alone.
    """
    newest = summary_news(raw, after, until, tie_breakers)
    pending = raw if until is None else days_between(raw, after, until)
    pending = cast_columns(upper_trim(pending, ["environment"]), {"long": ["division"]})
    changed = pending.select(F.col("environment").alias("_new_environment"), F.col("division").alias("_new_divisioncode"))
    old = summary.join(changed.distinct(), same_keys(summary, changed, DIVISION, "_new_"), "left_anti")
    return old.unionByName(newest, allowMissingColumns=True)
