"""Master-data setup: how each division got its master data, by first-match rules.

Every side table is reduced to one row per division before it is joined, so no
step multiplies rows, and the division rows keep one partitioning throughout.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.fixed_values import (
    ACCESS_ACTIVITY,
    ACCOUNTANT_TEMPLATE,
    BLOCKED_FROM,
    CONVERSION,
    COPY,
    DEMO,
    EMPTY,
    IMPORT,
    IMPORT_ACTIVITIES,
    IMPORT_SUCCESS_ACTIVITIES,
    REJECTED_REQUEST_STATUS,
    SAVE_ACTIVITY,
    SAVES_STARTED,
    SETUP_SINCE,
    TEMPLATE,
    TEMPORARY,
    TRANSFER,
)
from tidemark.functions.columns import cast_value, trim_text
from tidemark.functions.expressions import not_among, ntz, number_before_colon
from tidemark.operators.latest import latest_record
from tidemark.operators.ordered import PIECE_ROWS, running_total

DIVISION = ["environment", "divisioncode"]
SETUP_COLUMNS = [
    "environment",
    "divisioncode",
    "accountcode",
    "divisionstartuptypecode",
    "divisioncreated",
    "templatedivisioncode",
    "notes",
    "accountid",
    "divisionfirstaccessed",
    "eventstarttime",
    "eventlatesttime",
    "masterdatasetuptype",
    "masterdatasetupstatus",
]


def whole_number(name: str, df: DataFrame) -> Column:
    """A code as a whole number; text with a fraction is cut."""
    return cast_value(F.col(name), "int", isinstance(df.schema[name].dataType, T.StringType))


def current_type() -> Column:
    return F.col("masterdatasetuptype")


def current_status() -> Column:
    return F.col("masterdatasetupstatus")


def assign(df: DataFrame, guard: Column, **values: Column) -> DataFrame:
    """Overwrite columns in the rows where the guard holds."""
    return df.withColumns({n: F.when(guard, v).otherwise(F.col(n)) for n, v in values.items()})


def add_divisions(
    setup: DataFrame, divisions: DataFrame, statistics: DataFrame, contracts: DataFrame
) -> DataFrame:
    """Append divisions that are not in the setup table yet.

    Only those count whose trial or contract, or the division itself, started
    in the period the table covers.
    """
    since = ntz(SETUP_SINCE)
    started = F.when(F.col("hadtrial") == 1, F.col("firsttrialstartdate")).otherwise(
        F.col("firstcommstartdate")
    )
    eligible = contracts.select(
        "accountid", "accountcode", (started >= since).alias("started_in_period")
    )
    new = (
        divisions.select(*DIVISION, "accountid", F.col("syscreated").alias("divisioncreated"))
        .join(setup.select(*DIVISION), DIVISION, "left_anti")
        .join(statistics.select(*DIVISION, "startuptype", "templatedivision"), DIVISION)
        .join(eligible, "accountid")
        .where(F.col("started_in_period") | (F.col("divisioncreated") >= since))
        .select(
            *DIVISION,
            "accountcode",
            F.col("startuptype").alias("divisionstartuptypecode"),
            "divisioncreated",
            whole_number("templatedivision", statistics).alias("templatedivisioncode"),
            "accountid",
        )
    )
    return setup.select(*SETUP_COLUMNS).unionByName(new, allowMissingColumns=True)


def refresh_owner(setup: DataFrame, divisions: DataFrame) -> DataFrame:
    """Take the current owner of each division; rows without a division leave."""
    owners = divisions.select(*DIVISION, F.col("accountid").alias("owner"))
    joined = setup.join(owners, DIVISION)
    return assign(joined, F.col("accountid") != F.col("owner"), accountid=F.col("owner")).drop("owner")


def with_activity_facts(setup: DataFrame, activity: DataFrame) -> DataFrame:
    """Add the first access and the import moments of each division.

    Access and imports count from the creation of the division on and only for
    its owner. The activity is read once for both and reduced to one row per
    account, division and day before the join. A division has one owner here, so
    the facts are joined on the division alone, which keeps its partitioning.
    """
    keys = ["accountid", "divisioncode"]
    kind = F.col("activityid")
    days = (
        activity.where(kind.isin(ACCESS_ACTIVITY, *IMPORT_ACTIVITIES))
        .groupBy(*keys, "date")
        .agg(
            F.max(kind == ACCESS_ACTIVITY).alias("accessed"),
            F.max(kind.isin(*IMPORT_ACTIVITIES)).alias("imported"),
            F.max(kind.isin(*IMPORT_SUCCESS_ACTIVITIES)).alias("import_succeeded"),
        )
    )
    known = setup.select(*DIVISION, "accountid", "divisioncreated").distinct()
    date = F.col("date")
    facts = (
        days.join(known, keys)
        .where(date >= F.col("divisioncreated"))
        .groupBy(*DIVISION)
        .agg(
            F.min(F.when(F.col("accessed"), date)).alias("first_access"),
            F.min(F.when(F.col("imported"), date)).alias("import_start"),
            F.max(F.when(F.col("import_succeeded"), date)).alias("import_success"),
        )
    )
    return setup.join(facts, DIVISION, "left")


FACT_COLUMNS = ("first_access", "import_start", "import_success")
SAVE_COLUMNS = ("firstsave", "fifthsave")


def with_all_activity(setup: DataFrame, activity: DataFrame, threshold: int = SAVES_STARTED) -> DataFrame:
    """What ``with_activity_facts`` and ``with_save_moments`` add, from one pass over the activity.

    The activity shrinks to one row per account, division and day inside the map tasks. A division
    has at most as many of them as there are days, so its quantity is added up over time by a plain
    window; then the days meet the rows of their division, and one aggregation reads off
    the access, the imports and the saves.
    """
    kind = F.col("activityid")
    days = activity.groupBy("environment", "accountid", "accountcode", "divisioncode", "date").agg(
        F.sum("quantity").alias("reached"),
        F.max(kind == SAVE_ACTIVITY).alias("saved"),
        F.max(kind == ACCESS_ACTIVITY).alias("accessed"),
        F.max(kind.isin(*IMPORT_ACTIVITIES)).alias("imported"),
        F.max(kind.isin(*IMPORT_SUCCESS_ACTIVITIES)).alias("import_succeeded"),
    )
    upto = (
        Window.partitionBy("divisioncode", "accountcode")
        .orderBy("date")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    totals = days.withColumn("reached", F.sum("reached").over(upto))
    own = ["environment", "accountid", "accountcode"]
    found = totals.select("divisioncode", *[F.col(c).alias(f"_{c}") for c in own], *totals.columns[4:])
    known = setup.select(*DIVISION, "accountid", "accountcode", "divisioncreated").distinct()
    date = F.col("date")
    owned = (F.col("_accountid") == F.col("accountid")) & (date >= F.col("divisioncreated"))
    coded = (F.col("_environment") == F.col("environment")) & (F.col("_accountcode") == F.col("accountcode"))
    save = coded & F.col("saved") & F.col("reached").isNotNull()
    facts = (
        found.join(known, "divisioncode")
        .where(owned | save)
        .groupBy(*DIVISION, "accountid", "accountcode")
        .agg(
            F.min(F.when(owned & F.col("accessed"), date)).alias("first_access"),
            F.min(F.when(owned & F.col("imported"), date)).alias("import_start"),
            F.max(F.when(owned & F.col("import_succeeded"), date)).alias("import_success"),
            F.min(F.when(save, date)).alias("firstsave"),
            F.min(F.when(save & (F.col("reached") > threshold), date)).alias("fifthsave"),
        )
    )
    names = {c: f"_{c}" for c in (*DIVISION, "accountid", "accountcode")}
    renamed = facts.withColumnsRenamed(names)
    same = [setup[c] == renamed[f"_{c}"] for c in DIVISION]
    same += [setup[c].eqNullSafe(renamed[f"_{c}"]) for c in ("accountid", "accountcode")]
    return setup.join(renamed, reduce(and_, same), "left").drop(*names.values())


def first_accessed(setup: DataFrame) -> DataFrame:
    """Fill in the first access of rows that have none yet (after ``with_activity_facts``)."""
    found = F.col("first_access").cast("timestamp_ntz")
    return setup.withColumn("divisionfirstaccessed", F.coalesce("divisionfirstaccessed", found))


def temporary_divisions(
    setup: DataFrame, raw_divisions: DataFrame, tie_breakers: Sequence[str] = ()
) -> DataFrame:
    """Divisions whose latest raw copy is blocked."""
    rows = raw_divisions.withColumns(
        {
            "divisioncode": whole_number("code", raw_divisions),
            "blocking": whole_number("blockingstatus", raw_divisions),
            "copied": F.col("cigcopytime").try_cast("timestamp_ntz"),
        }
    )
    latest = latest_record(rows, DIVISION, ["copied desc", *tie_breakers])
    blocked = latest.where(F.col("blocking") >= BLOCKED_FROM).select(*DIVISION, F.lit(True).alias("blocked"))
    joined = setup.join(blocked, DIVISION, "left")
    return assign(
        joined, current_type().isNull() & F.col("blocked"), masterdatasetuptype=F.lit(TEMPORARY)
    ).drop("blocked")


def by_startup_type(setup: DataFrame, code: str, setup_type: str) -> DataFrame:
    """Classify rows by their startup type alone."""
    guard = current_type().isNull() & (F.col("divisionstartuptypecode") == code)
    return assign(setup, guard, masterdatasetuptype=F.lit(setup_type))


def conversions(setup: DataFrame, conversion: DataFrame, divisions: DataFrame) -> DataFrame:
    """Divisions that a conversion was made for; the holding divisions leave.

    The target of a conversion is the division its holding division links to.
    Several conversions of one target count by the one changed last; one without a
    creation time counts for nothing.
    """
    links = divisions.select(*DIVISION, whole_number("linkeddivision", divisions).alias("target"))
    targets = conversion.join(links, DIVISION).select(
        "environment",
        F.col("target").alias("divisioncode"),
        F.col("syscreated").alias("converted"),
        "sysmodified",
        F.col("conversionstatusdescription").alias("outcome"),
    )
    newest = latest_record(
        targets.where(F.col("divisioncode").isNotNull() & F.col("converted").isNotNull()),
        DIVISION,
        ["sysmodified desc", "converted desc", "outcome"],
    ).drop("sysmodified")
    joined = setup.join(newest, DIVISION, "left")
    guard = F.col("converted").isNotNull() & (
        current_type().isNull() | ((current_type() == CONVERSION) & not_among(current_status(), ["Success", "Failure"]))
    )
    status = (
        F.when(F.col("outcome") == "csHandedOver", "Success")
        .when(F.col("outcome") == "csHandoverFailed", "Failure")
        .otherwise("InProgress")
    )
    changed = assign(
        joined, guard, masterdatasetuptype=F.lit(CONVERSION), masterdatasetupstatus=status
    )
    holding = conversion.select(*DIVISION)
    return changed.drop("converted", "outcome").join(holding, DIVISION, "left_anti")


def transfers(setup: DataFrame, requests: DataFrame, executions: DataFrame) -> DataFrame:
    """Divisions that were transferred from another account.

    The comment of the execution names the division; the earliest request per
    division decides.
    """
    done = executions.select(
        F.col("relatedrequest").alias("requestid"),
        number_before_colon(F.col("requestcomments")).alias("divisioncode"),
        F.col("description").alias("outcome"),
        F.col("created").alias("transfer_start"),
        F.col("realized").alias("transfer_end"),
    )
    asked = requests.select(
        "requestid",
        "environment",
        F.col("status").alias("request_status"),
        F.col("created").alias("requested"),
        F.col("realized").alias("request_realized"),
    )
    earliest = latest_record(
        asked.join(done.where(F.col("divisioncode").isNotNull()), "requestid"),
        DIVISION,
        [
            "requested",
            "request_realized",
            "transfer_start",
            "transfer_end",
            "request_status desc",
            "outcome",
        ],
    ).drop("requestid", "request_realized")
    joined = setup.join(earliest, DIVISION, "left")
    guard = F.col("requested").isNotNull() & (
        current_type().isNull()
        | ((current_type() == TRANSFER) & not_among(current_status(), ["Success", "Failure", "Rejected"]))
    )
    rejected = F.col("request_status") == REJECTED_REQUEST_STATUS
    status = (
        F.when(F.col("outcome") == "Request To Transfer", "Success")
        .when(F.col("outcome") == "Error on Transfer", "Failure")
        .when(rejected, "Rejected")
        .when(F.col("outcome").isNull(), "In Progress")
    )
    latest = F.coalesce(F.col("transfer_end"), F.when(rejected, F.col("requested")))
    return assign(
        joined,
        guard,
        masterdatasetuptype=F.lit(TRANSFER),
        masterdatasetupstatus=status,
        eventstarttime=F.col("transfer_start"),
        eventlatesttime=latest,
    ).drop("requested", "request_status", "outcome", "transfer_start", "transfer_end")


def imports(setup: DataFrame) -> DataFrame:
    """Divisions with an attempted file import (after ``with_activity_facts``).

    An import may also replace a template or an empty start found earlier.
    """
    start, success = F.col("import_start"), F.col("import_success")
    pending = (current_type() == IMPORT) & ~current_status().eqNullSafe("Success")
    guard = (start.isNotNull() | success.isNotNull()) & (
        current_type().isNull() | pending | current_type().isin(TEMPLATE, EMPTY)
    )
    return assign(
        setup,
        guard,
        masterdatasetuptype=F.lit(IMPORT),
        masterdatasetupstatus=F.when(success.isNotNull(), "Success").otherwise("Started"),
        eventstarttime=start.cast("timestamp_ntz"),
        eventlatesttime=success.cast("timestamp_ntz"),
    )


def save_moments(
    activity: DataFrame,
    threshold: int = SAVES_STARTED,
    save_activity: str = SAVE_ACTIVITY,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """When each account first saved in a division, and first beyond the threshold.

    The quantity of all activities is added up over time; the moments are read
    off at the save activity. One row per environment, account and division.
    """
    keys = ["accountcode", "divisioncode"]
    totals = running_total(
        activity,
        keys,
        "date",
        "quantity",
        "reached",
        detail=["environment"],
        also={"saved": F.max(F.col("activityid") == save_activity)},
        piece_rows=piece_rows,
    )
    reached = totals.where(F.col("saved") & F.col("reached").isNotNull())
    return reached.groupBy("environment", *keys).agg(
        F.min("date").alias("firstsave"),
        F.min(F.when(F.col("reached") > threshold, F.col("date"))).alias("fifthsave"),
    )


def with_save_moments(setup: DataFrame, moments: DataFrame) -> DataFrame:
    return setup.join(moments, ["environment", "accountcode", "divisioncode"], "left")


def _by_saves(many: str, some: str, none: str) -> Column:
    return (
        F.when(F.col("fifthsave").isNotNull(), many)
        .when(F.col("firstsave").isNotNull(), some)
        .otherwise(none)
    )


def template_divisions(setup: DataFrame) -> DataFrame:
    """Divisions started from the legislation template (after ``with_save_moments``)."""
    pending = (current_type() == IMPORT) & ~current_status().eqNullSafe("Success")
    guard = (current_type().isNull() | pending) & (F.col("divisionstartuptypecode") == "X")
    status = _by_saves("GLChangesMade", "GLChangesStarted", "StandardTemplate")
    return assign(setup, guard, masterdatasetuptype=F.lit(TEMPLATE), masterdatasetupstatus=status)


def empty_divisions(setup: DataFrame) -> DataFrame:
    """Divisions started without master data (after ``with_save_moments``)."""
    guard = current_type().isNull() & (F.col("divisionstartuptypecode") == "E")
    status = _by_saves("GLAccountsAdded", "GLAccountsStarted", "NoChanges")
    return assign(setup, guard, masterdatasetuptype=F.lit(EMPTY), masterdatasetupstatus=status)


@dataclass(frozen=True)
class SetupSources:
    """The tables that the rules look at."""

    raw_divisions: DataFrame
    divisions: DataFrame
    statistics: DataFrame
    contracts: DataFrame
    activity: DataFrame
    conversion: DataFrame
    transfer_requests: DataFrame
    transfer_executions: DataFrame

    def cleaned(self) -> SetupSources:
        """The same tables with trimmed text and environments in upper case."""
        frames = {f.name: getattr(self, f.name) for f in fields(self)}
        return SetupSources(**{n: trim_text(df, ["environment"]) for n, df in frames.items()})


def master_data_setup(
    setup: DataFrame, sources: SetupSources, tie_breakers: Sequence[str] = ()
) -> DataFrame:
    """Run all rules in their order; the first that matches a division counts."""
    s = sources.cleaned()
    setup = trim_text(setup, ["environment"])
    setup = add_divisions(setup, s.divisions, s.statistics, s.contracts)
    setup = refresh_owner(setup, s.divisions)
    setup = with_all_activity(setup, s.activity)
    setup = first_accessed(setup)
    setup = temporary_divisions(setup, s.raw_divisions, tie_breakers)
    setup = by_startup_type(setup, "Y", DEMO)
    setup = conversions(setup, s.conversion, s.divisions)
    setup = transfers(setup, s.transfer_requests, s.transfer_executions)
    setup = imports(setup)
    setup = template_divisions(setup)
    setup = by_startup_type(setup, "A", ACCOUNTANT_TEMPLATE)
    setup = by_startup_type(setup, "D", COPY)
    setup = empty_divisions(setup)
    return setup.select(*SETUP_COLUMNS)
