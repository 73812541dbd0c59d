"""Small derived tables: publish log, survey answers, conversions, modules, startup types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.fixed_values import (
    CONVERSION_STATUS,
    MODULE_CLASSES,
    STARTUP_TYPES,
    SURVEY_ANSWERS,
)
from tidemark.functions.columns import cast_columns, clean_columns
from tidemark.functions.expressions import lookup
from tidemark.operators.latest import latest_record


def publish_log(clients: DataFrame) -> DataFrame:
    """One row per client and publish date; without a date it counts as unpublished.

    An unpublished client gets the day of its first change as its date.
    """
    first_change = clients.groupBy("publishdate", "id").agg(F.min("sysmodified").alias("changed"))
    date_type = clients.schema["publishdate"].dataType
    return first_change.select(
        F.coalesce("publishdate", F.col("changed").try_cast("date").cast(date_type)).alias("publishdate"),
        F.col("id").alias("oauthclientid"),
        F.when(F.col("publishdate").isNull(), "Unpublished").otherwise("Published").alias("event"),
    )


def latest_negative_answer(results: DataFrame, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Accounts whose newest survey row answers question 0, with the answer in words.

    Only the newest row counts: an older answer to question 0 does not.
    """
    typed = cast_columns(
        clean_columns(results, ["accountid"]),
        {
            "integer": ["divisioncode", "objectiveanswer", "questioncode"],
            "timestamp": ["createddate"],
        },
    )
    newest = latest_record(typed, ["accountid"], ["createddate desc", *tie_breakers])
    return (
        newest.where(F.col("questioncode") == 0)
        .withColumn("objectiveanswerdescription", lookup(F.col("objectiveanswer"), SURVEY_ANSWERS))
        .withColumnRenamed("createddate", "submitteddate")
        .drop("surveyresultid", "questioncode", "cigcopytime", "environment", "cigprocessed")
    )


def conversion_source(
    status: DataFrame,
    sources: DataFrame,
    status_ties: Sequence[str] = (),
    source_ties: Sequence[str] = (),
    environment: str = "NL",
) -> DataFrame:
    """Latest conversion status per division with its source described.

    The description of a source comes from one environment, so that filter runs
    before the choice of the latest text.
    """
    latest_status = latest_record(
        cast_columns(
            clean_columns(status, ["environment"]),
            {
                "timestamp": ["cigcopytime", "syscreated", "sysmodified"],
                "integer": ["division", "conversionsource", "hid", "cigprocessed", "status"],
            },
        ),
        ["environment", "division"],
        ["cigcopytime desc", *status_ties],
    )
    texts = cast_columns(
        clean_columns(sources, ["id", "environment"]).where(F.col("environment") == environment),
        {"timestamp": ["cigcopytime"]},
    )
    latest_text = latest_record(texts, ["id"], ["cigcopytime desc", *source_ties]).select(
        F.col("id").try_cast("int").alias("conversionsource"),
        F.col("descriptionsuffix").alias("conversionsourcedescription"),
    )
    return latest_status.join(latest_text, "conversionsource").select(
        "environment",
        F.col("division").alias("divisioncode"),
        "idkey",
        F.col("status").alias("conversionstatuscode"),
        lookup(F.col("status"), CONVERSION_STATUS).alias("conversionstatusdescription"),
        "userid",
        F.col("document").alias("documentid"),
        "conversionsource",
        "conversionsourcedescription",
        "dirpath",
        "syscreated",
        "sysmodified",
    )


def active_modules(
    contracts: DataFrame,
    contract_summary: DataFrame,
    accounts: DataFrame,
    packages: DataFrame,
    tie_breakers: Sequence[str] = (),
    classes: Sequence[str] = MODULE_CLASSES,
) -> DataFrame:
    """Contract lines that are the newest of their item and brought a module in.

    The accounts are filtered before the joins; the package list only decides
    how many rows a package has, never whether an account counts.
    """
    newest = latest_record(
        contracts,
        ["environment", "accountcode", "itemcode"],
        ["eventdate desc", "inflowoutflow", *tie_breakers],
    ).where((F.col("itemtype") == "Module") & (F.col("inflowoutflow") == "Inflow"))
    keys = ["environment", "accountcode"]
    current = contract_summary.where(F.col("churned") == 0).select(*keys, "latestcommpackage")
    counted = accounts.where(F.col("accountclassificationcode").isin(*classes)).select(
        *keys, "accountid"
    )
    known = packages.select("environment", F.col("packagecode").alias("latestcommpackage"))
    return (
        newest.join(current, keys)
        .join(counted, keys)
        .join(known, ["environment", "latestcommpackage"], "left")
        .select(
            "accountid",
            "environment",
            "accountcode",
            "eventyearmonth",
            "eventyear",
            "eventmonth",
            "eventdate",
            "eventtype",
            "eventdescription",
            "inflowoutflow",
            "itemcode",
            "itemdescription",
            "valuepermonth",
        )
    )


def startup_types(spark: SparkSession) -> DataFrame:
    """The fixed list of startup types."""
    return spark.createDataFrame(
        list(STARTUP_TYPES.items()), "startuptype string, startuptypedescription string"
    )
