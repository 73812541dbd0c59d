"""Request tables by type: one pass over the history, one output per description."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.fixed_values import REQUEST_UPPER
from tidemark.functions.columns import cast_columns, clean_columns, drop_columns, rename_columns
from tidemark.functions.expressions import dotted_code
from tidemark.operators.latest import latest_record
from tidemark.sources.files import read_text
from tidemark.sources.sinks import write_if_any

REQUEST_NAME = "_request_name"


@dataclass(frozen=True)
class RequestTable:
    """One request type: which rows, which columns, which types."""

    name: str
    condition: str
    select: Sequence[str]
    rename: Mapping[str, str] = field(default_factory=dict)
    drop: Sequence[str] = ()
    types: Mapping[str, Sequence[str]] = field(default_factory=dict)
    destination: str | None = None


def requests_from_settings(spark: SparkSession, path: str) -> list[RequestTable]:
    """Read the JSON settings of the request tables."""
    return [
        RequestTable(
            name=entry["name"],
            condition=entry["filter_condition"],
            select=entry["columns_to_select"],
            rename=entry["columns_to_rename"],
            drop=entry["columns_to_drop"],
            types={
                "timestamp": entry["timestamp_columns"],
                "integer": entry["integer_columns"],
                "double": entry["double_cols"],
                "date": entry["date_columns"],
                "boolean": entry["boolean_cols"],
            },
            destination=entry["s3_destination"],
        )
        for entry in json.loads(read_text(spark, path))["settings"]
    ]


def latest_requests(
    raw: DataFrame, tables: Sequence[RequestTable], tie_breakers: Sequence[str] = ()
) -> DataFrame:
    """The latest row per request type and id, for all types in one pass.

    Each row is tagged with the names of the types it belongs to; a row that
    belongs to none leaves before the shuffle.
    """
    cleaned = clean_columns(raw, REQUEST_UPPER)
    matches = F.filter(
        F.array(*[F.when(F.expr(t.condition), F.lit(t.name)) for t in tables]),
        lambda name: name.isNotNull(),
    )
    tagged = cleaned.withColumn(REQUEST_NAME, F.explode(matches))
    return latest_record(tagged, [REQUEST_NAME, "id"], ["cigcopytime desc", *tie_breakers])


def request_table(latest: DataFrame, table: RequestTable) -> DataFrame:
    """The columns of one request type."""
    df = latest.where(F.col(REQUEST_NAME) == table.name).drop(REQUEST_NAME)
    df = rename_columns(drop_columns(df, table.drop), table.rename)
    df = df.withColumns(
        {
            "requesthid": F.lpad("requesthid", 8, "0"),
            "requestcode": dotted_code(F.col("requesthid")),
        }
    )
    return cast_columns(df, table.types).select(*table.select)


def write_requests(
    raw: DataFrame, tables: Sequence[RequestTable], tie_breakers: Sequence[str] = ()
) -> list[str]:
    """Write every request table that has rows; returns their names."""
    latest = latest_requests(raw, tables, tie_breakers).persist()
    try:
        return [
            table.name
            for table in tables
            if write_if_any(request_table(latest, table), table.destination)
        ]
    finally:
        latest.unpersist()
