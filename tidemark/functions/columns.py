"""Column-list operators: cleaning, typing, renaming, adding and dropping.

Each one is a single projection, whatever the number of columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from fnmatch import fnmatchcase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Type groups in the order in which they are applied; a column named in two
# groups goes through both casts.
TYPE_GROUPS = {
    "timestamp": "timestamp_ntz",
    "integer": "int",
    "long": "bigint",
    "boolean": "boolean",
    "double": "double",
    "float": "float",
    "date": "date",
}


def matching(names: Iterable[str], patterns: Iterable[str]) -> list[str]:
    """The names that match a pattern (``*`` allowed), ignoring case."""
    lowered = [pattern.lower() for pattern in patterns]
    return [name for name in names if any(fnmatchcase(name.lower(), p) for p in lowered)]


# Texts that Spark reads as a boolean.
TRUE_TEXTS = ("t", "true", "y", "yes", "1")
FALSE_TEXTS = ("f", "false", "n", "no", "0")
WHOLE_NUMBER = r"^\s*[+-]?\d+(\.\d*)?\s*$"


def cast_value(value: Column, sql_type: str, from_text: bool) -> Column:
    """Cast that gives NULL for unreadable values.

    Whole-number targets also read text with a fraction, which is cut off. Text
    is tested before the cast to a whole number, and read as a boolean by
    comparison: a failing ``try_cast`` to these types raises and catches an
    error for each value, which costs far more than the test.
    """
    if from_text and sql_type in ("int", "bigint"):
        whole = F.substring_index(value, ".", 1).try_cast(sql_type)
        return F.when(value.rlike(WHOLE_NUMBER), whole)
    if from_text and sql_type == "boolean":
        text = F.lower(F.trim(value))
        return F.when(text.isin(*TRUE_TEXTS), True).when(text.isin(*FALSE_TEXTS), False)
    return value.try_cast(sql_type)


def casts_by_column(
    names: Iterable[str], groups: Mapping[str, Iterable[str]]
) -> dict[str, list[str]]:
    """The casts each column goes through: ``{"integer": ["hid"], "date": ["*day"]}``."""
    unknown = set(groups) - set(TYPE_GROUPS)
    if unknown:
        raise ValueError(f"unknown type groups: {sorted(unknown)}")
    names = list(names)
    casts: dict[str, list[str]] = {}
    for group, sql_type in TYPE_GROUPS.items():
        for name in matching(names, groups.get(group, ())):
            casts.setdefault(name, []).append(sql_type)
    return casts


def cast_all(value: Column, sql_types: Iterable[str], from_text: bool) -> Column:
    """Several casts one after the other."""
    for sql_type in sql_types:
        value, from_text = cast_value(value, sql_type, from_text), False
    return value


def text_columns(df: DataFrame) -> set[str]:
    return {field.name for field in df.schema if isinstance(field.dataType, T.StringType)}


def cast_columns(df: DataFrame, groups: Mapping[str, Iterable[str]]) -> DataFrame:
    """Cast columns by group: ``{"integer": ["hid"], "date": ["*day"]}``."""
    text = text_columns(df)
    values = {
        name: cast_all(F.col(f"`{name}`"), sql_types, name in text)
        for name, sql_types in casts_by_column(df.columns, groups).items()
    }
    return df.withColumns(values) if values else df


def clean_columns(df: DataFrame, upper: Iterable[str] = ()) -> DataFrame:
    """Trim every column, which makes it text, and upper-case the named ones."""
    raised = set(matching(df.columns, upper))
    cleaned = []
    for name in df.columns:
        value = F.trim(F.col(f"`{name}`").cast("string"))
        cleaned.append((F.upper(value) if name in raised else value).alias(name))
    return df.select(cleaned)


def upper_trim(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Trim and upper-case the named columns only."""
    found = matching(df.columns, names)
    return df.withColumns({n: F.upper(F.trim(F.col(f"`{n}`"))) for n in found}) if found else df


def trim_text(df: DataFrame, upper: Iterable[str] = ()) -> DataFrame:
    """Trim the text columns and upper-case the named ones; types stay as they are."""
    raised = set(matching(df.columns, upper))
    trimmed = {}
    for name in text_columns(df):
        value = F.trim(F.col(f"`{name}`"))
        trimmed[name] = F.upper(value) if name in raised else value
    return df.withColumns(trimmed) if trimmed else df


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by mapping; absent sources are ignored."""
    return df.withColumnsRenamed(dict(mapping)) if mapping else df


def add_missing_columns(df: DataFrame, names: Iterable[str], sql_type: str) -> DataFrame:
    """Add the columns that are not there yet as typed NULLs."""
    present = {name.lower() for name in df.columns}
    absent = [name for name in names if name.lower() not in present]
    return df.withColumns({n: F.lit(None).cast(sql_type) for n in absent}) if absent else df


def drop_columns(df: DataFrame, patterns: Iterable[str]) -> DataFrame:
    """Drop columns by pattern; absent ones are ignored."""
    return df.drop(*matching(df.columns, patterns))


def suffix_columns(df: DataFrame, suffix: str) -> DataFrame:
    """Append a suffix to every column name."""
    return df.select([F.col(f"`{name}`").alias(name + suffix) for name in df.columns])
