"""Column expressions shared by several jobs; all are Spark built-ins."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_flag(*counters: str) -> Column:
    """1 if any of the counters is positive, else 0."""
    return F.when(reduce(or_, [F.col(c) > 0 for c in counters]), 1).otherwise(0)


def lookup(value: Column, names: Mapping) -> Column:
    """The name of a code by a fixed mapping; NULL for other codes."""
    pairs = [F.lit(part) for pair in names.items() for part in pair]
    return F.create_map(*pairs)[value]


def dotted_code(value: Column) -> Column:
    """``1234567`` as ``01.234.567``: eight places, left-filled with zeros."""
    padded = F.lpad(value, 8, "0")
    return F.concat_ws(".", padded.substr(1, 2), padded.substr(3, 3), padded.substr(6, 8))


def year_month(value: Column) -> Column:
    """Year and month of a date as one whole number, such as 202403."""
    return F.year(value) * 100 + F.month(value)


def number_before_colon(value: Column) -> Column:
    """The whole number from the first digit up to the next colon, or NULL."""
    return F.trim(F.regexp_extract(value, r"([0-9][^:]*):", 1)).try_cast("int")


def zero_if_null(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def not_among(value: Column, values: Iterable) -> Column:
    """True also for NULL, unlike SQL's NOT IN."""
    return value.isNull() | ~value.isin(*values)


def ntz(value) -> Column:
    """A date or time without zone as a constant, whatever the zone of the session."""
    return F.lit(str(value)).cast("timestamp_ntz")


def same_keys(left, right, keys: Iterable[str], right_prefix: str = "") -> Column:
    """Null-safe equality of all keys, so that NULL keys form a group as well."""
    return reduce(and_, [left[k].eqNullSafe(right[right_prefix + k]) for k in keys])
