"""Joins of intervals with the points that lie in them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BIN = "_bin"


def interval_join(
    intervals: DataFrame,
    points: DataFrame,
    start: str,
    end: str,
    point: str,
    *,
    keys: Sequence[str] = (),
    bin_days: int = 31,
) -> DataFrame:
    """Every interval with every date in it, both ends included.

    Time is cut into bins of equal width. An interval is repeated for each bin it touches and joined to the
    points of the bin by equality, and to those in its range by a test after it, so no
    range is joined. Bins should be no wider than a usual interval and hold a bounded number
    of points; the result doesn't depend on their width. Intervals and points without a date match nothing.
    """
    first, last, at = (F.unix_date(F.col(name)) for name in (start, end, point))
    width = F.lit(bin_days)
    touched = F.sequence(F.floor(first / width).cast("int"), F.floor(last / width).cast("int"))
    cut = intervals.where(F.col(start) <= F.col(end)).withColumn(BIN, F.explode(touched))
    placed = points.where(F.col(point).isNotNull()).withColumn(BIN, F.floor(at / width).cast("int"))
    joined = cut.join(placed, [*keys, BIN]).where(F.col(point).between(F.col(start), F.col(end)))
    return joined.drop(BIN)
