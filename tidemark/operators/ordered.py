"""Neighbours, positions and running totals along the ordered history of a key.

A plain window sorts the whole history of a key in one task. Here a history is cut into pieces of about
``PIECE_ROWS`` rows by quantiles of the order column; the windows run per piece, and one summary row per
piece of a longer history, carried along as its first row, brings in what lies before and after. It is
one plan for every size: nothing is counted or stored beforehand, and where no history is longer
than a piece Spark finds the branches for longer ones empty while it runs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.expressions import same_keys

# Rows of a history that one task should sort, and pieces that a history is cut into at most.
PIECE_ROWS = 2_000_000
MOST_PIECES = 256

PIECE = "_piece"
FIRST = "_first"
EDGE = "_edge_"
LONG = "_long_"
CUTS = "_long_cuts"

_RANGED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)
# Floating-point values are added up as decimals of this kind, so that totals don't depend on how
# rows are spread; values beyond the limit, and those that are no numbers, as they are.
_EXACT = "decimal(38,12)"
_EXACT_BELOW = 1e20


def long_histories(df: DataFrame, keys: Sequence[str], order: str, piece_rows: int) -> DataFrame | None:
    """Keys with more rows than a piece, and the quantiles of their order column.

    There are at most rows / ``piece_rows`` of them, so the list may be broadcast. Histories ordered by
    something other than a number, date or time aren't cut: None.
    """
    if not isinstance(df.schema[order].dataType, _RANGED):
        return None
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > piece_rows)
    found = counted.select([F.col(k).alias(LONG + k) for k in keys] + ["rows"])
    rows = df.select(*keys, order).join(F.broadcast(found), same_keys(df, found, keys, LONG))
    shares = [i / MOST_PIECES for i in range(1, MOST_PIECES)]
    pieces = F.least(F.lit(MOST_PIECES), F.ceil(F.first("rows") / piece_rows))
    return rows.groupBy(*[LONG + k for k in keys]).agg(
        F.percentile_approx(order, shares, 10_000).alias(CUTS), pieces.cast("int").alias(LONG)
    )


def in_pieces(
    df: DataFrame, keys: Sequence[str], order: str, piece_rows: int
) -> tuple[DataFrame, DataFrame | None]:
    """All rows with the number of their piece, and again only those of histories in several pieces.

    Rows of one value share a piece; NULLs are in the first.
    """
    marks = long_histories(df, keys, order, piece_rows)
    if marks is None:
        return df.withColumn(PIECE, F.lit(0)), None
    below = F.size(F.filter(CUTS, lambda cut: cut < F.col(order)))
    place = F.coalesce(F.floor(below * F.col(LONG) / MOST_PIECES).cast("int"), F.lit(0))
    names = [CUTS, LONG, *[LONG + k for k in keys]]

    def joined(how: str) -> DataFrame:
        found = df.join(F.broadcast(marks), same_keys(df, marks, keys, LONG), how)
        return found.withColumn(PIECE, F.when(F.col(CUTS).isNull(), 0).otherwise(place)).drop(*names)

    return joined("left"), joined("inner")


def with_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    position: str | None = None,
    previous: Mapping[str, tuple[str, Column]] | None = None,
    following: Mapping[str, tuple[str, Column]] | None = None,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Add the row number and values of the row before and after.

    ``previous`` and ``following`` map a new column to (source column, value
    used where there is no such row). The order is ascending and should end in
    a tie-breaker; its first column is what histories are cut by.
    """
    previous, following = dict(previous or {}), dict(following or {})
    cut, long = in_pieces(df, keys, order[0], piece_rows)
    values = {f"{EDGE}{n}": F.col(c) for n, (c, _) in {**previous, **following}.items()}
    rows = cut.withColumns({FIRST: F.lit(1), EDGE: F.lit(None).cast("long"), **values})
    if long is not None:
        rows = rows.unionByName(_carried(long, keys, order, previous, following), allowMissingColumns=True)
    window = Window.partitionBy(*keys, PIECE).orderBy(FIRST, *order)
    at = F.row_number().over(window)
    is_last = F.lead(F.lit(True), 1).over(window).isNull()
    # A carried row comes first, so it is the row before the piece, and any value of it can be looked up.
    carried = F.first(FIRST).over(window) == 0
    added = {
        n: F.when(at == 1, default).otherwise(F.lag(f"{EDGE}{n}", 1).over(window)) for n, (_, default) in previous.items()
    }
    for n, (_, default) in following.items():
        after = F.when(carried, F.first(f"{EDGE}{n}").over(window)).otherwise(default)
        added[n] = F.when(is_last, after).otherwise(F.lead(f"{EDGE}{n}", 1).over(window))
    if position:
        added[position] = (at + F.coalesce(F.first(EDGE).over(window) - 1, F.lit(0))).cast("int")
    found = rows.withColumns(added).where(F.col(FIRST) == 1)
    return found.drop(PIECE, FIRST, EDGE, *values)


def _carried(
    long: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    previous: Mapping[str, tuple[str, Column]],
    following: Mapping[str, tuple[str, Column]],
) -> DataFrame:
    """One row per piece of a long history: what is before and after it, and how many rows are before."""
    in_order = F.struct(*order)
    tail = F.struct(*[F.col(c).alias(n) for n, (c, _) in previous.items()], F.lit(1).alias("_"))
    head = F.struct(*[F.col(c).alias(n) for n, (c, _) in following.items()], F.lit(1).alias("_"))
    across = Window.partitionBy(*keys).orderBy(PIECE)
    edges = (
        long.groupBy(*keys, PIECE)
        .agg(F.count(F.lit(1)).alias("rows"), F.max_by(tail, in_order).alias("tail"), F.min_by(head, in_order).alias("head"))
        .select(
            *keys,
            PIECE,
            F.lag("tail").over(across).alias("before"),
            F.lead("head").over(across).alias("after"),
            F.coalesce(F.sum("rows").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"),
        )
    )

    def brought(side: str, name: str, default: Column) -> Column:
        return F.when(F.col(side).isNull(), default).otherwise(F.col(f"{side}.{name}")).alias(f"{EDGE}{name}")

    return edges.select(
        *keys,
        PIECE,
        F.lit(0).alias(FIRST),
        F.col("offset").alias(EDGE),
        *[brought("before", n, default) for n, (_, default) in previous.items()],
        *[brought("after", n, default) for n, (_, default) in following.items()],
    )


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    name: str,
    *,
    detail: Sequence[str] = (),
    also: Mapping[str, Column] | None = None,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Total of ``value`` up to each ``order`` value; rows of one instant share it.

    The input is reduced to one row per key, instant and ``detail`` first, which
    gives the same totals and shrinks the history inside the map tasks. The
    result has these columns, ``name`` and one per aggregate in ``also``. Floating-point values are
    added up to 12 places, so totals are the same however many pieces there are.
    """
    exact, odd = f"{EDGE}exact", f"{EDGE}odd"
    held = F.col(value)
    if isinstance(df.schema[value].dataType, (T.FloatType, T.DoubleType)):
        plain = F.abs(held) < _EXACT_BELOW
        parts = {exact: F.when(plain, held).cast(_EXACT), odd: F.when(~plain, held).cast("double")}
    else:
        parts = {exact: held}
    cut, long = in_pieces(df.withColumns(parts), keys, order, piece_rows)
    sums = [F.sum(part).alias(part) for part in parts]
    extra = [aggregate.alias(column) for column, aggregate in (also or {}).items()]
    instants = cut.groupBy(*keys, PIECE, order, *detail).agg(*sums, *extra)
    together = instants.withColumn(FIRST, F.lit(1))
    if long is not None:
        before = Window.partitionBy(*keys).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
        carried = long.groupBy(*keys, PIECE).agg(*sums).select(
            *keys, PIECE, F.lit(0).alias(FIRST), *[F.sum(part).over(before).alias(part) for part in parts]
        )
        together = together.unionByName(carried, allowMissingColumns=True)
    upto = Window.partitionBy(*keys, PIECE).orderBy(FIRST, order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    totals = together.withColumns({part: F.sum(part).over(upto) for part in parts}).where(F.col(FIRST) == 1)
    total = F.col(exact)
    if odd in parts:
        total = total.cast("double")
        total = F.when(F.col(odd).isNull(), total).otherwise(F.coalesce(total, F.lit(0.0)) + F.col(odd))
    return totals.select(*keys, order, *detail, total.alias(name), *[F.col(c) for c in also or {}])
