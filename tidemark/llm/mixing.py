"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions only.

Every document of a source should be taken ``target / size of the source`` times. The whole
part is taken as it is; the fractions are rounded together: two documents meet, words move from
one's fraction to the other's until one of the two is a whole number, and the other goes on to
meet the next. The direction is drawn so that each document's expected copies stay, and the
words moved are the same on both sides, so the total stays too. Documents meet in blocks; what is
left of a block (one fraction) meets what is left of others, in a tree that ends with one
fraction per source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import documents, stored

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
BLOCK = 128

WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_UNIT = ("row_key", "doc_id", "place", "source", "size", "whole", "chance", "source_size", "target")


def source_targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``source``, ``source_size`` and ``target`` of every source.

    All words are shared by weight, sources ordered by code point with null last and the
    weights repeating. A source gets at most ``most`` times its words; the rest is shared again.
    The level at which the shares of the uncapped sources use up everything is found in one
    ordered pass: sources are capped in the order of cap by weight.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    weighed = sizes.withColumn("weight", weight.cast("double")).withColumn("cap", most * F.col("source_size").cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    levels = weighed.withColumn("level", level)
    fitting = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))
    shared = F.coalesce(F.max(fitting).over(every), F.lit(float("inf")))
    return levels.select("source", "source_size", F.least("cap", shared * F.col("weight")).alias("target"))


def _meet() -> str:
    """SQL: fold a block's documents into decided ones and one open fraction.

    ``c`` is the open document, ``u`` the next one. Up: words move from u to c; down: back.
    """
    up = "least(a.c.size * (1 - a.c.chance), u.size * u.chance)"
    down = "least(a.c.size * a.c.chance, u.size * (1 - u.chance))"
    draw = "pmod(xxhash64(a.c.place, u.place, 29), 4194304) / 4194304D"
    rises = f"{draw} * greatest({up} + {down}, 1e-300D) < {down}"

    def with_chance(name: str, chance: str) -> str:
        fields = ", ".join(f"'{f}', " + (chance if f == "chance" else f"{name}.{f}") for f in _UNIT)
        return f"named_struct({fields})"

    def inside(value: str) -> str:
        return f"least(greatest({value}, 0D), 1D)"

    def step(carry: str, decided: str) -> str:
        return f"named_struct('c', {carry}, 'done', array_append(a.done, {decided}))"

    moved = {
        "c_full": step(with_chance("u", inside("u.chance - a.c.size * (1 - a.c.chance) / u.size")), with_chance("a.c", "1D")),
        "u_empty": step(with_chance("a.c", inside("a.c.chance + u.size * u.chance / a.c.size")), with_chance("u", "0D")),
        "c_empty": step(with_chance("u", inside("u.chance + a.c.size * a.c.chance / u.size")), with_chance("a.c", "0D")),
        "u_full": step(with_chance("a.c", inside("a.c.chance - u.size * (1 - u.chance) / a.c.size")), with_chance("u", "1D")),
    }
    return f"""
        CASE WHEN a.c IS NULL THEN named_struct('c', u, 'done', a.done)
        WHEN {rises} THEN
            CASE WHEN a.c.size * (1 - a.c.chance) <= u.size * u.chance THEN {moved["c_full"]} ELSE {moved["u_empty"]} END
        ELSE
            CASE WHEN a.c.size * a.c.chance <= u.size * (1 - u.chance) THEN {moved["c_empty"]} ELSE {moved["u_full"]} END
        END"""


def _fold(units: DataFrame) -> DataFrame:
    """One row per source and block: ``c``, the open document, and ``done``, the decided ones."""
    kind = (
        "struct<row_key: bigint, doc_id: bigint, place: bigint, source: string, size: bigint, whole: bigint, chance: double,"
        " source_size: bigint, target: double>"
    )
    # Large documents meet first: what stays open at the end is then a small one.
    order = F.struct((-F.col("size")).alias("size"), F.xxhash64("place", F.lit(5)).alias("draw"))
    unit = F.struct(order.alias("order"), F.struct(*_UNIT).alias("unit"))
    listed = units.groupBy("source", "block").agg(F.collect_list(unit).alias("units"))
    ordered = listed.withColumn("units", F.transform(F.array_sort("units"), lambda x: x.unit))
    start = f"named_struct('c', CAST(NULL AS {kind}), 'done', CAST(array() AS array<{kind}>))"
    folded = F.expr(f"aggregate(units, {start}, (a, u) -> {_meet()})")
    return ordered.select("source", "block", folded.alias("folded")).select("source", "block", "folded.*")


def _numbered(sized: DataFrame) -> DataFrame:
    """Give rows that share a place places of their own.

    Rows of a place are numbered 0, 1, ... within their part of the input, and on from part to part,
    so a place that very many rows share is no single task's work.
    """
    in_part = Window.partitionBy("place", "part").orderBy("row_key")
    earlier = Window.partitionBy("place").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sized.groupBy("place", "part").agg(F.count(F.lit(1)).alias("n"))
    parts = parts.select("place", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = sized.withColumn("number", F.row_number().over(in_part)).join(parts, ["place", "part"])
    return numbered.withColumn("place", F.xxhash64("place", F.col("before") + F.col("number"))).drop("part", "before", "number")


def with_row_key(docs: DataFrame) -> DataFrame:
    """The stored rows with ``row_key``: a number of each row, its part of the table in the upper bits."""
    return stored(docs.withColumn("row_key", F.monotonically_increasing_id()))


def mix_sources(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    key_column: str | None = None,
    weights: Sequence[int] = WEIGHTS,
    block: int = BLOCK,
) -> DataFrame:
    """How often each document is taken so that sources reach their targets.

    Columns: ``doc_id``, ``size`` (words), ``source``, ``source_size``, ``target``, ``copies`` and
    ``taken`` (size times copies). A source misses its target by half a document at most.
    Null text and text without words have size 0 and are taken by their source's whole copies;
    a null source is a source of its own. Draws depend on ids, sources and texts alone, so reruns agree.
    The order of documents within a block, too: rows that repeat all three are alike, and numbered.
    ``key_column``: the column of ``with_row_key``, which is then returned as ``row_key``; it tells
    which row the copies are of, whatever its id.
    """
    key = F.monotonically_increasing_id() if key_column is None else F.col(key_column)
    # ``place`` tells documents apart and deals them out; it needs no order.
    sized = stored(
        docs.select(
            key.alias("row_key"),
            F.col(id_column).cast("long").alias("doc_id"),
            F.xxhash64(id_column, source_column, text_column).alias("place"),
            F.col(source_column).cast("string").alias("source"),
            F.coalesce(F.regexp_count(text_column, F.lit(WORD_PATTERN)), F.lit(0)).cast("long").alias("size"),
        ).withColumn("part", F.shiftright("row_key", 33))
    )
    sized = stored(_numbered(sized))
    targets = stored(source_targets(sized, weights))
    per_source = sized.groupBy("source").agg(F.count(F.lit(1)).alias("documents"))
    plan = targets.alias("t").join(per_source.alias("p"), F.col("t.source").eqNullSafe(F.col("p.source")))
    plan = plan.select(F.col("t.source").alias("of"), "source_size", "target", F.ceil(F.col("documents") / block).alias("blocks"))
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    shares = sized.join(plan, F.col("source").eqNullSafe(F.col("of"))).withColumn("share", copies)
    shares = shares.withColumn("whole", F.floor(F.col("share") + 1e-9))
    shares = shares.withColumn("chance", F.greatest(F.col("share") - F.col("whole"), F.lit(0.0)))
    open_ones = (F.col("chance") > 1e-9) & (F.col("size") > 0)
    decided = [shares.where(~open_ones).withColumn("chance", F.lit(0.0)).select(*_UNIT)]

    spread = F.pmod(F.xxhash64("place", F.lit(3)), F.col("blocks"))
    units = shares.where(open_ones).select(*_UNIT, spread.alias("block"))
    blocks = plan.agg(F.max("blocks")).first()[0] or 0
    while blocks:
        folded = stored(_fold(units))
        decided.append(folded.select(F.explode("done").alias("u")).select("u.*"))
        left = folded.where("c is not null")
        if blocks == 1:
            # The last fraction of a source is rounded to the nearer side.
            last = left.select("c.*").withColumn("chance", F.round("chance"))
            decided.append(last.select(*_UNIT))
            break
        units = left.select("c.*", F.floor(F.col("block") / block).alias("block"))
        blocks = -(-blocks // block)
    result = decided[0]
    for part in decided[1:]:
        result = result.unionByName(part)
    result = result.withColumn("copies", F.col("whole") + F.col("chance").cast("long"))
    return result.select(
        *([] if key_column is None else ["row_key"]), "doc_id", "size", "source", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "copies")


QUERIES = {"op6_mix_sources": op6_mix_sources}
ORACLES: dict[str, str] = {}
