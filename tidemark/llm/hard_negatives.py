"""Hard negatives by an STR-packed R-tree over embeddings.

Sort-tile-recursive packing orders the rows by label, by the tile of their leading coordinates and by the
next one, cuts that order into pages, and goes on within a page down to leaves. A minimum bounding
box gives, coordinate by coordinate, the interval in which the inner product with a query can
lie. A block of anchors goes down the tree level by level, each level an equi-join on the node; in a
page each anchor has a best-first queue of boxes. A box is left out if it lies outside all of the
anchor's score windows, strictly below the k-th score found in each, or holds no label that
counts. Nothing else is, so the result is exact, ties included.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import prepared, shuffle_partitions, stored

PAGE_BITS, PARTITION_BITS = 12, 20
PAGE_ROWS = 1 << PAGE_BITS
LEAF_ROWS = 128
# Children of an inner node: pages in the directory, nodes within a page.
DIRECTORY, FANOUT = 64, 8
# Anchors that go down the tree together.
ANCHOR_ROWS = 4_096
# Leading coordinates that the pages are tiled by, and slabs of each at most.
TILED, SLABS = 3, 4
# Beyond this squared length an inner product could leave what a double holds exactly.
LARGEST_NORM = float(1 << 53)

POSITIVES, NEGATIVES = 5, 3
FRONTIER = "node long, keys binary, labels binary, vectors binary, limits binary"
FOUND = "key long, slot int, score long, vec_id long"


@dataclass
class Anchors:
    """Queries: row keys, labels, vectors, and score windows (lowest and highest, by slot)."""

    keys: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    limits: np.ndarray

    def __len__(self) -> int:
        return len(self.keys)

    def only(self, which: np.ndarray) -> Anchors:
        return Anchors(self.keys[which], self.labels[which], self.vectors[which], self.limits[which])

    def row(self, node: int) -> tuple:
        return (node, self.keys.tobytes(), self.labels.tobytes(), self.vectors.tobytes(), self.limits.tobytes())

    @staticmethod
    def read(keys: bytes, labels: bytes, vectors: bytes, limits: bytes) -> Anchors:
        names = np.frombuffer(keys, dtype=np.int64)
        n = max(1, len(names))
        return Anchors(
            names, np.frombuffer(labels, dtype=np.int64),
            np.frombuffer(vectors, dtype=np.int32).reshape(len(names), -1 if vectors else 0),
            np.frombuffer(limits, dtype=np.float64).reshape(len(names), len(limits) // 16 // n, 2),
        )


@dataclass
class Boxes:
    """Minimum bounding boxes of vectors, and the range of their labels."""

    low: np.ndarray
    high: np.ndarray
    first: np.ndarray
    last: np.ndarray

    @staticmethod
    def over(low: np.ndarray, high: np.ndarray, first: np.ndarray, last: np.ndarray, starts: np.ndarray) -> Boxes:
        """Boxes of consecutive groups."""
        return Boxes(
            np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts),
            np.minimum.reduceat(first, starts), np.maximum.reduceat(last, starts),
        )

    def intervals(self, anchors: Anchors) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest inner product of each anchor with anything in each box."""
        x = anchors.vectors.astype(np.float64)
        up, down = np.maximum(x, 0), np.minimum(x, 0)
        low, high = self.low.astype(np.float64).T, self.high.astype(np.float64).T
        return up @ low + down @ high, up @ high + down @ low

    def counting(self, anchors: Anchors, same: bool) -> np.ndarray:
        """Where a box holds labels that count for an anchor."""
        own = anchors.labels[:, None]
        if same:
            return (self.first[None, :] <= own) & (own <= self.last[None, :])
        return (self.first[None, :] != own) | (own != self.last[None, :])

    def open(self, anchors: Anchors, same: bool) -> np.ndarray:
        """Which boxes each anchor has to look into."""
        least, most = self.intervals(anchors)
        inside = np.zeros(least.shape, dtype=bool)
        for slot in range(anchors.limits.shape[1]):
            lowest, highest = anchors.limits[:, slot, :1], anchors.limits[:, slot, 1:]
            inside |= (most >= lowest) & (least <= highest)
        return inside & self.counting(anchors, same)


def tiles(vectors: np.ndarray, rows: int = LEAF_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Sort-tile-recursive order of some rows, and where its leaves start.

    Of n rows in d coordinates there are to be p = n / rows leaves, so the first coordinate is cut
    into the d-th root of p slabs, and each slab goes on with the next one.
    """
    order: list[np.ndarray] = []
    starts: list[int] = []
    work, done = [(np.arange(len(vectors)), 0)], 0
    while work:
        part, axis = work.pop()
        left = vectors.shape[1] - axis
        if len(part) <= rows or left <= 0:
            for at in range(0, len(part), rows):
                starts.append(done + at)
            order.append(part)
            done += len(part)
            continue
        leaves = ceil(len(part) / rows)
        slabs = max(2, ceil(leaves ** (1 / left)))
        step = ceil(leaves / slabs) * rows
        part = part[np.argsort(vectors[part, axis], kind="stable")]
        work += [(part[at : at + step], axis + 1) for at in reversed(range(0, len(part), step))]
    return np.concatenate(order), np.array(starts, dtype=np.int64)


class Page:
    """Some rows in packed order, with the tree over them."""

    def __init__(self, page: int, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, starts: np.ndarray):
        self.page, self.ids, self.labels, self.vectors, self.starts = page, ids, labels, vectors, starts
        self.exact = vectors.astype(np.float64)
        self.ends = np.append(starts[1:], len(ids))
        level = Boxes.over(vectors, vectors, labels, labels, starts)
        levels = [level]
        while len(level.first) > FANOUT:
            level = Boxes.over(level.low, level.high, level.first, level.last, np.arange(0, len(level.first), FANOUT))
            levels.append(level)
        self.levels = levels

    def search(self, anchors: Anchors, same: bool, keep: int) -> Iterator[tuple[int, int, int, int]]:
        """Key, slot, score and id of the ``keep`` best rows in each window of each anchor."""
        bounds = [(*level.intervals(anchors), level.counting(anchors, same)) for level in self.levels]
        top = len(self.levels) - 1
        for a in range(len(anchors)):
            x, label, own = anchors.vectors[a].astype(np.float64), anchors.labels[a], int(anchors.keys[a])
            lowest, highest = anchors.limits[a, :, 0].copy(), anchors.limits[a, :, 1]
            best: list[list[tuple[float, int]]] = [[] for _ in lowest]
            queue = [(-most, top, i) for i, most in enumerate(bounds[top][1][a].tolist()) if bounds[top][2][a, i]]
            heapq.heapify(queue)
            while queue:
                most, level, i = heapq.heappop(queue)
                if -most < lowest.min():
                    break
                if not ((-most >= lowest) & (bounds[level][0][a, i] <= highest)).any():
                    continue
                if level:
                    children = range(i * FANOUT, min((i + 1) * FANOUT, len(self.levels[level - 1].first)))
                    for c in children:
                        if bounds[level - 1][2][a, c]:
                            heapq.heappush(queue, (-bounds[level - 1][1][a, c], level - 1, c))
                    continue
                begin, end = self.starts[i], self.ends[i]
                scores = self.exact[begin:end] @ x
                counts = (self.labels[begin:end] == label) == same
                if same and own >> PAGE_BITS == self.page and begin <= (own & (PAGE_ROWS - 1)) < end:
                    counts[(own & (PAGE_ROWS - 1)) - begin] = False
                inside = (scores >= lowest[:, None]) & (scores <= highest[:, None]) & counts
                for slot in np.flatnonzero(inside.any(axis=1)).tolist():
                    hits = np.flatnonzero(inside[slot])
                    new = zip((-scores[hits]).tolist(), self.ids[begin + hits].tolist())
                    best[slot] = heapq.nsmallest(keep, [*best[slot], *new])
                    if len(best[slot]) == keep:
                        lowest[slot] = max(lowest[slot], -best[slot][-1][0])
            for slot, rows in enumerate(best):
                for score, name in rows:
                    yield own, slot, int(-score), name


def usable_rows(df: DataFrame, id_column: str, label: Column, vector_column: str, scale: int) -> DataFrame:
    """Rows that take part: a name, a label, and a vector of finite whole numbers."""
    vector = F.transform(F.col(vector_column), lambda x: F.floor(x.cast("double") * scale))
    finite = F.forall(F.col(vector_column), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    norm = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    named = df.where(F.col(vector_column).isNotNull() & finite).select(
        F.col(id_column).cast("long").alias("vec_id"), label.cast("long").alias("label"), vector.alias("vector")
    )
    whole = F.transform("vector", lambda x: x.cast("int")).alias("vector")
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (norm < LARGEST_NORM)
    return named.where(usable).select("vec_id", "label", whole)


def _cut_points(rows: DataFrame, coordinate: Column, tile: Column, slabs: int) -> dict[int, list[float]]:
    shares = [i / slabs for i in range(1, slabs)]
    found = rows.groupBy(tile.alias("tile")).agg(F.percentile_approx(coordinate, shares, 10_000).alias("cuts"))
    return {r["tile"]: list(r["cuts"] or []) for r in found.collect()}


def _tile(rows: DataFrame, pages: int, width: int) -> Column:
    """Tile of the leading coordinates: slabs of the first, slabs within each, and so on.

    There are at most ``SLABS ** TILED`` tiles, so their cut points are a small list.
    """
    tile = F.lit(0)
    levels = min(TILED, width)
    slabs = min(SLABS, ceil(pages ** (1 / levels))) if levels else 1
    if slabs < 2:
        return tile
    for axis in range(levels):
        value = F.coalesce(F.get("vector", F.lit(axis)), F.lit(0))
        slab = F.lit(0)
        for name, cuts in sorted(_cut_points(rows, value, tile, slabs).items()):
            inner = sum(((value > cut).cast("int") for cut in cuts), F.lit(0))
            slab = F.when(tile == name, inner).otherwise(slab)
        tile = tile * slabs + slab
    return tile


def _packed(frame: pd.DataFrame, page: int, width: int) -> Page:
    vectors = np.zeros((len(frame), width), dtype=np.int32)
    for i, v in enumerate(frame["vector"]):
        vectors[i, : len(v)] = v
    order, starts = tiles(vectors)
    ids, labels = frame["vec_id"].to_numpy(np.int64)[order], frame["label"].to_numpy(np.int64)[order]
    return Page(page, ids, labels, vectors[order], starts)


def build_pages(rows: DataFrame, pages: int, width: int) -> DataFrame:
    """One row per page: its box, and its rows in packed order."""
    names = ["page", "first", "last", "low", "high", "ids", "labels", "vectors", "starts"]
    spread = rows.withColumns({"tile": _tile(rows, pages, width), "at": F.get("vector", F.lit(min(TILED, max(width - 1, 0))))})
    keys = ["label", "tile", "at", "vec_id"]
    dealt = spread.repartitionByRange(pages, *keys).sortWithinPartitions(*keys).drop("tile", "at")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId() << PARTITION_BITS
        waiting: list[pd.DataFrame] = []
        count = number = 0

        def page(frame: pd.DataFrame) -> pd.DataFrame:
            p = _packed(frame, part + number, width)
            box = Boxes.over(p.vectors, p.vectors, p.labels, p.labels, np.zeros(1, dtype=np.int64))
            arrays = (p.ids, p.labels, p.vectors, p.starts)
            row = (p.page, int(box.first[0]), int(box.last[0]), box.low.tobytes(), box.high.tobytes(), *(x.tobytes() for x in arrays))
            return pd.DataFrame([row], columns=names)

        for batch in batches:
            waiting.append(batch)
            count += len(batch)
            while count >= PAGE_ROWS:
                whole = pd.concat(waiting)
                yield page(whole.iloc[:PAGE_ROWS])
                number += 1
                waiting, count = [whole.iloc[PAGE_ROWS:]], count - PAGE_ROWS
        if count:
            yield page(pd.concat(waiting))

    schema = "page long, first long, last long, low binary, high binary, ids binary, labels binary, vectors binary, starts binary"
    return dealt.mapInPandas(pack, schema)


def _page(r, width: int) -> Page:
    ids = np.frombuffer(r.ids, dtype=np.int64)
    vectors = np.frombuffer(r.vectors, dtype=np.int32).reshape(len(ids), width)
    return Page(r.page, ids, np.frombuffer(r.page_labels, dtype=np.int64), vectors, np.frombuffer(r.starts, dtype=np.int64))


class Tree:
    """The stored pages and the levels of the directory above them, the root last."""

    def __init__(self, rows: DataFrame):
        size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).first()
        self.rows, self.width = size["n"], size["width"] or 0
        parts = max(1, ceil(self.rows / PAGE_ROWS))
        self.pages = stored(build_pages(rows, parts, self.width))
        self.levels = [self._level(self.pages.withColumnRenamed("page", "child"), DIRECTORY << PARTITION_BITS)]
        span = DIRECTORY
        while span < parts:
            span *= DIRECTORY
            self.levels.append(self._level(self._boxes(self.levels[-1]), DIRECTORY))

    @staticmethod
    def _level(children: DataFrame, span: int) -> DataFrame:
        """Nodes with the boxes of their children. Pages of neighbouring partitions are neighbours."""
        child = F.struct("child", "first", "last", "low", "high")
        node = F.floor(F.col("child") / F.lit(span)).alias("node")
        return stored(children.groupBy(node).agg(F.sort_array(F.collect_list(child)).alias("children")))

    def _boxes(self, nodes: DataFrame) -> DataFrame:
        width = self.width

        def union(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                rows = []
                for node, children in zip(batch["node"].tolist(), batch["children"]):
                    b = _boxes_of(children, width)
                    rows.append((node, int(b.first.min()), int(b.last.max()), b.low.min(axis=0).tobytes(), b.high.max(axis=0).tobytes()))
                yield pd.DataFrame(rows, columns=["child", "first", "last", "low", "high"])

        return nodes.mapInPandas(union, "child long, first long, last long, low binary, high binary")

    def anchors(self, wanted: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
        """Rows to search for, each with the k-th score that its own page holds already."""
        width = self.width

        def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for r in batch.itertuples():
                    page = _page(r, width)
                    at = np.flatnonzero(wanted(page.ids))
                    keys = (np.int64(r.page) << np.int64(PAGE_BITS)) + at
                    limits = np.tile([-np.inf, np.inf], (len(at), 1, 1))
                    own = Anchors(keys, page.labels[at], page.vectors[at], limits)
                    scores: dict[int, list[int]] = {}
                    for key, _, score, _ in page.search(own, True, POSITIVES):
                        scores.setdefault(key, []).append(score)
                    least = [float(min(s)) if len(s := scores.get(k, [])) == POSITIVES else -np.inf for k in keys.tolist()]
                    yield pd.DataFrame(
                        {"key": keys, "anchor_id": page.ids[at], "label": page.labels[at], "vector": [x.tobytes() for x in own.vectors], "lowest": least}
                    )

        kept = self.pages.select("page", "ids", F.col("labels").alias("page_labels"), "vectors", "starts")
        return stored(kept.mapInPandas(draw, "key long, anchor_id long, label long, vector binary, lowest double"))

    def search(self, anchors: DataFrame, same: bool, keep: int) -> DataFrame:
        """The best rows in each window of each anchor (``FOUND``): a few from each page, to be merged.

        ``anchors``: key, label, vector, and ``limits``, an array of two bounds per window.
        """
        width, spark = self.width, anchors.sparkSession
        parts = shuffle_partitions(spark)

        def block(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for at in range(0, len(batch), ANCHOR_ROWS):
                    b = batch.iloc[at : at + ANCHOR_ROWS]
                    vectors = np.frombuffer(b"".join(b["vector"]), dtype=np.int32).reshape(len(b), width)
                    limits = np.stack([np.asarray(x, dtype=np.float64) for x in b["limits"]]).reshape(len(b), -1, 2)
                    held = Anchors(b["key"].to_numpy(np.int64), b["label"].to_numpy(np.int64), vectors, limits)
                    yield pd.DataFrame([held.row(0)], columns=_FRONTIER)

        def descend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for r in batch.itertuples():
                    held = Anchors.read(r.keys, r.labels, r.vectors, r.limits)
                    ways = _boxes_of(r.children, width).open(held, same)
                    for i, child in enumerate(r.children):
                        if ways[:, i].any():
                            yield pd.DataFrame([held.only(ways[:, i]).row(child["child"])], columns=_FRONTIER)

        def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            page = None
            for batch in batches:
                for r in batch.itertuples():
                    if page is None or page.page != r.page:
                        page = _page(r, width)
                    held = Anchors.read(r.keys, r.labels, r.page_vectors, r.limits)
                    yield pd.DataFrame(list(page.search(held, same, keep)), columns=["key", "slot", "score", "vec_id"])

        frontier = anchors.mapInPandas(block, FRONTIER)
        for level in reversed(self.levels):
            frontier = stored(frontier.join(level, "node").mapInPandas(descend, FRONTIER))
        pages = self.pages.select("page", "ids", F.col("labels").alias("page_labels"), "vectors", "starts").repartition(parts, "page")
        blocks = frontier.withColumnsRenamed({"node": "page", "vectors": "page_vectors"}).repartition(parts, "page")
        return blocks.join(pages, "page").mapInPandas(visit, FOUND)


_FRONTIER = ["node", "keys", "labels", "vectors", "limits"]


def _boxes_of(children, width: int) -> Boxes:
    def matrix(name: str) -> np.ndarray:
        return np.frombuffer(b"".join(bytes(c[name]) for c in children), dtype=np.int32).reshape(len(children), width)

    first, last = (np.array([c[name] for c in children], dtype=np.int64) for name in ("first", "last"))
    return Boxes(matrix("low"), matrix("high"), first, last)


def _best(found: DataFrame, keys: list[str], keep: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def mine_hard_negatives(
    df: DataFrame,
    wanted: Callable[[np.ndarray], np.ndarray],
    *,
    label: Column | None = None,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: int = 256,
    lowest_percent: int = 50,
    highest_percent: int = 95,
) -> DataFrame:
    """The hardest negatives of each anchor and positive; one row for each of the three.

    Anchors are the rows whose ids ``wanted`` (of an array) picks; positives the first five other rows
    of an anchor's label; negatives the first three rows of other labels whose score lies
    between the two shares of the positive's score. Scores are inner products of
    ``floor(scale * component)``.

    Rows with a null id, label or vector, with a null or non-finite component, or whose squared length
    reaches 2 ** 53 (products would not be exact) take no part. Of vectors of different length
    the missing components count as zero; empty ones score zero. Rows that repeat an id are rows of
    their own, as anchors too; other columns are ignored; equal scores go by the smaller id. An
    empty table gives none.
    """
    rows = stored(usable_rows(df, id_column, F.col("label") if label is None else label, vector_column, scale))
    tree = Tree(rows)
    anchors = tree.anchors(wanted)
    open_above = F.array(F.array(F.col("lowest"), F.lit(float("inf"))))
    near = tree.search(anchors.select("key", "label", "vector", F.flatten(open_above).alias("limits")), True, POSITIVES)
    positives = stored(_best(near, ["key"], POSITIVES).select("key", "rank", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))

    low, high = (F.col("positive_score") * percent for percent in (lowest_percent, highest_percent))
    low, high = (low + F.pmod(-low, F.lit(100))) / 100, (high - F.pmod(high, F.lit(100))) / 100
    bounds = F.struct("rank", low.cast("double").alias("low"), high.cast("double").alias("high"))
    windows = positives.groupBy("key").agg(F.sort_array(F.collect_list(bounds)).alias("bounds"))
    never = F.array(F.lit(float("inf")), F.lit(float("-inf")))
    listed = F.transform("bounds", lambda b: F.array(b["low"], b["high"]))
    padded = F.flatten(F.concat(listed, F.array_repeat(never, F.lit(POSITIVES) - F.size("bounds")))).alias("limits")
    sought = anchors.join(windows, "key").select("key", "label", "vector", padded)
    far = tree.search(sought, False, NEGATIVES).select("key", (F.col("slot") + 1).alias("of"), "score", "vec_id")
    negatives = _best(far, ["key", "of"], NEGATIVES)
    named = positives.join(anchors.select("key", "anchor_id"), "key").withColumnRenamed("rank", "of")
    return negatives.join(named, ["key", "of"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the rows whose id is divisible by 50; the labels of some rows are moved on by one."""
    prepared(spark)
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine_hard_negatives(vectors, lambda ids: ids % 50 == 0, label=moved)


_SQL = """
with rows_in as (
  select row_number() over () as n, vec_id, case when vec_id % 7 = 0 then (cast(label as bigint) + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and list_count(embedding) = len(embedding) and len(list_filter(embedding, lambda x: not isfinite(x))) = 0
), positives as (
  select a.n, a.vec_id as anchor_id, a.label, a.v, p.vec_id as positive_id,
         cast(list_inner_product(a.v, p.v) as bigint) as positive_score
  from rows_in a join rows_in p on p.label = a.label and p.n <> a.n where a.vec_id % 50 = 0
  qualify row_number() over (partition by a.n order by positive_score desc, p.vec_id) <= 5
), numbered as (
  select *, row_number() over () as pair from positives
), negatives as (
  select p.pair, p.anchor_id, p.positive_id, p.positive_score, r.vec_id as negative_id,
         cast(list_inner_product(p.v, r.v) as bigint) as negative_score
  from numbered p join rows_in r on r.label <> p.label
  where 50 * p.positive_score <= 100 * list_inner_product(p.v, r.v) and 100 * list_inner_product(p.v, r.v) <= 95 * p.positive_score
)
select anchor_id, positive_id,
       cast(row_number() over (partition by pair order by negative_score desc, negative_id) as integer) as rank,
       negative_id, positive_score, negative_score
from negatives
qualify row_number() over (partition by pair order by negative_score desc, negative_id) <= 3
"""

QUERIES = {"op11_hard_negatives": op11_hard_negatives}
ORACLES = {"op11_hard_negatives": _SQL}
