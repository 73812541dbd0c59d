"""Nearest neighbours by forests of random-projection trees with one queue, and exact reranking.

The rows are dealt into shards by hash. A task holds one shard and a block of queries: it grows the shard's
trees, and each query walks all of them with one priority queue, in which the branch with the smallest
margins crossed on the way to it comes next, whatever tree it belongs to. The rows of the
leaves that are opened are compared exactly, and the walk goes on as long as a branch may hold something
nearer than the k-th found and the leaves allowed are not used up. Those are a number per shard, so
they grow with the rows. Without that limit the result is exact.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import prepared, shuffle_partitions, stored

# Rows of a shard, its trees and the rows of their leaves.
SHARD_ROWS = 8_192
TREES = 6
LEAF_ROWS = 128
# Leaves a query opens in each shard, over all its trees; the README states the recall.
LEAVES = 64
# Leaves that are opened before their rows are compared and the k-th score is looked at again.
LEAVES_AT_ONCE = 8
# Queries that meet a shard together.
QUERY_ROWS = 4_096
# What rounding may take from the distance to a hyperplane.
MARGIN_ERROR = 1e-4

_SHARDS = "shard long, ends binary, ids binary, vectors binary"
_QUERIES = "shard long, keys binary, names binary, asked binary"
HITS = "key long, query_id long, vec_id long, score double"


def _unit(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    return (wide / np.linalg.norm(wide, axis=1, keepdims=True)).astype(np.float32)


class Forest:
    """Complete binary trees over unit vectors: a hyperplane for each inner node, children of k at 2k+1, 2k+2."""

    def __init__(self, units: np.ndarray, trees: int = TREES, leaf_rows: int = LEAF_ROWS, seed: int = 11):
        rows, width = units.shape
        self.depth = max(0, ceil(log2(max(1, rows) / leaf_rows)))
        self.inner = (1 << self.depth) - 1
        self.normals = np.zeros((trees, self.inner, width), dtype=np.float32)
        self.offsets = np.zeros((trees, self.inner), dtype=np.float32)
        self.leaves: list[list[np.ndarray]] = []
        rng = np.random.default_rng(seed)
        for t in range(trees):
            level = [np.arange(rows)]
            for node in range(self.inner):
                own = level[node]
                normal = units[rng.choice(own, 2)] if len(own) else np.zeros((2, width), np.float32)
                normal = normal[0] - normal[1]
                size = float(np.linalg.norm(normal))
                # Two draws of one point: any direction does.
                normal = normal / size if size > 1e-6 else _unit(rng.standard_normal((1, width)))[0]
                side = units[own] @ normal
                cut = np.median(side) if len(own) else 0.0
                self.normals[t, node], self.offsets[t, node] = normal, cut
                right = side > np.float32(cut)
                level += [own[~right], own[right]]
            self.leaves.append(level[self.inner :])

    def margins(self, units: np.ndarray) -> np.ndarray:
        """Signed distance of each unit vector to every hyperplane (rows by trees by nodes)."""
        flat = self.normals.reshape(-1, units.shape[1])
        return (units @ flat.T).reshape(len(units), len(self.normals), self.inner) - self.offsets

    def walk(self, margins: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
        """Leaves in the order of the queue, each with the least distance that anything in it
        or in what is still queued may have."""
        # Priority, the widest margin crossed (a bound of the distance), tree and node.
        queue = [(0.0, 0.0, t, 0) for t in range(len(self.normals))]
        while queue:
            far, bound, t, node = heapq.heappop(queue)
            own = margins[t]
            while node < self.inner:
                margin = float(own[node])
                near, other = (2 * node + 2, 2 * node + 1) if margin > 0 else (2 * node + 1, 2 * node + 2)
                crossed = abs(margin)
                heapq.heappush(queue, (far + crossed * crossed, max(bound, crossed), t, other))
                node = near
            yield bound, self.leaves[t][node - self.inner]


class Shard:
    """Distinct vectors with the smallest ids that hold them, and the trees over them."""

    def __init__(self, vectors: np.ndarray, ids: list[np.ndarray], trees: int, leaf_rows: int):
        self.vectors, self.ids = vectors.astype(np.float64), ids
        self.norms = np.linalg.norm(self.vectors, axis=1)
        self.smallest = np.array([i[0] for i in ids], dtype=np.int64)
        self.forest = Forest(_unit(vectors), trees, leaf_rows)

    def search(self, vector: np.ndarray, margins: np.ndarray, k: int, leaves: int | None) -> list[tuple[int, float]]:
        """(row, score) of the best ``k`` rows found, ties by the smaller id."""
        norm = float(np.linalg.norm(vector))
        seen = np.zeros(len(self.vectors), dtype=bool)
        best_rows, best_scores = np.zeros(0, dtype=np.int64), np.zeros(0)
        waiting: list[np.ndarray] = []
        opened = 0

        def compare() -> None:
            nonlocal best_rows, best_scores
            rows = np.unique(np.concatenate(waiting))
            rows = rows[~seen[rows]]
            seen[rows] = True
            # Row by row, so that a score doesn't depend on what else is compared.
            scores = (self.vectors[rows] * vector).sum(axis=1) / (self.norms[rows] * norm)
            rows, scores = np.concatenate([best_rows, rows]), np.concatenate([best_scores, scores])
            order = np.lexsort((self.smallest[rows], -scores))[:k]
            best_rows, best_scores = rows[order], scores[order]
            waiting.clear()

        for bound, members in self.forest.walk(margins):
            if len(best_rows) == k and bound - MARGIN_ERROR > np.sqrt(max(0.0, 2 - 2 * best_scores[-1])):
                # Only this branch is too far; others in the queue have crossed narrower margins.
                continue
            waiting.append(members)
            opened += 1
            if len(waiting) == LEAVES_AT_ONCE:
                compare()
            if opened == leaves:
                break
        if waiting:
            compare()
        return list(zip(best_rows.tolist(), best_scores.tolist()))


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``vec_id`` and ``vector`` of rows that can be compared: no nulls, all finite, not zero."""
    v = F.col(vector_column)
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fine = v.isNotNull() & F.col(id_column).isNotNull() & sound & F.exists(v, lambda x: x != 0)
    return vectors.where(fine).select(F.col(id_column).cast("long").alias("vec_id"), v.alias("vector"))


def _matrix(column) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column])


def _runs(frames: Iterator[pd.DataFrame], column: str) -> Iterator[pd.DataFrame]:
    """The rows of one value of a sorted column at a time."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        values = frame[column].to_numpy()
        cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
        for begin, end in zip(cuts, cuts[1:]):
            if held and begin < end and held[0][column].iat[0] != values[begin]:
                yield pd.concat(held, ignore_index=True)
                held = []
            if begin < end:
                held.append(frame.iloc[begin:end])
    if held:
        yield pd.concat(held, ignore_index=True)


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    *,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    trees: int = TREES,
    leaf_rows: int = LEAF_ROWS,
    leaves: int | None = LEAVES,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """The ``k`` nearest of each query by cosine: ``query_id``, ``rank``, ``vec_id``, ``score``.

    With ``leaves`` None the result is exact. Ties go to the smaller id; rows with a query's id are no
    candidates of it. Rows with a null id, or a vector that is null, zero or not finite, take no part;
    neither do vectors of another length than most. Rows alike in id and vector count once; an id
    with several vectors is a row, and a query, for each of them. Of equal vectors in a shard the k + 1
    smallest ids are held: no more can be among the nearest. No row reaches the driver.
    """
    spark = vectors.sparkSession
    parts = shuffle_partitions(spark)
    rows = usable(vectors, id_column, vector_column)
    lengths = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if lengths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width, shards = lengths["d"], max(1, ceil(lengths["count"] / shard_rows))
    rows = rows.where(F.size("vector") == width).distinct()
    shard = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards))
    single = rows.schema["vector"].dataType.simpleString() == "array<float>"
    kind = np.dtype(np.float32 if single else np.float64)

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in _runs(frames, "shard"):
            found = np.ascontiguousarray(_matrix(run["vector"]).astype(kind)) + kind.type(0)
            names = run["vec_id"].to_numpy(np.int64)
            _, first, which = np.unique(found.view(f"V{kind.itemsize * width}").ravel(), return_index=True, return_inverse=True)
            order = np.lexsort((names, which))
            place = np.arange(len(order)) - np.searchsorted(which[order], which[order])
            held = order[place <= k]
            ends = np.searchsorted(which[held], np.arange(len(first)), side="right")
            yield pd.DataFrame(
                {"shard": [run["shard"].iat[0]], "ends": [ends.tobytes()], "ids": [names[held].tobytes()], "vectors": [found[first].tobytes()]}
            )

    dealt = rows.withColumn("shard", shard).repartition(parts, "shard").sortWithinPartitions("shard")
    index = stored(dealt.mapInPandas(pack, _SHARDS))

    def block(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), QUERY_ROWS):
                part = frame.iloc[at : at + QUERY_ROWS]
                asked = _matrix(part["vector"]).astype(kind)
                yield pd.DataFrame(
                    {"keys": [part["key"].to_numpy(np.int64).tobytes()], "names": [part["vec_id"].to_numpy(np.int64).tobytes()], "asked": [asked.tobytes()]}
                )

    asked = usable(queries, id_column, vector_column).where(F.size("vector") == width).distinct()
    numbered = stored(asked.withColumn("key", F.monotonically_increasing_id()))
    blocks = numbered.mapInPandas(block, "keys binary, names binary, asked binary")
    # Every block of queries meets every shard.
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard")
    met = blocks.select(every, "*").repartition(parts, "shard").join(index.repartition(parts, "shard"), "shard")

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, own = None, None
        for frame in frames:
            for r in frame.itertuples(index=False):
                if number != r.shard:
                    ids = np.split(np.frombuffer(r.ids, np.int64), np.frombuffer(r.ends, np.int64)[:-1])
                    own = Shard(np.frombuffer(r.vectors, kind).reshape(-1, width), ids, trees, leaf_rows)
                    number = r.shard
                wanted = np.frombuffer(r.asked, kind).reshape(-1, width)
                keys, names = np.frombuffer(r.keys, np.int64), np.frombuffer(r.names, np.int64)
                out = []
                for begin in range(0, len(wanted), 256):
                    part = wanted[begin : begin + 256]
                    margins = own.forest.margins(_unit(part))
                    for i, vector in enumerate(part.astype(np.float64)):
                        key, name = int(keys[begin + i]), int(names[begin + i])
                        # One more than k: the query's own row may be among them.
                        for row, score in own.search(vector, margins[i], k + 1, leaves):
                            out += [(key, name, other, score) for other in own.ids[row].tolist() if other != name]
                yield pd.DataFrame(out, columns=["key", "query_id", "vec_id", "score"])

    best = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    ranked = met.mapInPandas(compare, HITS).withColumn("rank", F.row_number().over(best))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries are the rows whose id is divisible by 50."""
    prepared(spark)
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, vectors.where("vec_id % 50 = 0"))


QUERIES = {"op2_nearest_neighbours": op2_nearest_neighbours}
ORACLES: dict[str, str] = {}
