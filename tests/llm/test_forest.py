"""Nearest neighbours against all pairs."""

import collections

import numpy as np
import pytest

from tidemark.llm import forest
from tidemark.llm.common import prepared

SCHEMA = "vec_id long, embedding array<float>, rank string, shard string"


def table_of(spark, vectors, ids=None):
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], "r", "s") for i, v in zip(ids or range(len(vectors)), vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def found_by(df):
    own = collections.defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        own[r["query_id"]].append((r["vec_id"], r["score"]))
        assert r["rank"] == len(own[r["query_id"]])
    return own


def truth(vectors, ids, query, k=5):
    x = np.asarray(vectors, dtype=np.float32).astype(np.float64)
    at = ids.index(query)
    score = (x * x[at]).sum(axis=1) / (np.linalg.norm(x, axis=1) * np.linalg.norm(x[at]))
    return sorted((-s, i) for s, i in zip(score, ids) if i != query)[:k]


@pytest.fixture(params=["spread", "clustered"])
def vectors(request):
    rng = np.random.default_rng(3)
    if request.param == "spread":
        return rng.standard_normal((3_000, 32))
    return rng.standard_normal((40, 32))[rng.integers(0, 40, 3_000)] + 0.05 * rng.standard_normal((3_000, 32))


def test_exact_without_a_limit_on_leaves(spark, vectors):
    prepared(spark)
    vectors[1_000:1_400] = vectors[0]  # copies: ties go to the smaller id
    ids = list(range(3_000, 0, -1))
    df = table_of(spark, vectors, ids)
    found = found_by(forest.nearest(df, df.where("vec_id % 100 = 0"), leaves=None, shard_rows=700, leaf_rows=16))
    assert len(found) == 30
    for query, got in found.items():
        want = truth(vectors, ids, query)
        assert [i for i, _ in got] == [i for _, i in want]
        assert [s for _, s in got] == pytest.approx([-s for s, _ in want], abs=1e-12)


@pytest.mark.parametrize("rows", [500, 3_000, 12_000])
def test_recall_when_a_part_of_the_leaves_is_opened(spark, rows):
    """Vectors without clusters, the least favourable kind, at three sizes; a part of the leaves each."""
    prepared(spark)
    x = np.random.default_rng(rows).standard_normal((rows, 48))
    df = table_of(spark, x)
    found = found_by(forest.nearest(df, df.where("vec_id % 50 = 0"), shard_rows=2_048, leaf_rows=32))
    assert 2_048 / 32 * forest.TREES > 3 * forest.LEAVES
    hits = sum(len({i for i, _ in got} & {i for _, i in truth(x, list(range(rows)), q)}) for q, got in found.items())
    assert len(found) == rows // 50 and hits >= 0.9 * 5 * len(found)


def test_clusters_close_the_queue_early():
    rng = np.random.default_rng(5)
    x = (rng.standard_normal((20, 24))[rng.integers(0, 20, 4_000)] + 0.01 * rng.standard_normal((4_000, 24))).astype(np.float32)
    shard = forest.Shard(x, [np.array([i]) for i in range(len(x))], trees=3, leaf_rows=32)
    margins = shard.forest.margins(forest._unit(x[:50]))
    walk = shard.forest.walk
    total = sum(map(len, shard.forest.leaves))
    compared = []
    for i in range(50):
        best = shard.search(x[i].astype(np.float64), margins[i], 6, None)
        reach = np.sqrt(max(0, 2 - 2 * best[-1][1]))
        compared.append(sum(bound - forest.MARGIN_ERROR <= reach for bound, _ in walk(margins[i])))
    assert np.mean(compared) < 0.6 * total


def test_every_leaf_holds_its_rows_and_bounds_are_true():
    rng = np.random.default_rng(4)
    units = forest._unit(np.concatenate([rng.standard_normal((900, 6)), np.ones((300, 6))]))
    grown = forest.Forest(units, trees=3, leaf_rows=32)
    for leaves in grown.leaves:
        assert sorted(np.concatenate(leaves).tolist()) == list(range(1_200))
    margins = grown.margins(units[:40])
    for i in range(40):
        distance = np.linalg.norm(units - units[i], axis=1)
        seen = 0
        for bound, members in grown.walk(margins[i]):
            seen += 1
            assert not len(members) or distance[members].min() >= bound - 1e-4
        assert seen == sum(map(len, grown.leaves))


def test_odd_rows(spark):
    prepared(spark)
    x = [[1, 0, 0], [1, 0.1, 0], [0, 1, 0], [0, 0, 2], [1, 0, 0], None, [0, 0, 0], [float("nan"), 1, 1], [None, 1, 1], [1], [1, 0.2, 0], [1, 0.2, 0]]
    ids = [0, 1, 2, 3, 50, 4, 5, 6, 7, 8, None, 50]
    df = table_of(spark, x, ids)
    found = forest.nearest(df, df.where("vec_id % 50 = 0"), leaves=1).collect()
    assert [r["vec_id"] for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == 0] == [50, 1, 50, 2, 3]
    # Two vectors share the id 50: two queries, neither a candidate of the other.
    both = [r for r in found if r["query_id"] == 50]
    assert sorted(r["rank"] for r in both) == [1, 1, 2, 2, 3, 3, 4, 4] and all(r["vec_id"] != 50 for r in both)
    empty = table_of(spark, [])
    assert forest.nearest(empty, empty).collect() == []
    few = table_of(spark, [[1.0, 2.0], [2.0, 1.0]])
    assert found_by(forest.nearest(few, few))[0][0][0] == 1


def test_query_on_the_whole_table(spark):
    path = "/root/testdata/sf0.001"
    found = found_by(forest.op2_nearest_neighbours(spark, path))
    rows = spark.read.parquet(f"{path}/embeddings.parquet").collect()
    ids, x = [r["vec_id"] for r in rows], [r["embedding"] for r in rows]
    assert set(found) == {i for i in ids if i % 50 == 0}
    hits = sum(len({i for i, _ in got} & {i for _, i in truth(x, ids, q)}) for q, got in found.items())
    assert hits >= 0.9 * 5 * len(found)
