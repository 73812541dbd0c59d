"""Hard negatives against all pairs, and against SQL."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives
from tidemark.llm.common import prepared

SCHEMA = "vec_id long, embedding array<float>, label int, key string, page string"


def brute(rows, wanted, moved=True):
    """All pairs, row by row."""
    part = []
    for name, vector, label, *_ in rows:
        if name is None or vector is None or label is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        whole = [int(np.floor(256 * float(np.float32(x)))) for x in vector]
        if sum(float(x) * x for x in whole) < 2**53:
            part.append((name, whole, (label + 1) % 10 if moved and name % 7 == 0 else label))
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    found = []
    for i, (name, x, label) in enumerate(part):
        if not wanted(name):
            continue
        others = [(-score(x, y), other, kind) for j, (other, y, kind) in enumerate(part) if j != i]
        for s, positive, _ in sorted(o for o in others if o[2] == label)[:5]:
            fits = sorted(o[:2] for o in others if o[2] != label and 50 * -s <= 100 * -o[0] <= 95 * -s)[:3]
            found += [(name, positive, rank, other, -s, -t) for rank, (t, other) in enumerate(fits, 1)]
    return sorted(found)


def some_rows(count, width, seed=3):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, width))
    rows = []
    for i in range(count):
        kind = int(rng.integers(0, 6))
        vector = centers[kind] + rng.normal(size=width) * rng.choice([0.1, 0.6])
        rows.append((i, [float(np.float32(x)) for x in vector / 2], int(rng.choice([kind, 1, 1])), "k", "p"))
    return rows


ODD = [
    (None, [1.0, 2.0, 3.0], 1, "", ""), (100, None, 1, "", ""), (150, [1.0, None, 2.0], 1, "", ""), (200, [float("nan"), 1.0, 1.0], 1, "", ""),
    (250, [float("inf"), 1.0, 1.0], 2, "", ""), (300, [1.0, 1.0, 1.0], None, "", ""), (350, [3e38, 1.0, 1.0], 1, "", ""), (350, [], 1, "", ""),
    (-50, [0.5, -1.0], 1, "", ""), (0, [0.5, -1.0, 0.25, 7.0], 4, "", ""), (-7, [0.0, 0.0, 0.0], 9, "", ""),
]


@pytest.fixture(params=["as is", "small pages"])
def tree_sizes(request, monkeypatch):
    """With small pages several levels of directory and of nodes stand above the rows."""
    if request.param == "small pages":
        for name, value in {"PAGE_ROWS": 16, "LEAF_ROWS": 3, "DIRECTORY": 2, "FANOUT": 2, "ANCHOR_ROWS": 7}.items():
            monkeypatch.setattr(hard_negatives, name, value)


def mined(df, wanted, moved=True):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label")) if moved else None
    return sorted(map(tuple, hard_negatives.mine_hard_negatives(df, wanted, label=label).collect()))


def test_equals_all_pairs(spark, tree_sizes):
    prepared(spark)
    # Repeated rows, repeated ids with other vectors, ties, and one vector that a third of the rows hold.
    rows = some_rows(160, 4)
    rows += [(1_000 + i, [0.5, 0.5, -0.25, 1.0], 1, "", "") for i in range(80)] + rows[:10] + [(50, [0.1, 0.2, 0.3, 0.4], 2, "", "")] + ODD
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = mined(df, lambda ids: ids % 10 == 0)
    assert found == brute(rows, lambda name: name % 10 == 0) and len(found) > 100


def test_many_coordinates_few_rows_and_none(spark, tree_sizes):
    for rows in (some_rows(60, 64), some_rows(3, 2), [(0, [1.0], 1, "", "")], [(0, [], 1, "", ""), (50, [], 2, "", "")]):
        df = spark.createDataFrame(rows, SCHEMA)
        assert mined(df, lambda ids: ids % 10 == 0, moved=False) == brute(rows, lambda name: name % 10 == 0, moved=False)
    empty = hard_negatives.mine_hard_negatives(spark.createDataFrame([], SCHEMA), lambda ids: ids % 10 == 0)
    assert empty.collect() == []
    assert empty.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_boxes_hold_every_product():
    rng = np.random.default_rng(1)
    vectors = rng.integers(-300, 300, (500, 7)).astype(np.int32)
    order, starts = hard_negatives.tiles(vectors, 16)
    assert sorted(order.tolist()) == list(range(500)) and np.diff(np.append(starts, 500)).max() <= 16
    vectors, labels = vectors[order], np.zeros(500, dtype=np.int64)
    boxes = hard_negatives.Boxes.over(vectors, vectors, labels, labels, starts)
    x = rng.integers(-300, 300, (20, 7)).astype(np.int32)
    anchors = hard_negatives.Anchors(np.arange(20), np.zeros(20, dtype=np.int64), x, np.zeros((20, 1, 2)))
    least, most = boxes.intervals(anchors)
    scores = x.astype(float) @ vectors.astype(float).T
    assert (np.minimum.reduceat(scores, starts, axis=1) >= least).all() and (np.maximum.reduceat(scores, starts, axis=1) <= most).all()


def test_boxes_are_left_out():
    """With few coordinates and clusters most leaves are never compared."""
    rows = some_rows(4_000, 2)
    vectors = np.array([np.floor(np.array(r[1]) * 256) for r in rows]).astype(np.int32)
    order, starts = hard_negatives.tiles(vectors)
    page = hard_negatives.Page(0, np.arange(4_000)[order], np.zeros(4_000, dtype=np.int64), vectors[order], starts)
    looked = []
    page.exact = type("Counted", (), {"__getitem__": lambda self, at: looked.append(at) or page.vectors[at].astype(float)})()
    own = hard_negatives.Anchors(np.arange(20) << 20, np.zeros(20, dtype=np.int64), vectors[:20], np.tile([-np.inf, np.inf], (20, 1, 1)))
    assert len(list(page.search(own, True, 5))) == 100 and len(looked) < 0.3 * 20 * len(starts)


def test_query_equals_sql(spark, tmp_path):
    rows = some_rows(300, 8) + ODD
    spark.createDataFrame(rows, SCHEMA).drop("key", "page").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    for folder, parts in ((str(tmp_path), "/*.parquet"), ("/root/testdata/sf0.001", "")):
        db = duckdb.connect()
        where = " where len(embedding) = 8" if parts else ""
        if parts:
            spark.read.parquet(f"{folder}/embeddings.parquet").where(F.size("embedding") == 8).write.parquet(f"{folder}/even/embeddings.parquet")
        db.execute(f"create view embeddings as select * from '{folder}/embeddings.parquet{parts}'{where}")
        wanted = sorted(db.execute(hard_negatives.ORACLES["op11_hard_negatives"]).fetchall())
        found = hard_negatives.op11_hard_negatives(spark, f"{folder}/even" if parts else folder).collect()
        assert sorted(map(tuple, found)) == wanted and wanted
