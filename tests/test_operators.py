import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.frames import day, frame, rows
from tidemark.operators.erasure import erase_history, mask_columns, stale_files
from tidemark.operators.latest import latest_record
from tidemark.operators.intervals import interval_join
from tidemark.operators.ordered import in_pieces, running_total, with_neighbours
from tidemark.operators.skew import hot_keys, salted_join
from tidemark.sources.tables import with_file_path


def test_latest_record(spark):
    df = frame(spark, "k string, t int, tie int", ("a", 1, 1), ("a", 2, 1), ("a", 2, 2), ("b", None, 1), (None, 5, 1))
    assert rows(latest_record(df, ["k"], ["t desc", "tie desc"]), "k", "t", "tie") == [
        (None, 5, 1),
        ("a", 2, 2),
        ("b", None, 1),
    ]


def test_latest_record_reduces_before_the_shuffle(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3)

    def plan(order, aggregate=False):
        return latest_record(df, ["k"], order, aggregate=aggregate)._jdf.queryExecution().executedPlan().toString()

    assert "partial_max_by" in plan(["id desc"], True) and "partial_min_by" in plan(["id"], True)
    mixed = plan(["id desc", "k"])
    assert "WindowGroupLimit" in mixed and "Partial" in mixed


def test_latest_record_in_all_directions(spark):
    df = frame(spark, "k int, a int, b int", (1, 1, 1), (1, 1, 2), (1, 2, 2), (1, 2, 3), (1, None, 4))

    def first(*order):
        return rows(latest_record(df, ["k"], order), "a", "b")

    assert first("a desc", "b desc") == [(2, 3)]
    assert first("a", "b") == [(None, 4)]
    assert first("a desc", "b") == [(2, 2)]
    assert first(F.col("a").asc_nulls_last(), "b desc") == [(1, 2)]
    aggregated = latest_record(df, ["k"], ["a desc", "b desc"], aggregate=True)
    assert aggregated.columns == ["k", "a", "b"] and rows(aggregated, "a", "b") == [(2, 3)]
    assert latest_record(df.select("k"), ["k"], ["k desc"], aggregate=True).count() == 1
    with pytest.raises(ValueError):
        latest_record(df, ["k"], ["a desc", "b"], aggregate=True)


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds a third of all rows, NULL is a key, times repeat."""
    ids = spark.range(3000)
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 101 == 0, None).otherwise(F.col("id") % 50)
    return ids.select(
        key.alias("k"),
        (F.col("id") * 7919 % 400).alias("t"),
        "id",
        F.when(F.col("id") % 7 != 0, F.col("id") % 11).alias("v"),
    )




def neighbours(df, piece_rows):
    return with_neighbours(
        df,
        ["k"],
        ["t", "id"],
        position="p",
        previous={"b": ("v", F.lit(-1))},
        following={"a": ("v", F.lit(-1))},
        piece_rows=piece_rows,
    )


def test_hot_keys_are_found(spark, skewed):
    hot = hot_keys(skewed, ["k"], 500)
    assert hot.rows == hot.largest == skewed.where("k = 0").count()
    assert hot.only(skewed).count() + hot.without(skewed).count() == skewed.count()
    assert not hot_keys(skewed, ["k"], 10_000)


def test_all_hot_keys_are_split(spark):
    df = spark.range(8000).select((F.col("id") % 2000).alias("k"), F.col("id").alias("t"), "id", F.col("id").alias("v"))
    hot = hot_keys(df, ["k"], 3)
    assert (hot.rows, hot.largest, hot.frame.count()) == (8000, 4, 2000)
    assert hot.without(df).isEmpty()


@pytest.mark.parametrize("piece_rows", [5, 50, 500])
def test_neighbours_do_not_depend_on_the_pieces(skewed, piece_rows):
    plain, split = neighbours(skewed, 10_000), neighbours(skewed, piece_rows)
    assert split.count() == plain.count() == 3000 and split.columns == plain.columns
    assert plain.exceptAll(split).isEmpty() and split.exceptAll(plain).isEmpty()


def test_neighbours_equal_the_window(skewed):
    window = Window.partitionBy("k").orderBy("t", "id")
    plain = skewed.withColumns(
        {"b": F.lag("v", 1, -1).over(window), "a": F.lead("v", 1, -1).over(window), "p": F.row_number().over(window)}
    )
    split = neighbours(skewed, 30).select(plain.columns)
    assert plain.exceptAll(split).isEmpty() and split.exceptAll(plain).isEmpty()


@pytest.mark.parametrize("kind", ["string", "date", "timestamp_ntz", "decimal(9,2)"])
def test_histories_are_cut_by_any_ordered_type(spark, kind):
    moments = F.date_add(F.lit(day("2024-01-01")), (F.col("id") * 37 % 100).cast("int"))
    value = moments.cast(kind) if kind != "decimal(9,2)" else (F.col("id") * 37 % 100).cast(kind)
    df = spark.range(300).select((F.col("id") % 3).alias("k"), F.when(F.col("id") % 10 > 0, value).alias("t"), "id", F.col("id").alias("v"))
    cut, long = in_pieces(df, ["k"], "t", 20)
    assert cut.select("_piece").distinct().count() == (1 if kind == "string" else 5)
    assert long is None if kind == "string" else long.count() == 300
    plain, split = neighbours(df, 1_000), neighbours(df, 20)
    assert plain.exceptAll(split).isEmpty() and split.exceptAll(plain).isEmpty()


def test_ordered_operators_start_no_job_while_they_are_built(spark, skewed):
    group = "building"
    spark.sparkContext.setJobGroup(group, group)
    try:
        neighbours(skewed, 80)
        running_total(skewed, ["k"], "t", "v", "total", piece_rows=80)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_neighbours_default_only_where_there_is_no_row(spark):
    df = frame(spark, "k int, t int, v int", (1, 1, None), (1, 2, 5))
    found = with_neighbours(df, ["k"], ["t"], previous={"b": ("v", F.lit(9))}, following={"a": ("v", F.lit(9))})
    assert rows(found, "t", "b", "a") == [(1, 9, 5), (2, None, 9)]


@pytest.mark.parametrize("piece_rows", [20, 500])
def test_running_total_does_not_depend_on_the_pieces(skewed, piece_rows):
    plain = running_total(skewed, ["k"], "t", "v", "total")
    split = running_total(skewed, ["k"], "t", "v", "total", piece_rows=piece_rows)
    assert plain.exceptAll(split).isEmpty() and split.exceptAll(plain).isEmpty()
    assert plain.where("k = 0").agg(F.max("total")).first()[0] == skewed.where("k = 0").agg(F.sum("v")).first()[0]


def test_totals_of_fractions_have_the_same_digits_in_any_number_of_pieces(spark):
    ids = spark.range(4000).repartition(7)
    df = ids.select((F.col("id") % 2).alias("k"), (F.col("id") * 31 % 997).alias("t"), (F.col("id") / 7).alias("v"))
    found = [rows(running_total(df.repartition(n), ["k"], "t", "v", "total", piece_rows=2000 // n), "k", "t", "total") for n in (1, 2, 50)]
    assert found[0] == found[1] == found[2] and len(found[0]) > 1900
    odd = frame(spark, "k int, t int, v double", (1, 1, 1.5), (1, 2, float("nan")), (2, 1, None), (2, 2, 1e300), (2, 3, 0.25), (3, 1, None))
    totals = {(r.k, r.t): r.total for r in running_total(odd, ["k"], "t", "v", "total", piece_rows=1).collect()}
    assert totals[1, 1] == 1.5 and totals[1, 2] != totals[1, 2] and totals[2, 1] is totals[3, 1] is None
    assert totals[2, 2] == totals[2, 3] == 1e300


def test_running_total_is_shared_by_ties(spark):
    df = frame(spark, "k int, d date, v int", (1, day("2020-01-01"), 2), (1, day("2020-01-01"), 3), (1, day("2020-01-02"), 4))
    assert rows(running_total(df, ["k"], "d", "v", "total"), "d", "total") == [
        (day("2020-01-01"), 5),
        (day("2020-01-02"), 9),
    ]


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_salted_join(spark, skewed, how):
    right = spark.range(0, 25).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    plain = skewed.join(right, "k", how)
    salted = salted_join(skewed, right, ["k"], how, task_rows=100).select(plain.columns)
    assert plain.exceptAll(salted).isEmpty() and salted.exceptAll(plain).isEmpty()


def test_rows_alike_of_one_hot_key_are_spread(spark):
    left = spark.range(0, 20_000, 1, 4).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    right = spark.createDataFrame([(1, "a"), (2, "b")], "k int, w string")
    joined = salted_join(left, right, ["k"], task_rows=1_000)
    assert joined.count() == 20_000 and joined.distinct().count() == 1
    salts = spark.read.parquet(next(f for f in joined.inputFiles() if "salted-" in f).rsplit("/", 1)[0])
    sizes = [r["count"] for r in salts.groupBy("_salt").count().collect()]
    assert len(sizes) == 20 and max(sizes) - min(sizes) <= 4


@pytest.mark.parametrize("width", [1, 7, 31, 1000])
def test_interval_join_equals_a_range_join(spark, width):
    intervals = spark.range(60).select(
        (F.col("id") % 3).alias("g"), "id",
        F.date_add(F.lit(day("1969-12-20")), (F.col("id") * 17 % 90).cast("int")).alias("a"),
        F.when(F.col("id") % 9 > 0, F.date_add(F.lit(day("1969-12-15")), (F.col("id") * 29 % 140).cast("int"))).alias("z"),
    )
    points = spark.range(150).select((F.col("id") % 4).alias("g"), F.date_add(F.lit(day("1969-12-25")), (F.col("id") % 75).cast("int")).alias("d"))
    points = points.unionByName(frame(spark, "g long, d date", (1, None)))
    plain = intervals.alias("i").join(points.alias("p"), F.expr("i.g = p.g and p.d between i.a and i.z")).select("i.g", "id", "a", "z", "d")
    found = interval_join(intervals, points, "a", "z", "d", keys=["g"], bin_days=width)
    assert rows(found, "g", "id", "a", "z", "d") == rows(plain, "g", "id", "a", "z", "d") and plain.count() > 300
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()


def test_erase_history_keeps_latest_and_unlisted(spark):
    df = frame(spark, "id string, t int", ("a", 1), ("a", 2), ("b", 1), ("b", 2), (None, 1), (None, 2))
    ids = frame(spark, "x string", ("a",), ("a",), ("gone",))
    assert rows(erase_history(df, "id", ids, ["t desc"]), "id", "t") == [
        (None, 1),
        (None, 2),
        ("a", 2),
        ("b", 1),
        ("b", 2),
    ]


def test_erase_history_by_another_column(spark):
    df = frame(
        spark,
        "id string, ref string, t int",
        ("k1", "x", 1),
        ("k1", "y", 2),
        ("k2", "x", 1),
        ("k2", "x", 2),
        ("k3", None, 1),
    )
    ids = frame(spark, "ref string", ("x",))
    erased = erase_history(df, "id", ids, ["t desc"], "ref")
    assert rows(erased, "id", "ref", "t") == [("k1", "y", 2), ("k2", "x", 2), ("k3", None, 1)]


def test_a_missing_key_is_a_key_of_its_own(spark, tmp_path):
    """Listed rows with a NULL key keep their latest record, and older ones are listed as stale."""
    schema = "id string, ref string, t int, path string"
    df = frame(spark, schema, (None, "x", 1, "f1"), (None, "x", 2, "f2"), (None, "y", 1, "f1"), ("k", "x", 1, "f3"))
    ids = frame(spark, "ref string", ("x",))
    assert rows(erase_history(df, "id", ids, ["t desc"], "ref"), "id", "ref", "t") == [(None, "x", 2), (None, "y", 1), ("k", "x", 1)]
    assert rows(stale_files(df, "id", ids, ["t desc"], "ref"), "path") == [("f1",)]


def test_mask_columns_keeps_all_rows(spark):
    df = frame(spark, "owner string, city string, n int", ("a", "Delft", 1), ("a", None, 2), ("b", "Gent", 3), (None, "Lyon", 4))
    ids = frame(spark, "id string", ("a",), ("a",))
    assert rows(mask_columns(df, "owner", ids, ["city"]), "n", "city") == [
        (1, "####"),
        (2, "####"),
        (3, "Gent"),
        (4, "Lyon"),
    ]


def test_stale_files(spark, tmp_path):
    path = str(tmp_path / "history")
    for number, data in enumerate(
        [[("a", 1), ("b", 1)], [("a", 2), ("c", 1)], [("a", 3)], [("d", 1), ("d", 2)]]
    ):
        frame(spark, "id string, t int", *data).withColumn("file", F.lit(number)).coalesce(1).write.mode(
            "append"
        ).partitionBy("file").parquet(path)
    df = with_file_path(spark.read.parquet(path))
    ids = frame(spark, "id string", ("a",), ("c",), ("d",))
    stale = stale_files(df, "id", ids, ["t desc"])
    found = sorted(row.path.split("file=")[1][0] for row in stale.collect())
    assert found == ["0", "1", "3"]
