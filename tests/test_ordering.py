"""Bucketed ordering against plain windows on awkward data: ties, signs, tiny and huge values, NULLs."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from vendaflow.operators import ordering
from vendaflow.operators.ordering import exact_quantiles, fine_bucket, join_whole, order_bucket, row_numbers, running_totals


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(7)
    pool = [0.0, -1.5, 3.25, 1e-9, 1e12, -1e12] + [rnd.uniform(-50, 50) for _ in range(60)]
    data = [(f"k{i}", rnd.choice(["a", "b", None]), rnd.choice(pool) if i % 3 else 0.0, rnd.randint(1, 9))
            for i in range(3000)]
    data += [(f"n{i}", "a", None, 1) for i in range(5)]
    return spark.createDataFrame(data, "k string, g string, v double, w int").cache()


def test_bucket_is_monotone(spark):
    values = sorted({random.Random(i).uniform(-1, 1) * 10 ** random.Random(-i).randint(-12, 12) for i in range(4000)}
                    | {0.0, 1.0, 2.0, 4.0, -4.0, 2.0 ** 40, 2.0 ** 40 - 1e-4})
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r.b for r in df.select("i", order_bucket(F.col("v")).alias("b")).orderBy("i").collect()]
    assert got == sorted(got)


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_equal_range_window(rows, descending):
    got = running_totals(rows, ["g"], "v", {"s": F.col("w")}, descending)
    axis = F.col("v").desc() if descending else F.col("v").asc()
    w = Window.partitionBy("g").orderBy(axis)
    want = rows.select("g", "v", F.sum("w").over(w).alias("s_ate"),
                       F.sum("w").over(Window.partitionBy("g")).alias("s_total")).distinct()
    a = got.select("g", "v", "s_ate", "s_total")
    assert a.exceptAll(want).count() == 0 and want.exceptAll(a).count() == 0


@pytest.mark.parametrize("part, descending", [(["g"], True), ([], False)])
def test_row_numbers_equal_window(rows, part, descending):
    got = row_numbers(rows, part, "v", "k", "rn", descending)
    axis = F.col("v").desc() if descending else F.col("v").asc()
    w = Window.partitionBy(*part).orderBy(axis, F.md5(F.col("k").cast("binary")), "k")
    want = rows.withColumn("rn", F.row_number().over(w).cast("long")).withColumn(
        "rn_n", F.count("*").over(Window.partitionBy(*part)))
    assert got.count() == rows.count()
    assert got.exceptAll(want).count() == 0


@pytest.mark.parametrize("limit", [0, 40, 10_000])
@pytest.mark.parametrize("part, descending", [(["g"], True), ([], False)])
def test_row_numbers_by_cells_and_by_slots(rows, monkeypatch, limit, part, descending):
    """All cells hot, some (equal values), none: the numbers are those of one window."""
    monkeypatch.setattr(ordering, "CELL_ROWS", limit)
    got = row_numbers(rows, part, "v", "k", "rn", descending)
    axis = F.col("v").desc() if descending else F.col("v").asc()
    w = Window.partitionBy(*part).orderBy(axis, F.md5(F.col("k").cast("binary")), "k")
    want = rows.withColumn("rn", F.row_number().over(w).cast("long")).withColumn(
        "rn_n", F.count("*").over(Window.partitionBy(*part)))
    assert got.count() == rows.count() and got.exceptAll(want).count() == 0


def test_row_numbers_move_the_rows_once(spark):
    """Without a hot value the rows are shuffled once, and the table of cells at most once more."""
    spread = spark.range(50_000).select(F.rand(3).alias("v"), F.col("id").cast("string").alias("k"))
    plan = row_numbers(spread, [], "v", "k", "rn")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2, plan


def test_no_task_orders_a_third_of_the_rows(spark):
    """All rows share one value: the largest window partition must stay a small slice."""
    hot = spark.range(20000).select(F.lit(5.0).alias("v"), F.col("id").cast("string").alias("k"))
    numbered = row_numbers(hot, [], "v", "k", "rn")
    assert numbered.agg(F.countDistinct("rn"), F.max("rn")).first() == (20000, 20000)
    slots = hot.groupBy(F.substring(F.md5(F.col("k").cast("binary")), 1, 3)).count().agg(F.max("count")).first()[0]
    assert slots < 50


@pytest.mark.parametrize("probs", [{"q": 0.25}, {"a": 0.0, "b": 0.5, "c": 1.0}])
def test_quantiles(rows, probs):
    got = exact_quantiles(rows, "v", probs).first()
    for name, p in probs.items():
        assert got[name] == pytest.approx(rows.agg(F.percentile("v", p)).first()[0])
    disc = exact_quantiles(rows, "v", probs, interpolate=False).first()
    values = sorted(r.v for r in rows.filter("v IS NOT NULL").collect())
    for name, p in probs.items():
        want = next(v for i, v in enumerate(values) if (i + 1) / len(values) >= p)
        assert disc[name] == want


def test_join_whole_matches_nulls(spark):
    a = spark.createDataFrame([(1, None, "x"), (None, None, "y")], "p int, q int, l string")
    b = spark.createDataFrame([(1, None, 10), (None, None, 20), (2, 2, 30)], "p int, q int, r int")
    assert {(r.l, r.r) for r in join_whole(a, b, ["p", "q"]).collect()} == {("x", 10), ("y", 20)}


@pytest.mark.parametrize("descending", [False, True])
def test_nan_infinities_and_null_are_ordered_as_spark_does(spark, descending):
    odd = [5.0, float("nan"), 1.0, float("inf"), float("-inf"), None, -0.0, 0.0, float("nan"), -3.0, 1e308, 5e-324]
    df = spark.createDataFrame([(f"k{i}", v) for i, v in enumerate(odd)], "k string, v double")
    axis = F.col("v").desc() if descending else F.col("v").asc()
    tie = F.md5(F.col("k").cast("binary"))
    want = df.withColumn("n", F.row_number().over(Window.orderBy(axis, tie, "k")).cast("long")).select("k", "n")
    got = row_numbers(df, [], "v", "k", "n", descending).select("k", F.col("n").cast("long"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


@pytest.mark.parametrize("descending", [False, True])
def test_a_narrow_band_is_spread_and_exact(spark, descending):
    df = spark.range(5000).selectExpr("CAST(id AS STRING) AS k", "IF(id % 2 = 0, 1, -1) * (1.7e9 + (id * 37) % 4999) AS v")
    parts = df.select(order_bucket(F.col("v")).alias("b"), fine_bucket(F.col("v")).alias("f")).distinct()
    assert parts.select("b").distinct().count() <= 4 and parts.count() > 8
    assert parts.agg(F.min("f"), F.max("f")).first()[0] >= 0
    axis = F.col("v").desc() if descending else F.col("v").asc()
    tie = F.md5(F.col("k").cast("binary"))
    want = df.withColumn("n", F.row_number().over(Window.orderBy(axis, tie, "k")).cast("long")).select("k", "n")
    got = row_numbers(df, [], "v", "k", "n", descending).select("k", F.col("n").cast("long"))
    assert got.exceptAll(want).count() == 0
