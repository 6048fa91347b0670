from __future__ import annotations

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetlens.operators import ordered
from fleetlens.operators.ordered import RUN, Limits


def skewed(spark, seed=0, rows=600):
    rng = random.Random(seed)
    data = []
    for i in range(rows):
        key = rng.choice(["hot", "hot", None, "a", "b", "c", "d"])
        data.append((key, rng.choice([None, *range(60)]), i, rng.randrange(1000)))
    return spark.createDataFrame(data, "k string, t int, i int, v int")


def rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: r[2])


def test_hot_keys_are_cut_and_cold_ones_are_not(spark):
    limits = Limits(max_rows=100, min_rows=10)
    runs = ordered.cut(skewed(spark), ["k"], ["t", "i"], limits)
    assert runs.is_cut
    sizes = {(r["k"], r[RUN]): r["count"] for r in runs.df.groupBy("k", RUN).count().collect()}
    assert {k for k, run in sizes if run >= 0} == {"hot"}
    assert sum(1 for k, run in sizes if k == "hot") >= 2
    assert all(n >= 10 for (k, run), n in sizes.items() if run >= 0)


def test_small_input_is_left_alone(spark):
    assert not ordered.cut(skewed(spark), ["k"], ["t", "i"]).is_cut


def test_cut_operators_equal_plain_windows(spark, tiny):
    for seed in range(3):
        df = skewed(spark, seed)
        w = Window.partitionBy("k").orderBy("t", "i")
        to_here = w.rowsBetween(Window.unboundedPreceding, 0)

        got = ordered.numbered(df, ["k"], ["t", "i"], "x", tiny)
        assert rows(got) == rows(df.withColumn("x", F.row_number().over(w)))

        got = ordered.previous(df, ["k"], ["t", "i"], {"x": F.col("v")}, tiny)
        assert rows(got) == rows(df.withColumn("x", F.lag("v").over(w)))

        got = ordered.following(df, ["k"], ["t", "i"], {"x": F.col("v")}, tiny)
        assert rows(got) == rows(df.withColumn("x", F.lead("v").over(w)))

        got = ordered.running_max(df, ["k"], ["t", "i"], F.col("v"), "x", tiny)
        assert rows(got) == rows(df.withColumn("x", F.max("v").over(to_here)))

        runs = ordered.cut(df, ["k"], ["t", "i"], tiny)
        got = runs.result(runs.df.withColumn("x", runs.counted()))
        want = df.withColumn("x", F.count(F.lit(1)).over(Window.partitionBy("k")))
        assert rows(got) == rows(want)

        runs = runs.with_neighbours(before=9)
        frame = runs.window.rowsBetween(-9, 0)
        got = runs.result(runs.df.withColumn("x", F.sum("v").over(frame)))
        assert rows(got) == rows(df.withColumn("x", F.sum("v").over(w.rowsBetween(-9, 0))))


def test_whole_input_as_one_sequence(spark, tiny):
    df = skewed(spark)
    w = Window.orderBy("t", "i")
    got = ordered.running_max(df, [], ["t", "i"], F.col("v"), "x", tiny)
    want = df.withColumn("x", F.max("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    assert rows(got) == rows(want)


def test_first_rows_are_limited_before_the_shuffle(spark):
    df = skewed(spark)
    got = ordered.first_rows(df, ["k"], [F.col("t").desc(), F.col("i").desc()], 2)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert got.count() == 12
