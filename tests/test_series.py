from pyspark.sql import functions as F

from veloframe.functions import blank_to_null, label_from, minutes_seconds
from veloframe.operators import series


def overlap(spark, rows, **kw):
    df = spark.createDataFrame(rows, "id string, sport string, start int, stop int, distance double")
    out = series.sessions(df, ["sport"], "start", "stop", [F.desc(F.col("stop") - F.col("start"))], "id", scope=F.col("distance") > 0, **kw)
    return {r.id: (r.is_duplicate, r.duplicate_of) for r in out.collect()}


def test_sessions_are_transitive_and_keep_the_longest(spark):
    got = overlap(spark, [("a", "x", 0, 50, 1.0), ("b", "x", 40, 120, 1.0), ("c", "x", 110, 130, 1.0), ("d", "x", 130, 140, 1.0), ("e", "y", 0, 500, 1.0)])
    assert got == {"a": (True, "b"), "b": (False, None), "c": (True, "b"), "d": (False, None), "e": (False, None)}


def test_a_row_out_of_scope_does_not_split_a_group(spark):
    rows = [("a", "x", 0, 100, 1.0), ("z", "x", 10, 60, 0.0), ("b", "x", 20, 90, 1.0), ("n", "x", 30, 40, None)]
    got = overlap(spark, rows)
    assert got["b"] == (True, "a") and not got["z"][0] and not got["n"][0]
    assert overlap(spark, rows, compat=True)["b"] != (True, "a")


def test_equal_starts_have_one_order(spark):
    got = overlap(spark, [("b", "x", 0, 10, 1.0), ("a", "x", 0, 10, 1.0)])
    assert got == {"a": (False, None), "b": (True, "a")}


def test_incomplete_windows_do_not_count(spark):
    df = spark.createDataFrame([(1, i, 100.0 + i) for i in range(10)], "k int, s int, v double").withColumn("t", F.timestamp_seconds("s"))
    got = {r.seconds: r.best for r in series.best_means(df, "k", "t", "v", [(4, 4), (60, 54)]).collect()}
    assert got == {4: 107.0}  # both ends are in: five samples


def test_best_means_by_second_are_those_of_the_range_frames(spark):
    import random

    rng = random.Random(3)
    rows, t = [], 0
    for _ in range(400):
        t += rng.choice([1, 1, 1, 1, 2, 5, 40, 200])
        rows += [(rng.randint(1, 2), t, rng.choice([None, 0, 100, 250]))] * rng.choice([1, 1, 1, 2])
    df = spark.createDataFrame(rows, "k int, s int, v int").withColumn("t", F.timestamp_seconds("s"))
    windows = [(3, 3), (10, 6), (60, 12)]
    want = {(r.k, r.seconds): round(r.best, 9) for r in series.best_means(df.filter("v is not null"), "k", "t", "v", windows).collect()}
    got = {(r.k, r.seconds): round(r.best, 9) for r in series.best_means_by_second(df, "k", "t", "v", windows).collect()}
    assert got == want and len(got) >= 4


def test_as_of_takes_the_latest_at_or_before(spark):
    left = spark.createDataFrame([("a", 5), ("a", 1), ("b", 9)], "k string, t int")
    right = spark.createDataFrame([("a", 3, "x"), ("a", 5, "y"), ("c", 1, "z")], "k string, t int, v string")
    got = {(r.k, r.t): r.asof_v for r in series.as_of(left, right, ["k"], "t", "t", ["v"]).collect()}
    assert got == {("a", 5): "y", ("a", 1): None, ("b", 9): None}


def test_hold_stops_at_gaps(spark):
    df = spark.createDataFrame([(1, 0, 5.0), (1, 2, 6.0), (1, 20, 7.0)], "k int, t int, v double")
    got = sorted((r.step, r.v) for r in series.held(df, ["k"], "t", ["v"], 5).collect())
    assert got == [(0, 5.0), (1, 5.0), (2, 6.0), (20, 7.0)]


def test_halves_weigh_by_time_and_do_not_fill(spark):
    df = spark.createDataFrame([(1, 0.0, 100.0), (1, 4.0, None), (1, 6.0, 200.0), (1, 10.0, 0.0)], "k int, t double, v double")
    r = series.halves(df, ["k"], "t", "v", 5.0).first()
    assert (r.first_half, r.second_half) == (100.0, 200.0)


def test_linear_fit_needs_three_points(spark):
    df = spark.createDataFrame([("a", x, 2.0 * x + 1) for x in (1.0, 2.0, 3.0)] + [("b", 1.0, 1.0), ("b", 2.0, 2.0)], "k string, x double, y double")
    rows = series.linear_fit(df, ["k"], "x", "y").collect()
    assert [(r.k, round(r.slope, 9), round(r.intercept, 9)) for r in rows] == [("a", 2.0, 1.0)]


def test_scalars(spark):
    df = spark.createDataFrame([(" ", None, 59.5), ("None", "g1234567", None), ("x", "g1", 61.4)], "a string, g string, s double")
    got = [tuple(r) for r in df.select(blank_to_null(F.col("a")), label_from(F.col("g"), {"g1": "one"}, "none"), minutes_seconds(F.col("s"))).collect()]
    assert got == [(None, "none", "1:00"), (None, "other(g12345…)", None), ("x", "one", "1:01")]


def test_windows_share_one_exchange(spark):
    df = spark.range(10).select(F.col("id").alias("k"), F.timestamp_seconds("id").alias("t"), F.lit(1.0).alias("v")).repartition(3)
    plan = series.best_means(df, "k", "t", "v", [(4, 4), (8, 8), (12, 12)])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("+- Window") <= 1


def test_disjoint_intervals_with_missing_ends(spark):
    made = [(None, 0, 5), (None, 4, 9), (None, 5, 6), (1, None, 3), (1, 3, 4), (1, 4, 4), (1, 4, 9), (2, 1, None), (2, 7, 8), (3, 1, 2), (3, 1, 2), (3, 2, 2)]
    df = spark.createDataFrame(made, "k int, s int, e int").repartition(5)
    want = [(None, 0, 5), (None, 5, 6), (1, None, 3), (1, 3, 4), (1, 4, 4), (1, 4, 9), (2, 1, None), (3, 1, 2), (3, 2, 2)]
    assert sorted(map(tuple, series.greedy_disjoint(df, ["k"], "s", "e").collect()), key=repr) == sorted(want, key=repr)
    assert series.greedy_disjoint(df.limit(0), ["k"], "s", "e").count() == 0
