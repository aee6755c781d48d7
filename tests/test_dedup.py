"""Which rows survive, on any partitioning and with any skew."""

import random

from pyspark.sql import functions as F

from gaugeworks.operators.dedup import drop_exact_duplicates, keep_one
from plan_text import executed_plan


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_latest_row_wins_and_ties_are_settled(spark):
    data = [("a", 1, "x"), ("a", 2, "z"), ("a", 2, "y"), ("b", None, "q"), ("b", 0, "r")]
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k string, t int, v string").repartition(3)
        assert rows(keep_one(df, ["k"], "t")) == [("a", 2, "y"), ("b", 0, "r")]


def test_without_time_the_smallest_row_wins(spark):
    data = [("a", 2, "x"), ("a", None, "y"), ("a", 1, "z")]
    df = spark.createDataFrame(data, "k string, t int, v string").repartition(3)
    assert rows(keep_one(df, ["k"])) == [("a", None, "y")]


def test_null_keys_only_lose_exact_copies(spark):
    data = [(None, 1, "x"), (None, 1, "x"), (None, 1, "y"), (None, 2, "x"), (7, 1, "x"), (7, 1, "y")]
    df = spark.createDataFrame(data, "k int, year int, v string")
    kept = keep_one(df, ["k", "year"])
    assert rows(kept) == rows(
        spark.createDataFrame(
            [(None, 1, "x"), (None, 1, "y"), (None, 2, "x"), (7, 1, "x")], df.schema
        )
    )
    collapsed = keep_one(df, ["k", "year"], null_keys="collapse")
    assert rows(collapsed) == [(7, 1, "x"), (None, 1, "x"), (None, 2, "x")]


def test_key_of_all_columns(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (1, None)], "a int, b int")
    assert rows(keep_one(df, ["a", "b"])) == [(1, 2), (1, None)]
    assert rows(drop_exact_duplicates(df)) == [(1, 2), (1, None)]


def test_matches_brute_force_with_a_hot_key(spark):
    rng = random.Random(5)
    data = [
        (0 if rng.random() < 0.4 else rng.randrange(50), rng.randrange(20), rng.randrange(5))
        for _ in range(3000)
    ]
    df = spark.createDataFrame(data, "k int, t int, v int").repartition(6)
    best = {}
    for k, t, v in data:
        if k not in best or (-t, v) < best[k]:
            best[k] = (-t, v)
    expected = sorted((k, -t, v) for k, (t, v) in best.items())
    assert sorted(tuple(r) for r in keep_one(df, ["k"], "t").collect()) == expected


def test_a_hot_key_is_folded_before_the_shuffle(spark):
    df = spark.range(1000).select(F.floor(F.col("id") / 400).alias("k"), F.col("id").alias("v"))
    plan = executed_plan(keep_one(df.repartition(4), ["k"], "v"))
    assert plan.count("WindowGroupLimit") == 2
    below = plan.split("Exchange hashpartitioning(k", 1)[1]
    assert "WindowGroupLimit" in below


def test_known_keys_need_no_null_test(spark):
    df = spark.range(10).select(F.col("id").alias("k"), F.col("id").alias("v"))
    assert "named_struct" not in executed_plan(keep_one(df, ["k"], never_null=["k"]))
