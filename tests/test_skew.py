"""Hot keys: spread ranking and joins must equal the plain ones."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.operators import skew
from millrace.operators.dedup import dedup_first


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    data = []
    for i in range(4000):
        key = "hot" if rng.random() < 0.4 else ("warm" if rng.random() < 0.3 else f"k{rng.randrange(300)}")
        when = None if rng.random() < 0.02 else rng.randrange(50)
        data.append((key if rng.random() > 0.01 else None, when, f"s{rng.randrange(20)}", i))
    return spark.createDataFrame(data, "key string, at int, word string, id int").repartition(5, "id").cache()


@pytest.mark.parametrize("order", [["at", "id"], ["-at", "word", "-id"], ["-word", "at", "id"]])
@pytest.mark.parametrize("keys", [["key"], [], ["key", "word"]])
def test_position_equals_row_number(rows, keys, order):
    hot_rows = 20 if len(order) < 3 or not keys else 400
    placed = skew.with_position(rows, keys, order, "place", hot_rows=hot_rows, hot_share=1 / 1000)
    window = Window.partitionBy(*(keys or [F.lit(1)])).orderBy(*skew.sort_columns(order))
    want = rows.withColumn("place", F.row_number().over(window).cast("long"))
    assert placed.columns == want.columns
    assert sorted(map(str, placed.collect())) == sorted(map(str, want.collect()))


def test_hot_ranking_spreads_the_hot_key(rows):
    placed = skew.with_position(rows, ["key"], ["at", "id"], "place", hot_rows=50, hot_share=1 / 1000)
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "_range" in plan  # the window is partitioned by key and range


def test_no_more_hot_keys_than_the_bound(rows):
    hot = skew.hot_keys(rows, ["key"], hot_rows=1, hot_share=1 / 10)
    assert {r["key"] for r in hot} == {"hot", "warm"}
    assert len(skew.hot_keys(rows, ["id"], hot_rows=0, hot_share=1 / 10)) == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_equals_join(spark, rows, how):
    names = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3)], "key string, n int")
    got = skew.lookup_join(rows, names, ["key"], how, hot_rows=100, hot_share=1 / 1000)
    want = rows.join(names, ["key"], how)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_dedup_limits_before_the_shuffle(rows):
    plan = dedup_first(rows, ["key"], ["at", "id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert dedup_first(rows, ["key"], ["at", "id"]).count() == rows.select("key").distinct().count()


def test_broadcast_only_when_small(spark):
    assert skew.small_enough(spark.range(5), 5) is not None
    big = spark.range(6)
    assert skew.small_enough(big, 5) is big


def test_hot_null_key_of_a_left_join_is_not_shuffled(spark):
    left = spark.createDataFrame([(None, i) for i in range(50)] + [(k, 100 + k) for k in range(5)], "k long, v long")
    right = spark.createDataFrame([(k, f"n{k}") for k in range(3)], "k long, name string")
    plain = left.join(right, ["k"], "left")
    split = skew.lookup_join(left, right, ["k"], "left", hot_rows=10, hot_share=0.1)
    assert split.columns == plain.columns
    assert sorted(split.collect(), key=str) == sorted(plain.collect(), key=str)
    inner = skew.lookup_join(left, right, ["k"], hot_rows=10, hot_share=0.1)
    assert sorted(inner.collect()) == sorted(left.join(right, ["k"]).collect())
