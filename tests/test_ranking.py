from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import sample
from tillbook.functions import ASC, DESC, ascending, descending, directed
from tillbook.operators import ranking
from tillbook.operators import global_ntile, global_ntiles, global_position, global_rank, moving_average, share_of_total


@pytest.fixture(scope="module")
def scores(spark):
    """Ten thousand rows, a third of them with one value, others with few values, some NULL."""
    rng = random.Random(7)

    def value(index):
        if index % 3 == 0:
            return 50
        return None if index % 17 == 0 else rng.randrange(200)

    rows = [(index, value(index)) for index in range(10_007)]
    return spark.createDataFrame(rows, "id int, value int").repartition(11)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_position(scores):
    got = global_position(scores, [("value", DESC), ("id", ASC)], "n")
    order = Window.orderBy(descending("value"), ascending("id"))
    expected = scores.withColumn("n", F.row_number().over(order))
    assert sample.bag(got) == sample.bag(expected)
    assert "SinglePartition" not in plan(got)


@pytest.mark.parametrize("tiles", [1, 3, 7, 10_007, 20_000])
def test_ntile(scores, tiles):
    got = global_ntile(scores, tiles, [("value", ASC), ("id", ASC)], "tile")
    order = Window.orderBy(ascending("value"), ascending("id"))
    expected = scores.withColumn("tile", F.ntile(tiles).over(order))
    assert sample.bag(got) == sample.bag(expected)
    assert "SinglePartition" not in plan(got)


@pytest.mark.parametrize("rows", [0, 1, 2, 5])
def test_ntile_of_few_rows(spark, rows):
    df = spark.range(rows)
    expected = df.withColumn("tile", F.ntile(3).over(Window.orderBy("id")))
    assert sample.bag(global_ntile(df, 3, [("id", ASC)], "tile")) == sample.bag(expected)


@pytest.mark.parametrize("tiles", [1, 3, 7, 20_000])
def test_ntiles_by_bounds(spark, scores, tiles):
    some = scores.filter("id < 50") if tiles > 10_000 else scores
    some = some.withColumn("money", F.col("value").cast("decimal(38,2)"))
    orders = {"up": [("value", ASC), ("id", DESC)], "down": [("money", DESC), ("id", ASC)]}
    got = global_ntiles(some, min(tiles, 60), orders)
    expected = some.withColumn("up", F.ntile(min(tiles, 60)).over(Window.orderBy(ascending("value"), descending("id"))))
    down = Window.orderBy(descending("money"), ascending("id"))
    assert sample.bag(got) == sample.bag(expected.withColumn("down", F.ntile(min(tiles, 60)).over(down)))
    assert global_ntiles(some.filter("id < 0"), 3, orders).collect() == []


@pytest.mark.parametrize("few, sampled", [(50, 40), (600, 300), (5_000, 100)])
def test_tile_bounds_are_found_without_a_sort(spark, scores, monkeypatch, few, sampled):
    monkeypatch.setattr(ranking, "_FEW_KEYS", few)
    monkeypatch.setattr(ranking, "_SAMPLE_KEYS", sampled)
    monkeypatch.setattr(ranking, "_sorted", None)
    names = scores.withColumn("text", F.concat(F.lit("n"), F.col("value").cast("string")))
    names = names.withColumn("real", F.when(F.col("id") % 5 == 0, float("nan")).otherwise(F.col("value") / 3))
    orders = {"a": [("text", DESC), ("id", ASC)], "b": [("real", DESC), ("id", DESC)], "c": [("id", ASC)]}
    got = global_ntiles(names, 5, orders)
    expected = names
    for out, order in orders.items():
        expected = expected.withColumn(out, F.ntile(5).over(Window.orderBy(*(directed(*key) for key in order))))
    assert sample.bag(got.drop("real")) == sample.bag(expected.drop("real"))


def test_keys_that_reach_the_driver_stay_few(spark, monkeypatch):
    monkeypatch.setattr(ranking, "_FEW_KEYS", 500)
    monkeypatch.setattr(ranking, "_SAMPLE_KEYS", 400)
    seen, take = [], ranking._in_order
    monkeypatch.setattr(ranking, "_in_order", lambda keys, order: seen.append(len(keys)) or take(keys, order))
    rows = spark.range(200_000).withColumn("value", F.when(F.col("id") % 3 == 0, 7).otherwise(F.hash("id")))
    got = global_ntiles(rows, 3, {"tile": [("value", ASC), ("id", ASC)]})
    assert [row["count"] for row in got.groupBy("tile").count().orderBy("tile").collect()] == [66_667, 66_667, 66_666]
    assert max(seen) <= 700


def test_equal_keys_are_refused_if_many(spark, monkeypatch):
    monkeypatch.setattr(ranking, "_FEW_KEYS", 50)
    monkeypatch.setattr(ranking, "_SAMPLE_KEYS", 40)
    with pytest.raises(ValueError, match="apart"):
        ranking._rows_at(spark.range(300).select(F.lit(1).alias("one")), 300, [([("one", ASC)], 100)])


@pytest.mark.parametrize("direction", [DESC, ASC])
@pytest.mark.parametrize("few", [10, 50_000])
def test_rank(scores, direction, few, monkeypatch):
    monkeypatch.setattr(ranking, "_FEW_KEYS", few)
    got = global_rank(scores, ("value", direction), "place")
    expected = scores.withColumn("place", F.rank().over(Window.orderBy(directed("value", direction))))
    assert sample.bag(got) == sample.bag(expected)
    assert "SinglePartition" not in plan(got)


def test_rank_sorts_values_and_not_rows(spark, scores, monkeypatch):
    seen, keep = [], ranking.checkpointed
    monkeypatch.setattr(ranking, "_FEW_KEYS", 10)
    monkeypatch.setattr(ranking, "checkpointed", lambda df: seen.append((df.columns, df.count())) or keep(df))
    assert global_rank(scores, ("value", DESC), "place").count() == 10_007
    assert seen == [(["_value", "_rows"], scores.select("value").distinct().count())]


def test_rank_of_no_rows_and_of_one_value(spark, scores):
    assert global_rank(scores.filter("id < 0"), ("value", DESC), "place").collect() == []
    one = global_rank(spark.range(50_000).withColumn("value", F.lit(1)), ("value", ASC), "place")
    assert [tuple(row) for row in one.groupBy("place").count().collect()] == [(1, 50_000)]


def test_rank_splits_a_value_held_by_most_rows(spark):
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        rows = spark.range(0, 60_000, 1, 6).withColumn("value", F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id") % 400))
        ranked = global_rank(rows, ("value", DESC), "place")
        ranked.collect()
        assert "skew=true" in plan(ranked)
    finally:
        for name in names:
            spark.conf.unset(name)


def test_sort_splits_a_value_held_by_most_rows(spark):
    df = spark.range(80_000).select("id", F.lit(1).alias("value"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = global_position(df, [("value", DESC), ("id", ASC)], "n")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [row["count"] for row in placed.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 40_000


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "k string, v int").selectExpr(
        "k", "cast(v as decimal(38,2)) v"
    )
    shares = share_of_total(df, "v", "pct")
    assert sample.bag(shares) == [("a", "1.00", "33.3"), ("b", "2.00", "66.7"), ("c", None, None)]
    text = plan(shares)
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_moving_average_counts_rows_and_puts_null_last(spark):
    df = spark.createDataFrame([(5, 4.0), (1, 1.0), (9, None), (None, 7.0), (2, 2.0)], "d int, v double")
    got = moving_average(df, [ascending("d")], "v", 2, "avg").orderBy(ascending("d"))
    assert [row.avg for row in got.collect()] == [1.0, 1.5, 2.33, 3.0, 5.5]


@pytest.mark.parametrize("direction", [DESC, ASC])
def test_wide_decimals_sort_exactly(spark, direction):
    """Neighbours that share a double, values on both sides of the limit, both signs, NULL."""
    texts = [str(10**37 + step) for step in range(40)] + [str(-(10**37) - step) for step in range(40)]
    for step in range(-9, 9):
        texts += [f"{sign}{10**13 + step}{cents}" for sign in ("", "-") for cents in (".01", ".02")]
    texts += ["0", "0.01", "-0.01", "5", None]
    random.Random(1).shuffle(texts)
    df = spark.createDataFrame([(index, text) for index, text in enumerate(texts)], "id int, text string")
    for scale in (0, 2):
        values = df.select("id", F.col("text").try_cast(f"decimal(38,{scale})").alias("value")).repartition(4)
        got = global_position(values, [("value", direction), ("id", ASC)], "n")
        order = Window.orderBy(directed("value", direction), ascending("id"))
        assert sample.bag(got) == sample.bag(values.withColumn("n", F.row_number().over(order)))
