"""Ordered scans, surrogate ids and minting (WIN-1..4)."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from touchline.operators.keys import dense_ids, keep_first, mint_additive, mint_mixed
from touchline.operators.scan import ordered_scan


def test_ordered_scan_matches_window(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice("abc"), rnd.randint(0, 50), float(rnd.randint(-5, 5))) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, g string, k int, v double")
    order = [F.col("k").desc(), F.col("id")]
    got = ordered_scan(df, order, ["g"], sums={"run": F.col("v")}, num_partitions=7)
    w = Window.partitionBy("g").orderBy(*order)
    want = df.select("id", F.row_number().over(w).alias("rn"),
                     F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("run"))
    assert sorted(map(tuple, got.select("id", "rn", "run").collect())) == sorted(map(tuple, want.collect()))


def test_ordered_scan_global(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"))
    got = ordered_scan(df, ["k"], num_partitions=5).collect()
    assert sorted((r.k, r.rn) for r in got) == [(k, k + 1) for k in range(1000)]


def test_dense_ids(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "key string")
    assert [(r.player_id, r.key) for r in dense_ids(df, "key").orderBy("player_id").collect()] == \
        [(1, "a"), (2, "b"), (3, "c")]


def test_additive_minting_keeps_ids_and_is_stable(spark):
    existing = spark.createDataFrame([(1, "b"), (2, "d")], "player_id long, key string")
    incoming = spark.createDataFrame([("a",), ("b",), ("e",), ("c",)], "key string")
    new = mint_additive(existing, incoming, "key")
    assert sorted(map(tuple, new.collect())) == [(3, "a"), (4, "c"), (5, "e")]
    registry = existing.unionByName(new)
    again = mint_additive(registry, incoming, "key")
    assert again.count() == 0


def test_one_allocator_over_both_registries(spark):
    hub = spark.createDataFrame([(1, "x"), (2, "y")], "player_id long, key string")
    other = spark.createDataFrame([(7, "g")], "player_id long, gsis_id string")
    new = mint_additive(hub, spark.createDataFrame([("z",)], "key string"), "key", floor_ids=[other])
    assert new.collect()[0].player_id == 8  # above the max of both, no collision with 7


def test_mixed_minting(spark):
    incoming = spark.createDataFrame([("g1",), ("g2",), ("g3",)], "gsis_id string")
    reuse = spark.createDataFrame([("g2", 5)], "gsis_id string, rid long")
    floor = spark.createDataFrame([(9, "s")], "player_id long, sleeper_id string")
    got = sorted(map(tuple, mint_mixed(incoming, "gsis_id", reuse, "rid", [floor]).collect()))
    assert got == [(5, "g2"), (10, "g1"), (11, "g3")]


def test_keep_first(spark):
    df = spark.createDataFrame([(1, 3), (1, 1), (2, 5)], "k long, v long")
    assert sorted(map(tuple, keep_first(df, ["k"], [F.col("v")]).collect())) == [(1, 1), (2, 5)]
