"""Join helpers: exclusion anti-join, bounded broadcast, crosswalk rejects, salted join."""

from pyspark.sql import functions as F

from touchline.operators.joins import anti_by_lower, bounded_broadcast, resolve_ids, salted_join


def test_anti_by_lower(spark):
    players = spark.createDataFrame([(1, "Josh Allen"), (2, "CeeDee Lamb"), (3, "Other")], "id int, full_name string")
    drafted = spark.createDataFrame([(" josh allen",), ("CEEDEE LAMB",)], "name string")
    assert [r.id for r in anti_by_lower(players, drafted, "full_name").collect()] == [3]


def test_bounded_broadcast(spark):
    _, ok = bounded_broadcast(spark.range(10), 100)
    _, big = bounded_broadcast(spark.range(1000), 100)
    assert ok and not big


def test_resolve_with_rejects(spark):
    facts = spark.createDataFrame([("00-1", 5), ("00-9", 7)], "gsis string, v int")
    xw = spark.createDataFrame([(1, "gsis", "00-1"), (2, "pfr", "00-9")], "player_id int, source string, source_id string")
    ok, rej = resolve_ids(facts, xw, "gsis", "gsis", with_rejects=True)
    assert [r.v for r in ok.collect()] == [5] and [r.v for r in rej.collect()] == [7]


def test_salted_join_matches_plain_join(spark):
    big = spark.range(2000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))  # three hot keys
    small = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "k long, name string")
    plain = sorted(map(tuple, big.join(small, "k").select("v", "name").collect()))
    salted = sorted(map(tuple, salted_join(big, small, ["k"], 8).select("v", "name").collect()))
    assert plain == salted and len(salted) == 2000
