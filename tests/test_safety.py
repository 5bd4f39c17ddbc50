"""Writes that fail keep the old rows; keys stay whole; casts read every form the feeds use."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline import session
from touchline.functions.scalars import kickoff_timestamp, percent_label
from touchline.operators.upsert import VersionedTable, upsert_partitions
from touchline.plans import feeds
from touchline.plans.identity import hub_keys, stage_hub
from touchline.plans.marts import project_spec
from touchline.sources.generations import read_table
from touchline.sources.scan import read_lake
from touchline.sources.sinks import write_table


def failing(spark):
    return spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("id"))


def test_failed_write_keeps_the_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert write_table(spark.range(5), path) == 5 and write_table(spark.range(7), path) == 7
    with pytest.raises(Exception, match="no"):
        write_table(failing(spark), path)
    assert read_table(spark, path).count() == 7


def test_unreadable_table_is_not_a_first_write(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "season int, id int, v string")
    assert upsert_partitions(spark, path, rows, ["season", "id"], ["season"]) == 2
    (tmp_path / "t" / "season=1" / "part-bad.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        upsert_partitions(spark, path, rows.limit(1), ["season", "id"], ["season"])
    (tmp_path / "t" / "season=1" / "part-bad.parquet").unlink()
    assert spark.read.parquet(path).count() == 2


def test_uncommitted_version_is_not_read(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    assert t.version() is None and t.commit(spark.range(4)) == 1
    half = tmp_path / "t" / "v=2"
    half.mkdir()
    (half / "part-0.parquet").write_bytes(b"half")
    assert t.version() == 1 and t.read().count() == 4
    assert t.commit(spark.range(6)) == 3 and t.read().count() == 6


def test_ids_stay_distinct_at_every_width(spark, tmp_path):
    keys = [k + i for k in (10**5, 10**6, 10**7) for i in range(-5, 5)]
    rows = [(k, f"Customer#{k:09d}", "BUILDING", 0, 10.0) for k in keys]
    spark.createDataFrame(rows, "c_custkey long, c_name string, c_mktsegment string, c_nationkey int, c_acctbal double") \
        .write.parquet(f"{tmp_path}/customer.parquet")
    master = feeds.raw_master(spark, str(tmp_path))
    hub = feeds.raw_hub(spark, str(tmp_path))
    assert master.select("gsis_id").distinct().count() == master.select("pfr_id").distinct().count() == len(keys)
    assert hub.select("player_id").distinct().count() == len(keys)


def test_raw_tree_takes_the_season_from_its_folder(spark, tmp_path):
    spark.createDataFrame([("p", 3)], "player string, yds int").write.parquet(f"{tmp_path}/season=2023")
    schema = T.StructType([T.StructField("player", T.StringType()), T.StructField("yds", T.LongType()), T.StructField("season", T.IntegerType())])
    assert [tuple(r) for r in read_lake(spark, str(tmp_path), schema, hive=False).collect()] == [("p", 3, 2023)]


def test_kickoff_forms_and_labels(spark):
    rows = [("2024-09-08", t) for t in ("9:30", "13:00", "13:00:00", None, "x")]
    out = spark.createDataFrame(rows, "d string, t string").select(kickoff_timestamp("d", "t")).collect()
    at = [r[0] for r in out]
    assert at == [dt.datetime(2024, 9, 8, 9, 30), dt.datetime(2024, 9, 8, 13), dt.datetime(2024, 9, 8, 13), dt.datetime(2024, 9, 8), None]
    assert spark.range(1).select(percent_label(F.lit(12.345))).first()[0] == "1234%"


def test_hub_numbers_and_half_even(spark):
    rows = [("S1", "A", "72.0"), ("S2", "B", "72.5"), ("S3", "C", ""), ("S4", "D", "x")]
    hub = spark.createDataFrame(rows, "player_id string, full_name string, height string").withColumn("snapshot_date", F.lit("2026-01-01"))
    assert [r["height_inches"] for r in stage_hub(hub).orderBy("sleeper_id").collect()] == [72, 73, None, None]
    spec = (("n", "n", "int"),)
    out = project_spec(spark.createDataFrame([(7.5,), (8.5,), (-1.7,)], "n double"), spec).collect()
    assert [r["n"] for r in out] == [8, 8, -2]


def test_one_id_per_player_when_a_master_id_is_shared(spark):
    existing = spark.createDataFrame([(1, "S0")], "player_id long, sleeper_id string")
    master = spark.createDataFrame([(1, "g0"), (2, "g1")], "player_id long, gsis_id string")
    hub = spark.createDataFrame([("S0", "g0"), ("S1", "g1"), ("S2", "g1"), ("S3", "g0")], "sleeper_id string, gsis_id string")
    got = {r["sleeper_id"]: r["player_id"] for r in hub_keys(hub, existing, master).collect()}
    assert got["S0"] == 1 and got["S1"] == 2 and len(set(got.values())) == 4


def test_a_cluster_needs_a_named_checkpoint_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext, conf = Context(), {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
