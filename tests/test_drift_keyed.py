"""Files that disagree are read together; one giant keyed object is read by several tasks."""

import json
import random

import pytest
from pyspark.sql import types as T

from touchline.sources import drift
from touchline.sources.keyed import keyed_records, read_keyed_json_split
from touchline.sources.scan import read_keyed_json

FIELDS = ["player_id", "espn_id", "yahoo_id", "full_name", "notes", "positions", "metadata"]


def test_int_bigint_double_and_text_files(spark, tmp_path):
    root = f"{tmp_path}/lake"
    for season, ddl, rows in ((2021, "id int, yards int", [(1, 10)]), (2022, "id bigint, yards bigint, team string", [(2**40, 2**50, "KC")]),
                              (2023, "id int, yards double", [(3, 1.5)]), (2024, "id int, team int, yards float", [(4, 7, 2.5)])):
        spark.createDataFrame(rows, ddl).write.parquet(f"{root}/season={season}/part")
    out = drift.read_drifting(spark, root)
    assert out.dtypes == [("id", "bigint"), ("yards", "double"), ("team", "string"), ("season", "bigint")]
    assert sorted(map(tuple, out.collect())) == [(1, 10.0, None, 2021), (3, 1.5, None, 2023), (4, 2.5, "7", 2024), (2**40, float(2**50), "KC", 2022)]


def test_like_files_are_read_in_one_pass(spark, tmp_path):
    root = f"{tmp_path}/lake"
    for i in range(9):
        spark.createDataFrame([(i, "a")] if i % 2 else [(i,)], "id int, extra string" if i % 2 else "id int").coalesce(1).write.parquet(f"{root}/f{i}")
    parts = drift.alike(spark, drift.list_files(spark, root))
    assert len(parts) == 1 and len(parts[0][1]) == 9  # a missing column is no conflict
    assert sorted(r["id"] for r in drift.read_drifting(spark, root).collect()) == list(range(9))
    with pytest.raises(Exception):
        drift.read_drifting(spark, f"{tmp_path}/none")


def test_widest_types():
    i, lng, d, s = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
    dec = T.DecimalType
    assert drift.widest(i, lng) == lng and drift.widest(lng, d) == d and drift.widest(i, s) == s and drift.widest(T.NullType(), i) == i
    assert drift.widest(dec(5, 2), i) == dec(12, 2) and drift.widest(dec(38, 0), dec(38, 10)) == d and drift.widest(dec(7, 3), dec(6, 2)) == dec(7, 3)
    assert drift.widest(T.DateType(), T.TimestampNTZType()) == T.TimestampNTZType() and drift.widest(T.BooleanType(), i) == s
    a = T.StructType([T.StructField("x", i)])
    b = T.StructType([T.StructField("x", lng), T.StructField("y", s)])
    assert drift.widest(T.ArrayType(a), T.ArrayType(b)) == T.ArrayType(T.StructType([T.StructField("x", lng), T.StructField("y", s)]))


def test_text_partitions_keep_their_zeros(spark, tmp_path):
    root = f"{tmp_path}/lake"
    for code, n in (("07", 1), ("7", 2), ("a b%2Fc", 3)):
        spark.createDataFrame([(n,)], "n int").write.parquet(f"{root}/code={code}/p")
    assert sorted(map(tuple, drift.read_drifting(spark, root).collect())) == [(1, "07"), (2, "7"), (3, "a b/c")]


def players(n, seed=1):
    rnd = random.Random(seed)
    texts = ["plain", "with }, inside", 'a "quoted" }, word', "back\\slash", 'end\\"', "{[}]", "é ✓", "", "line\nbreak }, here"]
    out = {}
    for i in range(n):
        one = {"player_id": str(i), "espn_id": i * 7, "yahoo_id": rnd.choice(["", None, "y1"]), "full_name": rnd.choice(texts), "notes": rnd.choice(texts)}
        if rnd.random() < 0.5:
            one["positions"] = rnd.choice([[], ["RB"], [{"a": "}, {"}, {"b": [1, 2]}]])
        if rnd.random() < 0.5:
            one["metadata"] = rnd.choice([{}, {"k": {"deep": {"x": "},"}, "y": [{}, {"z": 1}]}}])
        out[f"id {i} }}, \" x" if i % 50 == 7 else str(i)] = one
    return out


@pytest.mark.parametrize("indent, separators", [(None, None), (None, (",", ":")), (1, None)])
def test_one_object_by_several_tasks(spark, tmp_path, indent, separators):
    data = players(400)
    path = f"{tmp_path}/players.json"
    with open(path, "w") as f:
        json.dump(data, f, indent=indent, separators=separators, ensure_ascii=False)
    whole = sorted(map(str, read_keyed_json(spark, path, FIELDS).collect()))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "6000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert spark.read.option("lineSep", "},").text(path).rdd.getNumPartitions() >= 8
        records = keyed_records(spark, path).collect()
        split = sorted(map(str, read_keyed_json_split(spark, path, FIELDS).collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert split == whole and len(whole) == 400
    assert sorted(r["record"] for r in records) == list(range(400)) and {k for r in records for k in json.loads(r["entries"])} == set(data)


def test_several_files_and_small_objects(spark, tmp_path):
    for name, data in (("a", players(30)), ("b", {}), ("c", {"1": {"full_name": "only"}}), ("d", players(5, seed=3))):
        (tmp_path / f"{name}.json").write_text(json.dumps(data))
    path = f"{tmp_path}/*.json"
    whole = sorted(map(str, read_keyed_json(spark, path, FIELDS).collect()))
    assert sorted(map(str, read_keyed_json_split(spark, path, FIELDS).collect())) == whole and len(whole) == 36
