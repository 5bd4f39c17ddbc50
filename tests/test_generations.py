"""Tables behind a commit pointer: failed and unfinished writes are never seen; scoped writes, conflicts, cleaning."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from touchline.sources.generations import ConflictError, GenerationTable, read_table
from touchline.sources.scan import try_register_view
from touchline.sources.sinks import write_partitioned, write_table


def rows_of(df):
    return sorted(map(str, map(tuple, df.collect())))


def seasons(spark, rows):
    return spark.createDataFrame(rows, "season int, id int, v string")


def failing(df):
    return df.withColumn("v", F.when(F.col("id") >= 0, F.raise_error(F.lit("broken feed"))).cast("string"))


def test_failed_refresh_leaves_the_old_rows(spark, tmp_path):
    path, old = f"{tmp_path}/t", [(2023, 1, "a"), (2023, 2, "b"), (2024, 3, "c"), (2024, 4, "d"), (None, 5, "e")]
    assert write_partitioned(seasons(spark, old), path, ["season"]) == 5
    before = read_table(spark, path)
    with pytest.raises(Exception, match="broken feed"):
        write_partitioned(failing(seasons(spark, [(2024, 9, "x"), (2025, 9, "x")])), path, ["season"])
    assert rows_of(read_table(spark, path)) == sorted(str(r) for r in old)
    assert write_partitioned(seasons(spark, [(2026, 6, "f")]), path, ["season"]) == 1
    assert rows_of(read_table(spark, path)) == ["(2026, 6, 'f')"]
    assert rows_of(before) == sorted(str(r) for r in old)  # a reader in between keeps its generation
    assert rows_of(read_table(spark, path, version=1)) == sorted(str(r) for r in old)


def test_a_table_is_whole_between_writes(spark, tmp_path):
    path = f"{tmp_path}/t"
    for n in (5, 3, 7):
        held = read_table(spark, path) if n != 5 else None
        assert write_table(spark.range(n), path) == n
        if held is not None:
            assert held.count() in (5, 3)
    t = GenerationTable(spark, path)
    assert read_table(spark, path).count() == 7 and [c.version for c in t.commits()] == [3, 2, 1]
    with pytest.raises(FileNotFoundError):
        read_table(spark, f"{tmp_path}/none")


def test_half_written_commit_is_passed_over(spark, tmp_path):
    path = f"{tmp_path}/t"
    write_table(spark.range(4), path)
    (tmp_path / "t" / "_commits" / f"{2:020d}.json").write_text('{"version": 2, "fold')
    assert read_table(spark, path).count() == 4
    write_table(spark.range(6), path)
    assert GenerationTable(spark, path).current().version == 3 and read_table(spark, path).count() == 6


def test_types_and_odd_partitions_come_back(spark, tmp_path):
    rows = [(dt.date(2024, 1, 2), "a/b=c d%", 1.5), (dt.date(2024, 1, 2), None, 2.5), (None, "07", 3.5), (dt.date(2024, 1, 3), "é{x}*", None)]
    df = spark.createDataFrame(rows, "day date, code string, v double")
    path = f"{tmp_path}/t"
    write_partitioned(df, path, ["day", "code"])
    back = read_table(spark, path)
    assert back.dtypes == df.dtypes and rows_of(back) == rows_of(df)
    write_partitioned(df.where("false"), path, ["day", "code"])
    assert read_table(spark, path).dtypes == df.dtypes and read_table(spark, path).count() == 0


def test_scoped_writes_keep_other_partitions(spark, tmp_path):
    t = GenerationTable(spark, f"{tmp_path}/t")
    assert t.upsert(seasons(spark, [(1, 1, "a"), (1, 2, "b"), (2, 3, "c")]), ["season", "id"], ["season"]) == 3
    kept = [f for f in t.current().folders if f.startswith("season=2/")]
    assert t.upsert(seasons(spark, [(1, 2, "B"), (3, 4, "d")]), ["season", "id"], ["season"]) == 3
    assert rows_of(t.read()) == ["(1, 1, 'a')", "(1, 2, 'B')", "(2, 3, 'c')", "(3, 4, 'd')"]
    assert set(kept) <= set(t.current().folders)  # not read, not written again
    with pytest.raises(Exception, match="broken feed"):
        t.upsert(failing(seasons(spark, [(1, 1, "x")])), ["season", "id"], ["season"])
    assert len(t.read().collect()) == 4
    with pytest.raises(ValueError):
        t.upsert(seasons(spark, [(1, 1, "x")]), ["id"], ["season"])


def test_a_batch_run_again_changes_nothing(spark, tmp_path):
    t = GenerationTable(spark, f"{tmp_path}/t")
    t.upsert(seasons(spark, [(1, 1, "a")]), ["season", "id"], ["season"], tag="0", writer="feed")
    t.upsert(seasons(spark, [(1, 1, "b")]), ["season", "id"], ["season"], tag="0", writer="other")
    assert t.upsert(seasons(spark, [(1, 1, "z")]), ["season", "id"], ["season"], tag="0", writer="feed") == 0
    assert rows_of(t.read()) == ["(1, 1, 'b')"]


def test_two_writers(spark, tmp_path):
    t = GenerationTable(spark, f"{tmp_path}/t")
    t.replace(seasons(spark, [(1, 1, "a"), (2, 2, "b")]), ["season"])
    base = t.current()
    t.replace_partitions(seasons(spark, [(1, 1, "first")]), ["season"], base=base)
    t.replace_partitions(seasons(spark, [(2, 2, "second")]), ["season"], base=base)  # another partition: both count
    assert rows_of(t.read()) == ["(1, 1, 'first')", "(2, 2, 'second')"]
    with pytest.raises(ConflictError):
        t.replace_partitions(seasons(spark, [(1, 1, "late")]), ["season"], base=base)
    assert rows_of(t.read()) == ["(1, 1, 'first')", "(2, 2, 'second')"]


def test_vacuum_keeps_what_commits_name(spark, tmp_path):
    t = GenerationTable(spark, f"{tmp_path}/t")
    for v in "abcd":
        t.upsert(seasons(spark, [(1, 1, v), (ord(v), 2, v)]), ["season", "id"], ["season"])
    with pytest.raises(Exception, match="broken feed"):
        t.replace(failing(seasons(spark, [(1, 1, "x")])), ["season"])
    expected = rows_of(t.read())
    assert t.vacuum(keep=1) == 0  # all too young
    assert t.vacuum(keep=1, grace_seconds=-60) >= 3
    assert rows_of(t.read()) == expected and [c.version for c in t.commits()] == [4]


def test_view_over_a_staged_table(spark, tmp_path):
    write_partitioned(seasons(spark, [(1, 1, "a")]), f"{tmp_path}/t", ["season"])
    assert try_register_view(spark, "v_staged", f"{tmp_path}/t") and spark.table("v_staged").count() == 1
