"""The binding drops nothing: every team-week has one game, every line is a play."""

from pyspark.sql import functions as F

from touchline.operators.scan import ordered_scan
from touchline.plans import catalog_marts, feeds

SF = "/root/testdata/sf0.001"


def test_every_team_week_has_one_game(spark):
    weeks = feeds.team_weeks(spark, SF).select("season", "week", feeds.code(F.col("nation")).alias("team"))
    games = feeds.schedule(spark, SF).select("season", "week", F.explode(F.array("home_team", "away_team")).alias("team"))
    games = games.withColumn("team", F.regexp_replace("team", "^X", "N")).where(f"team != 'N{feeds.VISITOR}'")
    counts = games.groupBy("season", "week", "team").count()
    assert counts.where("count > 1").count() == 0
    assert weeks.join(counts, ["season", "week", "team"], "left_anti").count() == 0


def test_plays_keep_every_line(spark):
    assert catalog_marts.pbp_feed(spark, SF).count() == spark.read.parquet(f"{SF}/lineitem.parquet").count()


def test_whole_table_numbers_take_no_shuffle_by_piece(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"))
    out = ordered_scan(rows, [F.col("k").asc()], num_partitions=16)
    assert [(r["k"], r["rn"]) for r in out.orderBy("k").collect()] == [(i, i + 1) for i in range(5000)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 1  # over the partitions' totals only
