"""Backtest metrics and band calibration (FIXTURES A3)."""

import math

from pyspark.sql import functions as F

from touchline.operators.scan import average_rank, exact_quantile
from touchline.plans import grading

PROJ = "player_id long, season int, scoring_format string, projected_points double, floor double, ceiling double"
ACT = "player_id long, season int, scoring_format string, position string, games long, actual double"


def _evals(spark, proj, act, min_games=1):
    p = spark.createDataFrame([(i, 2025, "ppr", pts, lo, hi) for i, pts, lo, hi in proj], PROJ)
    a = spark.createDataFrame([(i, 2025, "ppr", pos, g, pts) for i, pos, g, pts in act], ACT)
    return grading.build_evals(p, a, min_games=min_games)


def test_error_sign_and_missing_actual(spark):
    e = _evals(spark, [(1, 200.0, 0.0, 0.0)], [(1, "WR", 17, 180.0)]).collect()[0]
    assert e.projected - e.actual == 20.0
    assert _evals(spark, [(2, 90.0, 0.0, 0.0)], [], min_games=1).count() == 0
    kept = _evals(spark, [(2, 90.0, 0.0, 0.0)], [], min_games=0).collect()[0]
    assert (kept.actual, kept.games, kept.position, kept.projected - kept.actual) == (0.0, 0, "UNK", 90.0)


def test_min_games_filter(spark):
    assert _evals(spark, [(1, 50.0, 0.0, 0.0)], [(1, "RB", 3, 40.0)], min_games=4).count() == 0
    assert _evals(spark, [(1, 50.0, 0.0, 0.0)], [(1, "RB", 3, 40.0)], min_games=3).count() == 1


def _metrics(spark, evals):
    return {r.label: r for r in grading.grade(evals).collect()}


def test_mae_rmse_bias(spark):
    e = _evals(spark, [(1, 120.0, 0.0, 999.0), (2, 70.0, 0.0, 999.0)],
               [(1, "WR", 17, 100.0), (2, "WR", 17, 100.0)])
    m = _metrics(spark, e)["ALL"]
    assert m.n == 2 and abs(m.mae - 25) < 1e-9 and abs(m.bias + 5) < 1e-9
    assert abs(m.rmse - math.sqrt(650)) < 1e-9


def test_empty_metrics_are_zero(spark):
    e = _evals(spark, [], [])
    m = _metrics(spark, e)
    assert list(m) == ["ALL"]
    assert (m["ALL"].n, m["ALL"].mae, m["ALL"].rmse, m["ALL"].pearson, m["ALL"].spearman, m["ALL"].band_pct) == (0, 0, 0, 0, 0, 0)


def test_identical_pairs_correlate_perfectly(spark):
    pts = [50.0, 120.0, 200.0, 300.0]
    e = _evals(spark, [(i, p, 0.0, 999.0) for i, p in enumerate(pts)], [(i, "WR", 17, p) for i, p in enumerate(pts)])
    m = _metrics(spark, e)["ALL"]
    assert abs(m.pearson - 1) < 1e-9 and abs(m.spearman - 1) < 1e-9 and m.mae == 0


def test_band_share(spark):
    e = _evals(spark, [(1, 100.0, 80.0, 120.0), (2, 100.0, 80.0, 120.0), (3, 100.0, 80.0, 120.0)],
               [(1, "WR", 17, 80.0), (2, "WR", 17, 120.0), (3, "WR", 17, 130.0)])
    assert abs(_metrics(spark, e)["ALL"].band_pct - 2 / 3) < 1e-9


def test_spearman_vs_pearson_on_monotone(spark):
    xs = [(1.0, 1.0), (2.0, 4.0), (3.0, 9.0), (4.0, 16.0)]
    e = _evals(spark, [(i, x, 0.0, 0.0) for i, (x, _) in enumerate(xs)], [(i, "WR", 17, y) for i, (_, y) in enumerate(xs)])
    m = _metrics(spark, e)["ALL"]
    assert abs(m.spearman - 1) < 1e-9 and m.pearson < 1


def test_constant_side_gives_zero_correlation(spark):
    e = _evals(spark, [(i, 10.0, 0.0, 0.0) for i in range(3)], [(i, "WR", 17, float(i)) for i in range(3)])
    m = _metrics(spark, e)["ALL"]
    assert m.pearson == 0.0 and m.spearman == 0.0


def test_average_ranks_with_ties(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 10.0), (3, 20.0)], "id long, v double")
    got = {r.id: r.avg_rank for r in average_rank(df, "v").collect()}
    assert got == {1: 1.5, 2: 1.5, 3: 3.0}


def test_position_order_and_biggest_misses(spark):
    e = _evals(spark, [(1, 100.0, 0.0, 0.0), (2, 100.0, 0.0, 0.0), (3, 100.0, 0.0, 0.0)],
               [(1, "WR", 17, 95.0), (2, "QB", 17, 40.0), (3, "RB", 17, 80.0)])
    rows = sorted(grading.grade(e).collect(), key=lambda r: r.display_order)
    assert [r.label for r in rows] == ["ALL", "QB", "RB", "WR"]
    misses = grading.biggest_misses(e, 2).collect()
    assert [r.projected - r.actual for r in misses] == [60.0, 20.0]


def test_normalized_residual(spark):
    df = spark.createDataFrame([(0.0, 100.0, 17.0), (100.0, 120.0, 17.0), (100.0, 120.0, 8.5)], "p double, a double, g double")
    got = [r.r for r in df.select(grading.normalized_residual("p", "a", "g", 17).alias("r")).collect()]
    assert got[0] is None and abs(got[1] - 0.2) < 1e-9 and abs(got[2] - 0.2 / math.sqrt(2)) < 1e-9


def test_exact_quantile(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 10, 20, 30)], "v double")
    got = [exact_quantile(df, "v", q, out="x").collect()[0].x for q in (0.0, 1.0, 0.5)]
    assert got == [0.0, 30.0, 15.0]


def test_recommend_covs(spark):
    s = spark.createDataFrame([("WR", i / 100) for i in range(100)], "position string, r double")
    rec = grading.recommend_covs(s, covs={"WR": 0.10}).collect()[0]
    assert abs(rec.current_coverage - 0.10) <= 0.02
    assert 0.6 <= rec.recommended_cov <= 0.75
    assert abs(rec.target_coverage - math.erf(1 / math.sqrt(2))) < 1e-12


def test_projectable_seasons(spark):
    g = spark.createDataFrame([(s,) for s in range(2018, 2026)], "season int")
    assert sorted(r.season for r in grading.projectable_seasons(g).collect()) == [2022, 2023, 2024, 2025]
    short = spark.createDataFrame([(2024,), (2025,)], "season int")
    assert grading.projectable_seasons(short).count() == 0


def test_cov_merge(spark):
    recs = spark.createDataFrame([("QB", 0.5), ("WR", 0.6), ("UNK", 0.9)], "position string, recommended_cov double")
    got = {r.position: r.cov for r in grading.merge_covs(spark, recs).collect()}
    assert got == {"QB": 0.5, "RB": 0.57, "WR": 0.6, "TE": 0.54}


def test_latest_snapshot_filter(spark):
    df = spark.createDataFrame(
        [("2026-08-01", 2026, "m", "ppr", 0, 1), ("2026-09-01", 2026, "m", "ppr", 0, 2),
         ("2026-09-05", 2026, "m", "ppr", 3, 3), ("2026-07-01", 2026, "m", "std", 0, 4)],
        "snapshot_date string, season int, source string, scoring_format string, week int, v int"
    ).withColumn("snapshot_date", F.to_date("snapshot_date"))
    assert sorted(r.v for r in grading.latest_snapshot(df).collect()) == [2, 4]
