"""Scoring and projection pinned to the reference's own unit values (FIXTURES A1, A2)."""

from pyspark.sql import functions as F

from touchline.plans.projection import (
    ACTUAL_SCORE_INPUTS, BASELINE_RATES, TOTAL_FIELDS, band, project_lines, rz_factor, score_expr,
)
from touchline.sources import rules

SETTINGS = dict(pass_yard_pts=.04, pass_td_pts=4.0, pass_int_pts=-2.0, rush_yard_pts=.1, rush_td_pts=6.0,
                rec_pts=1.0, rec_yard_pts=.1, rec_td_pts=6.0, fumble_lost_pts=-2.0, two_pt_pts=2.0,
                te_premium=.5)
STATS = [s for s, _ in rules.POINT_PAIRS]


def _score(spark, lines):
    rows = [tuple(float(l[0].get(s, 0.0)) for s in STATS) + (l[1],) for l in lines]
    df = spark.createDataFrame(rows, ", ".join(f"{s} double" for s in STATS) + ", position string")
    st = spark.createDataFrame([tuple(SETTINGS.values())], ", ".join(f"{k} double" for k in SETTINGS))
    out = df.crossJoin(st).select(score_expr(ACTUAL_SCORE_INPUTS, F.col("position")).alias("p"))
    return [r.p for r in out.collect()]


def test_score_line_values(spark):
    got = _score(spark, [
        ({"receptions": 100, "rec_yards": 1200, "rec_tds": 10}, "WR"),
        ({"receptions": 80, "rec_yards": 800, "rec_tds": 6}, "WR"),
        ({"receptions": 80, "rec_yards": 800, "rec_tds": 6}, "TE"),
        ({"pass_yards": 4000, "pass_tds": 30, "interceptions": 12, "fumbles_lost": 3}, None),
        ({}, None),
    ])
    assert [round(g, 9) for g in got] == [280.0, 196.0, 236.0, 250.0, 0.0]


def _totals(spark, seasons):
    names = [n for n, _ in TOTAL_FIELDS]
    rows = []
    for s in seasons:
        rows.append((1, s["season"], "WR", s.get("games", 17)) + tuple(float(s.get(n, 0.0)) for n in names))
    schema = "player_id long, season int, position string, games long, " + ", ".join(f"{n} double" for n in names)
    return spark.createDataFrame(rows, schema)


def _wr_baseline(spark, target=2026):
    vals = {"catch_rate": .65, "yards_per_target": 8.0, "rec_td_per_target": .05, "rz_target_rate": .08}
    row = (target, "WR") + tuple(float(vals.get(n, 0.0)) for n, *_ in BASELINE_RATES)
    return spark.createDataFrame([row], "target int, position string, " +
                                 ", ".join(f"b_{n} double" for n, *_ in BASELINE_RATES))


def _wr(season, targets, rec, rec_yards, rec_tds, games=17, rz_targets=8):
    return dict(season=season, games=games, targets=targets, receptions=rec, rec_yards=rec_yards,
                rec_tds=rec_tds, rz_targets=rz_targets)


def test_projection_regresses_toward_baseline(spark):
    t = _totals(spark, [_wr(2025, 100, 70, 1400, 10), _wr(2024, 100, 70, 1400, 10)])
    line = project_lines(t, [2026], _wr_baseline(spark)).collect()[0]
    assert 8.0 < line.proj_rec_yards / 100.0 < 14.0
    assert line.games == 17.0


def test_projection_scales_with_games(spark):
    full = project_lines(_totals(spark, [_wr(2025, 170, 110, 1530, 10, rz_targets=14)]), [2026],
                         _wr_baseline(spark)).collect()[0]
    half = project_lines(_totals(spark, [_wr(2025, 80, 52, 720, 5, games=8, rz_targets=7)]), [2026],
                         _wr_baseline(spark)).collect()[0]
    assert full.games == 17.0 and half.games == 8.0
    assert half.proj_receptions < full.proj_receptions
    assert abs(half.proj_receptions / full.proj_receptions - 8 / 17) < 0.05


def test_no_projection_without_recent_history(spark):
    t = _totals(spark, [_wr(2021, 100, 65, 900, 6)])
    assert project_lines(t, [2026], _wr_baseline(spark)).count() == 0


def test_rz_factor(spark):
    df = spark.createDataFrame([(16.0, 100.0, .08), (0.0, 0.0, .08), (8.0, 100.0, 0.0)], "rz double, opp double, b double")
    got = [r.f for r in df.select(rz_factor(F.col("rz"), F.col("opp"), F.col("b")).alias("f")).collect()]
    assert got[0] > 1.0 and got[1] == 1.0 and got[2] == 1.0


def test_band_widens_with_missed_time(spark):
    df = spark.createDataFrame([(200.0, "RB", 17.0), (200.0, "RB", 9.0)], "p double, pos string, g double")
    lo, hi = band(F.col("p"), F.col("pos"), F.col("g"))
    (f_full, c_full), (f_part, c_part) = [(r.lo, r.hi) for r in df.select(lo.alias("lo"), hi.alias("hi")).collect()]
    assert f_full < 200.0 < c_full
    assert f_part < f_full and c_part > c_full


def test_recency_weights_renormalise():
    from touchline.plans.projection import recency_weight_table
    t = recency_weight_table(rules.RECENCY)
    assert abs(t[(1, 1)] - 1.0) < 1e-12
    assert abs(t[(2, 1)] - 2 / 3) < 1e-12 and abs(t[(2, 2)] - 1 / 3) < 1e-12
    assert abs(sum(t[(3, i)] for i in (1, 2, 3)) - 1.0) < 1e-12
