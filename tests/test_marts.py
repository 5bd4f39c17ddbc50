"""Marts and identity on small feed-shaped fixtures (FIXTURES B edge cases)."""

import datetime as dt

from pyspark.sql import functions as F

from touchline.plans import identity, marts
from touchline.sources import rules

SCHED = ("game_id string, season int, week int, game_type string, gameday string, gametime string, "
         "home_team string, away_team string, home_score double, away_score double, spread_line double, "
         "total_line double, home_moneyline int, away_moneyline int, temp string, wind string")


def _schedule(spark):
    return spark.createDataFrame([
        ("2018_01_OAK_KC", 2018, 1, "REG", "2018-09-09", None, "OAK", "KC", 24.5, 17.0, 3.0, 47.5, -150, 130, " 72 ", "5"),
        ("2018_22_KC_LA", 2018, 22, "SB", "2019-02-03", "18:30", "KC", "STL", 27.0, 20.0, None, None, None, None, "n/a", None),
        ("2019_01_LV_SD", 2019, 1, None, None, "13:00", "LV", "SD", 3.5, 2.5, -2.0, None, 110, -130, "60.5", "x"),
    ], SCHED)


def test_dim_teams_canonical_codes(spark):
    teams = marts.dim_teams(_schedule(spark), spark.createDataFrame(list(rules.TEAM_META),
                            "abbr string, franchise_id int, city string, name string, conference string, division string"))
    got = sorted((r.season, r.abbr, r.team_id) for r in teams.collect())
    assert (2018, "LV", 201819) in got and (2018, "LA", 201818) in got and (2019, "LAC", 201917) in got
    assert all(a not in {"OAK", "STL", "SD"} for _, a, _ in got)


def test_dim_games_casts_and_kickoff(spark):
    meta = spark.createDataFrame(list(rules.TEAM_META),
                                 "abbr string, franchise_id int, city string, name string, conference string, division string")
    s = _schedule(spark)
    g = {r.game_id: r for r in marts.dim_games(s, marts.dim_teams(s, meta)).collect()}
    a = g["2018_01_OAK_KC"]
    assert a.kickoff_time == dt.datetime(2018, 9, 9, 0, 0) and a.season_type == "REG"
    assert a.home_score == 24 and a.weather_temp_f == 72 and a.home_team_id == 201819
    b = g["2018_22_KC_LA"]
    assert b.season_type == "POST" and b.away_team_id == 201818 and b.weather_temp_f is None
    c = g["2019_01_LV_SD"]
    assert c.season_type == "POST" and c.game_date is None and c.kickoff_time is None
    assert c.home_score == 4 and c.away_score == 2  # half-even: 3.5 -> 4, 2.5 -> 2
    assert c.weather_temp_f == 61 and c.weather_wind_mph is None  # text: half away from zero; junk -> NULL


def test_vegas_lines(spark):
    v = {r.game_id: r for r in marts.vegas_closing_lines(_schedule(spark)).collect()}
    assert set(v) == {"2018_01_OAK_KC"}  # no lines / no date -> dropped
    r = v["2018_01_OAK_KC"]
    assert float(r.spread_home) == -3.0 and float(r.home_implied_total) == 25.3 or float(r.home_implied_total) == 25.2
    assert r.sportsbook == rules.CLOSING_BOOK and r.snapshot_at == dt.datetime(2018, 9, 9, 0, 0)


def _xwalk(spark):
    return spark.createDataFrame([(1, "gsis", "00-1"), (2, "gsis", "00-2"), (1, "pfr", "P1")],
                                 "player_id int, source string, source_id string")


def test_ngs_full_outer_and_week_remap(spark):
    rec = spark.createDataFrame([("00-1", 2023, 23, 3.1, 6.0)],
                                "player_gsis_id string, season int, week int, avg_separation double, avg_cushion double")
    rush = spark.createDataFrame([("00-1", 2023, 23, 1.25), ("00-2", 2023, 5, -0.5), ("00-9", 2023, 5, 1.0)],
                                 "player_gsis_id string, season int, week int, rush_yards_over_expected double")
    got = sorted(map(tuple, marts.ngs_player_week(rec, rush, _xwalk(spark))
                     .select("player_id", "week", F.col("avg_separation").cast("double"),
                             F.col("rush_yards_over_expected").cast("double")).collect()))
    assert got == [(1, 22, 3.1, 1.25), (2, 5, None, -0.5)]  # 00-9 unresolved -> dropped


def test_pbp_redzone_counts(spark):
    plays = spark.createDataFrame([
        (2023, 1, 15, 1, 0, "00-1", None), (2023, 1, 3, 1, 0, "00-1", None), (2023, 1, 40, 1, 0, "00-1", None),
        (2023, 1, 4, 0, 1, None, "00-2"), (2023, 1, 4, 0, 1, None, None),
    ], "season int, week int, yardline_100 int, rush_attempt int, pass_attempt int, rusher_player_id string, receiver_player_id string")
    got = {r.player_id: r for r in marts.pbp_redzone(plays, _xwalk(spark)).collect()}
    assert (got[1].rz_carries, got[1].inside_5_carries, got[1].rz_targets) == (2, 1, 0)
    assert (got[2].rz_targets, got[2].inside_5_targets, got[2].rz_carries) == (1, 1, 0)


def test_identity_pipeline(spark):
    raw = spark.createDataFrame([
        ("s1", "00-1", "", "A", "2026-08-01"), ("s2", "0", "77", "B", "2026-08-01"),
        ("s1", "00-1", "", "A", "2026-09-01"), ("s2", "0", "77", "B", "2026-09-01"),
        ("s3", "00-3", "0", "C", "2026-09-01"), ("s4", "00-1", None, "", "2026-09-01"),
    ], "player_id string, gsis_id string, espn_id string, full_name string, snapshot_date string")
    staged = identity.stage_hub(raw)
    assert staged.filter("sleeper_id = 's4'").count() == 0  # blank name dropped
    latest = identity.latest_snapshot_rows(staged)
    first = staged.filter("snapshot_date = date'2026-08-01'")
    k0 = identity.hub_keys(first)
    k1 = identity.hub_keys(latest, existing=k0)
    assert sorted(map(tuple, k1.collect())) == [(1, "s1"), (2, "s2"), (3, "s3")]
    master = identity.stage_master(spark.createDataFrame(
        [("00-1", "A", None), ("00-5", "E", "P5")], "gsis_id string, display_name string, pfr_id string"))
    mk = identity.master_keys(master, k1, latest)
    assert sorted(map(tuple, mk.collect())) == [(1, "00-1"), (4, "00-5")]  # reuse, then above max(hub)
    xw = {(r.source, r.source_id): r.player_id for r in identity.crosswalk(k1, latest, mk, master).collect()}
    assert xw[("gsis", "00-1")] == 1 and xw[("pfr", "P5")] == 4 and ("espn", "0") not in xw and xw[("espn", "77")] == 2
    dim = {r.player_id: r.full_name for r in identity.dim_players(k1, latest, mk, master, with_timestamps=False).collect()}
    assert dim == {1: "A", 2: "B", 3: "C", 4: "E"}
    # re-run is stable: nothing new to mint
    assert identity.hub_keys(latest, existing=k1).count() == 3


def test_identity_split_is_avoided(spark):
    """A master id minted first and later listed by the hub keeps its id (no second player)."""
    k0 = spark.createDataFrame([(1, "s1")], "player_id long, sleeper_id string")
    mk = spark.createDataFrame([(1, "00-1"), (2, "00-2")], "player_id long, gsis_id string")
    hub = spark.createDataFrame([("s1", "00-1"), ("s2", "00-2"), ("s3", None)], "sleeper_id string, gsis_id string")
    k1 = identity.hub_keys(hub, existing=k0, master_keys=mk)
    assert sorted(map(tuple, k1.collect())) == [(1, "s1"), (2, "s2"), (3, "s3")]


def test_fact_join_chain(spark):
    meta = spark.createDataFrame(list(rules.TEAM_META),
                                 "abbr string, franchise_id int, city string, name string, conference string, division string")
    s = _schedule(spark)
    teams = marts.dim_teams(s, meta)
    games = marts.dim_games(s, teams)
    stats = spark.createDataFrame([
        ("00-1", 2018, 1, "LV", "KC", "WR", 5.0, 60.0, 1.0, None),
        ("00-2", 2018, 1, "KC", "OAK", "RB", 3.0, 20.0, 0.0, 1),
        ("00-9", 2018, 1, "KC", "LV", "RB", 3.0, 20.0, 0.0, None),   # not in the crosswalk -> dropped
        ("00-1", 2018, 2, "LV", "DEN", "WR", 5.0, 60.0, 1.0, None),  # no game that week -> dropped
    ], "player_id string, season int, week int, team string, opponent_team string, position string, "
       "receptions double, receiving_yards double, receiving_tds double, rushing_fumbles_lost long")
    f = {r.player_id: r for r in marts.fct_player_game_stats(stats, _xwalk(spark), teams, games,
                                                             ingested_at="2026-01-01 00:00:00").collect()}
    assert set(f) == {1, 2}
    assert f[1].game_id == "2018_01_OAK_KC" and f[1].team_id == 201819 and f[1].opponent_id == 201816
    assert f[2].opponent_id == 201819 and f[2].fumbles_lost == 1 and f[1].fumbles_lost == 0
    assert f[1].rec_yards == 60 and f[1].pass_epa is None


def test_fact_rows_stay_where_the_weeks_were_joined(spark):
    """A game of one week is deduplicated without another shuffle of the fact; one listed in two weeks still gives a row a player."""
    stats = spark.createDataFrame([("00-1", 2018, w, "LV", "KC", "WR", float(w)) for w in (1, 2, 1)] + [("00-2", 2018, 2, "KC", "LV", "RB", 3.0)],
                                  "player_id string, season int, week int, team string, opponent_team string, position string, receptions double")
    teams = spark.createDataFrame([(2018, "LV", 1), (2018, "KC", 2)], "season int, abbr string, team_id int")
    snaps = spark.createDataFrame([(1, 2018, 1, 9, None), (1, 2018, 2, 8, None)],
                                  "player_id long, season int, week int, offensive_snaps int, offensive_snap_pct decimal(5,2)")

    def fact(*games):
        listed = spark.createDataFrame(list(games), "season int, week int, game_id string, home_team_id int, away_team_id int")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            out = marts.fct_player_game_stats(stats, _xwalk(spark), teams, listed, snaps=snaps, ingested_at="2026-01-01 00:00:00")
            rows = sorted((r.player_id, r.game_id, r.week, r.offensive_snaps) for r in out.collect())
            return rows, out._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

    rows, plan = fact((2018, 1, "a", 1, 2), (2018, 2, "b", 1, 2))
    assert rows == [(1, "a", 1, 9), (1, "b", 2, 8), (2, "b", 2, None)]
    deals = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert deals and not any("game_id" in line for line in deals)
    rows, plan = fact((2018, 1, "a", 1, 2), (2018, 2, "a", 1, 2))
    assert rows == [(1, "a", 1, 9), (2, "a", 2, None)]
    assert any("game_id" in line for line in plan.splitlines() if "Exchange hashpartitioning(" in line)
