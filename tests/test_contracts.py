"""Contracts of all mart tables: defaults, required columns, and every kind of violation in one pass."""

import datetime as dt
import decimal

import pytest

from touchline.sources.contracts import CONTRACTS, Reference, contract, empty_shell, enforce, violations


def test_all_tables_have_a_contract(spark):
    assert len(CONTRACTS) == 13 and all(c.key for c in CONTRACTS.values())
    widths = {"fct_player_game_stats": 42, "fct_team_game_stats": 20, "dim_players": 16, "fct_projections": 16, "scoring_settings": 15}
    assert {n: len(CONTRACTS[n].schema) for n in widths} == widths
    assert CONTRACTS["fct_projections"].schema["projected_points"].dataType.simpleString() == "decimal(5,2)"
    assert "full_name" in CONTRACTS["dim_players"].required and "player_id" in CONTRACTS["dim_players"].required
    for c in CONTRACTS.values():
        assert empty_shell(spark, c.schema).columns == c.schema.names
        assert all(r.parent in CONTRACTS and set(r.parent_columns) <= set(CONTRACTS[r.parent].schema.names) for r in c.references)


def test_defaults_stand_in_for_absent_columns_only(spark):
    rows = spark.createDataFrame([("half_ppr", 0.5, None)], "scoring_format string, rec_pts double, te_premium double")
    got = enforce(rows, CONTRACTS["scoring_settings"]).first()
    assert got["rec_pts"] == decimal.Decimal("0.5") and got["pass_yard_pts"] == decimal.Decimal("0.040") and got["te_premium"] is None
    player = enforce(spark.createDataFrame([(1, "A B", "7")], "player_id long, full_name string, draft_pick string"),
                     CONTRACTS["dim_players"], now="2026-09-01 10:00:00").first()
    assert player["created_at"] == dt.datetime(2026, 9, 1, 10) and player["draft_pick"] == 7 and player["college"] is None


def test_required_columns_raise(spark):
    rows = spark.createDataFrame([(1, "A"), (2, None)], "player_id int, full_name string")
    with pytest.raises(Exception, match="dim_players.full_name is required"):
        enforce(rows, CONTRACTS["dim_players"]).collect()
    with pytest.raises(Exception, match="player_id_crosswalk.source_id is required"):
        enforce(spark.createDataFrame([(1, "pfr")], "player_id int, source string"), CONTRACTS["player_id_crosswalk"]).collect()


def test_every_violation_is_found_once(spark):
    teams = spark.createDataFrame([(1, 9, 2023, "KC"), (1, 9, 2024, "KC"), (2, None, 2023, "KC"), (3, 8, None, "LV"), (None, 9, 2025, "LV")],
                                  "team_id int, franchise_id int, season int, abbr string")
    franchises = spark.createDataFrame([(9, "Chiefs"), (7, "Bears")], "franchise_id int, canonical_name string")
    games = spark.createDataFrame([("g1", 2023, 1, 1, 2), ("g2", 2023, 1, 4, 4), ("g3", 2023, 1, None, 5)],
                                  "game_id string, season int, week int, home_team_id int, away_team_id int")
    tables = {"dim_teams": teams, "dim_franchises": franchises, "dim_games": games}
    got = sorted(map(str, map(tuple, violations(tables, CONTRACTS).collect())))
    assert got == sorted(map(str, [
        ("dim_teams", "unique", "team_id", "1", 2), ("dim_teams", "required", "team_id", None, 1), ("dim_teams", "required", "season", None, 1),
        ("dim_teams", "unique", "season,abbr", "4:2023 2:KC ", 2), ("dim_teams", "refers", "franchise_id", "8", 1),
        ("dim_games", "refers", "home_team_id", "4", 1), ("dim_games", "refers", "away_team_id", "4", 1), ("dim_games", "refers", "away_team_id", "5", 1)]))
    alone = violations({"dim_games": games}, CONTRACTS)
    assert alone.collect() == []  # no parent given: not checked
    assert violations({n: t.where("false") for n, t in tables.items()}, CONTRACTS).collect() == []


def test_keys_that_join_alike_stay_apart(spark):
    pair = contract("t", "a string, b string", ("a", "b"), references=(Reference(("a", "b"), "t", ("b", "a")),))
    rows = spark.createDataFrame([("x y", "z"), ("x", "y z"), ("", "q"), ("q", "")], "a string, b string")
    got = [(r["kind"], r["n"]) for r in violations({"t": rows}, {"t": pair}).collect()]
    assert got == [("refers", 1), ("refers", 1)]


def test_whole_number_keys_are_grouped_as_numbers(spark):
    of = {"p": contract("p", "a bigint, b int", ("a", "b")),
          "c": contract("c", "k bigint, a int, b int, t string", ("k",), (("a", "b", "k"), ("t",)),
                        (Reference(("a", "b"), "p", ("a", "b")), Reference(("t",), "p", ("a",))))}
    parents = spark.createDataFrame([(1, 2), (12, 3), (None, 5), (7, 7), (7, 7)], "a bigint, b int")
    children = spark.createDataFrame([(1, 1, 2, "12"), (2, 11, 2, "13"), (2, 11, 2, None), (3, None, 5, "7"), (4, 12, 3, "07")], "k bigint, a int, b int, t string")
    got = violations({"p": parents, "c": children}, of)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [
        ("p", "required", "a", None, 1), ("p", "unique", "a,b", "1:7 1:7 ", 2), ("c", "unique", "k", "2", 2), ("c", "unique", "a,b,k", "2:11 1:2 1:2 ", 2),
        ("c", "refers", "a,b", "2:11 1:2 ", 2), ("c", "refers", "t", "13", 1), ("c", "refers", "t", "07", 1)]))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    scan = plan[plan.index("Aggregate"):]  # what every row goes through
    assert "lambda" not in scan and "concat(" not in scan and "cast(k#" not in scan
