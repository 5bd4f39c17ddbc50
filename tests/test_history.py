"""As-of reads, stints, version differences, waiver trends, boards of many leagues."""

import datetime as dt
import random

import pytest

from touchline.operators.asof import asof_join, stints
from touchline.plans import board, history
from touchline.plans.board_leagues import league_boards, league_starters


@pytest.mark.parametrize("strict", [False, True])
def test_asof_like_a_plain_search(spark, strict):
    rnd = random.Random(4)
    keys = ["hot"] * 8 + ["a", "b", None]
    left = [(i, rnd.choice(keys), rnd.choice([None, *range(40)])) for i in range(500)]
    right = [(rnd.choice(keys[:9]), rnd.choice([None, *range(0, 40, 3)]), rnd.randrange(5), f"v{i}") for i in range(120)]
    right += [("hot", 12, 9, "last")]
    out = asof_join(spark.createDataFrame(left, "id int, k string, t int"), spark.createDataFrame(right, "k string, at int, rank int, value string"),
                    ["k"], "t", "at", ["at", "value"], ["rank", "value"], strict, num_partitions=7).collect()

    def plain(k, t):
        fits = [r for r in right if k is not None and t is not None and r[0] == k and r[1] is not None and (r[1] < t or (r[1] == t and not strict))]
        best = max(fits, key=lambda r: (r[1], r[2], r[3]), default=None)
        return (best[1], best[3]) if best else (None, None)

    assert sorted((r["id"], r["at"], r["value"]) for r in out) == [(i, *plain(k, t)) for i, k, t in left]


def test_a_key_that_spans_partitions_carries_on(spark):
    left = spark.createDataFrame([(i, "hot", i) for i in range(300)], "id int, k string, t int")
    right = spark.createDataFrame([("hot", 3, "only")], "k string, at int, value string")
    out = {r["id"]: r["value"] for r in asof_join(left, right, ["k"], "t", "at", ["value"], num_partitions=12).collect()}
    assert out == {i: "only" if i >= 3 else None for i in range(300)}
    assert asof_join(left, right.where("false"), ["k"], "t", "at", ["value"]).where("value is not null").count() == 0
    assert asof_join(left.where("false"), right, ["k"], "t", "at", ["value"]).collect() == []


def test_stints_and_the_team_at_a_game(spark):
    rows = [("p", 2024, w, t, w, f"d{w}") for w, t in ((1, 10), (2, 10), (5, 11), (6, 10), (9, 10))] + [("q", 2024, 3, 12, 1, "x"), ("q", 2024, 4, None, 1, "x")]
    rosters = spark.createDataFrame(rows, "player_id string, season int, week int, team_id int, jersey_number int, depth_chart_pos string")
    found = history.player_team_history(rosters)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [("p", 10, 2024, 1, 2, 2, "d2"), ("p", 11, 2024, 5, 5, 5, "d5"), ("p", 10, 2024, 6, None, 9, "d9"), ("q", 12, 2024, 3, None, 1, "x")], key=str)
    games = spark.createDataFrame([("p", 2024, w) for w in (1, 4, 5, 18)] + [("q", 2024, 2), ("p", 2023, 5)], "player_id string, season int, week int")
    at = {(r["player_id"], r["season"], r["week"]): r["team_id"] for r in history.team_at(games, found).collect()}
    assert at == {("p", 2024, 1): 10, ("p", 2024, 4): 10, ("p", 2024, 5): 11, ("p", 2024, 18): 10, ("q", 2024, 2): None, ("p", 2023, 5): None}
    nulls = spark.createDataFrame([(1, 1, None), (1, 2, None), (1, 3, "a")], "k int, t int, v string")
    assert sorted((r["v"], r["begin"], r["end"]) for r in stints(nulls, ["k"], "t", "v").collect() if r["v"]) == [("a", 3, None)]
    assert [(r["begin"], r["end"]) for r in stints(nulls, ["k"], "t", "v").collect() if r["v"] is None] == [(1, 2)]


@pytest.mark.parametrize("refresh", [False, True])
def test_version_changes(spark, refresh):
    t0, t1 = dt.datetime(2026, 1, 1), dt.datetime(2026, 2, 1)
    prev = spark.createDataFrame([(1, "a", None, t0, t0), (2, "b", 2.0, t0, t0), (3, "c", 3.0, t0, t0), (4, "d", None, t0, t0)],
                                 "k int, name string, v double, created_at timestamp_ntz, updated_at timestamp_ntz")
    cur = spark.createDataFrame([(1, "a", None), (2, "b", None), (3, "C", 3.5), (5, "e", 5.0)], "k int, name string, v double")
    out = {r["k"]: r for r in history.version_changes(prev, cur, ["k"], "2026-02-01 00:00:00", refresh).collect()}
    assert {k: r["change"] for k, r in out.items()} == {1: "same", 2: "changed", 3: "changed", 4: "gone", 5: "added"}
    assert out[2]["changed"] == ["v"] and out[3]["changed"] == ["name", "v"] and out[1]["changed"] is None and out[4]["name"] == "d"
    assert [out[k]["created_at"] for k in (1, 2, 4, 5)] == [t0, t0, t0, t1]
    assert [out[k]["updated_at"] for k in (1, 2, 4, 5)] == [t1 if refresh else t0, t1, t0, t1]


def test_trend_counts_weeks_not_games(spark):
    rows = [("p", 2024, w, "RB", 1, u, 10) for w, u in ((1, 2), (2, 4), (9, 20))] + [("q", 2024, 9, "RB", 2, 5, 30)]
    games = spark.createDataFrame(rows, "player_id string, season int, week int, position string, opponent_id int, touches int, points int")
    out = {(r["player_id"], r["week"]): r for r in history.waiver_trends(games, ["touches"], "points", 24).collect()}
    last = out["p", 9]
    assert last["recent"] == 20.0 and last["earlier"] == 3.0 and last["trend"] == 17.0  # weeks 7 to 9, and 1 to 6
    assert out["p", 2]["recent"] == 3.0 and out["p", 2]["earlier"] is None and out["p", 2]["trend"] == 0.0
    assert last["matchup"] == pytest.approx(10 / 15) and last["claim"] == pytest.approx(37 * 10 / 15)


def test_boards_of_many_leagues_like_one_after_the_other(spark):
    rnd = random.Random(5)
    leagues = {
        "flex": {"roster": {"RB": 1, "WR": 1, "FLEX": 1}, "teams": 1}, "dry": {"roster": {"RB": 1, "FLEX": 3}, "teams": 1},
        "super": {"roster": {"QB": 1, "RB": 1, "SUPERFLEX": 1}, "teams": 2},
        "chain": {"roster": {"QB": 1, "RB": 1, "WR": 1, "TE": 1, "WRT": 2, "REC_FLEX": 1, "QFLEX": 1}, "teams": 3},
    }
    rows = []
    for name in leagues:
        n = {"QB": 9, "RB": 1 if name == "dry" else 20, "WR": 0 if name == "dry" else 24, "TE": 0 if name == "dry" else 8}
        rows += [(name, 100 * i + k, p, float(rnd.randrange(0, 60) * 5), 0.0, 0.0) for i, (p, c) in enumerate(n.items()) for k in range(c)]
    players = spark.createDataFrame(rows, "league string, player_id int, position string, points double, floor double, ceiling double")
    got = {}
    for r in league_starters(spark, players, leagues).collect():
        got.setdefault(r["league"], {})[r["position"]] = r["starters"]
    boards = {}
    for r in league_boards(spark, players, leagues).collect():
        boards.setdefault(r["league"], []).append((r["player_id"], r["vor"], r["overall_rank"], r["position_rank"], r["tier"], r["starter"]))
    assert got["dry"] == {"QB": 0, "RB": 1, "WR": 0, "TE": 0}
    for name, of in leagues.items():
        own = players.where(f"league = '{name}'").drop("league")
        assert got[name] == {r["position"]: r["starters"] for r in board.starter_counts(spark, own, of["roster"], of["teams"]).collect()}
        one = board.build_board(spark, own, of["roster"], of["teams"]).collect()
        assert sorted(boards[name]) == sorted((r["player_id"], r["vor"], r["overall_rank"], r["position_rank"], r["tier"], r["starter"]) for r in one)
