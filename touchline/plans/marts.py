"""Dimensions, facts and staging over feed-shaped inputs (DOM-19..DOM-22, JOI-1..6).

Inputs carry the feed column names (schedules, weekly player stats, snap
counts, next-gen receiving/rushing, play-by-play).  Any feed column a mart
needs but a feed lacks is read as NULL (drift-safe select), as the
reference's ``union_by_name`` reads do.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.scalars import (
    canonical_code, kickoff_timestamp, null_safe_sum, remap_value, season_type, try_date,
    try_int_from_double, try_int_from_text,
)
from touchline.operators.joins import bounded_broadcast
from touchline.operators.keys import keep_first
from touchline.operators.setops import both_sides
from touchline.session import cut_lineage
from touchline.sources import rules


def col_or_null(df: DataFrame, name: str, dtype: str = "string") -> Column:
    """A feed column if present, else a typed NULL (schema drift: missing -> NULL)."""
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


# ---------------------------------------------------------------------------
# Dimensions
# ---------------------------------------------------------------------------

def dim_franchises(franchises: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """SRC-7 + SNK-4 + JOI-8: the franchise list; on re-runs only unseen ids are emitted."""
    out = franchises.select(F.col("franchise_id").cast("int"), "canonical_name")
    if existing is not None:
        out = out.join(existing.select("franchise_id"), "franchise_id", "left_anti")
    return out


def dim_teams(schedule: DataFrame, team_meta: DataFrame, aliases: Mapping[str, str] | None = None,
              existing: DataFrame | None = None) -> DataFrame:
    """SET-2 + AGG-7 + SCA-1 + SCA-12: one row per team per season.

    The (season, code) pairs come from both sides of every game (one scan,
    exploded), canonicalised and de-duplicated; metadata is a literal table.
    team_id = season*100 + franchise_id.  With ``existing``, only new ids.
    """
    sides = both_sides(schedule, ["season"], {"home": "home_team", "away": "away_team"},
                       out="team", side_col=None)
    season_teams = sides.select("season", canonical_code(F.col("team"), aliases).alias("abbr")).distinct()
    out = season_teams.join(F.broadcast(team_meta), "abbr").select(
        (F.col("season") * 100 + F.col("franchise_id")).cast("int").alias("team_id"),
        F.col("franchise_id").cast("int").alias("franchise_id"),
        F.col("season").cast("int").alias("season"),
        "abbr", "city", "name", "conference", "division",
    )
    if existing is not None:
        out = out.join(existing.select("team_id"), "team_id", "left_anti")
    return out


def dim_games(schedule: DataFrame, teams: DataFrame, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """JOI-4 + SCA-3/4/9 + PRJ-2: one row per game; home/away resolved by two aliased
    left joins to the team dimension on (season, canonical code)."""
    t = teams.select("season", "abbr", "team_id")
    h = t.select(F.col("season").alias("h_season"), F.col("abbr").alias("h_abbr"), F.col("team_id").alias("home_team_id"))
    a = t.select(F.col("season").alias("a_season"), F.col("abbr").alias("a_abbr"), F.col("team_id").alias("away_team_id"))
    s = schedule.withColumn("_home", canonical_code(F.col("home_team"), aliases)) \
                .withColumn("_away", canonical_code(F.col("away_team"), aliases))
    j = (s.join(h, (F.col("h_season") == F.col("season")) & (F.col("h_abbr") == F.col("_home")), "left")
          .join(a, (F.col("a_season") == F.col("season")) & (F.col("a_abbr") == F.col("_away")), "left"))
    return j.select(
        F.col("game_id").cast("string").alias("game_id"),
        F.col("season").cast("int").alias("season"),
        F.col("week").cast("int").alias("week"),
        season_type(F.col("game_type")).alias("season_type"),
        try_date("gameday").alias("game_date"),
        kickoff_timestamp(F.col("gameday"), F.col("gametime")).alias("kickoff_time"),
        "home_team_id", "away_team_id",
        try_int_from_double(F.col("home_score")).alias("home_score"),
        try_int_from_double(F.col("away_score")).alias("away_score"),
        col_or_null(j, "stadium").alias("stadium"),
        col_or_null(j, "surface").alias("surface"),
        col_or_null(j, "roof").alias("roof"),
        (try_int_from_text("temp") if "temp" in j.columns else F.lit(None).cast("int")).alias("weather_temp_f"),
        (try_int_from_text("wind") if "wind" in j.columns else F.lit(None).cast("int")).alias("weather_wind_mph"),
        F.lit(None).cast("string").alias("weather_desc"),
    )


def team_games(games: DataFrame) -> DataFrame:
    """SET-2: (season, week, team_id) -> game_id from both sides of every game."""
    return both_sides(games, ["season", "week", "game_id"],
                      {"home": "home_team_id", "away": "away_team_id"}, out="team_id", side_col="side")


def vegas_closing_lines(schedule: DataFrame) -> DataFrame:
    """DOM-22 + FLT-5 + SCA-9 + SCA-13: one closing snapshot per game at kickoff.

    spread_home is the negated home-perspective line; implied totals split the
    total by the spread.  Games without a date or without both lines are dropped.
    """
    lines = schedule.filter(F.col("gameday").isNotNull()
                            & (F.col("spread_line").isNotNull() | F.col("total_line").isNotNull()))
    lines = lines.select(
        F.col("game_id").cast("string").alias("game_id"),
        kickoff_timestamp(F.col("gameday"), F.col("gametime")).alias("snapshot_at"),
        (-F.col("spread_line")).cast("decimal(4,1)").alias("spread_home"),
        F.col("spread_line").cast("decimal(4,1)").alias("spread_away"),
        F.col("total_line").cast("decimal(4,1)").alias("total"),
        F.col("home_moneyline").cast("int").alias("home_moneyline"),
        F.col("away_moneyline").cast("int").alias("away_moneyline"),
    ).filter(F.col("snapshot_at").isNotNull())
    half = F.lit(2.0)
    return lines.select(
        "game_id", "snapshot_at", F.lit(rules.CLOSING_BOOK).alias("sportsbook"),
        "spread_home", "spread_away", "total", "home_moneyline", "away_moneyline",
        (F.col("total") / half - F.col("spread_home") / half).cast("decimal(4,1)").alias("home_implied_total"),
        (F.col("total") / half + F.col("spread_home") / half).cast("decimal(4,1)").alias("away_implied_total"),
    )


# ---------------------------------------------------------------------------
# Intermediates joined into the per-game fact
# ---------------------------------------------------------------------------

def _xwalk(crosswalk: DataFrame, source: str, key: str) -> DataFrame:
    return crosswalk.filter(F.col("source") == source).select(
        F.col("source_id").alias(key), F.col("player_id").cast("long").alias("player_id"))


def snap_counts(snaps: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """AGG-1 + JOI-1 + FLT-4: weekly offensive snaps (sum) and share (max) per player."""
    x = _xwalk(crosswalk, "pfr", "pfr_player_id")
    s = snaps.filter(F.col("season").isNotNull() & F.col("week").isNotNull()).join(x, "pfr_player_id")
    return s.groupBy("player_id", F.col("season").cast("int").alias("season"),
                     F.col("week").cast("int").alias("week")).agg(
        F.sum("offense_snaps").cast("int").alias("offensive_snaps"),
        F.max("offense_pct").cast("decimal(5,2)").alias("offensive_snap_pct"))


def ngs_player_week(receiving: DataFrame, rushing: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """JOI-6 + SCA-2: full outer join of receiving and rushing tracking stats on
    (gsis, season, week), with the final week renumbered 23 -> 22."""
    rec = receiving.select(F.col("player_gsis_id").alias("gsis"), "season",
                           remap_value("week", 23, 22).alias("week"), "avg_separation", "avg_cushion")
    rush = rushing.select(F.col("player_gsis_id").alias("gsis"), "season",
                          remap_value("week", 23, 22).alias("week"), "rush_yards_over_expected")
    c = rec.join(rush, ["gsis", "season", "week"], "full_outer")  # named keys coalesce themselves
    x = _xwalk(crosswalk, "gsis", "gsis")
    return c.join(x, "gsis").select(
        "player_id", F.col("season").cast("int").alias("season"), F.col("week").cast("int").alias("week"),
        F.col("avg_separation").cast("decimal(4,2)").alias("avg_separation"),
        F.col("avg_cushion").cast("decimal(4,2)").alias("avg_cushion"),
        F.col("rush_yards_over_expected").cast("decimal(6,2)").alias("rush_yards_over_expected"))


def pbp_redzone(plays: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """PRJ-3 + AGG-2 + JOI-6: red-zone (<= 20) and inside-5 carries/targets per player-week.

    Each play is exploded into its touches and grouped once, which gives what a full outer
    join of carries and targets would; the scan reads the seven columns selected.
    """
    p = plays.select("season", "week", "yardline_100", "rush_attempt", "pass_attempt",
                     "rusher_player_id", "receiver_player_id")
    touches = F.array(*[F.struct(F.lit(role).alias("role"), F.when(F.col(flag) == 1, F.col(who)).alias("gsis"))
                        for role, flag, who in (("carries", "rush_attempt", "rusher_player_id"),
                                                ("targets", "pass_attempt", "receiver_player_id"))])
    t = (p.select("season", "week", "yardline_100", F.explode(touches).alias("t"))
         .select("season", "week", "yardline_100", "t.role", "t.gsis").filter(F.col("gsis").isNotNull()))
    c = t.groupBy("gsis", "season", "week").agg(
        *[F.count_if((F.col("role") == role) & (F.col("yardline_100") <= near)).alias(f"{name}_{role}")
          for role in ("carries", "targets") for name, near in (("rz", 20), ("inside_5", 5))])
    x = _xwalk(crosswalk, "gsis", "gsis")
    return c.join(x, "gsis").select(
        "player_id", F.col("season").cast("int").alias("season"), F.col("week").cast("int").alias("week"),
        *[F.coalesce(F.col(k), F.lit(0)).cast("int").alias(k)
          for k in ("rz_carries", "rz_targets", "inside_5_carries", "inside_5_targets")])


# ---------------------------------------------------------------------------
# The per-game fact
# ---------------------------------------------------------------------------

# FIXED VALUES — weekly-stats feed column -> (fact column, cast), the fact's naming contract.
FACT_STAT_COLUMNS = (
    ("attempts", "pass_attempts", "int"),
    ("completions", "pass_completions", "int"),
    ("passing_yards", "pass_yards", "int"),
    ("passing_tds", "pass_tds", "int"),
    ("passing_interceptions", "interceptions", "int"),
    ("sacks_suffered", "sacks_taken", "int"),
    ("passing_air_yards", "pass_air_yards", "int"),
    ("passing_epa", "pass_epa", "decimal(7,3)"),
    ("passing_cpoe", "cpoe", "decimal(5,2)"),
    ("carries", "rush_attempts", "int"),
    ("rushing_yards", "rush_yards", "int"),
    ("rushing_tds", "rush_tds", "int"),
    ("targets", "targets", "int"),
    ("receptions", "receptions", "int"),
    ("receiving_yards", "rec_yards", "int"),
    ("receiving_tds", "rec_tds", "int"),
    ("receiving_air_yards", "air_yards", "int"),
    ("receiving_yards_after_catch", "yac", "int"),
    ("target_share", "target_share", "decimal(5,2)"),
    ("air_yards_share", "air_yards_share", "decimal(5,2)"),
)


#: Rows of a team or schedule side that are broadcast to the fact (some 60 bytes each).
MOST_SIDES = 500_000


def fct_player_game_stats(stats: DataFrame, crosswalk: DataFrame, teams: DataFrame, games: DataFrame,
                          snaps: DataFrame | None = None, ngs: DataFrame | None = None,
                          redzone: DataFrame | None = None, aliases: Mapping[str, str] | None = None,
                          ingested_at: str | None = None) -> DataFrame:
    """JOI-1..5 + PRJ-1/2 + SCA-8 + WIN-4: one row per (player, game).

    gsis -> internal id (inner, unresolved dropped); (season, canonical team) ->
    team_id (inner); (season, week, team_id) -> game_id from both sides of each
    game (inner); opponent by a second, left join to the team dimension; usage
    intermediates by left joins on (player_id, season, week).  Duplicates per
    (player, game) keep one row by a total order.
    """
    ps = stats.filter(F.col("player_id").isNotNull()).withColumnRenamed("player_id", "gsis_id")
    x = _xwalk(crosswalk, "gsis", "gsis_id")
    # a row a team and season, and two a game: written once, and broadcast if they are as few as they should be
    t, _ = bounded_broadcast(cut_lineage(teams.select("season", "abbr", "team_id")), MOST_SIDES)
    sides = cut_lineage(team_games(games).select("season", "week", "team_id", "game_id"))
    tg, _ = bounded_broadcast(sides, MOST_SIDES)
    j = (ps.join(x, "gsis_id")
         .withColumn("_team", canonical_code(F.col("team"), aliases))
         .withColumn("_opp", canonical_code(F.col("opponent_team"), aliases)))
    j = j.join(t.select("season", F.col("abbr").alias("_team"), "team_id"), ["season", "_team"], "inner")
    j = j.join(tg, ["season", "week", "team_id"], "inner")
    opp = t.select("season", F.col("abbr").alias("_opp"), F.col("team_id").alias("opponent_id"))  # keeps the hint
    j = j.join(opp, ["season", "_opp"], "left")
    keys = ["player_id", "season", "week"]
    for extra in (snaps, ngs, redzone):
        if extra is not None:
            j = j.join(extra, keys, "left")
    ts = F.lit(ingested_at).cast("timestamp") if ingested_at else F.current_timestamp()
    cols = [
        F.col("player_id").cast("long").alias("player_id"), F.col("game_id"),
        F.col("season").cast("int").alias("season"), F.col("week").cast("int").alias("week"),
        F.col("team_id"), F.col("opponent_id"), F.col("position"),
        col_or_null(j, "offensive_snaps", "int").alias("offensive_snaps"),
        col_or_null(j, "offensive_snap_pct", "decimal(5,2)").alias("offensive_snap_pct"),
        F.lit(None).cast("int").alias("routes_run"),
    ]
    for src, dst, typ in FACT_STAT_COLUMNS:
        cols.append(_typed(col_or_null(j, src, "double"), typ, j, src).alias(dst))
    cols += [
        F.lit(None).cast("decimal(6,2)").alias("rush_yards_before_contact"),
        col_or_null(j, "rush_yards_over_expected", "decimal(6,2)").alias("rush_yards_over_expected"),
        col_or_null(j, "avg_separation", "decimal(4,2)").alias("avg_separation"),
        col_or_null(j, "avg_cushion", "decimal(4,2)").alias("avg_cushion"),
        col_or_null(j, "rz_carries", "int").alias("rz_carries"),
        col_or_null(j, "rz_targets", "int").alias("rz_targets"),
        col_or_null(j, "inside_5_carries", "int").alias("inside_5_carries"),
        col_or_null(j, "inside_5_targets", "int").alias("inside_5_targets"),
        null_safe_sum(*[col_or_null(j, c, "long") for c in ("sack_fumbles", "rushing_fumbles", "receiving_fumbles")]).cast("int").alias("fumbles"),
        null_safe_sum(*[col_or_null(j, c, "long") for c in ("sack_fumbles_lost", "rushing_fumbles_lost", "receiving_fumbles_lost")]).cast("int").alias("fumbles_lost"),
        null_safe_sum(*[col_or_null(j, c, "long") for c in ("passing_2pt_conversions", "rushing_2pt_conversions", "receiving_2pt_conversions")]).cast("int").alias("two_pt_conversions"),
        ts.alias("ingested_at"),
    ]
    out = j.select(*cols)
    # a game of one week, as they should be: its rows are where the joins by player and week have put them
    weeks = sides.groupBy("game_id").agg(F.count_distinct(F.struct("season", "week")).alias("n"))
    key = ["player_id", "game_id"] if weeks.where("n > 1").limit(1).count() else [*keys, "game_id"]
    return keep_first(out, key, [F.col("season"), F.col("week"), F.col("team_id")])


# ---------------------------------------------------------------------------
# Play-by-play slice (PRJ-1)
# ---------------------------------------------------------------------------

# FIXED VALUES — the play-by-play slice: (output column, source column, cast or None).
PBP_SLICE = (
    ("game_id", "game_id", None), ("play_id", "play_id", "long"), ("season", "season", "int"),
    ("week", "week", "int"), ("season_type", "season_type", None), ("posteam", "posteam", None),
    ("defteam", "defteam", None), ("home_team", "home_team", None), ("away_team", "away_team", None),
    ("qtr", "qtr", "int"), ("down", "down", "int"), ("ydstogo", "ydstogo", "int"),
    ("goal_to_go", "goal_to_go", "boolean"), ("yardline_100", "yardline_100", "int"),
    ("half_seconds_remaining", "half_seconds_remaining", "int"),
    ("game_seconds_remaining", "game_seconds_remaining", "int"), ("drive", "drive", "int"),
    ("series", "series", "int"), ("posteam_score", "posteam_score", "int"),
    ("defteam_score", "defteam_score", "int"), ("score_differential", "score_differential", "int"),
    ("play_type", "play_type", None), ("play_desc", "desc", None), ("yards_gained", "yards_gained", "int"),
    ("shotgun", "shotgun", "boolean"), ("no_huddle", "no_huddle", "boolean"),
    ("qb_dropback", "qb_dropback", "boolean"), ("qb_scramble", "qb_scramble", "boolean"),
    ("air_yards", "air_yards", "int"), ("yards_after_catch", "yards_after_catch", "int"),
    ("passer_player_id", "passer_player_id", None), ("passer_player_name", "passer_player_name", None),
    ("rusher_player_id", "rusher_player_id", None), ("rusher_player_name", "rusher_player_name", None),
    ("receiver_player_id", "receiver_player_id", None), ("receiver_player_name", "receiver_player_name", None),
    ("td_player_id", "td_player_id", None), ("td_player_name", "td_player_name", None),
    ("pass_attempt", "pass_attempt", "boolean"), ("rush_attempt", "rush_attempt", "boolean"),
    ("complete_pass", "complete_pass", "boolean"), ("incomplete_pass", "incomplete_pass", "boolean"),
    ("interception", "interception", "boolean"), ("sack", "sack", "boolean"), ("fumble", "fumble", "boolean"),
    ("fumble_lost", "fumble_lost", "boolean"), ("touchdown", "touchdown", "boolean"),
    ("pass_touchdown", "pass_touchdown", "boolean"), ("rush_touchdown", "rush_touchdown", "boolean"),
    ("return_touchdown", "return_touchdown", "boolean"), ("two_point_attempt", "two_point_attempt", "boolean"),
    ("field_goal_attempt", "field_goal_attempt", "boolean"),
    ("extra_point_attempt", "extra_point_attempt", "boolean"), ("kickoff_attempt", "kickoff_attempt", "boolean"),
    ("punt_attempt", "punt_attempt", "boolean"), ("penalty", "penalty", "boolean"),
    ("first_down", "first_down", "boolean"), ("ep", "ep", "double"), ("epa", "epa", "double"),
    ("wp", "wp", "double"), ("wpa", "wpa", "double"), ("cp", "cp", "double"), ("cpoe", "cpoe", "double"),
)


def _typed(value, typ: str, df: DataFrame, src: str):
    """D1: a whole number from a fractional source column is rounded half-even; any other cast is strict."""
    if typ in ("int", "long") and src in df.columns and isinstance(df.schema[src].dataType, (T.DoubleType, T.FloatType)):
        return F.bround(F.col(src).cast("double"), 0).cast(typ)
    return value.cast(typ)


def project_spec(df: DataFrame, spec: Sequence[tuple[str, str, str | None]]) -> DataFrame:
    """PRJ-1: rename + strict cast from a spec table; missing source columns -> NULL."""
    cols = []
    for out, src, typ in spec:
        c = col_or_null(df, src, typ or "string")
        cols.append((_typed(c, typ, df, src) if typ else c).alias(out))
    return df.select(*cols)


def fct_pbp(pbp: DataFrame) -> DataFrame:
    """PRJ-1 + FLT-4: the typed 63-column play slice keyed on (game_id, play_id)."""
    return project_spec(pbp, PBP_SLICE).filter(F.col("game_id").isNotNull() & F.col("play_id").isNotNull())


def fct_team_game_stats(pbp_slice: DataFrame, teams: DataFrame, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Extension (declared but never built by the reference): per (team, game) offence
    from the play slice, self-joined to the opponent's row for what was allowed."""
    p = pbp_slice.filter(F.col("posteam").isNotNull())
    off = p.groupBy("game_id", "season", "week", canonical_code(F.col("posteam"), aliases).alias("team"),
                    canonical_code(F.col("defteam"), aliases).alias("opp")).agg(
        F.count(F.lit(1)).cast("int").alias("plays"),
        F.sum(F.coalesce("yards_gained", F.lit(0))).cast("int").alias("total_yards"),
        F.sum(F.when(F.col("pass_attempt"), F.coalesce("yards_gained", F.lit(0)))).cast("int").alias("pass_yards"),
        F.sum(F.when(F.col("rush_attempt"), F.coalesce("yards_gained", F.lit(0)))).cast("int").alias("rush_yards"),
        F.count_if(F.col("pass_attempt")).alias("_passes"),
        F.max("posteam_score").cast("int").alias("points"),
        F.first(F.col("home_team") == F.col("posteam"), ignorenulls=True).alias("is_home"),
    )
    allowed = off.select("game_id", F.col("team").alias("opp"),
                         F.col("points").alias("points_allowed"), F.col("total_yards").alias("yards_allowed"),
                         F.col("pass_yards").alias("pass_yards_allowed"), F.col("rush_yards").alias("rush_yards_allowed"))
    j = off.join(allowed, ["game_id", "opp"], "left")
    t = teams.select("season", "abbr", "team_id")
    j = j.join(t.select("season", F.col("abbr").alias("team"), "team_id"), ["season", "team"], "left")
    o = t.select("season", F.col("abbr").alias("opp"), F.col("team_id").alias("opponent_id"))
    j = j.join(o, ["season", "opp"], "left")
    return j.select(
        "team_id", "game_id", F.col("season").cast("int"), F.col("week").cast("int"), "opponent_id",
        "is_home", "points", "total_yards", "pass_yards", "rush_yards", "plays",
        F.lit(None).cast("decimal(4,2)").alias("seconds_per_play"),
        F.try_divide(F.col("_passes").cast("double"), F.col("plays")).cast("decimal(5,2)").alias("pass_rate"),
        F.lit(None).cast("decimal(5,2)").alias("pace_neutral"),
        "points_allowed", "yards_allowed", "pass_yards_allowed", "rush_yards_allowed",
        F.lit(None).cast("int").alias("sacks"), F.lit(None).cast("int").alias("interceptions"))
