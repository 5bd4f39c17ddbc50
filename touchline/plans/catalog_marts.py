"""Registered identity and mart queries over the graded tables (see plans/feeds.py)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.plans import binding, feeds, identity, marts
from touchline.plans import oracle as O
from touchline.plans.catalog import register
from touchline.session import cut_lineage
from touchline.sources.contracts import CONTRACTS

INGESTED_AT = "2026-09-01 00:00:00"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)


BASE = binding.sql_player_games().strip()
IDENT = feeds.SQL_FEEDS.strip()
SCHED = feeds.SQL_SCHEDULE.strip()


# ---------------------------------------------------------------------------
# Identity
# ---------------------------------------------------------------------------

class _Identity:
    """The identity tables, each built on first use and materialised once
    (they are registries in the reference); a query pays only for what it reads."""

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf

    @cached_property
    def staged(self) -> DataFrame:
        return cut_lineage(identity.stage_hub(feeds.raw_hub(self.spark, self.sf)))

    @cached_property
    def latest(self) -> DataFrame:
        return identity.latest_snapshot_rows(self.staged)

    @cached_property
    def keys0(self) -> DataFrame:
        s = self.staged
        first = s.join(F.broadcast(s.agg(F.min("snapshot_date").alias("snapshot_date"))), "snapshot_date", "left_semi")
        return identity.hub_keys(first)

    @cached_property
    def keys1(self) -> DataFrame:
        return cut_lineage(identity.hub_keys(self.latest, existing=self.keys0))

    @cached_property
    def master(self) -> DataFrame:
        return cut_lineage(identity.stage_master(feeds.raw_master(self.spark, self.sf)))

    @cached_property
    def mkeys(self) -> DataFrame:
        return cut_lineage(identity.master_keys(self.master, self.keys1, self.latest))

    @cached_property
    def xwalk(self) -> DataFrame:
        return cut_lineage(identity.crosswalk(self.keys1, self.latest, self.mkeys, self.master))

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)


def _identity(spark: SparkSession, sf: str) -> _Identity:
    return _Identity(spark, sf)


@register("hub_latest_snapshot", _with(IDENT) + """
SELECT sleeper_id, gsis_id, espn_id, yahoo_id, full_name, position, team, height_inches, snapshot_date
FROM hub_latest""")
def q_hub_latest(spark: SparkSession, sf: str) -> DataFrame:
    """DOM-21 + FLT-6 + FLT-4 + SCA-6/7: the staged hub, latest snapshot only."""
    latest = identity.latest_snapshot_rows(identity.stage_hub(feeds.raw_hub(spark, sf)))
    return latest.select("sleeper_id", "gsis_id", "espn_id", "yahoo_id", "full_name", "position", "team",
                         "height_inches", "snapshot_date")


@register("surrogate_keys", _with(IDENT) + "\nSELECT player_id, sleeper_id FROM keys0")
def q_surrogate_keys(spark: SparkSession, sf: str) -> DataFrame:
    """WIN-1: dense ids 1..N over the first snapshot's hub ids (ordered scan, no global window)."""
    return _identity(spark, sf)["keys0"]


@register("surrogate_keys_increment", _with(IDENT) + "\nSELECT player_id, sleeper_id FROM keys1")
def q_surrogate_keys_increment(spark: SparkSession, sf: str) -> DataFrame:
    """WIN-2 + JOI-7 + JOI-9: the registry after the latest snapshot (old ids kept, new above max)."""
    return _identity(spark, sf)["keys1"]


@register("master_keys", _with(IDENT) + "\nSELECT player_id, gsis_id FROM mkeys")
def q_master_keys(spark: SparkSession, sf: str) -> DataFrame:
    """WIN-3: master ids reuse the hub's id, the rest minted above the hub maximum."""
    return _identity(spark, sf)["mkeys"]


@register("id_unpivot_crosswalk", _with(IDENT) + "\nSELECT player_id, source, source_id FROM xwalk")
def q_crosswalk(spark: SparkSession, sf: str) -> DataFrame:
    """SET-3 + WIN-4: (source, source_id) -> lowest player_id over hub and master ids."""
    return _identity(spark, sf)["xwalk"]


@register("dim_players_union", _with(IDENT, """dimp AS (
  SELECT CAST(k.player_id AS BIGINT) AS player_id, h.full_name, h.first_name, h.last_name, h.position,
    NULL::DATE AS birthdate, h.height_inches, NULL::INTEGER AS weight_lbs, NULL::VARCHAR AS college,
    NULL::INTEGER AS draft_year, NULL::INTEGER AS draft_round, NULL::INTEGER AS draft_pick,
    NULL::INTEGER AS debut_season, NULL::VARCHAR AS status
  FROM keys1 k JOIN hub_latest h ON h.sleeper_id = k.sleeper_id
  UNION ALL
  SELECT CAST(k.player_id AS BIGINT), m.full_name, m.first_name, m.last_name, m.position,
    NULL::DATE, NULL::INTEGER, m.weight_lbs, NULL::VARCHAR, NULL::INTEGER, NULL::INTEGER, NULL::INTEGER,
    NULL::INTEGER, m.status
  FROM mkeys k JOIN master m ON m.gsis_id = k.gsis_id
  WHERE m.full_name IS NOT NULL AND k.player_id NOT IN (SELECT player_id FROM keys1)
)""") + "\nSELECT * FROM dimp")
def q_dim_players(spark: SparkSession, sf: str) -> DataFrame:
    """SET-1 + JOI-8: hub bio first, master bio for the players the hub lacks."""
    i = _identity(spark, sf)
    return identity.dim_players(i["keys1"], i["latest"], i["mkeys"], i["master"], with_timestamps=False)


# ---------------------------------------------------------------------------
# Teams, games, lines
# ---------------------------------------------------------------------------

def _teams_games(spark: SparkSession, sf: str):
    sched = feeds.schedule(spark, sf)
    teams = marts.dim_teams(sched, feeds.team_meta(spark, sf), feeds.ALIASES)
    games = marts.dim_games(sched, teams, feeds.ALIASES)
    return sched, teams, games


@register("dim_teams", _with(SCHED) + "\nSELECT * FROM dim_teams")
def q_dim_teams(spark: SparkSession, sf: str) -> DataFrame:
    """SET-2 + AGG-7 + SCA-1 + SCA-12 + DOM-19: teams per season from both sides of every game."""
    return _teams_games(spark, sf)[1]


@register("dim_games", _with(SCHED) + "\nSELECT * FROM dim_games")
def q_dim_games(spark: SparkSession, sf: str) -> DataFrame:
    """JOI-4 + SCA-3/4/9 + D1/D1b casts: one row per game with both team ids."""
    return _teams_games(spark, sf)[2]


@register("home_away_union", _with(SCHED) + "\nSELECT season, week, game_id, team_id, side FROM team_games")
def q_home_away(spark: SparkSession, sf: str) -> DataFrame:
    """SET-2: (season, week, team) -> game from both sides, one scan exploded."""
    return marts.team_games(_teams_games(spark, sf)[2])


@register("vegas_lines", _with(SCHED) + """
SELECT game_id, kickoff_time AS snapshot_at, 'nflverse_closing' AS sportsbook,
  CAST(-spread_line AS DECIMAL(4,1)) AS spread_home, CAST(spread_line AS DECIMAL(4,1)) AS spread_away,
  CAST(total_line AS DECIMAL(4,1)) AS total, CAST(home_moneyline AS INTEGER) AS home_moneyline,
  CAST(away_moneyline AS INTEGER) AS away_moneyline,
  CAST((total_line + spread_line) / 2 AS DECIMAL(4,1)) AS home_implied_total,
  CAST((total_line - spread_line) / 2 AS DECIMAL(4,1)) AS away_implied_total
FROM schedule JOIN (SELECT game_id, kickoff_time FROM dim_games) USING (game_id)
WHERE coalesce(spread_line, total_line) IS NOT NULL""")
def q_vegas(spark: SparkSession, sf: str) -> DataFrame:
    """DOM-22 + FLT-5 + SCA-9 + SCA-13: closing lines with implied team totals."""
    return marts.vegas_closing_lines(feeds.schedule(spark, sf))


# ---------------------------------------------------------------------------
# Usage intermediates and the per-game fact
# ---------------------------------------------------------------------------

def plays_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Play-by-play-shaped rows from lineitem: 'R' lines are carries, 'A' lines targets, others touch nobody."""
    li = binding.table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag", "l_shipdate").where("l_returnflag in ('R', 'A')")
    o = binding.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    rf = F.col("l_returnflag")
    gs = feeds._gsis(F.col("o_custkey"))
    return j.select(
        binding.season_of("l_shipdate").alias("season"), binding.week_of("l_shipdate").alias("week"),
        F.col("l_quantity").cast("int").alias("yardline_100"),
        F.when(rf == "R", 1).otherwise(0).alias("rush_attempt"),
        F.when(rf == "A", 1).otherwise(0).alias("pass_attempt"),
        F.when(rf == "R", gs).alias("rusher_player_id"),
        F.when(rf == "A", gs).alias("receiver_player_id"),
    )


SQL_PLAYS = f"""redzone AS (
  SELECT x.player_id, t.season, t.week,
    CAST(count(*) FILTER (t.flag = 'R' AND t.yards <= 20) AS INTEGER) AS rz_carries,
    CAST(count(*) FILTER (t.flag = 'A' AND t.yards <= 20) AS INTEGER) AS rz_targets,
    CAST(count(*) FILTER (t.flag = 'R' AND t.yards <= 5) AS INTEGER) AS inside_5_carries,
    CAST(count(*) FILTER (t.flag = 'A' AND t.yards <= 5) AS INTEGER) AS inside_5_targets
  FROM (SELECT '00-' || CAST(o.o_custkey AS VARCHAR) AS gsis, l.l_returnflag AS flag, CAST(l.l_quantity AS INTEGER) AS yards,
          CAST(year(l.l_shipdate) AS INTEGER) AS season, CAST({binding.SQL_WEEK.format(c='l.l_shipdate')} AS INTEGER) AS week
        FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey WHERE l.l_returnflag IN ('R', 'A')) t
  JOIN xwalk x ON x.source = 'gsis' AND x.source_id = t.gsis
  GROUP BY t.gsis, x.player_id, t.season, t.week
)"""


@register("conditional_counts_full_outer", _with(IDENT, SQL_PLAYS) + "\nSELECT * FROM redzone")
def q_redzone(spark: SparkSession, sf: str) -> DataFrame:
    """PRJ-3 + AGG-2 + JOI-1: red-zone counts per player-week, carries and targets in one grouping."""
    return marts.pbp_redzone(plays_feed(spark, sf), _identity(spark, sf)["xwalk"])


def snaps_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Snap-count-shaped rows: one per (customer, season, week), keyed by a pfr-style id."""
    c = binding.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    pg = binding.player_games(spark, sf).groupBy("player_id", "season", "week").agg(
        (F.sum(F.coalesce("pass_attempts", F.lit(0))) + F.sum(F.coalesce("rush_attempts", F.lit(0)))
         + F.sum(F.coalesce("targets", F.lit(0)))).alias("offense_snaps"))
    j = pg.join(c, pg.player_id == c.c_custkey)
    return j.select(
        F.when(F.col("c_nationkey") % 2 == 0, F.concat(F.lit("PF"), F.col("player_id").cast("string")))
         .otherwise(F.concat(F.lit("PX"), F.col("player_id").cast("string"))).alias("pfr_player_id"),
        "season", "week", "offense_snaps",
        ((F.col("offense_snaps") % 100) / 100.0).alias("offense_pct"))


SQL_SNAPS = """snaps_feed AS (
  SELECT CASE WHEN c.c_nationkey % 2 = 0 THEN 'PF' || CAST(s.player_id AS VARCHAR)
              ELSE 'PX' || CAST(s.player_id AS VARCHAR) END AS pfr_player_id,
    s.season, s.week, s.offense_snaps, (s.offense_snaps % 100) / 100.0 AS offense_pct
  FROM (SELECT player_id, season, week,
          sum(coalesce(pass_attempts, 0)) + sum(coalesce(rush_attempts, 0)) + sum(coalesce(targets, 0)) AS offense_snaps
        FROM player_games GROUP BY 1, 2, 3) s
  JOIN customer c ON c.c_custkey = s.player_id
),
snaps AS (
  SELECT p.player_id, CAST(s.season AS INTEGER) AS season, CAST(s.week AS INTEGER) AS week,
    CAST(sum(s.offense_snaps) AS INTEGER) AS offensive_snaps, CAST(max(s.offense_pct) AS DECIMAL(5,2)) AS offensive_snap_pct
  FROM snaps_feed s JOIN (SELECT source_id AS pfr_id, player_id FROM xwalk WHERE source = 'pfr') p ON p.pfr_id = s.pfr_player_id
  WHERE s.season IS NOT NULL AND s.week IS NOT NULL GROUP BY 1, 2, 3
)"""


@register("usage_snap_counts", _with(BASE, IDENT, SQL_SNAPS) + "\nSELECT * FROM snaps")
def q_snaps(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-1 + JOI-1 + FLT-4: weekly snaps (sum) and share (max) resolved through pfr ids."""
    return marts.snap_counts(snaps_feed(spark, sf), _identity(spark, sf)["xwalk"])


#: Weekly columns that the binding's feed has, as they are named in the fact; the fact's other stat columns are NULL.
FACT_FEED = {"attempts": "pass_attempts", "completions": "pass_completions", "passing_yards": "pass_yards", "passing_tds": "pass_tds",
             "passing_interceptions": "interceptions", "carries": "rush_attempts", "rushing_yards": "rush_yards", "rushing_tds": "rush_tds",
             "targets": "targets", "receptions": "receptions", "receiving_yards": "rec_yards", "receiving_tds": "rec_tds"}
_FACT_TYPES = {f.name: f.dataType.simpleString() for f in CONTRACTS["fct_player_game_stats"].schema.fields}


def _fact_columns() -> str:
    """The fact's columns in the contract's order: keys, usage, stats by the feed's names, extras."""
    from_feed = {out: f"feed.{given}" for given, out in FACT_FEED.items()}
    own = {"player_id": "who.player_id", "game_id": "side.game_id", "season": "feed.season", "week": "feed.week", "team_id": "side.team_id",
           "opponent_id": "met.team_id", "position": "feed.position", "fumbles": "0", "fumbles_lost": "coalesce(feed.rushing_fumbles_lost, 0)",
           "two_pt_conversions": "coalesce(feed.rushing_2pt_conversions, 0)"}
    given = own | from_feed | {c: f"extra.{c}" for c in EXTRAS}
    kinds = _FACT_TYPES | {"player_id": "BIGINT", "position": "VARCHAR", "game_id": "VARCHAR"}
    return ",\n    ".join(f"CAST({given.get(c, 'NULL')} AS {kinds[c]}) AS {c}" for c in kinds if c != "ingested_at")


#: What the three enrichments add to a player's week.
EXTRAS = ("offensive_snaps", "offensive_snap_pct", "rz_carries", "rz_targets", "inside_5_carries", "inside_5_targets",
          "avg_separation", "avg_cushion", "rush_yards_over_expected")
SQL_FACT = f"""codes AS (  -- every spelling of a team's code in a season
  SELECT season, abbr AS code, team_id FROM dim_teams
  UNION ALL SELECT t.season, c.old, t.team_id FROM canon c, dim_teams t WHERE t.abbr = c.new
), sides AS (  -- who plays when, by any spelling
  SELECT c.season, g.week, c.code, g.team_id, g.game_id FROM codes c, team_games g WHERE g.season = c.season AND g.team_id = c.team_id
), extras AS (  -- the enrichments as one relation, a row for each player's week
  SELECT player_id, season, week, {', '.join(f'max({c}) AS {c}' for c in EXTRAS)} FROM (
    SELECT * FROM snaps UNION ALL BY NAME SELECT * FROM redzone UNION ALL BY NAME SELECT * FROM ngs) u GROUP BY ALL
), fact AS (
  SELECT DISTINCT ON (player_id, game_id) * FROM (
    SELECT {_fact_columns()}
    FROM sides side
    JOIN weekly_feed feed ON (feed.season, feed.week, feed.team) = (side.season, side.week, side.code)
    JOIN xwalk who ON (who.source, who.source_id) = ('gsis', feed.player_id)
    LEFT JOIN extras extra ON (extra.player_id, extra.season, extra.week) = (who.player_id, feed.season, feed.week)
    LEFT JOIN codes met ON (met.season, met.code) = (feed.season, feed.opponent_team)) every
  ORDER BY player_id, game_id, season, week, team_id
)"""


def tracking_feeds(spark: SparkSession, sf: str, plays: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Receiving and rushing tracking rows from the plays, one per (gsis, season, week) each.

    'A' lines are receiving, 'R' lines rushing.  As in the tracking feed the final week is
    numbered 23 and there is no week 22: the lines of both half-months are that one week.
    """
    p = (plays_feed(spark, sf) if plays is None else plays).withColumn("week", F.when(F.col("week") == 22, 23).otherwise(F.col("week")))
    yards = F.col("yardline_100")

    def per_week(who: str, *stats) -> DataFrame:
        return p.filter(F.col(who).isNotNull()).groupBy(F.col(who).alias("player_gsis_id"), "season", "week").agg(*stats)

    receiving = per_week("receiver_player_id", (F.max(yards) / 10.0).alias("avg_separation"),
                         (F.min(yards) / 5.0).alias("avg_cushion"))
    rushing = per_week("rusher_player_id", (F.sum(yards - 25) / 10.0).alias("rush_yards_over_expected"))
    return receiving, rushing


SQL_NGS = f"""tracking AS (
  SELECT '00-' || CAST(o.o_custkey AS VARCHAR) AS gsis, l.l_returnflag AS flag, CAST(l.l_quantity AS INTEGER) AS yards,
    CAST(year(l.l_shipdate) AS INTEGER) AS season,
    CASE {binding.SQL_WEEK.format(c='l.l_shipdate')} WHEN 22 THEN 23 ELSE {binding.SQL_WEEK.format(c='l.l_shipdate')} END AS week
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
),
receiving AS (
  SELECT gsis, season, week, max(yards) / 10.0 AS avg_separation, min(yards) / 5.0 AS avg_cushion
  FROM tracking WHERE flag = 'A' GROUP BY 1, 2, 3
),
rushing AS (
  SELECT gsis, season, week, sum(yards - 25) / 10.0 AS rush_yards_over_expected FROM tracking WHERE flag = 'R' GROUP BY 1, 2, 3
),
ngs AS (
  SELECT x.player_id, n.season, CASE n.week WHEN 23 THEN 22 ELSE n.week END AS week,
    CAST(n.avg_separation AS DECIMAL(4,2)) AS avg_separation, CAST(n.avg_cushion AS DECIMAL(4,2)) AS avg_cushion,
    CAST(n.rush_yards_over_expected AS DECIMAL(6,2)) AS rush_yards_over_expected
  FROM (SELECT * FROM receiving FULL OUTER JOIN rushing USING (gsis, season, week)) n
  JOIN xwalk x ON x.source = 'gsis' AND x.source_id = n.gsis
)"""
_FACT = _with(BASE, IDENT, SCHED, O.mode_cte("wk_mode", "player_games", ["player_id", "season", "week"], "position"),
              feeds.SQL_WEEKLY, SQL_SNAPS, SQL_PLAYS, SQL_NGS, SQL_FACT) + "\nSELECT * FROM fact"


@register("player_game_fact", _FACT)
@register("player_game_fact_tracked", _FACT)
def q_fact(spark: SparkSession, sf: str) -> DataFrame:
    """JOI-1..6 + PRJ-1/2 + SCA-8 + WIN-4 + DOM-19: the per-player-per-game fact with its three enrichments.

    The tracking one is receiving FULL OUTER rushing.  The plays are written once and read by
    the red-zone counts and both tracking feeds.
    """
    i = _identity(spark, sf)
    _, teams, games = _teams_games(spark, sf)
    plays = cut_lineage(plays_feed(spark, sf))
    out = marts.fct_player_game_stats(feeds.weekly_stats(spark, sf), i["xwalk"], teams, games, snaps=marts.snap_counts(snaps_feed(spark, sf), i["xwalk"]),
                                      ngs=marts.ngs_player_week(*tracking_feeds(spark, sf, plays), i["xwalk"]),
                                      redzone=marts.pbp_redzone(plays, i["xwalk"]), aliases=feeds.ALIASES, ingested_at=INGESTED_AT)
    return out.drop("ingested_at")


@register("crosswalk_rejects", _with(BASE, IDENT, SQL_SNAPS) + """
SELECT s.season, count(*) AS unresolved_rows, count(DISTINCT s.pfr_player_id) AS unresolved_ids
FROM snaps_feed s WHERE s.pfr_player_id NOT IN (SELECT source_id FROM xwalk WHERE source = 'pfr')
GROUP BY s.season""")
def q_crosswalk_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """JOI-1 rejects: feed rows whose source id has no crosswalk entry, per season."""
    from touchline.operators.joins import resolve_ids
    _, rejects = resolve_ids(snaps_feed(spark, sf), _identity(spark, sf)["xwalk"], "pfr", "pfr_player_id",
                             with_rejects=True)
    return rejects.groupBy("season").agg(F.count(F.lit(1)).alias("unresolved_rows"),
                                         F.countDistinct("pfr_player_id").alias("unresolved_ids"))


def pbp_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Play-by-play-shaped rows: each line is a play of its customer's nation against
    the team it is paired with that week."""
    li = binding.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate")
    o = binding.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = binding.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == F.col("c_custkey"))
    j = j.select("*", binding.season_of("l_shipdate").alias("season"), binding.week_of("l_shipdate").alias("week"))
    j = j.withColumn("opp", feeds.opponent(F.col("week"), F.col("c_nationkey")))
    home = F.least("c_nationkey", "opp")
    rf = F.col("l_returnflag")
    return j.select(
        F.format_string("%d_%02d_%02d", "season", "week", home).alias("game_id"),
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("play_id"), "season", "week",
        feeds.code(F.col("c_nationkey")).alias("posteam"), feeds.code(F.col("opp"), legacy=True).alias("defteam"),
        feeds.code(home).alias("home_team"),
        F.col("l_quantity").alias("yards_gained"),
        (F.col("l_linenumber") * 7).cast("double").alias("posteam_score"),
        (rf == "A").cast("double").alias("pass_attempt"), (rf == "R").cast("double").alias("rush_attempt"))


SQL_PBP = f"""pbp AS (
  SELECT printf('%d_%02d_%02d', season, week, least(nat, opp)) AS game_id, season, week,
    'N' || lpad(CAST(nat AS VARCHAR), 2, '0') AS team,
    coalesce((SELECT new FROM canon WHERE old = (CASE WHEN opp < {feeds.LEGACY_BELOW} THEN 'X' ELSE 'N' END
      || lpad(CAST(opp AS VARCHAR), 2, '0'))), CASE WHEN opp < {feeds.LEGACY_BELOW} THEN 'X' ELSE 'N' END
      || lpad(CAST(opp AS VARCHAR), 2, '0')) AS opp_code,
    'N' || lpad(CAST(least(nat, opp) AS VARCHAR), 2, '0') AS home_team,
    CAST(l_quantity AS INTEGER) AS yards, l_linenumber * 7 AS score,
    l_returnflag = 'A' AS is_pass, l_returnflag = 'R' AS is_rush
  FROM (
    SELECT l.*, c.c_nationkey AS nat, CAST(year(l.l_shipdate) AS INTEGER) AS season,
      {binding.SQL_WEEK.format(c='l.l_shipdate')} AS week,
      {feeds.sql_opponent(binding.SQL_WEEK.format(c='l.l_shipdate'), 'c.c_nationkey')} AS opp
    FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
  ) x
),
off AS (
  SELECT game_id, season, week, team, opp_code AS opp, CAST(count(*) AS INTEGER) AS plays,
    CAST(sum(coalesce(yards, 0)) AS INTEGER) AS total_yards,
    CAST(sum(CASE WHEN is_pass THEN coalesce(yards, 0) END) AS INTEGER) AS pass_yards,
    CAST(sum(CASE WHEN is_rush THEN coalesce(yards, 0) END) AS INTEGER) AS rush_yards,
    CAST(max(score) AS INTEGER) AS points, bool_or(home_team = team) AS is_home
  FROM pbp GROUP BY game_id, season, week, team, opp_code
)"""


@register("team_game_stats", _with(SCHED, SQL_PBP) + """
SELECT t.team_id, f.game_id, CAST(f.season AS INTEGER) AS season, CAST(f.week AS INTEGER) AS week,
  o.team_id AS opponent_id, f.is_home, f.points, f.total_yards, f.pass_yards, f.rush_yards, f.plays,
  a.points AS points_allowed, a.total_yards AS yards_allowed, a.pass_yards AS pass_yards_allowed,
  a.rush_yards AS rush_yards_allowed
FROM off f
LEFT JOIN off a ON a.game_id = f.game_id AND a.team = f.opp
LEFT JOIN dim_teams t ON t.season = f.season AND t.abbr = f.team
LEFT JOIN dim_teams o ON o.season = f.season AND o.abbr = f.opp""")
def q_team_game_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Extension (declared, never built by the reference): per (team, game) offence from the
    play slice (PRJ-1) with what the opponent gained against it (self-join)."""
    teams = _teams_games(spark, sf)[1]
    tg = marts.fct_team_game_stats(marts.fct_pbp(pbp_feed(spark, sf)), teams, feeds.ALIASES)
    return tg.select("team_id", "game_id", "season", "week", "opponent_id", "is_home", "points", "total_yards",
                     "pass_yards", "rush_yards", "plays", "points_allowed", "yards_allowed",
                     "pass_yards_allowed", "rush_yards_allowed")
