"""Feed-shaped views of the graded tables (the binding for identity and marts).

hub snapshots  <- customer: two snapshot dates (an early one with the larger
                  balances, the latest with every customer); ids
                  carry junk ('' / '0') and some names are blank
player master  <- customer: every customer has a master id
schedule       <- orders: per (season, week) the teams that played pair up
                  round-robin (team k meets (week - k) mod 25; the team that
                  would meet itself plays a visitor outside the nations, so no
                  team-week is without a game)
weekly stats   <- player_games summed per (customer, season, week)
team codes     <- nation: 'N00'..'N24'; the away side spells nations 0-4 with a
                  legacy code 'X00'..'X04' that the alias map canonicalises
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.plans import binding
from touchline.plans.binding import SEGMENT_POSITION, map_values

N_TEAMS = 25
VISITOR = N_TEAMS  # the extra opponent; it has no metadata, so its team id stays unresolved
LEGACY_BELOW = 5
# Alias map built by rule: legacy 'Xkk' -> current 'Nkk' for the first LEGACY_BELOW nations.
ALIASES = {f"X{k:02d}": f"N{k:02d}" for k in range(LEGACY_BELOW)}
HEIGHT_ENDS = ("", ".0", ".5")  # heights arrive as text of all three forms
SNAPSHOTS = (("2026-08-01", "c_acctbal >= 2000"), ("2026-09-01", "true"))  # (date, which customers are listed)


def code(key_col, legacy: bool = False):
    pref = F.when(key_col < LEGACY_BELOW, F.lit("X")).otherwise(F.lit("N")) if legacy else F.lit("N")
    return F.concat(pref, F.lpad(key_col.cast("string"), 2, "0"))


def opponent(week, nation):
    """Key of the team that ``nation`` meets in ``week``."""
    opp = F.pmod(week - nation, F.lit(N_TEAMS))
    return F.when(opp == nation, VISITOR).otherwise(opp)


def sql_opponent(week: str, nation: str) -> str:
    opp = f"((({week} - {nation}) % {N_TEAMS}) + {N_TEAMS}) % {N_TEAMS}"
    return f"(CASE WHEN {opp} = {nation} THEN {VISITOR} ELSE {opp} END)"


def _gsis(custkey_col):
    return F.concat(F.lit("00-"), custkey_col.cast("string"))


# ---------------------------------------------------------------------------
# Identity feeds
# ---------------------------------------------------------------------------

def raw_hub(spark: SparkSession, sf: str) -> DataFrame:
    c = binding.table(spark, sf, "customer")
    k = F.col("c_custkey")
    one = c.select(
        F.concat(F.lit("S"), k.cast("string")).alias("player_id"),
        F.when(F.col("c_mktsegment") != "MACHINERY", _gsis(k)).otherwise(F.lit("")).alias("gsis_id"),
        F.when(F.col("c_acctbal") > 7000, F.lit("0")).otherwise((k + 1000000).cast("string")).alias("espn_id"),
        F.when(F.col("c_nationkey") < 5, F.lit("")).otherwise((k + 2000000).cast("string")).alias("yahoo_id"),
        F.lit("Customer").alias("first_name"),
        F.expr("substr(c_name, 10)").alias("last_name"),
        F.when(F.col("c_acctbal") < -900, F.lit("")).otherwise(F.col("c_name")).alias("full_name"),
        map_values(F.col("c_mktsegment"), SEGMENT_POSITION).alias("position"),
        code(F.col("c_nationkey")).alias("team"),
        F.concat((F.col("c_nationkey") + 60).cast("string"),
                 F.element_at(F.array(*map(F.lit, HEIGHT_ENDS)), (F.col("c_nationkey") % 3 + 1).cast("int"))).alias("height"),
        F.col("c_acctbal"),
    )
    parts = [one.filter(listed).withColumn("snapshot_date", F.lit(d).cast("date"))
             for d, listed in SNAPSHOTS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.drop("c_acctbal")


def raw_master(spark: SparkSession, sf: str) -> DataFrame:
    c = binding.table(spark, sf, "customer")
    k = F.col("c_custkey")
    return c.select(
        _gsis(k).alias("gsis_id"),
        F.col("c_name").alias("display_name"),
        F.lit("Customer").alias("first_name"),
        F.expr("substr(c_name, 10)").alias("last_name"),
        map_values(F.col("c_mktsegment"), SEGMENT_POSITION).alias("position"),
        F.when(F.col("c_nationkey") % 2 == 0, F.concat(F.lit("PF"), k.cast("string"))).alias("pfr_id"),
        (k + 1000000).cast("string").alias("espn_id"),
        F.when(F.col("c_nationkey") % 3 == 0, F.lit("")).otherwise(
            F.concat(((k % 90) + 160).cast("string"), F.lit(".5"))).alias("weight"),
        F.lit("ACT").alias("status"),
    )


SQL_FEEDS = f"""
raw_hub1 AS (
  SELECT 'S' || CAST(c_custkey AS VARCHAR) AS player_id,
    CASE WHEN c_mktsegment <> 'MACHINERY' THEN '00-' || CAST(c_custkey AS VARCHAR) ELSE '' END AS gsis_id,
    CASE WHEN c_acctbal > 7000 THEN '0' ELSE CAST(c_custkey + 1000000 AS VARCHAR) END AS espn_id,
    CASE WHEN c_nationkey < 5 THEN '' ELSE CAST(c_custkey + 2000000 AS VARCHAR) END AS yahoo_id,
    'Customer' AS first_name, substr(c_name, 10) AS last_name,
    CASE WHEN c_acctbal < -900 THEN '' ELSE c_name END AS full_name,
    {binding._case_sql('c_mktsegment', SEGMENT_POSITION)} AS position,
    'N' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS team,
    CAST(c_nationkey + 60 AS VARCHAR) || (CASE c_nationkey % 3 WHEN 0 THEN '' WHEN 1 THEN '.0' ELSE '.5' END) AS height, c_acctbal
  FROM customer
),
raw_hub AS (
  {' UNION ALL '.join(f"SELECT * EXCLUDE (c_acctbal), DATE '{d}' AS snapshot_date FROM raw_hub1 WHERE {listed}" for d, listed in SNAPSHOTS)}
),
hub_staged AS (
  SELECT player_id AS sleeper_id,
    nullif(nullif(gsis_id, ''), '0') AS gsis_id, nullif(nullif(espn_id, ''), '0') AS espn_id,
    nullif(nullif(yahoo_id, ''), '0') AS yahoo_id,
    NULL::VARCHAR AS rotowire_id, NULL::VARCHAR AS rotoworld_id, NULL::VARCHAR AS sportradar_id,
    NULL::VARCHAR AS stats_id, NULL::VARCHAR AS swish_id, NULL::VARCHAR AS fantasy_data_id, NULL::VARCHAR AS oddsjam_id,
    nullif(first_name, '') AS first_name, nullif(last_name, '') AS last_name, nullif(full_name, '') AS full_name,
    nullif(position, '') AS position, nullif(team, '') AS team,
    CAST(round(try_cast(height AS DOUBLE)) AS INTEGER) AS height_inches, snapshot_date
  FROM raw_hub WHERE nullif(full_name, '') IS NOT NULL
),
hub_latest AS (SELECT * FROM hub_staged WHERE snapshot_date = (SELECT max(snapshot_date) FROM hub_staged)),
hub_first AS (SELECT * FROM hub_staged WHERE snapshot_date = (SELECT min(snapshot_date) FROM hub_staged)),
master AS (
  SELECT '00-' || CAST(c_custkey AS VARCHAR) AS gsis_id, c_name AS full_name,
    'Customer' AS first_name, substr(c_name, 10) AS last_name,
    {binding._case_sql('c_mktsegment', SEGMENT_POSITION)} AS position,
    CASE WHEN c_nationkey % 2 = 0 THEN 'PF' || CAST(c_custkey AS VARCHAR) END AS pfr_id,
    CAST(c_custkey + 1000000 AS VARCHAR) AS espn_id,
    CAST(round(try_cast(trim(CASE WHEN c_nationkey % 3 = 0 THEN '' ELSE CAST(c_custkey % 90 + 160 AS VARCHAR) || '.5' END) AS DOUBLE)) AS INTEGER) AS weight_lbs,
    lower('ACT') AS status
  FROM customer
),
keys0 AS (SELECT row_number() OVER (ORDER BY sleeper_id) AS player_id, sleeper_id FROM (SELECT DISTINCT sleeper_id FROM hub_first) s),
hub_new AS (
  SELECT DISTINCT h.sleeper_id, h.gsis_id FROM hub_latest h
  WHERE h.sleeper_id NOT IN (SELECT sleeper_id FROM keys0)
),
keys1 AS (
  SELECT player_id, sleeper_id FROM keys0
  UNION ALL
  SELECT (SELECT max(player_id) FROM keys0) + row_number() OVER (ORDER BY sleeper_id) AS player_id, sleeper_id
  FROM (SELECT DISTINCT sleeper_id FROM hub_new) n
),
hub_gsis AS (
  SELECT h.gsis_id, min(k.player_id) AS player_id
  FROM hub_latest h JOIN keys1 k ON k.sleeper_id = h.sleeper_id
  WHERE h.gsis_id IS NOT NULL GROUP BY h.gsis_id
),
master_only AS (SELECT gsis_id FROM master EXCEPT SELECT gsis_id FROM hub_gsis),
mkeys AS (
  SELECT player_id, gsis_id FROM hub_gsis SEMI JOIN master USING (gsis_id)
  UNION ALL
  SELECT (SELECT max(player_id) FROM keys1) + row_number() OVER (ORDER BY gsis_id), gsis_id FROM master_only
),
xwalk AS (
  SELECT CAST(min(player_id) AS BIGINT) AS player_id, source, source_id FROM (
    SELECT k.player_id, 'sleeper' AS source, h.sleeper_id AS source_id FROM keys1 k JOIN hub_latest h ON h.sleeper_id = k.sleeper_id
    UNION ALL SELECT k.player_id, 'gsis', h.gsis_id FROM keys1 k JOIN hub_latest h ON h.sleeper_id = k.sleeper_id
    UNION ALL SELECT k.player_id, 'espn', h.espn_id FROM keys1 k JOIN hub_latest h ON h.sleeper_id = k.sleeper_id
    UNION ALL SELECT k.player_id, 'yahoo', h.yahoo_id FROM keys1 k JOIN hub_latest h ON h.sleeper_id = k.sleeper_id
    UNION ALL SELECT k.player_id, 'gsis', m.gsis_id FROM mkeys k JOIN master m ON m.gsis_id = k.gsis_id
    UNION ALL SELECT k.player_id, 'pfr', m.pfr_id FROM mkeys k JOIN master m ON m.gsis_id = k.gsis_id
    UNION ALL SELECT k.player_id, 'espn', m.espn_id FROM mkeys k JOIN master m ON m.gsis_id = k.gsis_id
  ) a WHERE source_id IS NOT NULL GROUP BY source, source_id
)"""


# ---------------------------------------------------------------------------
# Schedule, teams and weekly stats
# ---------------------------------------------------------------------------

def team_meta(spark: SparkSession, sf: str) -> DataFrame:
    """Team metadata for the binding: one team per nation, franchise = nation key + 1."""
    n = binding.table(spark, sf, "nation")
    r = binding.table(spark, sf, "region")
    return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select(
        code(F.col("n_nationkey")).alias("abbr"),
        (F.col("n_nationkey") + 1).cast("int").alias("franchise_id"),
        F.col("n_name").alias("city"), F.col("n_name").alias("name"),
        F.col("r_name").alias("conference"),
        F.concat(F.lit("D"), (F.col("n_nationkey") % 4).cast("string")).alias("division"),
    )


def team_weeks(spark: SparkSession, sf: str) -> DataFrame:
    """(season, week, nation) that had at least one order, with the nation's order value."""
    o = binding.table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    c = binding.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return j.groupBy(binding.season_of("o_orderdate").alias("season"),
                     binding.week_of("o_orderdate").alias("week"),
                     F.col("c_nationkey").alias("nation")).agg(
        F.sum("o_totalprice").alias("value"), F.count(F.lit(1)).alias("orders"))


def schedule(spark: SparkSession, sf: str) -> DataFrame:
    """Schedules feed: one game per pair {k, opponent of k} of teams active that week."""
    tw = team_weeks(spark, sf)
    opp = opponent(F.col("week"), F.col("nation"))
    sides = tw.select(
        "season", "week", F.least("nation", opp).alias("home"), F.greatest("nation", opp).alias("away"))
    pairs = sides.distinct()
    val = tw.select("season", "week", F.col("nation").alias("_n"), "value", "orders")
    hv = val.select("season", "week", F.col("_n").alias("home"), F.col("value").alias("hv"))
    av = val.select("season", "week", F.col("_n").alias("away"), F.col("orders").alias("ao"))
    g = pairs.join(hv, ["season", "week", "home"], "left").join(av, ["season", "week", "away"], "left")
    month = F.expr("(week - 1) div 2") + 1
    day = F.when(F.col("week") % 2 == 1, 1).otherwise(16)
    gameday = F.format_string("%04d-%02d-%02d", F.col("season"), month, day)
    return g.select(
        F.format_string("%d_%02d_%02d_%02d", "season", "week", "away", "home").alias("game_id"),
        F.col("season").cast("int").alias("season"),
        F.col("week").cast("int").alias("week"),
        F.when(F.col("week") <= 18, "REG").when(F.col("week") == 24, F.lit(None)).otherwise("POST").alias("game_type"),
        gameday.alias("gameday"),
        F.when(F.col("week") % 6 == 1, "13:00").when(F.col("week") % 6 == 2, "16:25")
         .when(F.col("week") % 6 == 4, "9:30").when(F.col("week") % 6 == 5, "13:00:00").alias("gametime"),
        code(F.col("home")).alias("home_team"),
        code(F.col("away"), legacy=True).alias("away_team"),
        (F.coalesce("hv", F.lit(0.0)) / 100000).alias("home_score"),
        (F.coalesce("ao", F.lit(0)) * 3).cast("double").alias("away_score"),
        F.when((F.col("home") + F.col("away")) % 7 == 0, F.lit(None))
         .otherwise(((F.col("home") * 3 + F.col("week")) % 29 - 14).cast("double")).alias("spread_line"),
        F.when(F.col("week") % 5 == 0, F.lit(None))
         .otherwise((30 + (F.col("home") + F.col("away") + F.col("week")) % 31).cast("double")).alias("total_line"),
        ((F.col("home") * 37 + F.col("week")) % 400 - 200).alias("home_moneyline"),
        (200 - (F.col("home") * 37 + F.col("week")) % 400).alias("away_moneyline"),
        F.when(F.col("week") % 4 == 0, F.lit("n/a")).otherwise(
            F.format_string(" %d.5 ", (F.col("home") + F.col("week")) % 90)).alias("temp"),
        ((F.col("away") + F.col("week")) % 25).cast("string").alias("wind"),
    )


SQL_SCHEDULE = f"""
team_weeks AS (
  SELECT CAST(year(o.o_orderdate) AS INTEGER) AS season, {binding.SQL_WEEK.format(c='o.o_orderdate')} AS week,
    c.c_nationkey AS nation, sum(o.o_totalprice) AS value, count(*) AS orders
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey GROUP BY ALL
),
pairs AS (
  SELECT DISTINCT season, week, least(nation, opp) AS home, greatest(nation, opp) AS away
  FROM (SELECT season, week, nation, {sql_opponent('week', 'nation')} AS opp FROM team_weeks)
),
schedule AS (
  SELECT printf('%d_%02d_%02d_%02d', p.season, p.week, p.away, p.home) AS game_id,
    p.season, p.week, p.home AS home_n, p.away AS away_n,
    CASE WHEN p.week <= 18 THEN 'REG' WHEN p.week = 24 THEN NULL ELSE 'POST' END AS game_type,
    printf('%04d-%02d-%02d', p.season, (p.week - 1) // 2 + 1, CASE WHEN p.week % 2 = 1 THEN 1 ELSE 16 END) AS gameday,
    ['13:00', '16:25', NULL, '9:30', '13:00:00', NULL][(p.week + 5) % 6 + 1] AS gametime,
    'N' || lpad(CAST(p.home AS VARCHAR), 2, '0') AS home_team,
    CASE WHEN p.away < {LEGACY_BELOW} THEN 'X' ELSE 'N' END || lpad(CAST(p.away AS VARCHAR), 2, '0') AS away_team,
    coalesce(h.value, CAST('0.0' AS DOUBLE)) / 100000 AS home_score,
    CAST(coalesce(a.orders, 0) * 3 AS DOUBLE) AS away_score,
    CASE WHEN (p.home + p.away) % 7 = 0 THEN NULL ELSE CAST((p.home * 3 + p.week) % 29 - 14 AS DOUBLE) END AS spread_line,
    CASE WHEN p.week % 5 = 0 THEN NULL ELSE CAST(30 + (p.home + p.away + p.week) % 31 AS DOUBLE) END AS total_line,
    (p.home * 37 + p.week) % 400 - 200 AS home_moneyline,
    200 - (p.home * 37 + p.week) % 400 AS away_moneyline,
    CASE WHEN p.week % 4 = 0 THEN 'n/a' ELSE printf(' %d.5 ', (p.home + p.week) % 90) END AS temp,
    CAST((p.away + p.week) % 25 AS VARCHAR) AS wind
  FROM pairs p
  LEFT JOIN team_weeks h ON h.season = p.season AND h.week = p.week AND h.nation = p.home
  LEFT JOIN team_weeks a ON a.season = p.season AND a.week = p.week AND a.nation = p.away
),
canon AS (SELECT * FROM (VALUES {', '.join(f"('{k}', '{v}')" for k, v in ALIASES.items())}) AS t(old, new)),
dim_teams AS (
  SELECT CAST(y.season * 100 + y.k + 1 AS INTEGER) AS team_id, CAST(y.k + 1 AS INTEGER) AS franchise_id, y.season,
    printf('N%02d', y.k) AS abbr, n.n_name AS city, n.n_name AS name, r.r_name AS conference,
    'D' || CAST(y.k % 4 AS VARCHAR) AS division
  FROM (SELECT DISTINCT season, unnest([home_n, away_n]) AS k FROM schedule) y, nation n, region r
  WHERE n.n_nationkey = y.k AND r.r_regionkey = n.n_regionkey
),
dim_games AS (
  SELECT game_id, season, week, CASE game_type WHEN 'REG' THEN 'REG' ELSE 'POST' END AS season_type,
    CAST(gameday AS DATE) AS game_date,
    CAST(gameday AS DATE) + CASE gametime WHEN '9:30' THEN TIME '09:30:00' WHEN '16:25' THEN TIME '16:25:00'
      ELSE CASE WHEN gametime IS NULL THEN TIME '00:00:00' ELSE TIME '13:00:00' END END AS kickoff_time,
    CAST(season * 100 + home_n + 1 AS INTEGER) AS home_team_id,
    CASE WHEN away_n < {N_TEAMS} THEN CAST(season * 100 + away_n + 1 AS INTEGER) END AS away_team_id,
    CAST(home_score AS INTEGER) AS home_score, CAST(away_score AS INTEGER) AS away_score,
    CAST(NULL AS VARCHAR) AS stadium, CAST(NULL AS VARCHAR) AS surface, CAST(NULL AS VARCHAR) AS roof,
    CASE WHEN week % 4 <> 0 THEN CAST((home_n + week) % 90 + 1 AS INTEGER) END AS weather_temp_f,
    CAST(wind AS INTEGER) AS weather_wind_mph, CAST(NULL AS VARCHAR) AS weather_desc
  FROM schedule
),
team_games AS (
  SELECT season, week, game_id, s.id AS team_id, s.side
  FROM (SELECT *, unnest([{{'id': home_team_id, 'side': 'home'}}, {{'id': away_team_id, 'side': 'away'}}]) AS s FROM dim_games)
)"""


def weekly_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Weekly player-stats feed: player_games summed per (customer, season, week)."""
    pg = binding.player_games(spark, sf)
    c = binding.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    wk = pg.groupBy("player_id", "season", "week").agg(
        F.mode("position", True).alias("position"),
        *[F.sum(s).alias(s) for s in binding.STAT_COLUMNS])
    j = wk.join(c, wk.player_id == c.c_custkey)
    opp = opponent(F.col("week"), F.col("c_nationkey"))
    return j.select(
        _gsis(F.col("player_id")).alias("player_id"), "season", "week",
        code(F.col("c_nationkey")).alias("team"),
        code(opp, legacy=True).alias("opponent_team"),
        "position",
        F.col("pass_attempts").cast("double").alias("attempts"),
        F.col("pass_completions").cast("double").alias("completions"),
        F.col("pass_yards").cast("double").alias("passing_yards"),
        F.col("pass_tds").cast("double").alias("passing_tds"),
        F.col("interceptions").cast("double").alias("passing_interceptions"),
        F.col("rush_attempts").cast("double").alias("carries"),
        F.col("rush_yards").cast("double").alias("rushing_yards"),
        F.col("rush_tds").cast("double").alias("rushing_tds"),
        F.col("targets").cast("double").alias("targets"),
        F.col("receptions").cast("double").alias("receptions"),
        F.col("rec_yards").cast("double").alias("receiving_yards"),
        F.col("rec_tds").cast("double").alias("receiving_tds"),
        F.col("fumbles_lost").alias("rushing_fumbles_lost"),
        F.col("two_pt_conversions").alias("rushing_2pt_conversions"),
    )


SQL_WEEKLY = f"""
weekly AS (
  SELECT w.*, c.c_nationkey FROM (
    SELECT g.player_id, g.season, g.week, m.mode_value AS position,
      {', '.join(f'sum(g.{s}) AS {s}' for s in binding.STAT_COLUMNS)}
    FROM player_games g JOIN wk_mode m ON m.player_id = g.player_id AND m.season = g.season AND m.week = g.week
    GROUP BY g.player_id, g.season, g.week, m.mode_value
  ) w JOIN customer c ON c.c_custkey = w.player_id
),
weekly_feed AS (
  SELECT '00-' || CAST(player_id AS VARCHAR) AS player_id, season, week,
    'N' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS team,
    CASE WHEN {sql_opponent('week', 'c_nationkey')} < {LEGACY_BELOW} THEN 'X' ELSE 'N' END
      || lpad(CAST({sql_opponent('week', 'c_nationkey')} AS VARCHAR), 2, '0') AS opponent_team,
    position,
    CAST(pass_attempts AS DOUBLE) AS attempts, CAST(pass_completions AS DOUBLE) AS completions,
    CAST(pass_yards AS DOUBLE) AS passing_yards, CAST(pass_tds AS DOUBLE) AS passing_tds,
    CAST(interceptions AS DOUBLE) AS passing_interceptions, CAST(rush_attempts AS DOUBLE) AS carries,
    CAST(rush_yards AS DOUBLE) AS rushing_yards, CAST(rush_tds AS DOUBLE) AS rushing_tds,
    CAST(targets AS DOUBLE) AS targets, CAST(receptions AS DOUBLE) AS receptions,
    CAST(rec_yards AS DOUBLE) AS receiving_yards, CAST(rec_tds AS DOUBLE) AS receiving_tds,
    fumbles_lost AS rushing_fumbles_lost, two_pt_conversions AS rushing_2pt_conversions
  FROM weekly
)"""
