"""Registered queries over time: as-of reads, team history, version differences, waiver trends, boards of many leagues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.scalars import percent_label
from touchline.operators.asof import asof_join
from touchline.plans import binding, feeds, history, marts
from touchline.plans import oracle as O
from touchline.plans.board_leagues import league_boards
from touchline.plans.catalog import SNAPSHOT_DATE, _board_sql_ctes, _latest_season, r6, register
from touchline.plans.projection import ACTUAL_FIELDS, project_lines, score_expr, season_totals, snapshot_rows
from touchline.sources import rules


@register("last_shipment_before_order", """
WITH shipped AS (
  SELECT o.o_custkey AS custkey, l.l_shipdate AS shipped_at, l.l_orderkey AS shipped_order, l.l_linenumber AS line, l.l_quantity AS quantity
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
), one AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY custkey, shipped_at ORDER BY shipped_order DESC, line DESC, quantity DESC) AS rn FROM shipped)
  WHERE rn = 1
)
SELECT o.o_orderkey, o.o_custkey, s.shipped_at, s.shipped_order, s.quantity
FROM orders o ASOF LEFT JOIN one s ON s.custkey = o.o_custkey AND s.shipped_at <= o.o_orderdate""")
def q_last_shipment(spark: SparkSession, sf: str) -> DataFrame:
    """FLT-7 as-of: per order the customer's latest shipment on or before its date."""
    orders = binding.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = binding.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    shipped = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        "o_custkey", F.col("l_shipdate").alias("shipped_at"), F.col("l_orderkey").alias("shipped_order"), F.col("l_linenumber").alias("line"),
        F.col("l_quantity").alias("quantity"))
    out = asof_join(orders, shipped, ["o_custkey"], "o_orderdate", "shipped_at", ["shipped_at", "shipped_order", "quantity"],
                    ["shipped_order", "line", "quantity"])
    return out.drop("o_orderdate")


_ROSTER_SQL = f"""weekly AS (
  SELECT o.o_custkey AS player_id, CAST(year(o.o_orderdate) AS INTEGER) AS season, {binding.SQL_WEEK.format(c='o.o_orderdate')} AS week,
    CAST(s.s_nationkey AS INTEGER) % 4 AS team_id, l.l_partkey AS part, CAST(l.l_quantity AS INTEGER) AS number, o.o_orderpriority AS depth, l.l_orderkey AS ord, l.l_linenumber AS line
  FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey JOIN supplier s ON s.s_suppkey = l.l_suppkey
), rosters AS (
  SELECT player_id, season, week, team_id, number AS jersey_number, depth AS depth_chart_pos FROM (
    SELECT *, row_number() OVER (PARTITION BY player_id, season, week ORDER BY ord, line, part, number, team_id) AS rn FROM weekly) x WHERE rn = 1
), marked AS (
  SELECT *, CASE WHEN lag(team_id) OVER w IS DISTINCT FROM team_id THEN 1 ELSE 0 END AS fresh FROM rosters WINDOW w AS (PARTITION BY player_id, season ORDER BY week)
), numbered AS (
  SELECT *, sum(fresh) OVER (PARTITION BY player_id, season ORDER BY week) AS stint FROM marked
), history AS (
  SELECT player_id, season, any_value(team_id) AS team_id, CAST(min(week) AS INTEGER) AS week_start,
    CASE WHEN stint < max(stint) OVER (PARTITION BY player_id, season) THEN CAST(max(week) AS INTEGER) END AS week_end,
    arg_max(jersey_number, week) AS jersey_number, arg_max(depth_chart_pos, week) AS depth_chart_pos
  FROM numbered GROUP BY player_id, season, stint
)"""


def weekly_rosters(spark: SparkSession, sf: str) -> DataFrame:
    """The roster feed of the binding: one row per customer and week, the team being that of the week's first line's supplier."""
    orders = binding.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    lines = binding.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    suppliers = binding.table(spark, sf, "supplier").select("s_suppkey", (F.col("s_nationkey").cast("int") % 4).alias("team_id"))
    rows = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    first = F.struct("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("int").alias("number"), "team_id", "o_orderpriority")
    rows = rows.groupBy(F.col("o_custkey").alias("player_id"), binding.season_of("o_orderdate").alias("season"), binding.week_of("o_orderdate").alias("week"))
    return rows.agg(F.min(first).alias("first")).select("player_id", "season", "week", "first.team_id", F.col("first.number").alias("jersey_number"),
                                                        F.col("first.o_orderpriority").alias("depth_chart_pos"))


@register("player_team_history", f"""WITH {_ROSTER_SQL}
SELECT player_id, team_id, season, week_start, week_end, jersey_number, depth_chart_pos FROM history""")
def q_player_team_history(spark: SparkSession, sf: str) -> DataFrame:
    """SURVEY 2.12: stints by team from weekly rosters; the season's last one is open."""
    return history.player_team_history(weekly_rosters(spark, sf))


@register("team_at_game", f"""WITH {_ROSTER_SQL}, games AS (
  SELECT o_orderkey AS game_id, o_custkey AS player_id, CAST(year(o_orderdate) AS INTEGER) AS season, {binding.SQL_WEEK.format(c='o_orderdate')} AS week FROM orders
)
SELECT g.game_id, g.player_id, g.season, g.week, h.team_id FROM games g
ASOF LEFT JOIN history h ON h.player_id = g.player_id AND h.season = g.season AND h.week_start <= g.week""")
def q_team_at_game(spark: SparkSession, sf: str) -> DataFrame:
    """The team that a player was on at each game: validity intervals read as of the week."""
    games = binding.table(spark, sf, "orders").select(F.col("o_orderkey").alias("game_id"), F.col("o_custkey").alias("player_id"),
                                                      binding.season_of("o_orderdate").alias("season"), binding.week_of("o_orderdate").alias("week"))
    return history.team_at(games, history.player_team_history(weekly_rosters(spark, sf)))


@register("version_changes", """
WITH prev AS (SELECT o_orderkey, o_orderstatus AS status, o_totalprice AS price FROM orders WHERE o_orderpriority <> '1-URGENT'),
cur AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderstatus END AS status,
               CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice + 1 ELSE o_totalprice END AS price FROM orders WHERE o_orderpriority <> '5-LOW')
SELECT coalesce(c.o_orderkey, p.o_orderkey) AS o_orderkey, CASE WHEN c.o_orderkey IS NULL THEN p.status ELSE c.status END AS status,
  CASE WHEN c.o_orderkey IS NULL THEN p.price ELSE c.price END AS price, x.change,
  CASE WHEN x.change = 'changed' THEN concat_ws(',', CASE WHEN p.status IS DISTINCT FROM c.status THEN 'status' END,
                                                CASE WHEN p.price IS DISTINCT FROM c.price THEN 'price' END) END AS changed,
  CASE WHEN x.change = 'added' THEN TIMESTAMP '2026-09-08 06:00:00' ELSE TIMESTAMP '2026-09-01 06:00:00' END AS created_at,
  CASE WHEN x.change IN ('added', 'changed') THEN TIMESTAMP '2026-09-08 06:00:00' ELSE TIMESTAMP '2026-09-01 06:00:00' END AS updated_at
FROM prev p FULL JOIN cur c ON c.o_orderkey = p.o_orderkey,
LATERAL (SELECT CASE WHEN p.o_orderkey IS NULL THEN 'added' WHEN c.o_orderkey IS NULL THEN 'gone'
                     WHEN p.status IS DISTINCT FROM c.status OR p.price IS DISTINCT FROM c.price THEN 'changed' ELSE 'same' END AS change) x""")
def q_version_changes(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-7 + SCA-18: two versions of the orders compared, with first-seen and last-changed times by a fixed clock."""
    orders = binding.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"), "o_orderpriority")
    first = F.lit("2026-09-01 06:00:00").cast("timestamp_ntz")
    prev = orders.where("o_orderpriority <> '1-URGENT'").drop("o_orderpriority").withColumn("created_at", first).withColumn("updated_at", first)
    cur = orders.where("o_orderpriority <> '5-LOW'").withColumn("status", F.when(F.col("status") != "O", F.col("status"))) \
        .withColumn("price", F.when(F.col("o_orderpriority") == "2-HIGH", F.col("price") + 1).otherwise(F.col("price"))).drop("o_orderpriority")
    out = history.version_changes(prev, cur, ["o_orderkey"], "2026-09-08 06:00:00")
    return out.withColumn("changed", F.when(F.col("changed").isNotNull(), F.array_join("changed", ",")))


_WEEKS = 24


@register("waiver_trends", O.with_base(f"""g AS (
  SELECT pg.player_id, pg.season, pg.week, pg.position, {feeds.sql_opponent('pg.week', 'd.nation_key')} AS opponent_id, pg.season * {_WEEKS} + pg.week AS clock,
    CAST(coalesce(pg.targets, 0) + coalesce(pg.rush_attempts, 0) AS DOUBLE) AS usage, CAST(coalesce(pg.rec_yards, 0) AS DOUBLE) AS points
  FROM player_games pg JOIN player_dim d ON d.player_id = pg.player_id
), weekly AS (SELECT player_id, season, week, clock, sum(usage) AS used, count(*) AS games FROM g GROUP BY ALL
), windows AS (
  SELECT *, sum(used) OVER r / sum(games) OVER r AS recent, sum(used) OVER e / sum(games) OVER e AS earlier FROM weekly
  WINDOW r AS (PARTITION BY player_id ORDER BY clock RANGE BETWEEN 2 PRECEDING AND CURRENT ROW),
         e AS (PARTITION BY player_id ORDER BY clock RANGE BETWEEN 8 PRECEDING AND 3 PRECEDING)
), allowed AS (SELECT season, position, opponent_id, sum(points) AS points, count(*) AS games FROM g GROUP BY ALL
), league AS (SELECT season, position, sum(points) / sum(games) AS mean FROM allowed GROUP BY ALL
), met AS (
  SELECT g.player_id, g.season, g.week, avg(coalesce((a.points / a.games) / nullif(l.mean, 0), 1.0)) AS matchup
  FROM g JOIN allowed a ON a.season = g.season AND a.position = g.position AND a.opponent_id = g.opponent_id
  JOIN league l ON l.season = g.season AND l.position = g.position GROUP BY ALL
)""") + """
SELECT w.player_id, w.season, w.week, round(recent, 6) AS recent, round(earlier, 6) AS earlier, round(recent - coalesce(earlier, recent), 6) AS trend,
  round(coalesce(m.matchup, 1.0), 6) AS matchup, round((recent + recent - coalesce(earlier, recent)) * coalesce(m.matchup, 1.0), 6) + 0.0 AS claim
FROM windows w LEFT JOIN met m ON m.player_id = w.player_id AND m.season = w.season AND m.week = w.week""")
def q_waiver_trends(spark: SparkSession, sf: str) -> DataFrame:
    """SURVEY 2.12: usage trend over RANGE frames of weeks, times what the opponent allows to the position."""
    games = binding.player_games(spark, sf).join(binding.player_dim(spark, sf).select("player_id", "nation_key"), "player_id")
    games = games.withColumn("opponent_id", feeds.opponent(F.col("week"), F.col("nation_key")))
    out = history.waiver_trends(games, ["targets", "rush_attempts"], "rec_yards", _WEEKS)
    return out.select("player_id", "season", "week", *[r6(c).alias(c) for c in ("recent", "earlier", "trend", "matchup", "claim")])


#: Leagues of the query: the default one, one with two quarterbacks' worth of flex, and one chaining three flex kinds.
LEAGUES = {
    "home": {"scoring_format": "ppr", "teams": 12, "roster": {"QB": 1, "RB": 2, "WR": 2, "TE": 1, "FLEX": 1, "BENCH": 6}},
    "superflex": {"scoring_format": "half_ppr", "teams": 10, "roster": {"QB": 1, "RB": 2, "WR": 3, "TE": 1, "SUPERFLEX": 2}},
    "chained": {"scoring_format": "standard", "teams": 14, "roster": {"QB": 1, "RB": 1, "WR": 1, "TE": 1, "WRT": 2, "REC_FLEX": 1, "QFLEX": 1}},
}


@register("league_boards", "\nUNION ALL\n".join(f"""SELECT '{name}' AS league, b.* FROM ({O.with_base(*_board_sql_ctes(of))}
SELECT player_id, position, points, round(vor, 6) AS vor, overall_rank, position_rank, CAST(tier AS INTEGER) AS tier, position_rank <= starters AS starter FROM tiered) b"""
                                               for name, of in LEAGUES.items()))
def q_league_boards(spark: SparkSession, sf: str) -> DataFrame:
    """DOM-16..18 for many leagues in one job: scoring formats, SUPERFLEX and REC_FLEX chains; the SQL does one league after the other."""
    games = binding.player_games_table(spark, sf)
    target = _latest_season(games).select((F.col("latest_season") + 1).alias("target"))
    lines = project_lines(season_totals(games), targets=target)
    snap = snapshot_rows(lines, rules.scoring_settings(spark, sorted({of["scoring_format"] for of in LEAGUES.values()})), SNAPSHOT_DATE)
    leagues = spark.createDataFrame([(name, of["scoring_format"]) for name, of in LEAGUES.items()], "league string, scoring_format string")
    roster = binding.player_dim(spark, sf).select("player_id", "position").where(F.col("position").isin(list(rules.SKILL_POSITIONS)))
    players = (snap.select("player_id", "scoring_format", F.col("projected_points").alias("points")).join(F.broadcast(leagues), "scoring_format")
               .join(roster, "player_id").select("league", "player_id", "position", "points"))
    return league_boards(spark, players, LEAGUES).withColumn("vor", r6("vor"))


@register("top_receivers_latest_season", O.with_base("latest AS (SELECT max(season) AS season FROM player_games)") + """
SELECT d.full_name AS player, n.n_name AS team, CAST(sum(coalesce(g.receptions, 0)) AS BIGINT) AS rec,
  CAST(sum(coalesce(g.rec_yards, 0)) AS BIGINT) AS rec_yds, CAST(sum(coalesce(g.rec_tds, 0)) AS BIGINT) AS rec_td
FROM player_games g JOIN latest l ON l.season = g.season JOIN player_dim d ON d.player_id = g.player_id JOIN nation n ON n.n_nationkey = d.nation_key
GROUP BY d.full_name, n.n_name ORDER BY rec_yds DESC, player, team LIMIT 10""")
def q_top_receivers(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-17: the latest season's ten players of most receiving yards, summed by name and team."""
    games = binding.player_games(spark, sf).select("player_id", "season", "receptions", "rec_yards", "rec_tds")
    latest = F.broadcast(binding.table(spark, sf, "orders").agg(F.max(binding.season_of("o_orderdate")).alias("season")))
    nation = binding.table(spark, sf, "nation").select(F.col("n_nationkey").alias("nation_key"), F.col("n_name").alias("team"))
    named = games.join(latest, "season").join(binding.player_dim(spark, sf), "player_id").join(nation, "nation_key")
    totals = [F.sum(F.coalesce(c, F.lit(0))).cast("long").alias(out) for c, out in (("receptions", "rec"), ("rec_yards", "rec_yds"), ("rec_tds", "rec_td"))]
    return named.groupBy(F.col("full_name").alias("player"), "team").agg(*totals).orderBy(F.desc("rec_yds"), "player", "team").limit(10)


@register("new_franchises", """
SELECT CAST(n_nationkey + 1 AS INTEGER) AS franchise_id, n_name AS canonical_name FROM nation
WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000)""")
def q_new_franchises(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-7 + SNK-4 + JOI-8: a franchise list against those already there; only unseen ids come out."""
    listed = binding.table(spark, sf, "nation").select((F.col("n_nationkey") + 1).alias("franchise_id"), F.col("n_name").alias("canonical_name"))
    there = binding.table(spark, sf, "supplier").where("s_acctbal > 9000").select((F.col("s_nationkey") + 1).cast("int").alias("franchise_id")).distinct()
    return marts.dim_franchises(listed, there)


@register("stored_weights_scored", O.with_base() + f"""
SELECT g.player_id, g.game_id, w.scoring_format, round({O.score_sql({s: 'g.' + c for s, c in ACTUAL_FIELDS}, 'g.position', 'w')}, 6) AS points
FROM player_games g, (SELECT scoring_format, {', '.join(f"coalesce(CASE WHEN scoring_format = 'ppr' AND '{c}' = 'rec_pts' THEN NULL ELSE {c} END, 0) AS {c}"
                                                        for c in rules.SCORING_COLUMNS)} FROM scoring_settings) w""")
def q_stored_weights(spark: SparkSession, sf: str) -> DataFrame:
    """DOM-2: every game under every stored format; a weight that is NULL in the table counts nothing."""
    stored = rules.scoring_settings(spark).withColumn("rec_pts", F.when(F.col("scoring_format") != "ppr", F.col("rec_pts")))
    weights = rules.load_scoring_settings(stored)
    games = binding.player_games(spark, sf).crossJoin(F.broadcast(weights))
    points = score_expr({s: c for s, c in ACTUAL_FIELDS}, F.col("position"))
    return games.select("player_id", "game_id", "scoring_format", r6(points).alias("points"))


@register("coverage_report", O.with_base() + """
SELECT position, count(*) AS games, printf('%.0f%%', round_even(100.0 * avg(CASE WHEN rec_tds > 0 THEN 1.0 ELSE 0.0 END), 0)) AS share_scoring
FROM player_games GROUP BY position""")
def q_coverage_report(spark: SparkSession, sf: str) -> DataFrame:
    """SCA-17: a share as percent text, by position."""
    games = binding.player_games(spark, sf)
    share = F.avg((F.coalesce("rec_tds", F.lit(0)) > 0).cast("double"))
    return games.groupBy("position").agg(F.count("*").alias("games"), percent_label(share).alias("share_scoring"))
