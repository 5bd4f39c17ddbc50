"""Registered queries over the graded tables: name -> (spark builder, oracle SQL).

Every builder takes (spark, sf_dir) and returns a lazy DataFrame that reads the
whole tables.  Doubles that come out of float arithmetic are rounded to 6
places (2 where the reference itself rounds) so both engines print the same
value whatever order their sums ran in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.plans import binding
from touchline.plans import oracle as O
from touchline.plans.projection import (
    ACTUAL_FIELDS, LINE_COLUMNS, LINE_SCORE_INPUTS, TOTAL_FIELDS, project_lines, score_expr,
    season_totals, snapshot_rows,
)
from touchline.session import cut_lineage
from touchline.sources import rules

SNAPSHOT_DATE = "2026-09-01"

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def r6(c):
    return F.round(c, 6)


def _latest_season(pg: DataFrame) -> DataFrame:
    """One-row relation holding the latest season (JOI-10: bounded by construction)."""
    return pg.agg(F.max("season").alias("latest_season"))


# ---------------------------------------------------------------------------
# Step 1: minimum slice — top entities of the latest season by points
# ---------------------------------------------------------------------------

_TOP_SQL = O.with_base(
    "latest AS (SELECT max(season) AS latest_season FROM player_games)",
    O.mode_cte("pos_mode", "player_games pg, latest", ["player_id"], "position",
               "pg.season = latest.latest_season"),
    f"""agg AS (
  SELECT pg.player_id,
    CAST(sum(coalesce(pg.receptions, 0)) AS BIGINT) AS rec,
    CAST(sum(coalesce(pg.rec_yards, 0)) AS BIGINT) AS rec_yds,
    CAST(sum(coalesce(pg.rec_tds, 0)) AS BIGINT) AS rec_td,
    {', '.join(f'CAST(sum(coalesce(pg.{src}, 0)) AS DOUBLE) AS {n}' for n, src in ACTUAL_FIELDS)}
  FROM player_games pg, latest WHERE pg.season = latest.latest_season
  GROUP BY pg.player_id
)""",
) + f"""
SELECT d.full_name AS player, n.n_name AS team, a.rec, a.rec_yds, a.rec_td,
  round({O.score_sql({s: 'a.' + s for s, _ in ACTUAL_FIELDS}, 'm.mode_value')}, 6) AS points
FROM agg a
JOIN pos_mode m ON m.player_id = a.player_id
JOIN player_dim d ON d.player_id = a.player_id
JOIN nation n ON n.n_nationkey = d.nation_key
JOIN scoring_settings ss ON ss.scoring_format = 'ppr'
ORDER BY points DESC, a.player_id
LIMIT 10"""


@register("top_entities_latest_season", _TOP_SQL)
def top_entities_latest_season(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-17 + JOI-10 + TOP-1 + DOM-1: the latest season's top 10 by ppr points."""
    pg = binding.player_games_table(spark, sf)
    latest = _latest_season(pg)
    season = pg.crossJoin(F.broadcast(latest)).filter(F.col("season") == F.col("latest_season"))
    agg = season.groupBy("player_id").agg(
        F.mode("position", True).alias("position"),
        F.sum(F.coalesce("receptions", F.lit(0))).cast("long").alias("rec"),
        F.sum(F.coalesce("rec_yards", F.lit(0))).cast("long").alias("rec_yds"),
        F.sum(F.coalesce("rec_tds", F.lit(0))).cast("long").alias("rec_td"),
        *[F.sum(F.coalesce(F.col(src), F.lit(0))).cast("double").alias(n) for n, src in ACTUAL_FIELDS],
    )
    ppr = F.broadcast(rules.scoring_settings(spark, ["ppr"]))
    dim = binding.player_dim(spark, sf)
    nation = binding.table(spark, sf, "nation")
    scored = (agg.crossJoin(ppr)
              .withColumn("points", r6(score_expr({s: s for s, _ in ACTUAL_FIELDS}, F.col("position")))))
    return (scored.join(dim.select("player_id", "full_name", "nation_key"), "player_id")
            .join(F.broadcast(nation), F.col("nation_key") == F.col("n_nationkey"))
            .orderBy(F.col("points").desc(), F.col("player_id"))
            .limit(10)
            .select(F.col("full_name").alias("player"), F.col("n_name").alias("team"),
                    "rec", "rec_yds", "rec_td", "points"))


# ---------------------------------------------------------------------------
# Step 5: season totals, baselines, projections, snapshot rows
# ---------------------------------------------------------------------------

_TOTAL_NAMES = [n for n, _ in TOTAL_FIELDS]


@register("season_totals", O.with_base(O.season_totals_ctes()) + f"""
SELECT player_id, season, position, games, {', '.join(_TOTAL_NAMES)} FROM season_totals""")
def q_season_totals(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-3 + AGG-5 + FLT-3: per player-season totals over skill-position games."""
    return season_totals(binding.player_games(spark, sf))


@register("baselines", O.with_base(O.season_totals_ctes(), O.projection_ctes()) + f"""
SELECT target, position, {', '.join(f'round(b_{n}, 6) AS b_{n}' for n, *_ in O.BASELINE_RATES)}
FROM baselines""")
def q_baselines(spark: SparkSession, sf: str) -> DataFrame:
    """DOM-3 + AGG-8: position baselines for every target season the data supports."""
    from touchline.plans.projection import _window_rows, position_baselines
    totals = season_totals(binding.player_games(spark, sf))
    b = position_baselines(_window_rows(totals, None).filter(F.col("games") > 0))
    return b.select("target", "position", *[r6(c).alias(c) for c in b.columns if c.startswith("b_")])


_LINE_OUT = ["games"] + list(LINE_COLUMNS) + ["interceptions", "fumbles_lost", "two_pt"]


@register("project_entities", O.with_base(O.season_totals_ctes(), O.projection_ctes()) + f"""
SELECT season, player_id, position, {', '.join(f'round({c}, 6) AS {c}' for c in _LINE_OUT)}
FROM lines""")
def q_project_entities(spark: SparkSession, sf: str) -> DataFrame:
    """DOM-4..DOM-8 + WIN-6/7 + AGG-9: projected lines for every target season at once."""
    lines = project_lines(season_totals(binding.player_games(spark, sf)))
    return lines.select("season", "player_id", "position", *[r6(c).alias(c) for c in _LINE_OUT])


def _next_season_lines(spark: SparkSession, sf: str) -> DataFrame:
    pg = binding.player_games_table(spark, sf)
    target = _latest_season(pg).select((F.col("latest_season") + 1).alias("target"))
    return project_lines(season_totals(pg), targets=target)


_SNAP_COLS = ["projected_points", "floor", "ceiling"] + list(LINE_COLUMNS)
_BAND_LO, _BAND_HI = O.band_sql("x.points_raw", "x.position", "x.games")


@register("bands", O.with_base(
    O.season_totals_ctes(),
    O.projection_ctes("target = (SELECT max(season) + 1 FROM player_games)"),
    f"""priced AS (
  SELECT l.*, ss.scoring_format, {O.score_sql(O.LINE_INPUTS, 'l.position')} AS points_raw
  FROM lines l CROSS JOIN scoring_settings ss
)""") + f"""
SELECT DATE '{SNAPSHOT_DATE}' AS snapshot_date, 'my_model_v1' AS source, x.player_id,
  CAST(x.season AS INTEGER) AS season, 0 AS week, x.scoring_format,
  round(x.points_raw, 2) AS projected_points, round({_BAND_LO}, 2) AS floor, round({_BAND_HI}, 2) AS ceiling,
  {', '.join(f'round(x.{c}, 2) AS {c}' for c in LINE_COLUMNS)}, x.position, x.games
FROM priced x""")
def q_bands(spark: SparkSession, sf: str) -> DataFrame:
    """DOM-9 + DOM-10 + JOI-13: next-season snapshot rows for every scoring format."""
    return snapshot_rows(_next_season_lines(spark, sf), rules.scoring_settings(spark), SNAPSHOT_DATE)


@register("score_formats", O.with_base(
    O.season_totals_ctes("st", "TRUE", fields=ACTUAL_FIELDS)) + f"""
SELECT st.player_id, st.season, ss.scoring_format,
  round({O.score_sql({s: 'st.' + s for s, _ in ACTUAL_FIELDS}, 'st.position')}, 6) AS points
FROM st CROSS JOIN scoring_settings ss""")
def q_score_formats(spark: SparkSession, sf: str) -> DataFrame:
    """DOM-1 + DOM-2 + JOI-13: every player-season priced under every format."""
    st = season_totals(binding.player_games(spark, sf), positions=None, fields=ACTUAL_FIELDS)
    x = st.crossJoin(F.broadcast(rules.scoring_settings(spark)))
    return x.select("player_id", "season", "scoring_format",
                    r6(score_expr({s: s for s, _ in ACTUAL_FIELDS}, F.col("position"))).alias("points"))


# ---------------------------------------------------------------------------
# Step 6-7: grading and calibration
# ---------------------------------------------------------------------------

from touchline.plans import grading  # noqa: E402

_METRIC_COLS = ("mae", "rmse", "bias", "pearson", "spearman", "band_pct")


def _snap_ctes(target_sql: str, fmt: str | None = None) -> list[str]:
    """SQL: season totals -> lines for ``target_sql`` -> priced, rounded snapshot rows ``snap``."""
    lo, hi = O.band_sql("x.points_raw", "x.position", "x.games")
    where = f"WHERE ss.scoring_format = '{fmt}'" if fmt else ""
    return [
        O.season_totals_ctes(),
        O.projection_ctes(f"target = ({target_sql})"),
        f"""priced AS (
  SELECT l.*, ss.scoring_format, {O.score_sql(O.LINE_INPUTS, 'l.position')} AS points_raw
  FROM lines l CROSS JOIN scoring_settings ss {where}
)""",
        f"""snap AS (
  SELECT x.player_id, CAST(x.season AS INTEGER) AS season, x.scoring_format,
    round(x.points_raw, 2) AS projected_points, round({lo}, 2) AS floor, round({hi}, 2) AS ceiling,
    x.position AS line_position, x.games
  FROM priced x
)""",
    ]


def _act_cte(fmt: str) -> list[str]:
    return [
        O.season_totals_ctes("act_totals", "week <= 18", fields=ACTUAL_FIELDS),
        f"""act AS (
  SELECT a.player_id, a.season, coalesce(a.position, 'UNK') AS position, a.games,
    {O.score_sql({s: 'a.' + s for s, _ in ACTUAL_FIELDS}, "coalesce(a.position, 'UNK')")} AS actual
  FROM act_totals a JOIN scoring_settings ss ON ss.scoring_format = '{fmt}'
)""",
    ]


_EVAL_CTE = """evals AS (
  SELECT p.player_id, coalesce(a.position, 'UNK') AS position, p.projected_points AS projected,
    coalesce(a.actual, CAST('0.0' AS DOUBLE)) AS actual, p.floor, p.ceiling,
    CAST(coalesce(a.games, 0) AS BIGINT) AS games
  FROM snap p LEFT JOIN act a ON a.player_id = p.player_id AND a.season = p.season
  WHERE coalesce(a.games, 0) >= 1
)"""

_RANK_CTE = """ev_r AS (
  SELECT *,
    CAST(rank() OVER (ORDER BY projected) AS DOUBLE) + CAST(count(*) OVER (PARTITION BY projected) - 1 AS DOUBLE) / 2 AS rp_all,
    CAST(rank() OVER (ORDER BY actual) AS DOUBLE) + CAST(count(*) OVER (PARTITION BY actual) - 1 AS DOUBLE) / 2 AS ra_all,
    CAST(rank() OVER (PARTITION BY position ORDER BY projected) AS DOUBLE)
      + CAST(count(*) OVER (PARTITION BY position, projected) - 1 AS DOUBLE) / 2 AS rp_pos,
    CAST(rank() OVER (PARTITION BY position ORDER BY actual) AS DOUBLE)
      + CAST(count(*) OVER (PARTITION BY position, actual) - 1 AS DOUBLE) / 2 AS ra_pos
  FROM evals
)"""


def _pearson_sql(x: str, y: str) -> str:
    return (f"CASE WHEN count(*) < 2 THEN CAST('0.0' AS DOUBLE) ELSE coalesce(covar_pop({x}, {y}) / "
            f"nullif(sqrt(var_pop({x}) * var_pop({y})), 0), CAST('0.0' AS DOUBLE)) END")


def _metrics_sql(rx: str, ry: str) -> str:
    z = "CAST('0.0' AS DOUBLE)"
    return f"""count(*) AS n,
    round(coalesce(avg(abs(projected - actual)), {z}), 6) AS mae,
    round(coalesce(sqrt(avg((projected - actual) * (projected - actual))), {z}), 6) AS rmse,
    round(coalesce(avg(projected - actual), {z}), 6) AS bias,
    round({_pearson_sql('projected', 'actual')}, 6) AS pearson,
    round({_pearson_sql(rx, ry)}, 6) AS spearman,
    round(coalesce(avg(CASE WHEN floor <= actual AND actual <= ceiling THEN 1.0 ELSE 0.0 END), {z}), 6) AS band_pct"""


_POS_ORDER_SQL = "CASE position WHEN 'QB' THEN 0 WHEN 'RB' THEN 1 WHEN 'WR' THEN 2 WHEN 'TE' THEN 3 ELSE 4 END"
_BACKTEST_TARGET = "SELECT max(season) - 1 FROM player_games"


def _evals(spark: SparkSession, sf: str, fmt: str = "ppr", min_games: int = 1) -> DataFrame:
    """Backtest input: the snapshot for the last complete season vs what happened."""
    pg = binding.player_games_table(spark, sf)
    target = _latest_season(pg).select((F.col("latest_season") - 1).alias("target"))
    settings = rules.scoring_settings(spark, [fmt])
    snap = snapshot_rows(project_lines(season_totals(pg), targets=target), settings, SNAPSHOT_DATE)
    acts = grading.actual_points(pg, settings)
    # the graded pairs are a table of their own: materialise once for the rank passes
    return cut_lineage(grading.build_evals(snap, acts, min_games=min_games))


@register("grade_overall_by_group", O.with_base(
    *_snap_ctes(_BACKTEST_TARGET, "ppr"), *_act_cte("ppr"), _EVAL_CTE, _RANK_CTE) + f"""
SELECT 'ALL' AS label, {_metrics_sql('rp_all', 'ra_all')}, -1 AS display_order FROM ev_r
UNION ALL
SELECT position AS label, {_metrics_sql('rp_pos', 'ra_pos')}, {_POS_ORDER_SQL} AS display_order
FROM ev_r GROUP BY position""")
def q_grade(spark: SparkSession, sf: str) -> DataFrame:
    """DOM-11 + AGG-10..13 + WIN-5 + TOP-3 + JOI-11: backtest metrics, overall and per position."""
    g = grading.grade(_evals(spark, sf))
    return g.select("label", "n", *[r6(c).alias(c) for c in _METRIC_COLS], "display_order")


@register("eval_ranks", O.with_base(
    *_snap_ctes(_BACKTEST_TARGET, "ppr"), *_act_cte("ppr"), _EVAL_CTE, _RANK_CTE) + """
SELECT player_id, position, projected, round(actual, 6) AS actual, rp_all, ra_all, rp_pos, ra_pos FROM ev_r""")
def q_eval_ranks(spark: SparkSession, sf: str) -> DataFrame:
    """WIN-5: average (tie-shared) ranks, global and within position, via ordered scans."""
    from touchline.operators.scan import rank_table
    e = _evals(spark, sf)
    r = e = cut_lineage(e)
    for value, by, out in (("projected", [], "rp_all"), ("actual", [], "ra_all"), ("projected", ["position"], "rp_pos"), ("actual", ["position"], "ra_pos")):
        r = r.join(rank_table(e, value, by, out), [*by, value], "left")
    return r.select("player_id", "position", "projected", r6("actual").alias("actual"),
                    "rp_all", "ra_all", "rp_pos", "ra_pos")


@register("biggest_misses", O.with_base(
    *_snap_ctes(_BACKTEST_TARGET, "ppr"), *_act_cte("ppr"), _EVAL_CTE) + """
SELECT player_id, position, projected, round(actual, 6) AS actual, round(projected - actual, 6) AS error
FROM evals ORDER BY abs(projected - actual) DESC, player_id LIMIT 10""")
def q_biggest_misses(spark: SparkSession, sf: str) -> DataFrame:
    """TOP-2: the ten largest absolute errors of the backtest."""
    m = grading.biggest_misses(_evals(spark, sf), 10)
    return m.select("player_id", "position", "projected", r6("actual").alias("actual"),
                    r6("error").alias("error"))


_SWEEP_CTE = f"""sweep AS (
  SELECT unnest(range(greatest(lo + {rules.MIN_LOOKBACK}, hi - {rules.DEFAULT_NUM_SEASONS - 1}), hi + 1)) AS season
  FROM (SELECT min(season) AS lo, max(season) AS hi FROM player_games) b
)"""
_TARGET_COV = grading.target_coverage()
_SAMPLES_CTE = f"""samples AS (
  SELECT * FROM (
    SELECT x.season, x.player_id, coalesce(a.position, x.position) AS position,
      coalesce(a.games, 0) AS played,
      CASE WHEN x.points_raw > 0 THEN abs(coalesce(a.actual, CAST('0.0' AS DOUBLE)) / x.points_raw - CAST('1.0' AS DOUBLE))
        / sqrt(CAST('17.0' AS DOUBLE) / greatest(CAST('1.0' AS DOUBLE), x.games)) END AS r
    FROM priced x LEFT JOIN act a ON a.player_id = x.player_id AND a.season = x.season
  ) s WHERE played >= 0 AND r IS NOT NULL
)"""
_CAL_CTES = [
    _SWEEP_CTE, O.season_totals_ctes(), O.projection_ctes("target IN (SELECT season FROM sweep)"),
    f"""priced AS (
  SELECT l.*, {O.score_sql(O.LINE_INPUTS, 'l.position')} AS points_raw
  FROM lines l JOIN scoring_settings ss ON ss.scoring_format = 'ppr'
)""",
    *_act_cte("ppr"), _SAMPLES_CTE,
    f"""recs AS (
  SELECT position, count(*) AS n,
    {O.case_map('position', rules.POSITION_COV, O.d(rules.DEFAULT_COV))} AS current_cov,
    avg(CASE WHEN r <= {O.d(rules.BAND_Z)} * {O.case_map('position', rules.POSITION_COV, O.d(rules.DEFAULT_COV))}
        THEN 1.0 ELSE 0.0 END) AS current_coverage,
    quantile_cont(r, {O.d(_TARGET_COV)}) / {O.d(rules.BAND_Z)} AS recommended_cov,
    {O.d(_TARGET_COV)} AS target_coverage,
    {_POS_ORDER_SQL} AS display_order
  FROM samples GROUP BY position
)""",
]


def _recs(spark: SparkSession, sf: str) -> DataFrame:
    pg = binding.player_games_table(spark, sf)
    seasons = grading.projectable_seasons(pg)
    samples = grading.calibration_samples(pg, rules.scoring_settings(spark, ["ppr"]), seasons, min_games=0)
    return grading.recommend_covs(cut_lineage(samples))


@register("calibrate_cov", O.with_base(*_CAL_CTES) + """
SELECT position, n, current_cov, round(current_coverage, 6) AS current_coverage,
  round(recommended_cov, 6) AS recommended_cov, target_coverage, display_order FROM recs""")
def q_calibrate(spark: SparkSession, sf: str) -> DataFrame:
    """DOM-12..14 + AGG-14/15 + TOP-4: recalibrated band covs over the last four projectable seasons."""
    r = _recs(spark, sf)
    return r.select("position", "n", "current_cov", r6("current_coverage").alias("current_coverage"),
                    r6("recommended_cov").alias("recommended_cov"), "target_coverage", "display_order")


@register("cov_merge", O.with_base(*_CAL_CTES, f"""model_covs AS (SELECT * FROM (VALUES {', '.join(
    f"('{p}', {O.d(v)}, {i})" for i, (p, v) in enumerate(rules.POSITION_COV.items()))}) AS t(position, cov, model_order))""") + """
SELECT m.position, round(coalesce(r.recommended_cov, m.cov), 6) AS cov, m.model_order
FROM model_covs m LEFT JOIN recs r ON r.position = m.position""")
def q_cov_merge(spark: SparkSession, sf: str) -> DataFrame:
    """DOM-15: the model's cov table with recommendations applied; unknown positions dropped."""
    m = grading.merge_covs(spark, _recs(spark, sf))
    return m.select("position", r6("cov").alias("cov"), "model_order")


# ---------------------------------------------------------------------------
# Step 8: draft board
# ---------------------------------------------------------------------------

from touchline.plans import board as board_plan  # noqa: E402

_LEAGUE = rules.DEFAULT_LEAGUE
_NEXT_TARGET = "SELECT max(season) + 1 FROM player_games"


def _board_players(spark: SparkSession, sf: str) -> DataFrame:
    """JOI-12 + FLT-3: next-season ppr projections joined to the dimension's position."""
    pg = binding.player_games_table(spark, sf)
    target = _latest_season(pg).select((F.col("latest_season") + 1).alias("target"))
    snap = snapshot_rows(project_lines(season_totals(pg), targets=target),
                         rules.scoring_settings(spark, [_LEAGUE["scoring_format"]]), SNAPSHOT_DATE)
    dim = binding.player_dim(spark, sf).select("player_id", "position")
    return (snap.select("player_id", F.col("projected_points").alias("points"), "floor", "ceiling")
            .join(dim, "player_id").filter(F.col("position").isin(list(rules.SKILL_POSITIONS))))


def _board_sql_ctes(league: dict = _LEAGUE) -> list[str]:
    roster, teams = league["roster"], league["teams"]
    base = board_plan.base_counts(roster, teams)
    ctes = [
        *_snap_ctes(_NEXT_TARGET, league["scoring_format"]),
        f"""bp AS (
  SELECT s.player_id, d.position, s.projected_points AS points, s.floor, s.ceiling
  FROM snap s JOIN player_dim d ON d.player_id = s.player_id WHERE d.position IN ({O.SKILL})
)""",
        """pranked AS (SELECT *, row_number() OVER (PARTITION BY position ORDER BY points DESC, player_id) AS prank FROM bp)""",
        "counts0 AS (SELECT * FROM (VALUES " + ", ".join(f"('{p}', {n})" for p, n in base.items())
        + ") AS t(position, starters))",
    ]
    k = 0
    for key, eligible in rules.FLEX_KEYS:
        slots = int(roster.get(key, 0)) * teams
        if slots <= 0:
            continue
        eidx = "CASE " + " ".join(f"WHEN c.position = '{p}' THEN {i}" for i, p in enumerate(eligible)) + " END"
        elig = ", ".join(f"'{p}'" for p in eligible)
        ctes.append(f"""pick{k + 1} AS (
  SELECT position, count(*) AS add FROM (
    SELECT c.position, row_number() OVER (ORDER BY c.points DESC, {eidx}, c.prank) AS o
    FROM pranked c JOIN counts{k} k ON k.position = c.position
    WHERE c.position IN ({elig}) AND c.prank > k.starters
  ) z WHERE o <= {slots} GROUP BY position
),
counts{k + 1} AS (
  SELECT k.position, k.starters + coalesce(p.add, 0) AS starters
  FROM counts{k} k LEFT JOIN pick{k + 1} p ON p.position = k.position
)""")
        k += 1
    ctes.append(f"starters AS (SELECT position, CAST(starters AS BIGINT) AS starters FROM counts{k})")
    ctes.append("""repl AS (
  SELECT w.position, coalesce(p.points, 0.0) AS replacement FROM (
    SELECT s.position, least(coalesce(st.starters, 0) + 1, s.pool_size) AS want
    FROM (SELECT position, count(*) AS pool_size FROM bp GROUP BY position) s
    LEFT JOIN starters st ON st.position = s.position
  ) w LEFT JOIN pranked p ON p.position = w.position AND p.prank = w.want
)""")
    ctes.append(f"""ranked_board AS (
  SELECT b.*, b.points - coalesce(r.replacement, 0.0) AS vor
  FROM bp b LEFT JOIN repl r ON r.position = b.position
),
board AS (
  SELECT *, row_number() OVER (ORDER BY vor DESC, player_id) AS overall_rank,
    row_number() OVER (PARTITION BY position ORDER BY vor DESC, player_id) AS position_rank,
    lag(vor) OVER (PARTITION BY position ORDER BY vor DESC, player_id) - vor AS gap
  FROM ranked_board
),
medians AS (SELECT position, median(gap) AS median_gap FROM board WHERE gap > 0 GROUP BY position),
tiered AS (
  SELECT b.*, coalesce(st.starters, 0) AS starters,
    1 + sum(CASE WHEN m.median_gap IS NOT NULL AND b.gap > {O.d(rules.TIER_FACTOR)} * m.median_gap THEN 1 ELSE 0 END)
      OVER (PARTITION BY b.position ORDER BY b.vor DESC, b.player_id ROWS UNBOUNDED PRECEDING) AS tier
  FROM board b LEFT JOIN medians m ON m.position = b.position LEFT JOIN starters st ON st.position = b.position
)""")
    return ctes


@register("starter_counts", O.with_base(*_board_sql_ctes()) + "\nSELECT position, starters FROM starters")
def q_starter_counts(spark: SparkSession, sf: str) -> DataFrame:
    """DOM-16: leaguewide starters per position after greedy flex allocation."""
    players = cut_lineage(_board_players(spark, sf))
    return board_plan.starter_counts(spark, players, _LEAGUE["roster"], _LEAGUE["teams"])


@register("replacement", O.with_base(*_board_sql_ctes()) + "\nSELECT position, replacement FROM repl")
def q_replacement(spark: SparkSession, sf: str) -> DataFrame:
    """DOM-17 / WIN-11: replacement points per position."""
    players = cut_lineage(_board_players(spark, sf))
    roster, teams = _LEAGUE["roster"], _LEAGUE["teams"]
    st = board_plan.starter_counts(spark, players, roster, teams)
    return board_plan.replacement_levels(players, st, board_plan.candidate_depth(roster, teams))


@register("vor_board", O.with_base(*_board_sql_ctes()) + """
SELECT player_id, position, points, floor, ceiling, round(vor, 6) AS vor,
  overall_rank, position_rank, CAST(tier AS INTEGER) AS tier, position_rank <= starters AS starter
FROM tiered""")
def q_vor_board(spark: SparkSession, sf: str) -> DataFrame:
    """DOM-18 + WIN-8..10 + AGG-16: the full value-over-replacement board with tiers."""
    b = board_plan.build_board(spark, _board_players(spark, sf), _LEAGUE["roster"], _LEAGUE["teams"])
    return b.select("player_id", "position", "points", "floor", "ceiling", r6("vor").alias("vor"),
                    "overall_rank", "position_rank", "tier", "starter")


@register("board_flex_view", O.with_base(*_board_sql_ctes()) + """
SELECT player_id, position, overall_rank, CAST(tier AS INTEGER) AS tier,
  position || CAST(position_rank AS VARCHAR) AS pos_label, position || '-' || CAST(tier AS VARCHAR) AS tier_label
FROM tiered WHERE upper(position) IN ('RB', 'WR', 'TE')""")
def q_board_flex(spark: SparkSession, sf: str) -> DataFrame:
    """FLT-8 + SCA-17: the board filtered to FLEX with 'RB7' / 'RB-2' labels."""
    b = board_plan.build_board(spark, _board_players(spark, sf), _LEAGUE["roster"], _LEAGUE["teams"])
    b = board_plan.filter_position(b, "flex")
    return b.select("player_id", "position", "overall_rank", "tier",
                    F.concat("position", F.col("position_rank").cast("string")).alias("pos_label"),
                    F.concat_ws("-", "position", F.col("tier").cast("string")).alias("tier_label"))


# ---------------------------------------------------------------------------
# Summaries and extensions
# ---------------------------------------------------------------------------

from touchline.functions.scalars import id_label  # noqa: E402
from touchline.plans import feeds  # noqa: E402
from touchline.plans.feeds import SQL_FEEDS  # noqa: E402


def _hub_names(spark: SparkSession, sf: str) -> DataFrame:
    """Display names from the latest hub snapshot, keyed by the entity id."""
    from touchline.plans import identity
    latest = identity.latest_snapshot_rows(identity.stage_hub(feeds.raw_hub(spark, sf)))
    return latest.select(F.expr("substr(sleeper_id, 2)").cast("long").alias("player_id"), "full_name")


@register("projection_summary", O.with_base(
    O.season_totals_ctes(), O.projection_ctes(f"target = ({_NEXT_TARGET})"),
    f"""priced AS (
  SELECT l.*, {O.score_sql(O.LINE_INPUTS, 'l.position')} AS pts
  FROM lines l JOIN scoring_settings ss ON ss.scoring_format = 'ppr'
)""", SQL_FEEDS.strip()) + """
SELECT coalesce(h.full_name, '#' || CAST(p.player_id AS VARCHAR)) AS player, p.position AS pos, p.games AS g,
  round(p.pts, 1) AS pts, round(p.proj_pass_yards, 0) AS pass_yd, round(p.proj_rush_yards, 0) AS rush_yd,
  round(p.proj_receptions, 1) AS rec, round(p.proj_rec_yards, 0) AS rec_yd,
  round(p.proj_pass_tds + p.proj_rush_tds + p.proj_rec_tds, 1) AS tds
FROM priced p LEFT JOIN hub_latest h ON CAST(substr(h.sleeper_id, 2) AS BIGINT) = p.player_id
ORDER BY p.pts DESC, p.player_id LIMIT 25""")
def q_projection_summary(spark: SparkSession, sf: str) -> DataFrame:
    """TOP-1 + JOI-14 + SCA-16: the top 25 next-season ppr lines, '#<id>' when no name is known."""
    lines = _next_season_lines(spark, sf).crossJoin(F.broadcast(rules.scoring_settings(spark, ["ppr"])))
    lines = lines.withColumn("pts", score_expr(LINE_SCORE_INPUTS, F.col("position")))
    top = lines.orderBy(F.col("pts").desc(), F.col("player_id")).limit(25)
    named = top.join(_hub_names(spark, sf), "player_id", "left")
    return named.select(
        id_label(F.col("full_name"), F.col("player_id")).alias("player"), F.col("position").alias("pos"),
        F.col("games").alias("g"), F.round("pts", 1).alias("pts"),
        F.round("proj_pass_yards", 0).alias("pass_yd"), F.round("proj_rush_yards", 0).alias("rush_yd"),
        F.round("proj_receptions", 1).alias("rec"), F.round("proj_rec_yards", 0).alias("rec_yd"),
        F.round(F.col("proj_pass_tds") + F.col("proj_rush_tds") + F.col("proj_rec_tds"), 1).alias("tds"))


@register("calibration_samples_per_season", O.with_base(*_CAL_CTES) + """
SELECT season, count(*) AS samples FROM samples GROUP BY season""")
def q_samples_per_season(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-18: calibration samples collected per swept season."""
    pg = binding.player_games_table(spark, sf)
    s = grading.calibration_samples(pg, rules.scoring_settings(spark, ["ppr"]), grading.projectable_seasons(pg))
    return s.groupBy("season").agg(F.count(F.lit(1)).alias("samples"))


@register("player_role_history", O.with_base(
    O.mode_cte("wk_mode", "player_games", ["player_id", "season", "week"], "position")) + """
SELECT player_id, season, position, min(week) AS week_start, max(week) AS week_end, count(*) AS weeks
FROM (
  SELECT player_id, season, week, mode_value AS position,
    row_number() OVER (PARTITION BY player_id, season ORDER BY week)
      - row_number() OVER (PARTITION BY player_id, season, mode_value ORDER BY week) AS island
  FROM wk_mode
) x GROUP BY player_id, season, position, island""")
def q_role_history(spark: SparkSession, sf: str) -> DataFrame:
    """Extension (declared, never built by the reference): gaps-and-islands history of a
    player's weekly role; windows are per (player, season), so groups stay small."""
    from pyspark.sql import Window
    wk = binding.player_games(spark, sf).groupBy("player_id", "season", "week").agg(
        F.mode("position", True).alias("position"))
    w1 = Window.partitionBy("player_id", "season").orderBy("week")
    w2 = Window.partitionBy("player_id", "season", "position").orderBy("week")
    isl = wk.withColumn("island", F.row_number().over(w1) - F.row_number().over(w2))
    return isl.groupBy("player_id", "season", "position", "island").agg(
        F.min("week").alias("week_start"), F.max("week").alias("week_end"),
        F.count(F.lit(1)).alias("weeks")).drop("island")
