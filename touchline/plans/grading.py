"""Grade projection snapshots against realised seasons and recalibrate the band.

DOM-11 backtest, DOM-12 normalised residual, DOM-13 cov recommendation,
DOM-14 calibration sweep, DOM-15 cov-table merge.  Seasons are a column, so a
sweep over many seasons is one job; nothing is collected.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.scalars import position_order
from touchline.operators.scan import exact_quantile, rank_table
from touchline.operators.stats import coverage, error_metrics, safe_pearson
from touchline.plans.projection import (
    ACTUAL_FIELDS, ACTUAL_SCORE_INPUTS, LINE_SCORE_INPUTS, project_lines, score_expr, season_totals,
)
from touchline.session import cut_lineage
from touchline.sources import rules


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------------------
# Inputs
# ---------------------------------------------------------------------------

def latest_snapshot(snapshots: DataFrame, keys=("season", "source", "scoring_format")) -> DataFrame:
    """FLT-7: keep the rows of the latest season-long snapshot per key.

    A per-key max (tiny, one row per key) joined back; no window over the snapshot
    table, so a key owning most rows does not become one task.
    """
    keys = list(keys)
    season_long = snapshots.filter(F.col("week") == 0)
    latest = season_long.groupBy(*keys).agg(F.max("snapshot_date").alias("snapshot_date"))
    return season_long.join(latest, keys + ["snapshot_date"], "left_semi")


def actual_points(games: DataFrame, settings: DataFrame, *,
                  max_week: int = rules.REGULAR_SEASON_MAX_WEEK) -> DataFrame:
    """AGG-4: realised regular-season totals per (player, season), priced by each format.

    No position filter; the position is the season's mode, 'UNK' when absent.
    """
    st = season_totals(games, positions=None, max_week=max_week, fields=ACTUAL_FIELDS)
    st = st.withColumn("position", F.coalesce(F.col("position"), F.lit("UNK")))
    x = st.crossJoin(F.broadcast(settings))
    return x.select("player_id", "season", "scoring_format", "position", "games",
                    score_expr(ACTUAL_SCORE_INPUTS, F.col("position")).alias("actual"))


def build_evals(projections: DataFrame, actuals: DataFrame, *, min_games: int = 1,
                keys=("player_id", "season", "scoring_format")) -> DataFrame:
    """JOI-11: projection LEFT JOIN actual; missing actual -> 0 points, 0 games, 'UNK'."""
    keys = list(keys)
    a = actuals.select(*keys, F.col("position").alias("a_position"),
                       F.col("games").alias("a_games"), "actual")
    j = projections.join(a, keys, "left")
    return j.select(
        *keys,
        F.coalesce(F.col("a_position"), F.lit("UNK")).alias("position"),
        F.col("projected_points").alias("projected"),
        F.coalesce(F.col("actual"), F.lit(0.0)).alias("actual"),
        "floor", "ceiling",
        F.coalesce(F.col("a_games"), F.lit(0)).cast("long").alias("games"),
    ).filter(F.col("games") >= min_games)


# ---------------------------------------------------------------------------
# DOM-11: metrics overall and per position
# ---------------------------------------------------------------------------

def grade(evals: DataFrame, group: tuple[str, ...] = ()) -> DataFrame:
    """AGG-10..13 + WIN-5 + TOP-3: one 'ALL' row plus one row per position.

    Overall and per-position rows come from one ROLLUP pass; Spearman needs ranks
    relative to the row's own group, so both rank pairs are carried and the one
    matching ``grouping(position)`` is kept.  An 'ALL' row exists even for an
    empty input (all metrics 0), as the reference returns.
    """
    group = list(group)
    evals = cut_lineage(evals)  # four rank tables and the rollup read it: materialise once
    r = evals
    for value, by, out in (("projected", group, "rp_all"), ("actual", group, "ra_all"),
                           ("projected", group + ["position"], "rp_pos"), ("actual", group + ["position"], "ra_pos")):
        r = r.join(rank_table(evals, value, by, out), [*by, value], "left")  # each table from the pairs alone
    agg = r.rollup(*group, "position").agg(
        F.grouping("position").alias("_g"),
        *error_metrics("projected", "actual", "floor", "ceiling"),
        safe_pearson("projected", "actual").alias("pearson"),
        safe_pearson("rp_all", "ra_all").alias("_sp_all"),
        safe_pearson("rp_pos", "ra_pos").alias("_sp_pos"),
    )
    if group:
        agg = agg.filter(F.expr(" and ".join(f"grouping({g}) = 0" for g in group)))
    n_lt2 = F.col("n") < 2
    out = agg.select(
        *group,
        F.when(F.col("_g") == 1, F.lit("ALL")).otherwise(F.col("position")).alias("label"),
        "n", "mae", "rmse", "bias",
        F.when(n_lt2, F.lit(0.0)).otherwise(F.col("pearson")).alias("pearson"),
        F.when(n_lt2, F.lit(0.0)).otherwise(
            F.when(F.col("_g") == 1, F.col("_sp_all")).otherwise(F.col("_sp_pos"))).alias("spearman"),
        "band_pct",
        F.when(F.col("_g") == 1, F.lit(-1)).otherwise(position_order(F.col("position"))).alias("display_order"),
    )
    if group:
        return out
    spark = evals.sparkSession
    overall = spark.range(1).select(F.lit("ALL").alias("label")).join(
        out.filter(F.col("display_order") == -1), "label", "left")
    zero = {"n": F.lit(0).cast("long")}
    overall = overall.select(
        "label",
        *[F.coalesce(F.col(c), zero.get(c, F.lit(0.0))).alias(c)
          for c in ("n", "mae", "rmse", "bias", "pearson", "spearman", "band_pct")],
        F.lit(-1).alias("display_order"))
    return overall.unionByName(out.filter(F.col("display_order") >= 0))


def biggest_misses(evals: DataFrame, n: int) -> DataFrame:
    """TOP-2: the n largest absolute errors, worst first (ties by player)."""
    e = evals.withColumn("error", F.col("projected") - F.col("actual"))
    return e.orderBy(F.abs("error").desc(), F.col("player_id")).limit(n)


# ---------------------------------------------------------------------------
# DOM-12..DOM-15: band calibration
# ---------------------------------------------------------------------------

def normalized_residual(projected, actual, games, max_games: float = rules.MAX_GAMES) -> Column:
    """DOM-12: |actual/projected - 1| / sqrt(max/max(1, games)); NULL if projected <= 0."""
    p = _c(projected)
    scale = F.sqrt(F.lit(float(max_games)) / F.greatest(F.lit(1.0), _c(games)))
    return F.when(p > 0, F.abs(_c(actual) / p - F.lit(1.0)) / scale)


def target_coverage(z: float = rules.BAND_Z) -> float:
    """The nominal coverage of a +/- z band, erf(z/sqrt 2), computed at plan time."""
    return math.erf(z / math.sqrt(2.0))


def _cov_lookup(position: Column, covs: dict, default: float) -> Column:
    expr = None
    for p, v in covs.items():
        expr = F.when(position == p, F.lit(v)) if expr is None else expr.when(position == p, F.lit(v))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def recommend_covs(samples: DataFrame, *, z: float = rules.BAND_Z, covs: dict | None = None,
                   default_cov: float = rules.DEFAULT_COV) -> DataFrame:
    """DOM-13: per position n, current cov and coverage, recommended cov = quantile(r, t)/z."""
    covs = rules.POSITION_COV if covs is None else covs
    target = target_coverage(z)
    cur = _cov_lookup(F.col("position"), covs, default_cov)
    base = samples.groupBy("position").agg(
        F.count(F.lit(1)).alias("n"),
        coverage("r", cur, z).alias("current_coverage"),
    )
    ties = [c for c in ("season", "player_id") if c in samples.columns]
    q = exact_quantile(samples, "r", target, ["position"], "q", tie_breaker=ties)
    rec = (F.col("q") / F.lit(z)) if z else F.lit(0.0)
    return base.join(q, "position", "left").select(
        "position", "n", cur.alias("current_cov"), "current_coverage",
        rec.alias("recommended_cov"), F.lit(target).alias("target_coverage"),
        position_order(F.col("position")).alias("display_order"),
    )


def projectable_seasons(games: DataFrame, n: int = rules.DEFAULT_NUM_SEASONS,
                        lookback: int = rules.MIN_LOOKBACK) -> DataFrame:
    """TOP-4: the last n seasons that have ``lookback`` earlier seasons of data."""
    bounds = games.agg(F.min("season").alias("lo"), F.max("season").alias("hi"))
    lo_ok = F.greatest(F.col("lo") + lookback, F.col("hi") - (n - 1))
    # sequence() counts down when start > end, so guard it: too little history -> no season.
    seq = F.when(lo_ok <= F.col("hi"), F.sequence(lo_ok, F.col("hi"))).otherwise(
        F.array().cast("array<int>"))
    return bounds.select(F.explode(seq).alias("season"))


def calibration_samples(games: DataFrame, settings_row: DataFrame, seasons, *,
                        min_games: int = 0) -> DataFrame:
    """DOM-14: project every swept season with data before it, pair with actuals.

    Position falls back to the line's own position; points are unrounded.
    """
    lines = project_lines(season_totals(games), targets=seasons)
    priced = lines.crossJoin(F.broadcast(settings_row)).select(
        "season", "player_id", F.col("position").alias("line_position"), "games",
        score_expr(LINE_SCORE_INPUTS, F.col("position")).alias("projected"))
    acts = actual_points(games, settings_row).select(
        "season", "player_id", F.col("position").alias("a_position"),
        F.col("games").alias("a_games"), "actual")
    j = priced.join(acts, ["season", "player_id"], "left")
    j = j.select(
        "season", "player_id",
        F.coalesce("a_position", "line_position").alias("position"),
        F.coalesce(F.col("a_games"), F.lit(0)).alias("played"),
        normalized_residual("projected", F.coalesce(F.col("actual"), F.lit(0.0)), "games").alias("r"),
    )
    return j.filter((F.col("played") >= min_games) & F.col("r").isNotNull())


def merge_covs(spark: SparkSession, recs: DataFrame, covs: dict | None = None) -> DataFrame:
    """DOM-15: the model's cov table with recommendations applied; others dropped."""
    covs = rules.POSITION_COV if covs is None else covs
    cur = spark.createDataFrame([(p, float(v), i) for i, (p, v) in enumerate(covs.items())],
                                "position string, cov double, model_order int")
    return cur.join(recs.select("position", "recommended_cov"), "position", "left").select(
        "position", F.coalesce("recommended_cov", "cov").alias("cov"), "model_order")
