"""Draft boards of many leagues in one job (DOM-16..DOM-18, keyed by league).

Every step of ``plans.board`` with the league as part of its key: starters per (league,
position), the six flex kinds in their fixed order for all leagues at once, replacement
levels, ranks and tiers.  Only the top of each (league, position) takes part in the
allocation: as deep as the deepest roster, which the leagues' rules bound.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.operators.scan import exact_quantile, ordered_scan
from touchline.plans.board import base_counts, candidate_depth
from touchline.session import cut_lineage
from touchline.sources import rules

KEY = ["league", "position"]


def _slots(spark: SparkSession, leagues: Mapping[str, dict], key: str) -> DataFrame:
    """(league, slots) of one flex kind, where a league has any."""
    rows = [(name, int(of["roster"].get(key, 0)) * of["teams"]) for name, of in leagues.items()]
    return spark.createDataFrame([r for r in rows if r[1] > 0], "league string, slots long")


def league_starters(spark: SparkSession, players: DataFrame, leagues: Mapping[str, dict]) -> DataFrame:
    """(league, position, starters): base slots, then each flex kind greedily, in every league.

    ``players``: (league, player_id, position, points).  A flex slot goes to the eligible position
    whose next player has the most points, ties to the first in the kind's order; a kind
    stops when no eligible player is left.
    """
    depth = max((candidate_depth(of["roster"], of["teams"]) for of in leagues.values()), default=1)
    ranked = players.withColumn("prank", F.row_number().over(Window.partitionBy(*KEY).orderBy(F.col("points").desc(), F.col("player_id"))))
    pool = cut_lineage(ranked.where(F.col("prank") <= depth).select(*KEY, "points", "prank"))
    counts = spark.createDataFrame([(name, p, n) for name, of in leagues.items() for p, n in base_counts(of["roster"], of["teams"]).items()],
                                   "league string, position string, starters long")
    for kind, eligible in rules.FLEX_KEYS:
        slots = _slots(spark, leagues, kind)
        if not any(int(of["roster"].get(kind, 0)) for of in leagues.values()):
            continue
        place = F.array_position(F.array(*map(F.lit, eligible)), F.col("position"))
        left = (pool.where(F.col("position").isin(list(eligible))).join(F.broadcast(counts), KEY).join(F.broadcast(slots), "league")
                .where(F.col("prank") > F.col("starters")))
        order = Window.partitionBy("league").orderBy(F.col("points").desc(), place, F.col("prank"))
        taken = left.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= F.col("slots"))
        taken = taken.groupBy(*KEY).agg(F.count("*").alias("more"))
        counts = counts.join(F.broadcast(taken), KEY, "left").select(*KEY, (F.col("starters") + F.coalesce("more", F.lit(0))).alias("starters"))
    return counts


def league_boards(spark: SparkSession, players: DataFrame, leagues: Mapping[str, dict], tier_factor: float = rules.TIER_FACTOR) -> DataFrame:
    """(league, player_id, position, points, vor, overall_rank, position_rank, tier, starter) of every league.

    ``players``: (league, player_id, position, points), skill positions only; ``leagues``: name ->
    {"roster": {slot: count}, "teams": n}.
    """
    players = cut_lineage(players)
    starters = cut_lineage(league_starters(spark, players, leagues))  # four rows a league
    depth = max((candidate_depth(of["roster"], of["teams"]) for of in leagues.values()), default=1)
    by_points = Window.partitionBy(*KEY).orderBy(F.col("points").desc(), F.col("player_id"))
    top = players.withColumn("prank", F.row_number().over(by_points)).where(F.col("prank") <= depth)
    sizes = players.groupBy(*KEY).agg(F.count("*").alias("size"))
    want = sizes.join(starters, KEY, "left").select(*KEY, F.least(F.coalesce("starters", F.lit(0)) + 1, "size").alias("prank"), "starters")
    levels = want.join(top, [*KEY, "prank"], "left").select(*KEY, "starters", F.coalesce("points", F.lit(0.0)).alias("replacement"))
    board = players.join(F.broadcast(levels), KEY).withColumn("vor", F.col("points") - F.col("replacement"))
    order = [F.col("vor").desc(), F.col("player_id").asc()]
    board = ordered_scan(board, order, ["league"], row_number="overall_rank")
    board = ordered_scan(board, order, KEY, row_number="position_rank")
    above = board.select(*KEY, (F.col("position_rank") + 1).alias("position_rank"), F.col("vor").alias("above"))
    board = board.join(above, [*KEY, "position_rank"], "left").withColumn("gap", F.col("above") - F.col("vor"))
    usual = exact_quantile(board.where("gap > 0"), "gap", 0.5, KEY, "usual", tie_breaker=["player_id"])
    board = board.join(F.broadcast(usual), KEY, "left")
    cliff = F.coalesce(F.col("gap") > F.lit(float(tier_factor)) * F.col("usual"), F.lit(False)).cast("int")
    board = ordered_scan(board, order, KEY, sums={"cliffs": cliff}, row_number=None)
    starter = F.col("position_rank") <= F.coalesce("starters", F.lit(0))
    return board.select("league", "player_id", "position", "points", "vor", "overall_rank", "position_rank",
                        (F.col("cliffs") + 1).cast("int").alias("tier"), starter.alias("starter"))
