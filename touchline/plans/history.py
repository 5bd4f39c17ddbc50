"""Where players were, what changed between snapshots, and who is worth a claim."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.operators.asof import asof_join, stints


def player_team_history(rosters: DataFrame) -> DataFrame:
    """(player_id, team_id, season, week_start, week_end, jersey_number, depth_chart_pos): stints from weekly rosters.

    ``rosters`` has one row per player and week.  A stint lasts while the team stays the same;
    byes and missed weeks do not end it.  ``week_end`` is null for the season's last stint.
    """
    out = stints(rosters.where(F.col("team_id").isNotNull()), ["player_id", "season"], "week", "team_id",
                 ["jersey_number", "depth_chart_pos"], "week_start", "week_end")
    return out.select("player_id", "team_id", "season", "week_start", "week_end", "jersey_number", "depth_chart_pos")


def team_at(rows: DataFrame, history: DataFrame) -> DataFrame:
    """``rows`` (player_id, season, week, ...) with the ``team_id`` of the stint that was running: as of its week."""
    return asof_join(rows, history, ["player_id", "season"], "week", "week_start", ["team_id"], ["team_id"])


def version_changes(previous: DataFrame, current: DataFrame, keys: Sequence[str], now: str, refresh: bool = False) -> DataFrame:
    """SNK-7 / SCA-18: the difference of two versions of a table, and its rows with first-seen and last-changed times.

    ``previous`` carries created_at and updated_at besides the columns of ``current``; both have
    one row per key.  Every key of either comes once, with the columns of the current row (of the
    previous one where it is gone) and:

    change: added, changed, same or gone;
    changed: the names of the columns that differ (null-safe), for changed rows;
    created_at: when the key was first seen, kept for ever;
    updated_at: ``now`` for rows added or changed, and with ``refresh`` for all that are still
    there (as the reference does); else as it was.
    """
    keys = list(keys)
    columns = [c for c in current.columns if c not in keys]
    old = previous.select(*keys, F.struct(*columns, F.lit(1).alias("tl_here")).alias("tl_old"), "created_at", "updated_at")
    new = current.select(*keys, F.struct(*columns, F.lit(1).alias("tl_here")).alias("tl_new"))
    both = old.join(new, keys, "full")
    time = F.lit(now).cast(previous.schema["created_at"].dataType)
    differs = F.array(*[F.when(~F.col(f"tl_old.{c}").eqNullSafe(F.col(f"tl_new.{c}")), F.lit(c)) for c in columns]) if columns else F.array().cast("array<string>")
    differs = F.filter(differs, lambda c: c.isNotNull())
    change = (F.when(F.col("tl_old").isNull(), "added").when(F.col("tl_new").isNull(), "gone")
              .when(F.size(differs) > 0, "changed").otherwise("same"))
    both = both.withColumn("change", change).withColumn("changed", F.when(F.col("change") == "changed", differs))
    fresh = F.col("change").isin("added", "changed") | (F.lit(refresh) & (F.col("change") == "same"))
    values = [F.when(F.col("tl_new").isNull(), F.col(f"tl_old.{c}")).otherwise(F.col(f"tl_new.{c}")).alias(c) for c in columns]
    return both.select(*keys, *values, "change", "changed", F.when(F.col("change") == "added", time).otherwise(F.col("created_at")).alias("created_at"),
                       F.when(fresh, time).otherwise(F.col("updated_at")).alias("updated_at"))


RECENT, EARLIER = (-2, 0), (-8, -3)  # weeks of the two windows, the row's own week being 0


def waiver_trends(games: DataFrame, usage: Sequence[str], points: str, weeks_a_season: int) -> DataFrame:
    """(player_id, season, week, recent, earlier, trend, matchup, claim): usage on the rise, against the opponent met.

    ``games`` has one row per player and game, with position and opponent_id.  ``recent`` is the mean usage
    (sum of the ``usage`` columns) over the games of the last three weeks, ``earlier`` that of the
    six weeks before; both are RANGE frames over the week number, so weeks without a game
    count as time and not as games.  ``matchup`` is what the opponent allows to the position in the
    season, against what all allow; ``claim`` is (recent + trend) * matchup.
    """
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in usage])
    rows = games.select("player_id", "season", "week", "position", "opponent_id", (F.col("season") * weeks_a_season + F.col("week")).alias("at"),
                        total.cast("double").alias("usage"), F.coalesce(F.col(points).cast("double"), F.lit(0.0)).alias("points"))
    weekly = rows.groupBy("player_id", "season", "week", "at").agg(F.sum("usage").alias("used"), F.count("*").alias("games"))

    def mean(frame: tuple[int, int]):
        over = Window.partitionBy("player_id").orderBy("at").rangeBetween(*frame)
        return F.try_divide(F.sum("used").over(over), F.sum("games").over(over))

    weekly = weekly.withColumn("recent", mean(RECENT)).withColumn("earlier", mean(EARLIER))
    allowed = rows.groupBy("season", "position", "opponent_id").agg(F.sum("points").alias("points"), F.count("*").alias("games"))
    league = allowed.groupBy("season", "position").agg(F.sum("points").alias("all_points"), F.sum("games").alias("all_games"))
    strength = allowed.join(league, ["season", "position"]).select(
        "season", "position", "opponent_id",
        F.coalesce(F.try_divide(F.col("points") / F.col("games"), F.col("all_points") / F.col("all_games")), F.lit(1.0)).alias("strength"))
    met = rows.join(strength, ["season", "position", "opponent_id"])  # a row each of season, position and team: small beside the games
    met = met.groupBy("player_id", "season", "week").agg(F.avg("strength").alias("matchup"))
    out = weekly.join(met, ["player_id", "season", "week"], "left").withColumn("matchup", F.coalesce("matchup", F.lit(1.0)))
    trend = F.col("recent") - F.coalesce("earlier", "recent")
    return out.select("player_id", "season", "week", "recent", "earlier", trend.alias("trend"), "matchup",
                      ((F.col("recent") + trend) * F.col("matchup")).alias("claim"))
