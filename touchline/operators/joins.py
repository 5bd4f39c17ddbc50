"""Join helpers: bounded broadcast, crosswalk resolution with rejects, salting.

Broadcast only what has a proven size bound.  Literal rule tables and one-row
aggregates are bounded by construction; anything derived from data goes
through ``bounded_broadcast`` (a cheap ``limit(n+1).count()`` check) or is left
to AQE, which converts a join to broadcast only after measuring the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bounded_broadcast(df: DataFrame, max_rows: int) -> tuple[DataFrame, bool]:
    """Broadcast ``df`` only if it has at most ``max_rows`` rows; else leave it to a shuffle join."""
    n = df.limit(max_rows + 1).count()
    return (F.broadcast(df), True) if n <= max_rows else (df, False)


def resolve_ids(facts: DataFrame, crosswalk: DataFrame, source: str, fact_key: str,
                id_col: str = "player_id", with_rejects: bool = False):
    """JOI-1: translate a source-native id to the internal id (inner join).

    Unresolved rows are dropped like the reference; ``with_rejects`` also returns
    them (left_anti) so a pipeline can report what it lost.
    """
    x = crosswalk.filter(F.col("source") == source).select(
        F.col("source_id").alias(fact_key), F.col(id_col).alias(f"_{id_col}"))
    resolved = facts.join(x, fact_key, "inner")
    if not with_rejects:
        return resolved
    rejects = facts.join(x, fact_key, "left_anti")
    return resolved, rejects


def anti_by_lower(df: DataFrame, names: DataFrame, df_col: str, name_col: str = "name",
                  max_broadcast: int = 100_000) -> DataFrame:
    """JOI-15: drop rows whose lower-cased ``df_col`` is in ``names``; the list is
    broadcast only after its size is checked, else it is a shuffled anti join."""
    ex, _ = bounded_broadcast(names.select(F.lower(F.trim(F.col(name_col))).alias("_ex")).distinct(),
                              max_broadcast)
    return df.join(ex, F.lower(F.col(df_col)) == F.col("_ex"), "left_anti")


def salted_join(big: DataFrame, small_unique: DataFrame, keys: Sequence[str], salts: int,
                how: str = "inner", salt_source: Column | None = None) -> DataFrame:
    """Join a skewed ``big`` side to a side with one row per key, spreading each
    key over ``salts`` tasks.  The small side is replicated ``salts`` times; the
    salt of a big row comes from a hash of its columns (deterministic on retry)."""
    keys = list(keys)
    salt_expr = salt_source if salt_source is not None else F.xxhash64(*[F.col(c) for c in big.columns])
    b = big.withColumn("_salt", F.pmod(salt_expr, F.lit(salts)))
    s = small_unique.crossJoin(
        big.sparkSession.range(salts).select(F.col("id").alias("_salt")))
    return b.join(s, keys + ["_salt"], how).drop("_salt")
