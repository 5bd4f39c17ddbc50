"""Surrogate keys and keep-first dedup (WIN-1..WIN-4, JOI-7, JOI-9).

Dense ids use ``ordered_scan`` (range partitions + bounded offsets), never an
unpartitioned ``row_number()`` window.  The "current max id" is a one-row
global aggregate cross-joined back (bounded by construction).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.operators.scan import ordered_scan


def dense_ids(keys: DataFrame, key: str, id_col: str = "player_id", start: Column | int = 0) -> DataFrame:
    """WIN-1: number the distinct non-null ``key`` values ``start+1 .. start+N`` in key order."""
    distinct = keys.select(key).filter(F.col(key).isNotNull()).distinct()
    ranked = ordered_scan(distinct, [F.col(key).asc()], row_number="_rn")
    base = start if isinstance(start, Column) else F.lit(int(start))
    return ranked.select((base + F.col("_rn")).cast("long").alias(id_col), key)


def max_id(df: DataFrame, id_col: str, alias: str = "_max_id") -> DataFrame:
    """One-row relation with coalesce(max(id), 0) — JOI-9's scalar subquery."""
    return df.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("long").alias(alias))


def mint_additive(existing: DataFrame, incoming: DataFrame, key: str, id_col: str = "player_id",
                  floor_ids: Sequence[DataFrame] = ()) -> DataFrame:
    """WIN-2: keep existing ids; number only unseen keys above the current maximum.

    ``floor_ids`` are further id tables whose maximum the new ids must also clear
    (one allocator over every id space, which removes the reference's collision).
    Returns only the newly minted (id, key) rows; append them to ``existing``.
    """
    new_keys = (incoming.select(key).filter(F.col(key).isNotNull()).distinct()
                .join(existing.select(key), key, "left_anti"))
    top = max_id(existing, id_col)
    for i, other in enumerate(floor_ids):
        top = top.crossJoin(max_id(other, id_col, f"_max_{i}"))
    cols = [F.col(c) for c in top.columns]
    top = top.select((F.greatest(*cols) if len(cols) > 1 else cols[0]).alias("_base"))
    ranked = ordered_scan(new_keys, [F.col(key).asc()], row_number="_rn")
    return ranked.crossJoin(F.broadcast(top)).select(
        (F.col("_base") + F.col("_rn")).cast("long").alias(id_col), key)


def mint_mixed(incoming: DataFrame, key: str, reuse: DataFrame, reuse_id: str,
               floors: Sequence[DataFrame], id_col: str = "player_id",
               existing: DataFrame | None = None) -> DataFrame:
    """WIN-3: a key known to another registry reuses that id; the rest are minted
    above every floor's maximum, numbered among the unmatched only.

    ``reuse`` maps ``key`` -> ``reuse_id`` (one row per key).  With ``existing``,
    keys already registered are skipped (incremental run).
    """
    todo = incoming.select(key).filter(F.col(key).isNotNull()).distinct()
    if existing is not None:
        todo = todo.join(existing.select(key), key, "left_anti")
    resolved = todo.join(reuse.select(key, F.col(reuse_id).alias("_reuse")), key, "left")
    matched = resolved.filter(F.col("_reuse").isNotNull()).select(
        F.col("_reuse").cast("long").alias(id_col), key)
    unmatched = resolved.filter(F.col("_reuse").isNull()).select(key)
    tables = list(floors) + ([existing] if existing is not None else [])
    top = None
    for i, t in enumerate(tables):
        m = max_id(t, id_col, f"_m{i}")
        top = m if top is None else top.crossJoin(m)
    top = top.select(F.greatest(*[F.col(c) for c in top.columns]).alias("_base")) if len(tables) > 1 \
        else top.select(F.col(top.columns[0]).alias("_base"))
    minted = ordered_scan(unmatched, [F.col(key).asc()], row_number="_rn").crossJoin(F.broadcast(top)) \
        .select((F.col("_base") + F.col("_rn")).cast("long").alias(id_col), key)
    return matched.unionByName(minted)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """WIN-4: one row per key, the first in ``order`` (give a total order for determinism).

    A window partitioned by the key: groups are key-sized (no low-cardinality
    funnel); Spark 4.1 has no QUALIFY, so filter on the row number.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_kf", F.row_number().over(w)).filter(F.col("_kf") == 1).drop("_kf")


def lowest_per_key(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """WIN-4 variant: keep the lowest ``value`` per key as an aggregate (partial
    aggregation before the shuffle, so a hot key costs one row per task)."""
    return df.groupBy(*keys).agg(F.min(value).alias(value))
