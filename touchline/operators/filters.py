"""Row filters and de-duplication (FLT-1, FLT-6, FLT-7, AGG-6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.operators.keys import keep_first


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """FLT-1: rows that cannot be placed in a partition (a NULL key) are dropped."""
    return df.dropna(subset=list(keys))


def latest_rows(df: DataFrame, date_col: str) -> DataFrame:
    """FLT-6: rows whose ``date_col`` equals the overall maximum (one-row aggregate, broadcast)."""
    top = df.agg(F.max(date_col).alias("_top"))
    return df.join(F.broadcast(top), F.col(date_col) == F.col("_top"), "left_semi")


def latest_per_key(df: DataFrame, keys: Sequence[str], date_col: str) -> DataFrame:
    """FLT-7: rows of the latest ``date_col`` per key.

    A per-key max (partial aggregation, one row per key) semi-joined back: a key
    owning a large share of the rows is never gathered into one window task.
    """
    keys = list(keys)
    top = df.groupBy(*keys).agg(F.max(date_col).alias(date_col))
    return df.join(top, keys + [date_col], "left_semi")


def distinct_rows(df: DataFrame, natural_key: Sequence[str] | None = None,
                  order: Sequence[Column] | None = None) -> DataFrame:
    """AGG-6: full-row DISTINCT, or — for wide tables where hashing every column is
    the expensive part — one row per natural key (keep-first by ``order``)."""
    if natural_key is None:
        return df.distinct()
    return keep_first(df, natural_key, order or [F.col(c) for c in natural_key])
