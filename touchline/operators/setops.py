"""Set operations: first-source-wins union, home/away union, id unpivot (SET-1..3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_first_wins(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """SET-1: all of ``first`` plus the rows of ``second`` whose key ``first`` lacks."""
    extra = second.join(first.select(key), key, "left_anti")
    return first.unionByName(extra.select(*first.columns))


def both_sides(df: DataFrame, keep: Sequence[str], sides: dict[str, str], out: str = "team",
               side_col: str | None = "side") -> DataFrame:
    """SET-2: one row per side of each row (home/away) from a single scan.

    ``sides`` maps a side label to the column holding that side's value; the
    rows are produced by ``explode(array(struct(...)))`` rather than a UNION of
    two scans.
    """
    arr = F.array(*[F.struct(F.lit(lbl).alias("_side"), F.col(c).alias("_val")) for lbl, c in sides.items()])
    x = df.select(*keep, F.explode(arr).alias("_s"))
    cols = [*keep, F.col("_s._val").alias(out)]
    if side_col:
        cols.append(F.col("_s._side").alias(side_col))
    return x.select(*cols)


def unpivot_ids(df: DataFrame, id_col: str, columns: Sequence[tuple[str, str]],
                source_col: str = "source", value_col: str = "source_id") -> DataFrame:
    """SET-3: (id, col1..colN) -> (id, source, source_id), non-null values only.

    ``DataFrame.unpivot`` keeps NULLs, so they are filtered afterwards; one scan
    replaces the reference's N-way UNION ALL.
    """
    x = df.select(id_col, *[F.col(c).cast("string").alias(src) for src, c in columns])
    long = x.unpivot(id_col, [src for src, _ in columns], source_col, value_col)
    return long.filter(F.col(value_col).isNotNull())
