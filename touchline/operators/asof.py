"""As-of join: for each row the latest other row of its key at or before its time (FLT-7 with ``snapshot_date <= d``).

No range join: both sides are laid in one order by key and time, range-partitioned, and the
last right row seen is carried along.  A key that spans partitions takes what the partitions
before it saw last from a table of at most one row a partition, so a key with a third of all
rows is spread like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.session import cut_lineage


def asof_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str, columns: Sequence[str],
              tie_breaker: Sequence[str] = (), strict: bool = False, num_partitions: int | None = None) -> DataFrame:
    """Every row of ``left`` with ``columns`` of the right row of equal ``on`` and the greatest time not after its own.

    With ``strict`` the right time must lie before the left one.  Of right rows at one time
    the greatest by ``tie_breaker`` counts (nulls least).  Without such a row, or with a null
    key or time on the left, the columns are null; right rows with a null key or time match
    nothing.  ``columns`` must not be columns of ``left``.
    """
    spark, on = left.sparkSession, list(on)
    parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if set(columns) & set(left.columns):
        raise ValueError("columns of the right side would hide columns of the left")
    keys = [F.col(k).alias(f"tl_k{i}") for i, k in enumerate(on)]
    names = [f"tl_k{i}" for i in range(len(on))]
    picked = right.dropna(subset=[*on, right_time]).select(*keys, F.col(right_time).alias("tl_time"), F.lit(1 if strict else 0).alias("tl_side"),
                          F.struct(*[F.col(t).alias(f"t{i}") for i, t in enumerate(tie_breaker)], F.lit(0).alias("t")).alias("tl_tie"),
                          F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)]).alias("tl_right"))
    asking = left.select(*keys, F.col(left_time).alias("tl_time"), F.lit(0 if strict else 1).alias("tl_side"),
                         F.struct(*[F.col(f"`{c}`").alias(f"l{i}") for i, c in enumerate(left.columns)]).alias("tl_left"))
    both = picked.unionByName(asking, allowMissingColumns=True)
    place = ["tl_time", "tl_side", "tl_tie"]
    spread = F.xxhash64("tl_left")  # many rows of one key and time
    both = cut_lineage(both.repartitionByRange(parts, *names, *place, spread).withColumn("tl_pid", F.spark_partition_id()))
    along = Window.partitionBy("tl_pid", *names).orderBy(*place).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = both.withColumn("tl_seen", F.last("tl_right", True).over(along)).where(F.col("tl_left").isNotNull())

    given = F.when(F.col("tl_right").isNotNull(), F.struct("tl_time", "tl_tie"))
    ends = both.groupBy("tl_pid", *names).agg(F.max_by("tl_right", given).alias("tl_last"))
    before = Window.partitionBy(*names).orderBy("tl_pid").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("tl_pid", *names, F.last("tl_last", True).over(before).alias("tl_carried")).where(F.col("tl_carried").isNotNull())
    # only a partition's first key can continue one from before: at most a row a partition
    out = seen.join(F.broadcast(carried), ["tl_pid", *names], "left").withColumn("tl_found", F.coalesce("tl_seen", "tl_carried"))
    return out.select(*[F.col(f"tl_left.l{i}").alias(c) for i, c in enumerate(left.columns)],
                      *[F.col(f"tl_found.c{i}").alias(c) for i, c in enumerate(columns)])


def stints(rows: DataFrame, on: Sequence[str], time: str, value: str, carry: Sequence[str] = (), begin: str = "begin", end: str = "end") -> DataFrame:
    """Gaps and islands: (on, value, begin, end, carry): each unbroken stretch of one ``value`` of a key, in order of ``time``.

    ``rows`` holds one row per key and time.  ``end`` is the last time seen, null for a key's
    last stretch, which is still open; ``carry`` columns are those of the stretch's last row.
    """
    own = Window.partitionBy(*on).orderBy(time)
    fresh = ~F.col(value).eqNullSafe(F.lag(value).over(own)) | (F.row_number().over(own) == 1)
    numbered = rows.withColumn("tl_stint", F.sum(fresh.cast("int")).over(own))
    out = numbered.groupBy(*on, "tl_stint").agg(F.first(value).alias(value), F.min(time).alias(begin), F.max(time).alias("tl_end"),
                                                *[F.max_by(c, time).alias(c) for c in carry])
    open_ = F.col("tl_stint") == F.max("tl_stint").over(Window.partitionBy(*on))
    return out.select(*on, value, begin, F.when(~open_, F.col("tl_end")).alias(end), *carry)
