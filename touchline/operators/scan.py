"""Ordered scans that never funnel a whole segment into one task.

``row_number() over (order by k)`` without PARTITION BY, or partitioned by a
low-cardinality key such as position, puts every row of the segment into one
task.  ``ordered_scan`` computes the same row numbers and running sums in two
balanced passes:

1. range-partition the rows on (segment keys, order keys) into P partitions and
   compute row numbers / running sums *within* each (partition, segment) piece;
2. total each piece, turn the totals into per-piece offsets with a tiny window
   over at most P rows per segment, and add the offset back.

Only a piece that continues a segment from an earlier partition has a non-zero
offset; such a piece starts its partition, so there are at most P-1 of them.
The offset table is therefore bounded by the partition count and broadcast.
The range-partitioned rows are checkpointed (reliable checkpoint in the shared
``spark.checkpoint.dir``): both passes then read the same materialised
partitions, so the partition ids agree even if a range sample were re-drawn,
a lost executor cannot change them, and the plan of a chain of scans stays
linear instead of doubling with every scan.

The order keys should form a total order (add a unique tie-breaker) when row
numbers must be deterministic; a hot tied key would otherwise also land in one
range partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.operators.joins import bounded_broadcast
from touchline.session import cut_lineage

#: Rows of a table of pieces (one a segment and partition) that are broadcast.
MOST_PIECES = 500_000


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ordered_scan(df: DataFrame, order: Sequence, by: Sequence[str] = (),
                 sums: dict[str, Column] | None = None, row_number: str | None = "rn",
                 num_partitions: int | None = None) -> DataFrame:
    """Add a global (per ``by`` segment) row number and running sums in ``order``."""
    sums = dict(sums or {})
    by = list(by)
    order = [_col(o) for o in order]
    spark = df.sparkSession
    parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    if row_number and not sums:
        return _numbered(df, order, row_number, parts) if not by else _numbered_by(df, order, by, row_number, parts)

    base = df
    for name, expr in sums.items():
        base = base.withColumn(f"_v_{name}", expr)
    parted = cut_lineage(base.repartitionByRange(parts, *[F.col(b) for b in by], *order)
                         .withColumn("_pid", F.spark_partition_id()))

    piece = Window.partitionBy("_pid", *by).orderBy(*order)
    running = piece.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = parted.withColumn("_l_rn", F.row_number().over(piece))
    for name in sums:
        local = local.withColumn(f"_l_{name}", F.sum(f"_v_{name}").over(running))

    totals = parted.groupBy("_pid", *by).agg(
        F.count(F.lit(1)).alias("_t_rn"), *[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    before = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("_pid").alias("_o_pid"), *[F.col(b).alias(f"_o_by_{b}") for b in by],
        F.coalesce(F.sum("_t_rn").over(before), F.lit(0)).alias("_o_rn"),
        *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums],
    ).filter(F.col("_o_rn") > 0)  # <= P-1 rows: bounded by the partition count

    cond = [local["_pid"] == F.col("_o_pid")] + [local[b].eqNullSafe(F.col(f"_o_by_{b}")) for b in by]
    out = local.join(F.broadcast(offsets), reduce(lambda a, b: a & b, cond), "left")
    cols = [F.col(c) for c in df.columns]
    if row_number:
        cols.append((F.col("_l_rn") + F.coalesce(F.col("_o_rn"), F.lit(0))).alias(row_number))
    for name in sums:
        cols.append((F.col(f"_l_{name}") + F.coalesce(F.col(f"_o_{name}"), F.lit(0))).alias(name))
    return out.select(*cols)


def _numbered(df: DataFrame, order: Sequence[Column], name: str, parts: int) -> DataFrame:
    """Row numbers alone, over the whole table: one range shuffle and no other.

    Rows are sorted within their partition before the checkpoint; the id counter of the
    partition (33 bits, the partition index above them) is then the place of each row.
    """
    placed = cut_lineage(df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                         .withColumn("_at", F.monotonically_increasing_id()))
    pid, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    totals = placed.groupBy(pid.alias("_o_pid")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_o_pid").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = totals.select("_o_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o_rn"))
    out = placed.join(F.broadcast(offsets), pid == F.col("_o_pid"))
    return out.select(*df.columns, (place + 1 + F.col("_o_rn")).alias(name))


def _numbered_by(df: DataFrame, order: Sequence[Column], by: Sequence[str], name: str, parts: int) -> DataFrame:
    """Row numbers per segment: one range shuffle, and a row for each segment and partition that shift the places.

    As in ``_numbered`` the sorted partition's counter is the place of a row; the first place of
    its segment there, and the segment's rows in the partitions before, give its number.
    """
    keys = [F.col(b) for b in by]
    placed = cut_lineage(df.repartitionByRange(parts, *keys, *order).sortWithinPartitions(*keys, *order)
                         .withColumn("_at", F.monotonically_increasing_id()))
    pid = F.shiftright("_at", 33)
    pieces = placed.groupBy(pid.alias("_o_pid"), *by).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_o_pid").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1
    pieces = pieces.select("_o_pid", *[F.col(b).alias(f"_o_by_{b}") for b in by], shift.alias("_shift"))
    pieces, _ = bounded_broadcast(cut_lineage(pieces), MOST_PIECES)
    same = [pid == F.col("_o_pid")] + [placed[b].eqNullSafe(F.col(f"_o_by_{b}")) for b in by]
    out = placed.join(pieces, reduce(lambda a, b: a & b, same))
    return out.select(*df.columns, (F.col("_at") + F.col("_shift")).alias(name))


def average_rank(df: DataFrame, value: str, by: Sequence[str] = (), out: str = "avg_rank") -> DataFrame:
    """WIN-5: rank with ties sharing the mean of their positions (1-based).

    Distinct values are counted first (map-side combine collapses a hot value to
    one row per task), ranks are scanned over the distinct values, and the rank
    is joined back on (by, value).  The right side has one row per key, so AQE's
    skew-join split handles a value shared by a large share of the rows.
    """
    return df.join(rank_table(df, value, by, out), [*by, value], "left")


def rank_table(df: DataFrame, value: str, by: Sequence[str] = (), out: str = "avg_rank") -> DataFrame:
    """(by, value, out): the average rank of each distinct value; to be joined to ``df``, beside other rank tables of it."""
    by = list(by)
    counts = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_cnt"))
    scanned = ordered_scan(counts, [F.col(value).asc_nulls_first()], by,
                           sums={"_cum": F.col("_cnt")}, row_number=None)
    return scanned.select(*by, value, ((F.col("_cum") - F.col("_cnt")) + (F.col("_cnt") + 1) / 2.0).alias(out))


def exact_quantile(df: DataFrame, value: str, q: float, by: Sequence[str] = (),
                   out: str = "quantile", tie_breaker: Sequence[str] = ()) -> DataFrame:
    """AGG-14: linear-interpolated quantile at position q*(n-1), one row per segment.

    Computed from global ranks (``ordered_scan``) instead of holding every value
    of a segment in one aggregation buffer.  The two wanted ranks per segment
    are joined on (segment, rank), a key unique per row, so a large segment is
    never routed to one task.  Pass a ``tie_breaker`` so a hot repeated value
    spreads over range partitions.  NULL values are ignored.
    """
    by = list(by)
    vals = df.filter(F.col(value).isNotNull())
    order = [F.col(value).asc()] + [F.col(t).asc() for t in tie_breaker]
    ranked = ordered_scan(vals.select(*by, value, *tie_breaker), order, by, row_number="_r")
    sizes = vals.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    pos = F.lit(float(q)) * (F.col("_n") - 1)
    sizes = sizes.select(*by, pos.alias("_pos"), (F.floor(pos) + 1).alias("_lo"),
                         F.least(F.floor(pos) + 2, F.col("_n")).alias("_hi"))
    wanted = sizes.select(*by, "_pos", "_lo", F.explode(F.array_distinct(F.array("_lo", "_hi"))).alias("_r"))
    picked = ranked.select(*by, "_r", value).join(wanted, [*by, "_r"])
    agg = picked.groupBy(*by, "_pos", "_lo").agg(
        F.max(F.when(F.col("_r") == F.col("_lo"), F.col(value))).alias("_vlo"),
        F.max(F.col(value)).alias("_vmax"),
    )
    frac = F.col("_pos") - (F.col("_lo") - 1)
    vhi = F.coalesce(F.col("_vmax"), F.col("_vlo"))
    return agg.select(*by, (F.col("_vlo") * (F.lit(1.0) - frac) + vhi * frac).alias(out))
