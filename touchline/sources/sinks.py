"""Sinks and the schema contract (SNK-1, SNK-2, SNK-6).

Row counts come from ``Observation`` metrics collected while the write runs,
never from re-reading what was written.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.sources.generations import GenerationTable


def _observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def write_table(df: DataFrame, path: str) -> int:
    """SNK-1: replace a table by one new generation; returns rows written.

    The old rows stay what readers (``generations.read_table``) see until the commit; a
    failed write changes nothing.
    """
    return GenerationTable(df.sparkSession, path).replace(df)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and a constructor of its paths."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str]) -> int:
    """SNK-2: full refresh of a Hive-partitioned table; returns rows written.

    Partitions absent from the new data disappear (the reference's behaviour), but only with
    the commit: a failed refresh leaves the old generation as it was.
    """
    return GenerationTable(df.sparkSession, path).replace(df, partition_cols)


def conform(df: DataFrame, schema: T.StructType, defaults: dict | None = None) -> DataFrame:
    """SNK-6: select the contract's columns in order, cast, fill defaults; missing -> NULL."""
    defaults = defaults or {}
    cols = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        if f.name in defaults:
            c = F.coalesce(c, F.lit(defaults[f.name]))
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SNK-6: rows breaking a primary key: a NULL key part, or a key seen more than once."""
    keys = list(keys)
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    nulls = df.filter(any_null) \
        .select(*keys).withColumn("problem", F.lit("null_key")).withColumn("n", F.lit(1).cast("long"))
    dups = (df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1).withColumn("problem", F.lit("duplicate_key")))
    return nulls.unionByName(dups.select(*keys, "problem", "n"))


def fk_violations(child: DataFrame, parent: DataFrame, child_cols: Sequence[str],
                  parent_cols: Sequence[str] | None = None) -> DataFrame:
    """SNK-6: child rows whose non-null foreign key has no parent (left_anti)."""
    parent_cols = list(parent_cols or child_cols)
    p = parent.select(*[F.col(pc).alias(cc) for pc, cc in zip(parent_cols, child_cols, strict=True)]).distinct()
    c = child.dropna(subset=list(child_cols))
    return c.join(p, list(child_cols), "left_anti")
