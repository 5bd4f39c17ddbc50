"""Raw lake -> staged lake (DOM-20, DOM-21): scan, de-duplicate, require keys, write.

Wide datasets (play-by-play, ~370 columns) skip the full-row DISTINCT, which
hashes every column; they are unique on their natural key already, and
``dropDuplicates(natural_key)`` is the safe fallback when they are not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.operators.filters import drop_null_keys
from touchline.sources.scan import REGISTRY, DatasetSpec, read_lake
from touchline.sources.sinks import write_partitioned


def clean(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """DOM-20 body: optional full-row DISTINCT, then drop rows with NULL partition keys."""
    out = df.distinct() if spec.dedup else df
    return drop_null_keys(out, spec.partition_cols)


def stage_dataset(spark: SparkSession, lake: str, name: str, schema: T.StructType) -> int:
    """Stage one registered dataset into ``staging/<source>_<name>`` partitioned by its layout."""
    return stage(spark, lake, REGISTRY[name], schema)


def stage(spark: SparkSession, lake: str, spec: DatasetSpec, schema: T.StructType) -> int:
    """DOM-20: raw files of ``spec``, cleaned, as a new generation of its staged table; returns rows written.

    A refresh that fails leaves the staged table as it was; read it by ``generations.read_table``.
    """
    raw = read_lake(spark, spec.raw_root(lake), schema, hive=False)
    return write_partitioned(clean(raw, spec), spec.staged_root(lake), spec.partition_cols)


def clean_ngs(df: DataFrame) -> DataFrame:
    """DOM-21 (tracking stats): drop season-total rows (week 0) and rows without a season."""
    return df.filter(F.col("season").isNotNull() & (F.col("week") >= 1)).distinct()


def stage_ngs(spark: SparkSession, lake: str, kind: str, schema: T.StructType) -> int:
    spec = REGISTRY[f"ngs_{kind}"]
    raw = read_lake(spark, spec.raw_root(lake), schema, hive=False)
    return write_partitioned(clean_ngs(raw), spec.staged_root(lake), ["season"])
