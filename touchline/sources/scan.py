"""Scans: parquet, CSV, drift-safe partitioned lakes, keyed JSON, exclusion lists, views.

Every scan takes an explicit schema where the data may drift, so types never
depend on which file a sampler happened to open (SURVEY D5).
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """SRC-1: one Parquet file or folder."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """SRC-2: CSV with an explicit schema (inference differs between engines)."""
    return spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE").csv(path)


def read_lake(spark: SparkSession, root: str, schema: T.StructType, *, hive: bool = True) -> DataFrame:
    """SRC-3 / SRC-4: a partitioned Parquet tree read with one *wide* schema.

    Files missing a column read it as NULL; a file written with a narrower type
    (int where the schema says bigint/double) is widened by the reader.  With
    ``hive`` the ``key=value`` folders become columns, typed by ``schema`` when it
    names them.  Without it files are found at any depth, and a schema column that a
    file's path names as ``key=value`` takes that value.
    """
    if hive:
        return spark.read.schema(schema).option("basePath", root).parquet(root)
    df = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(root)
    cols = []
    for f in schema.fields:
        named = F.regexp_extract(F.col("_metadata.file_path"), f"/{re.escape(f.name)}=([^/]+)/", 1)
        named = F.when(~named.isin("", "__HIVE_DEFAULT_PARTITION__"), named).cast(f.dataType) \
            if isinstance(f.dataType, T.AtomicType) else F.lit(None).cast(f.dataType)
        cols.append(F.coalesce(named, F.col(f.name)).alias(f.name))
    return df.select(*cols)


def try_register_view(spark: SparkSession, name: str, path: str) -> bool:
    """SRC-12: expose a staged table, or plain files, as a temp view if there are any; False when there is nothing."""
    from touchline.sources.generations import GenerationTable

    staged = GenerationTable(spark, path)
    try:
        df = staged.read() if staged.current() else spark.read.parquet(path)
    except AnalysisException:
        return False
    df.createOrReplaceTempView(name)
    return True


# Hub fields that are ids: kept as clean text (JSON numbers stay digits, '' -> NULL).
HUB_ID_FIELDS = ("player_id", "gsis_id", "espn_id", "yahoo_id", "rotowire_id", "rotoworld_id",
                 "sportradar_id", "stats_id", "swish_id", "fantasy_data_id", "oddsjam_id", "kalshi_id",
                 "pandascore_id", "opta_id")


def read_keyed_json(spark: SparkSession, path: str, fields: list[str], *, whole_file: bool = True) -> DataFrame:
    """SRC-5: ``{id: {field: value, ...}, ...}`` -> one row per id.

    Values are read as text: scalars keep their text (a JSON number id stays
    ``3139477``, never ``3139477.0``), lists/objects keep compact JSON text and an
    empty list/object becomes NULL, id fields turn ``''`` into NULL, and
    ``player_id`` defaults to the object key.  ``whole_file`` reads one object per
    file (the feed's shape: one task per file); otherwise one object per line.
    """
    text = spark.read.text(path, wholetext=whole_file)
    parsed = text.select(F.explode(F.from_json("value", "map<string, map<string, string>>")).alias("key", "v"))
    return parsed.select(*keyed_columns(fields))


def keyed_columns(fields: Sequence[str]) -> list[Column]:
    """The fields of a record ``v`` found under ``key``, as clean text (SCA-19: nested values stay compact JSON)."""
    cols = []
    for f in fields:
        raw = F.col("v").getItem(f)
        if f in HUB_ID_FIELDS:
            val = F.nullif(raw, F.lit(""))
            if f == "player_id":
                val = F.coalesce(val, F.col("key"))
        else:
            val = F.when(raw.isin("[]", "{}"), F.lit(None)).otherwise(raw)
        cols.append(val.alias(f))
    return cols


def read_exclusions(spark: SparkSession, path: str) -> DataFrame:
    """SRC-11: lower-cased, trimmed names; blank lines and '#' comments skipped."""
    t = spark.read.text(path)
    name = F.lower(F.trim(F.col("value")))
    return (t.filter((F.trim(F.col("value")) != "") & ~F.ltrim(F.col("value")).startswith("#"))
            .select(name.alias("name")).distinct())


@dataclass(frozen=True)
class DatasetSpec:
    """SRC-6: one landed dataset — where it lives, how it is laid out, its key."""

    name: str
    source: str
    fmt: str = "parquet"
    per_season: bool = True
    partition_cols: tuple[str, ...] = ("season",)
    natural_key: tuple[str, ...] = ()
    dedup: bool = True
    schema: T.StructType | None = field(default=None, compare=False)

    def raw_root(self, lake: str) -> str:
        return f"{lake.rstrip('/')}/raw/{self.source}/{self.name}"

    def staged_root(self, lake: str) -> str:
        prefix = f"{self.source}_" if self.source != "ngs" else "ngs_"
        return f"{lake.rstrip('/')}/staging/{prefix}{self.name}"


WEEKLY = ("season", "week")
# FIXED VALUES — landed datasets: name, source, format, per-season flag, layout, natural key.
REGISTRY: dict[str, DatasetSpec] = {
    s.name if s.source != "ngs" else f"ngs_{s.name}": s for s in (
        DatasetSpec("player_stats", "nflverse", "parquet", True, WEEKLY, ("player_id", "season", "week")),
        DatasetSpec("pbp", "nflverse", "parquet", True, WEEKLY, ("game_id", "play_id"), dedup=False),
        DatasetSpec("snap_counts", "nflverse", "parquet", True, WEEKLY, ("pfr_player_id", "season", "week")),
        DatasetSpec("weekly_rosters", "nflverse", "parquet", True, WEEKLY),
        DatasetSpec("injuries", "nflverse", "parquet", True, WEEKLY),
        DatasetSpec("depth_charts", "nflverse", "parquet", True, WEEKLY),
        DatasetSpec("rosters", "nflverse", "parquet", True, ("season",)),
        DatasetSpec("schedules", "nflverse", "parquet", False, (), ("game_id",)),
        DatasetSpec("players", "nflverse", "parquet", False, (), ("gsis_id",)),
        DatasetSpec("passing", "ngs", "parquet", False, ("season",)),
        DatasetSpec("rushing", "ngs", "parquet", False, ("season",)),
        DatasetSpec("receiving", "ngs", "parquet", False, ("season",)),
    )
}


def scan_mart(spark: SparkSession, table: str, where: str, **params) -> DataFrame:
    """SRC-9: a parameterised read of a registered table, values bound as SQL
    parameters (no string splicing), e.g. ``scan_mart(s, "fct_projections",
    "season = :season AND week = 0", season=2025)``."""
    return spark.sql(f"SELECT * FROM {table} WHERE {where}", args=params)
