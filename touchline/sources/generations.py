"""Tables kept as generations behind one commit pointer (SNK-1, SNK-2, DOM-20).

A table is a folder::

    <root>/_generations/[day=.../]tl_generation=<id>/part-*.parquet    data, never changed
    <root>/_commits/<number>.json                                      which folders are the table

A write adds folders that no commit names, and then one commit file; readers take the
folders that the highest whole commit lists.  So a failed or unfinished write is never
seen, and a reader sees one whole generation, the one it resolved, whatever is written
meanwhile: old folders stay until ``vacuum``.  Commit numbers are claimed by exclusive
creation; of two writers one goes on to the next number.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

GENERATION = "tl_generation"


class ConflictError(RuntimeError):
    """Another writer has changed the same partitions since this write began."""


@dataclass(frozen=True)
class Commit:
    version: int
    folders: tuple[str, ...]
    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    rows: int = 0
    touched: tuple[str, ...] | None = None  # partitions that the commit replaced; None: the whole table
    tag: str | None = None  # what the writer wants to find again, as a batch number
    tags: dict = field(default_factory=dict)  # the last tag of each writer

    def to_json(self) -> str:
        return json.dumps({"version": self.version, "folders": self.folders, "schema": self.schema.jsonValue(), "partition_by": self.partition_by,
                           "rows": self.rows, "touched": self.touched, "tag": self.tag, "tags": self.tags, "end": True})

    @staticmethod
    def from_json(text: str) -> Commit | None:
        """None for a commit file that is not whole."""
        try:
            d = json.loads(text)
        except ValueError:
            return None
        if not d.pop("end", False):
            return None
        touched = d["touched"]
        return Commit(**(d | {"folders": tuple(d["folders"]), "schema": T.StructType.fromJson(d["schema"]), "partition_by": tuple(d["partition_by"]),
                              "touched": None if touched is None else tuple(touched)}))


def _partition(folder: str) -> str:
    """The partition that a folder belongs to; empty for a table without partitions."""
    return folder.rpartition("/")[0]


class GenerationTable:
    """A table at ``root`` (any path that Spark can read), read and written by generations."""

    def __init__(self, spark: SparkSession, root: str):
        from touchline.sources.sinks import file_system

        self.spark, self.root = spark, root.rstrip("/")
        self.data = f"{self.root}/_generations"
        self.fs, self.make = file_system(spark, self.root)

    # --- commits ---------------------------------------------------------------------------------

    def _numbers(self) -> list[int]:
        found = self.fs.globStatus(self.make(f"{self.root}/_commits/*.json")) or []
        return sorted((int(s.getPath().getName().removesuffix(".json")) for s in found), reverse=True)

    def _path(self, number: int):
        return self.make(f"{self.root}/_commits/{number:020d}.json")

    def _load(self, number: int) -> Commit | None:
        stream = self.fs.open(self._path(number))
        try:
            return Commit.from_json(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def current(self) -> Commit | None:
        """The highest whole commit; None where nothing was ever committed."""
        return next((c for n in self._numbers() if (c := self._load(n))), None)

    def commits(self) -> list[Commit]:
        """All whole commits that are left, newest first."""
        return [c for n in self._numbers() if (c := self._load(n))]

    def _claim(self, commit: Commit) -> bool:
        """Write a commit under its number; False if the number is taken."""
        try:
            stream = self.fs.create(self._path(commit.version), False)
        except Py4JJavaError as e:
            if "AlreadyExists" in str(e.java_exception) or "already exists" in str(e.java_exception):
                return False
            raise
        stream.write(commit.to_json().encode())
        stream.close()
        return True

    # --- reading ---------------------------------------------------------------------------------

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of the current generation, or of one commit."""
        commit = self.current() if version is None else self._load(version)
        if commit is None:
            raise FileNotFoundError(f"no committed generation in {self.root}")
        return self._rows(commit, commit.folders)

    def _rows(self, commit: Commit, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], commit.schema)
        wide = T.StructType([*commit.schema.fields, T.StructField(GENERATION, T.StringType())])
        read = self.spark.read.schema(wide).option("basePath", self.data)
        return read.parquet(*[f"{self.data}/{f}" for f in folders]).select(*commit.schema.names)

    # --- writing ---------------------------------------------------------------------------------

    def _write(self, df: DataFrame, partition_by: Sequence[str]) -> tuple[list[str], int]:
        """Add the rows as folders that no commit names yet; (folders, rows written)."""
        if GENERATION in df.columns:
            raise ValueError(f"a table cannot hold a column {GENERATION}")
        ident, seen = uuid.uuid4().hex, Observation("generation")
        out = df.hint("rebalance", *partition_by) if partition_by else df  # hot partitions are split, small ones gathered
        out = out.observe(seen, F.count(F.lit(1)).alias("rows")).withColumn(GENERATION, F.lit(ident))
        out.write.mode("append").partitionBy(*partition_by, GENERATION).parquet(self.data)
        depth = "*/" * len(partition_by)
        found = self.fs.globStatus(self.make(f"{self.data}/{depth}{GENERATION}={ident}")) or []
        top = self.fs.makeQualified(self.make(self.data)).toString()
        return sorted(s.getPath().toString().removeprefix(f"{top}/") for s in found), int(seen.get["rows"])

    @staticmethod
    def _schema(df: DataFrame) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])

    def replace(self, df: DataFrame, partition_by: Sequence[str] = (), tag: str | None = None, writer: str = "") -> int:
        """The table becomes ``df``; partitions that it lacks are gone (full refresh).  Returns rows written."""
        folders, rows = self._write(df, partition_by)
        return self._commit(None, folders, rows, self._schema(df), tuple(partition_by), None, tag, writer)

    def replace_partitions(self, df: DataFrame, partition_by: Sequence[str], tag: str | None = None, writer: str = "",
                           base: Commit | None = None) -> int:
        """Replace just the partitions that ``df`` holds, all in one commit.  Returns rows written.

        ``base`` is the commit that ``df`` was computed from; if another writer has changed one of
        these partitions since, ConflictError is raised and nothing changes.
        """
        base = base or self.current()
        if base and base.partition_by != tuple(partition_by):
            raise ValueError(f"the table is partitioned by {base.partition_by}")
        folders, rows = self._write(df, partition_by)
        return self._commit(base, folders, rows, self._schema(df), tuple(partition_by), tuple(sorted({_partition(f) for f in folders})), tag, writer)

    def _commit(self, base: Commit | None, folders: list[str], rows: int, schema: T.StructType, partition_by: tuple[str, ...],
                touched: tuple[str, ...] | None, tag: str | None, writer: str) -> int:
        while True:
            now = self.current()
            kept: list[str] = []
            if touched is not None and now:
                for c in self.commits():
                    if base and c.version <= base.version:
                        break
                    if c.touched is None or set(c.touched) & set(touched):
                        raise ConflictError(f"commit {c.version} changed the same partitions")
                kept = [f for f in now.folders if _partition(f) not in touched]
            tags = dict(now.tags) if now else {}
            if tag is not None:
                tags[writer] = tag
            number = max(self._numbers(), default=0) + 1
            if self._claim(Commit(number, tuple(kept + folders), schema, partition_by, rows, touched, tag, tags)):
                return rows

    def upsert(self, updates: DataFrame, keys: Sequence[str], partition_by: Sequence[str], tag: str | None = None, writer: str = "") -> int:
        """SNK-3 / SNK-5 by generations: rows of ``updates`` replace those of the same key; only touched partitions are read and written.

        ``partition_by`` must be part of the key.  With a ``tag`` that this writer has committed
        before, nothing is done (a stream's batch that is run again).  Returns rows written.
        """
        from touchline.operators.upsert import merge_upsert

        if not set(partition_by) <= set(keys):
            raise ValueError("partition columns must be part of the key")
        base = self.current()
        if base and tag is not None and base.tags.get(writer) == tag:
            return 0
        if base is None:
            return self.replace_partitions(updates, partition_by, tag, writer)
        touched = self.read(base.version)
        if partition_by:
            spread = updates.select(*partition_by).distinct()
            same = [touched[c].eqNullSafe(spread[c]) for c in partition_by]
            small = spread.limit(10_001).count() <= 10_000
            touched = touched.join(F.broadcast(spread) if small else spread, same, "left_semi")  # prunes partitions
        return self.replace_partitions(merge_upsert(touched, updates, keys), partition_by, tag, writer, base)

    # --- cleaning --------------------------------------------------------------------------------

    def vacuum(self, keep: int = 3, grace_seconds: float = 24 * 3600) -> int:
        """Delete commits but the last ``keep``, and folders that none of those names; returns folders deleted.

        Folders younger than ``grace_seconds`` stay: their write may not have been committed yet.
        """
        commits = self.commits()
        live = {f for c in commits[:keep] for f in c.folders}
        depths = {len(c.partition_by) for c in commits}
        top = self.fs.makeQualified(self.make(self.data)).toString()
        gone = 0
        for depth in depths:
            for s in self.fs.globStatus(self.make(f"{self.data}/{'*/' * depth}{GENERATION}=*")) or []:
                name = s.getPath().toString().removeprefix(f"{top}/")
                if name not in live and s.getModificationTime() / 1000 <= time.time() - grace_seconds:
                    gone += self.fs.delete(s.getPath(), True)
        if commits[keep:]:
            for n in (n for n in self._numbers() if n <= commits[keep].version):
                self.fs.delete(self._path(n), False)
        return gone


def read_table(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The current rows of the table at ``root``."""
    return GenerationTable(spark, root).read(version)
