"""SRC-5 at scale: one giant keyed JSON object, read by many tasks.

``{id: {...}, id: {...}, ...}`` is one line or many, but one value, so a line or whole-file
reader gives it to one task.  Here the file is split by bytes, as any text file, with the
mark ``},`` as line end.  How many quotes a fragment holds, and how deep it nests for either
state that it may begin in, is known from the fragment alone.  Sums over the fragments of a
split, and then over the few splits of a file, give the true state at each mark.  A record
ends at a mark outside of text that leaves only the outer object open; its fragments are
joined, and each record is parsed on its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.operators.joins import bounded_broadcast
from touchline.session import cut_lineage

_MARK = "},"
_SPLIT = ["file", "block"]


def _unescaped(text: Column) -> Column:
    """The text without escaped characters, so that each quote left begins or ends a string."""
    return F.regexp_replace(text, r"\\.", "")


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _nesting(text: Column) -> Column:
    """Braces and brackets opened less those closed, outside of strings; ``text`` is unescaped."""
    bare = F.regexp_replace(text, '"[^"]*("|$)', "")
    return _count(bare, "{[") - _count(bare, "}]")


def _earlier(value: Column, by: Sequence[str], order: str) -> Column:
    """The sum of ``value`` over the rows before."""
    return F.coalesce(F.sum(value).over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _with(parts: DataFrame, splits: DataFrame) -> DataFrame:
    """``parts`` joined to its splits' row (a row for each so many megabytes of the files)."""
    return parts.join(bounded_broadcast(splits, 100_000)[0], _SPLIT)


def keyed_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record, entries): each record of the objects in ``path``, as JSON text of an object with its key; numbered in file order.

    A file without ``},`` outside of text, or with blanks between the two, is cut less or not at
    all; what is read stays the same.
    """
    text = spark.read.option("lineSep", _MARK).text(path)
    parts = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                        F.monotonically_increasing_id().alias("at"), F.col("value").alias("text"))
    plain = _unescaped(F.concat("text", F.lit("}")))
    parts = parts.withColumn("quotes", _count(plain, '"')).withColumn("level0", _nesting(plain)).withColumn("level1", _nesting(F.concat(F.lit('"'), plain)))
    odd = _earlier(F.col("quotes"), _SPLIT, "at") % 2
    parts = parts.withColumn("odd", odd)  # in a string or not, if the split begins outside of one
    for begun, (even, uneven) in (("0", ("level0", "level1")), ("1", ("level1", "level0"))):
        parts = parts.withColumn(f"step{begun}", F.when(F.col("odd") == 0, F.col(even)).otherwise(F.col(uneven)))
    for begun in "01":
        parts = parts.withColumn(f"depth{begun}", _earlier(F.col(f"step{begun}"), _SPLIT, "at"))
    parts = cut_lineage(parts.drop("level0", "level1"))

    splits = parts.groupBy(*_SPLIT).agg(F.sum("quotes").alias("quotes"), F.sum("step0").alias("sum0"), F.sum("step1").alias("sum1"), F.max("at").alias("last"))
    splits = splits.withColumn("begun", _earlier(F.col("quotes"), ["file"], "block") % 2)
    splits = splits.withColumn("open", _earlier(F.when(F.col("begun") == 0, F.col("sum0")).otherwise(F.col("sum1")), ["file"], "block"))
    splits = splits.withColumn("lasting", F.max("block").over(Window.partitionBy("file")) == F.col("block"))
    parts = _with(parts, splits.select(*_SPLIT, "begun", "open", "lasting", "last"))
    final = F.col("lasting") & (F.col("at") == F.col("last"))  # the file's last fragment had no mark
    outside = (F.col("begun") + F.col("odd") + F.col("quotes")) % 2 == 0
    depth = F.col("open") + F.when(F.col("begun") == 0, F.col("depth0") + F.col("step0")).otherwise(F.col("depth1") + F.col("step1"))
    parts = parts.select(*_SPLIT, "at", "text", final.alias("final"), (outside & (depth == 1) & ~final).cast("int").alias("ends"))

    ends = parts.groupBy(*_SPLIT).agg(F.sum("ends").alias("n"))
    ends = ends.select(*_SPLIT, _earlier(F.col("n"), ["file"], "block").alias("first"))
    parts = _with(parts.withColumn("local", _earlier(F.col("ends"), _SPLIT, "at")), ends)
    pieces = F.array_sort(F.collect_list(F.struct("block", "at", "text")))
    body = F.array_join(F.transform(pieces, lambda x: x.text), _MARK)
    out = parts.groupBy("file", (F.col("first") + F.col("local")).alias("record")).agg(body.alias("body"), F.max("final").alias("final"))
    body = F.when(F.col("record") == 0, F.regexp_replace("body", r"^\s*\{", "")).otherwise(F.col("body"))
    body = F.when(F.col("final"), F.regexp_replace(body, r"\}\s*$", "")).otherwise(F.concat(body, F.lit("}")))
    return out.select("file", "record", F.concat(F.lit("{"), body, F.lit("}")).alias("entries"))


def read_keyed_json_split(spark: SparkSession, path: str, fields: Sequence[str]) -> DataFrame:
    """As ``scan.read_keyed_json``, with files of any size cut at record borders and read by several tasks."""
    from touchline.sources.scan import keyed_columns

    parsed = keyed_records(spark, path).select(F.explode(F.from_json("entries", "map<string, map<string, string>>")).alias("key", "v"))
    return parsed.select(*keyed_columns(fields))
