"""SRC-3 / D5: Parquet trees whose files disagree, read without a schema made by hand.

Spark merges the footers of many files in one distributed pass, as long as a column keeps
its type.  Where that fails the sorted file list is halved until each part merges: files of
one layout lie together, so parts are few.  Column types are then widened over the parts,
and each part is read with its own types and cast (Parquet readers do not widen every
type themselves, bigint to double for one).
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def widest(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds the values of both; text where there is no other.

    Whole numbers widen to the larger; with a float or double to double; with a decimal to a
    decimal that holds both.  Dates widen to timestamps.  Structs widen field by field, and
    lists and maps by their elements.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    kinds = {type(a), type(b)}
    if kinds <= set(_WHOLE):
        return max(a, b, key=lambda t: _WHOLE.index(type(t)))
    if kinds <= {*_WHOLE, T.FloatType, T.DoubleType, T.DecimalType}:
        if kinds & {T.FloatType, T.DoubleType}:
            return T.DoubleType()
        x, y = (t if isinstance(t, T.DecimalType) else T.DecimalType(_DIGITS[type(t)], 0) for t in (a, b))
        scale, whole = max(x.scale, y.scale), max(x.precision - x.scale, y.precision - y.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
    if kinds <= {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    if kinds <= {T.DateType, T.TimestampType, T.TimestampNTZType}:
        return T.TimestampType()
    if kinds == {T.StructType}:
        return widest_schema([a, b])
    if kinds == {T.ArrayType}:
        return T.ArrayType(widest(a.elementType, b.elementType))
    if kinds == {T.MapType}:
        return T.MapType(widest(a.keyType, b.keyType), widest(a.valueType, b.valueType))
    return T.StringType()


def widest_schema(schemas: Sequence[T.StructType]) -> T.StructType:
    """All columns of all schemas, in order of first appearance, each of its widest type."""
    types: dict[str, T.DataType] = {}
    for f in (f for s in schemas for f in s.fields):
        types[f.name] = widest(types[f.name], f.dataType) if f.name in types else f.dataType
    return T.StructType([T.StructField(n, t) for n, t in types.items()])


def list_files(spark: SparkSession, root: str) -> list[str]:
    """Paths of the Parquet files below ``root``, sorted (the content is not read)."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    return sorted(r["path"] for r in found.select("path").collect())


def _merged(spark: SparkSession, files: list[str]) -> T.StructType | None:
    """The schema that all the files fit, from their footers; None if they disagree."""
    try:
        return spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(*files).schema
    except (PySparkException, Py4JJavaError) as e:
        if "CANNOT_MERGE_SCHEMAS" in str(e):
            return None
        raise


def alike(spark: SparkSession, files: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """The files cut into runs that agree, with the schema of each."""
    schema = _merged(spark, files)
    if schema is not None:
        return [(schema, files)]
    half = len(files) // 2
    parts = alike(spark, files[:half]) + alike(spark, files[half:])
    out = parts[:1]
    for schema, names in parts[1:]:
        if schema == out[-1][0]:
            out[-1] = (schema, out[-1][1] + names)
        else:
            out.append((schema, names))
    return out


def _folders(files: list[str], root: str) -> dict[str, T.DataType]:
    """Columns that ``key=value`` folders name, in order: whole numbers where all values are plain ones, else text."""
    values: dict[str, set] = {}
    for f in files:
        for key, value in re.findall(r"(?<=/)([^/=]+)=([^/]*)(?=/)", f[len(root):]):
            values.setdefault(unquote(key), set()).add(unquote(value))
    plain = re.compile(r"-?(0|[1-9][0-9]{0,17})")
    return {k: T.LongType() if all(plain.fullmatch(v) for v in seen - {_NO_VALUE}) and seen != {_NO_VALUE} else T.StringType() for k, seen in values.items()}


def read_drifting(spark: SparkSession, root: str) -> DataFrame:
    """All Parquet files below ``root`` as one table: the union of their columns, each of its widest type.

    A column that a file lacks is null there.  ``key=value`` folders become columns, after the
    others.  An empty folder raises FileNotFoundError.
    """
    files = list_files(spark, root)
    if not files:
        raise FileNotFoundError(f"no Parquet file below {root}")
    top = _common_root(files, root)
    folders = _folders(files, top)
    parts = alike(spark, files)
    wide = widest_schema([T.StructType([f for f in schema.fields if f.name not in folders]) for schema, _ in parts])

    def read(schema: T.StructType, names: list[str]) -> DataFrame:
        own = T.StructType([f for f in schema.fields if f.name not in folders])
        given = T.StructType([*own.fields, *[T.StructField(c, T.StringType()) for c in folders]])
        df = spark.read.schema(given).option("basePath", top).parquet(*names)
        columns = [(F.col(f"`{f.name}`") if f.name in own.names else F.lit(None)).cast(f.dataType).alias(f.name) for f in wide.fields]
        return df.select(*columns, *[F.col(f"`{c}`").cast(t).alias(c) for c, t in folders.items()])

    return reduce(DataFrame.unionByName, [read(*p) for p in parts])


def _common_root(files: list[str], root: str) -> str:
    """``root`` as the listed paths spell it (scheme and authority included)."""
    path = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", root).rstrip("/")
    at = files[0].find(f"{path}/")
    return files[0][:at + len(path)] if at >= 0 else root.rstrip("/")
