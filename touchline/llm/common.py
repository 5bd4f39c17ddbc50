"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.session import ensure_checkpoint_dir

#: Rows up to which a table of narrow keys is broadcast (16 bytes a row: 16 MB at most).
BROADCAST_ROWS = 1_000_000

#: Text bytes of a batch that Python handles at a time.
SLICE_BYTES = 2 << 20

#: ASCII white space, the word separators of the contracts.
ASCII_SPACE = "\t\n\x0b\x0c\r "


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a given table; other columns never enter the plan."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it back.

    Cuts the lineage for good (a lost executor costs no recomputation of what lies
    above) and, unlike ``checkpoint()``, keeps column pruning and size statistics.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows, without copying, of about ``most`` bytes of text each; a longer row stands alone."""
    sizes = np.full(batch.num_rows, 16, dtype=np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            sizes += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(cuts, cuts[1:]):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


def with_arrow_columns(df: DataFrame, fields: Iterable[T.StructField],
                       compute: Callable[[pa.RecordBatch], list], keep: Iterable[str] | None = None) -> DataFrame:
    """Append columns computed batch-wise in Arrow; ``keep`` names the columns passed through.

    ``compute`` gets a record batch and returns one list or array per new field.
    Rows pass through one to one, in slices of a batch that hold SLICE_BYTES of text or one
    row, so what Python copies of a batch is bounded by bytes and not by rows.
    """
    fields = list(fields)
    kept = list(df.columns if keep is None else keep)
    schema = T.StructType([df.schema[c] for c in kept] + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in (part for whole in batches for part in slices(whole)):
            new = compute(batch)
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            arrays += [pa.array(v, type=arrow.field(f.name).type) for f, v in zip(fields, new)]
            yield pa.RecordBatch.from_arrays(arrays, names=arrow.names)

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Whole texts of a batch, null read as empty."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def drop_by_key(df: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not in ``gone`` (one row per key).

    ``gone`` is counted first: up to BROADCAST_ROWS keys are broadcast, so wide rows
    stay where they are; beyond that both sides are shuffled by the key.  Null keys
    match nothing and stay.
    """
    small = gone.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return df.join(F.broadcast(gone) if small else gone.hint("shuffle_hash"), key, "left_anti")


def crc_fold(doc_id, n: int):
    """crc32 of the id's text, modulo ``n``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n
