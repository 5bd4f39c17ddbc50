"""Conflict-constrained best-fit packing of documents into fixed-size sequences.

Texts longer than the capacity are cut into full pieces and a rest.  Pieces are dealt by
hash into shards of bounded size, and each shard is packed on its own in decreasing order
of length.  Open bins are ordered by residual; each carries one bitmap of the sources and
one of the duplicate clusters in it.  A piece goes to the successor of its length among
the residuals; while the bins there conflict with it the search goes on to the next
residual, so the tightest compatible bin is found, or a new one is opened.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm import simhash
from touchline.llm.common import materialise

#: Mean number of pieces in a shard; bounds a task's memory, and its search.
SHARD_PIECES = 8192


def best_fit(lengths: list[int], sources: list, clusters: list, capacity: int) -> list[int]:
    """Bin of each piece, taken in the given order.

    Two pieces share a bin only if their sources differ and their clusters differ; None
    conflicts with nothing.  Of the compatible bins the one with the least residual wins,
    on ties the oldest.  Bins of one residual are grouped by source bitmap, so that a
    conflict with a common source skips whole groups.
    """
    source_bit = {s: 1 << i for i, s in enumerate(dict.fromkeys(s for s in sources if s is not None))}
    often = [c for c, n in Counter(c for c in clusters if c is not None).items() if n > 1]
    cluster_bit = {c: 1 << i for i, c in enumerate(often)}  # a cluster with one piece conflicts with none
    residuals: list[int] = []  # the occupied ones, ascending
    at: dict[int, dict[int, list[int]]] = {}  # residual -> source bitmap -> its bins, oldest first
    held: list[int] = []  # cluster bitmap of each bin
    placed = []
    for length, source, cluster in zip(lengths, sources, clusters):
        s, c = source_bit.get(source, 0), cluster_bit.get(cluster, 0)
        found = None
        for k in range(bisect_left(residuals, length), len(residuals)) if length < capacity else ():
            for bitmap, bins in at[residuals[k]].items():
                if bitmap & s:
                    continue
                first = next((b for b in bins if not held[b] & c), None) if c else bins[0]
                if first is not None and (found is None or first < found[2]):
                    found = (residuals[k], bitmap, first)
            if found:
                break
        if found:
            residual, bitmap, b = found
            bins = at[residual][bitmap]
            bins.remove(b)
            if not bins:
                del at[residual][bitmap]
                if not at[residual]:
                    del at[residual]
                    residuals.pop(bisect_left(residuals, residual))
        else:
            residual, bitmap, b = capacity, 0, len(held)
            held.append(0)
        held[b] |= c
        placed.append(b)
        if residual > length:
            left = residual - length
            if left not in at:
                insort(residuals, left)
                at[left] = {}
            insort(at[left].setdefault(bitmap | s, []), b)
    return placed


def rows_to_pack(docs: DataFrame, text: str, key: str, source: str, cluster: str | None) -> DataFrame:
    """(doc, chars, src, copies, mix, row): what packing knows of each text that needs a place; text stays behind.

    ``row`` numbers the rows, repeats too.  The table is written, so that a task run again
    deals no row anew.
    """
    copies = F.xxhash64(text) if cluster is None else F.col(cluster)
    rows = docs.select(F.col(key).alias("doc"), F.length(text).alias("chars"), F.col(source).alias("src"), copies.alias("copies"),
                       F.xxhash64(key, text).alias("mix"))
    return materialise(rows.where("chars > 0").withColumn("row", F.monotonically_increasing_id()), "packing_rows")


def rows_by_likeness(docs: DataFrame, text: str, key: str, source: str, width: int = 3, radius: int = 2, seed: int = 42) -> DataFrame:
    """``rows_to_pack`` with the text's SimHash component as its cluster, row by row (keys may repeat or be null)."""
    rows = docs.select(F.col(key).alias("doc"), F.length(text).alias("chars"), F.col(source).alias("src"),
                       F.xxhash64(key, text).alias("mix"), F.col(text).alias("text")).where("chars > 0")
    prints = simhash.fingerprint_table(rows, width, seed, key="doc", others=("chars", "src", "mix"))
    prints = materialise(prints.withColumn("row", F.monotonically_increasing_id()), "packing_prints")
    roots = materialise(simhash.fingerprint_roots(prints.select("fp").distinct(), radius), "packing_roots")
    return prints.join(roots, "fp").select("doc", "chars", "src", F.col("root").alias("copies"), "mix", "row")


def pieces_of(rows: DataFrame, capacity: int) -> DataFrame:
    """(doc, piece, start, length, src, copies, mix, row): what is packed."""
    items = rows.withColumn("piece", F.explode(F.sequence(F.lit(0), F.floor((F.col("chars") - 1) / capacity).cast("int"))))
    start = F.col("piece") * capacity
    return items.select("doc", "piece", start.cast("long").alias("start"),
                        F.least(F.lit(capacity), F.col("chars") - start).cast("long").alias("length"), "src", "copies", "mix", "row")


def pack(docs: DataFrame, capacity: int = 8192, text: str = "text", key: str = "doc_id", source: str = "source",
         cluster: str | None = None, shard_pieces: int = SHARD_PIECES, near: bool = False) -> DataFrame:
    """(key, piece, start, length, bin_id, bin_offset): where each piece of each text goes.

    Lengths and offsets are in code points; piece p covers [start, start+length) of its
    text, and bin_offset is its place in the sequence ``bin_id``.  No bin holds more than
    ``capacity``, two pieces of one source, or two pieces of one duplicate cluster
    (``cluster`` names its column; with ``near`` it is the SimHash component, and equal
    texts are always in one; by default equal texts alone are a cluster).  A null source or
    cluster conflicts with nothing.  Null and empty texts need no place and give no row;
    repeated rows are packed once each.  An empty table gives an empty result.
    """
    rows = rows_by_likeness(docs, text, key, source) if near else rows_to_pack(docs, text, key, source, cluster)
    items = pieces_of(rows, capacity)
    total = items.agg(F.count("*")).first()[0]
    shards = max(1, -(-total // shard_pieces))
    items = items.withColumn("shard", F.pmod(F.xxhash64("mix", "row", "piece"), F.lit(shards))).drop("mix", "row")
    schema = (f"{key} {docs.schema[key].dataType.simpleString()}, piece int, start bigint, length bigint, "
              "bin_id bigint, bin_offset bigint")

    def pack_shard(keys: tuple, shard: pa.Table) -> pa.Table:
        shard = shard.sort_by([("length", "descending"), ("doc", "ascending"), ("piece", "ascending")])
        lengths = shard["length"].to_pylist()
        bins = best_fit(lengths, shard["src"].to_pylist(), shard["copies"].to_pylist(), capacity)
        filled, offsets = [0] * (max(bins) + 1), []
        for b, length in zip(bins, lengths):
            offsets.append(filled[b])
            filled[b] += length
        first = keys[0].as_py() << 24
        return pa.table({key: shard["doc"], "piece": shard["piece"], "start": shard["start"], "length": shard["length"],
                         "bin_id": pa.array([first + b for b in bins], pa.int64()),
                         "bin_offset": pa.array(offsets, pa.int64())})

    return items.groupBy("shard").applyInArrow(pack_shard, schema)
