"""SimHash near-duplicates by covering locality-sensitive hashing.

A document's fingerprint has one bit per hash bit, set when more than half of its
shingle hashes set it.  Fingerprints are linked at ``radius`` or fewer differing bits.

Candidate search is a covering family: every bit position i gets a non-zero vector m(i)
of radius+1 bits, and each non-zero vector v of as many bits is one table whose mask
holds the positions with <m(i), v> odd.  For any pair within the radius some v is
orthogonal to the vectors of all differing positions, so the pair agrees on that whole
mask: it collides in that table for certain, not with some probability.

Exact copies collapse to one fingerprint first.  Buckets of up to ``bucket_pairs``
distinct fingerprints compare their members pairwise; the members of larger buckets
link through shared neighbours instead: two fingerprints within 2 bits of each other are
both within 1 bit of some 64-bit value, so grouping the 65 values around each
member by value finds every such link in linear work (radii above 2 take more rounds).
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.common import drop_by_key, materialise, texts_of, with_arrow_columns
from touchline.llm.components import connected_components

BITS = 64
_CHUNK = 1 << 18  # shingle hashes whose bits are unpacked at a time (16 MB)


def shingle_hashes(text: str, width: int, seed: int) -> list[int]:
    """XXH64 of each shingle of ``width`` words (A-Z lower-cased, joined by one space)."""
    import xxhash

    words = text.encode().lower().split()  # bytes: ASCII case and ASCII white space only
    if not words:
        return []
    line = b" ".join(words)
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(line, seed)]
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    digest = xxhash.xxh64_intdigest
    return [digest(line[s:e - 1], seed) for s, e in zip(starts, starts[width:])]


def fingerprints(texts: list[str], width: int, seed: int) -> np.ndarray:
    """Fingerprint of each text as uint64; a text without words gives zero."""
    out = np.zeros(len(texts), dtype=np.uint64)
    powers = np.left_shift(np.uint64(1), np.arange(BITS, dtype=np.uint64))
    for i, text in enumerate(texts):
        hashes = np.array(shingle_hashes(text, width, seed), dtype="<u8")
        ones = np.zeros(BITS, dtype=np.int64)
        for at in range(0, len(hashes), _CHUNK):
            part = hashes[at:at + _CHUNK]
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
        out[i] = powers[2 * ones > len(hashes)].sum(dtype=np.uint64)
    return out


def fingerprint_table(docs: DataFrame, width: int, seed: int, text: str = "text", key: str = "doc_id",
                      others: Iterable[str] = ()) -> DataFrame:
    """(key, others, fp long): one row per document; whole texts, one Arrow batch at a time."""
    kept = [key, *others]

    def compute(batch: pa.RecordBatch) -> list:
        return [fingerprints(texts_of(batch, text), width, seed).view(np.int64)]

    return with_arrow_columns(docs.select(*kept, text), [T.StructField("fp", T.LongType())], compute, keep=kept)


def covering_masks(radius: int) -> list[int]:
    """The 2**(radius+1)-1 bit masks of the covering family, as signed 64-bit values.

    Position i carries the vector 1 + i mod (2**(radius+1)-1): all non-zero vectors in
    turn, so every mask holds just over half of the positions.
    """
    vectors = (1 << (radius + 1)) - 1
    masks = []
    for v in range(1, vectors + 1):
        mask = sum(1 << i for i in range(BITS) if ((1 + i % vectors) & v).bit_count() % 2)
        masks.append(mask - (1 << BITS) if mask >> (BITS - 1) else mask)
    return masks


def _pairs_in_small(members: DataFrame, radius: int) -> DataFrame:
    """Links between members of one bucket, which holds few enough to compare pairwise."""
    listed = members.groupBy("tab", "bucket").agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    a = listed.select("fps", F.explode("fps").alias("a"))
    near = F.expr(f"filter(fps, b -> b > a and bit_count(b ^ a) <= {radius})")
    return a.select("a", F.explode(near).alias("b"))


def _links_by_neighbour(members: DataFrame) -> DataFrame:
    """Links at up to 2 bits: each member to the smallest that shares a value within 1 bit."""
    flips = [F.lit(0).cast("long")] + [F.lit((1 << i) - (1 << BITS) if i == BITS - 1 else 1 << i) for i in range(BITS)]
    around = members.select("fp", F.explode(F.array(*flips)).alias("flip"))
    shared = (around.groupBy(F.col("fp").bitwiseXOR(F.col("flip")).alias("hub"))
              .agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1))  # at most 65 values lie within 1 bit
    pair = shared.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
    return pair.where("a != b")


def fingerprint_links(fps: DataFrame, radius: int = 2, bucket_pairs: int = 48) -> DataFrame:
    """Links (a, b) between distinct fingerprints whose components are those of all links within ``radius``."""
    if radius > 2:
        raise ValueError("large buckets are resolved through shared 1-bit neighbours, which reaches radius 2")
    masks = covering_masks(radius)
    tables = F.explode(F.array(*[F.struct(F.lit(i).alias("tab"), F.lit(m).alias("mask")) for i, m in enumerate(masks)]))
    keyed = (fps.select("fp", tables.alias("t"))
             .select("fp", F.col("t.tab").alias("tab"), F.col("fp").bitwiseAND(F.col("t.mask")).alias("bucket")))
    sizes = keyed.groupBy("tab", "bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = materialise(keyed.join(sizes, ["tab", "bucket"]), "bucket_members")
    few = members.where(F.col("n") <= bucket_pairs)
    many = members.where(F.col("n") > bucket_pairs).select("fp").distinct()
    near = _pairs_in_small(few, radius)
    if radius < 2:  # shared neighbours also join pairs at 2 bits apart: they must not stand in for a link at 1
        return near.unionByName(_adjacent(many, radius)).distinct()
    return near.unionByName(_links_by_neighbour(many)).distinct()


def _adjacent(members: DataFrame, radius: int) -> DataFrame:
    """Links at one differing bit by looking each single-bit variant up; none at radius 0."""
    if radius == 0:
        return members.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("false")
    flips = F.array(*[F.lit((1 << i) - (1 << BITS) if i == BITS - 1 else 1 << i) for i in range(BITS)])
    around = members.select(F.col("fp").alias("a"), F.explode(flips).alias("flip"))
    around = around.select("a", F.col("a").bitwiseXOR(F.col("flip")).alias("b")).where("b > a")
    return around.join(members.select(F.col("fp").alias("b")), "b").select("a", "b")


def fp_hex(fp: Column) -> Column:
    """16 lowercase hexadecimal digits of a 64-bit fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def simhash_components(docs: DataFrame, width: int = 3, radius: int = 2, seed: int = 42, bucket_pairs: int = 48,
                       text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, fp, component_id): component_id is the smallest key reachable over links, itself included.

    Null and word-less texts have fingerprint zero and link like any other; repeated
    rows are linked copies of each other; rows with a null key take part and get the
    component's smallest non-null key (null if there is none).  An empty table gives an
    empty result; columns besides key and text are not read.
    """
    prints = materialise(fingerprint_table(docs, width, seed, text, key), "fingerprints")
    return _components(prints, radius, bucket_pairs, key)


def fingerprint_roots(classes: DataFrame, radius: int = 2, bucket_pairs: int = 48) -> DataFrame:
    """``classes`` (one row per ``fp``) with root: the same for all fingerprints of one component."""
    links = fingerprint_links(classes.select("fp"), radius, bucket_pairs)
    roots = connected_components(links, "a", "b")
    placed = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    return placed.withColumn("root", F.coalesce("root", "fp"))


def _components(prints: DataFrame, radius: int, bucket_pairs: int, key: str) -> DataFrame:
    placed = fingerprint_roots(prints.groupBy("fp").agg(F.min(key).alias("least")), radius, bucket_pairs)
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    placed = materialise(placed.select("fp", "root").join(least, "root").select("fp", "component_id"), "components")
    return prints.join(placed, "fp")


def keep_one_per_group(docs: DataFrame, width: int = 3, radius: int = 2, seed: int = 42,
                       text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` (all columns) with one document left of each linked group: the smallest key.

    Rows that repeat a kept key collapse to one row.  A group without any non-null key
    keeps all its rows, as nothing tells them apart.
    """
    placed = materialise(simhash_components(docs, width, radius, seed, text=text, key=key), "simhash_placed")
    gone = placed.where(F.col(key) != F.col("component_id")).select(key).distinct()
    left = drop_by_key(docs, gone, key)
    left = left.where(F.col(key).isNotNull()).unionByName(_keyless(docs, placed, key, text, width, seed))
    again = placed.where(F.col(key) == F.col("component_id")).groupBy(key).count().where("count > 1").select(key)
    if again.limit(1).count() == 0:
        return left
    once = left.join(again, key, "left_semi").dropDuplicates([key])
    return drop_by_key(left, again, key).unionByName(once)


def _keyless(docs: DataFrame, placed: DataFrame, key: str, text: str, width: int, seed: int) -> DataFrame:
    """Rows without a key whose group holds no key at all."""
    rows = docs.where(F.col(key).isNull())
    if placed.where(F.col(key).isNull() & F.col("component_id").isNull()).limit(1).count() == 0:
        return rows.where("false")
    alone = placed.where(F.col("component_id").isNull()).select("fp").distinct()

    def compute(batch: pa.RecordBatch) -> list:
        return [fingerprints(texts_of(batch, text), width, seed).view(np.int64)]

    marked = with_arrow_columns(rows, [T.StructField("touchline_fp", T.LongType())], compute)
    alone = alone.withColumnRenamed("fp", "touchline_fp")
    return marked.join(alone, "touchline_fp", "left_semi").drop("touchline_fp")
