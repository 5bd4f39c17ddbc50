"""Merkle manifest of a dataset: per-source trees, and proofs by butterfly exchange.

1. Every row becomes a leaf digest, and gets its place within its source from one range
   shuffle (places within a partition plus offsets), so a hot source is spread.
2. Aligned blocks of ``fanout ** block_levels`` leaves are the partitions of the exchange.
   Each folds its leaves to the root of its subtree.
3. Butterfly: in each round, aligned groups of ``fanout`` subtrees swap their roots.  Every
   block takes part in the lane of its place within its subtree and hashes the common ancestor
   for itself, so after the last round each block holds the top digest and the siblings of
   all its ancestors: nothing is passed down.  In a subtree that ends early, members serve
   several lanes.  The same exchange over the subroots of the sources leads to the root.
4. A block's leaves and its upper proof meet once more; leaf proofs are listed and folded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import BROADCAST_ROWS, materialise

FANOUT, BLOCK_LEVELS = 16, 3
_HEX = 64  # characters of a digest


def digest_of(*values: Column) -> Column:
    """Hex sha256 over the values one after the other: ``-`` for null, else UTF-8 byte count, ``:`` and the value's text."""
    parts = [F.coalesce(F.concat(F.octet_length(v.cast("string")), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def climb(nodes: list[str], fanout: int, levels: int | None) -> list[list[str]]:
    """The nodes and all levels above them: ``levels`` of them, or up to a single node."""
    out = [nodes]
    while len(out) <= levels if levels is not None else len(out[-1]) > 1:
        below = out[-1]
        out.append([_h("".join(below[i:i + fanout])) for i in range(0, len(below), fanout)])
    return out


def numbered(rows: DataFrame, segment: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``rows`` with tl_pos, its place (from 0) in its segment, and tl_total, the segment's rows.

    ``order`` begins with the segment and is total.  The sorted partitions are written, so a
    task that runs again finds the places it gave.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    dealt = materialise(dealt.withColumn("tl_at", F.monotonically_increasing_id()), "numbered")
    piece = F.shiftright("tl_at", 33)  # the partition, above a counter of 33 bits
    pieces = dealt.groupBy(piece.alias("tl_piece"), *segment).agg(F.min("tl_at").alias("tl_first"), F.count("*").alias("tl_n"))
    whole = Window.partitionBy(*segment)
    before = F.sum("tl_n").over(whole.orderBy("tl_piece").rowsBetween(Window.unboundedPreceding, -1))
    pieces = pieces.select("tl_piece", *segment, (F.coalesce(before, F.lit(0)) - F.col("tl_first")).alias("tl_shift"),
                           F.sum("tl_n").over(whole).alias("tl_total"))
    pieces = materialise(pieces, "pieces")  # a row for each segment, and one for each partition at most
    small = pieces.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    dealt = dealt.withColumn("tl_piece", piece)
    out = dealt.join(F.broadcast(pieces) if small else pieces, ["tl_piece", *segment])
    return out.withColumn("tl_pos", F.col("tl_at") + F.col("tl_shift")).drop("tl_at", "tl_piece", "tl_shift")


def butterfly(nodes: DataFrame, segment: Sequence[str], fanout: int = FANOUT) -> DataFrame:
    """(segment, idx, top, path): for each of a segment's nodes (idx of total, digest node) the top digest and the upper proof.

    ``path`` lists, from the nodes' own level up, the siblings before and behind the node's
    ancestor.  A segment of one node is its own top.  A group's rows are at most ``fanout``;
    a round moves at most twice the nodes.
    """
    seg = list(segment)
    path = "array<struct<before:string,behind:string>>"
    now = materialise(nodes.select(*seg, "idx", "total", "node", F.expr(f"cast(array() as {path})").alias("path")), "nodes")
    most = now.agg(F.max("total")).first()[0] or 0
    stride = 1
    while most > stride:  # one round a level
        going = now.where(F.col("total") > stride)
        tree = F.expr(f"idx div {stride}")
        lane, child = F.col("idx") % stride, tree % fanout
        members = F.least(F.lit(stride), F.col("total") - tree * stride)
        last = F.when(child > 0, F.lit(stride - 1).cast("long")).otherwise(lane)  # a subtree alone in its group has no partners
        sent = going.select(*seg, F.expr(f"idx div {stride * fanout}").alias("group"), lane.alias("own"), F.explode(F.sequence(lane, last, members)).alias("lane"),
                            child.alias("child"), "idx", "total", "node", "path")
        own = F.col("own") == F.col("lane")
        item = F.struct("child", "node", own.alias("here"), "idx", "total", F.when(own, F.col("path")).alias("path"))
        met = sent.groupBy(*seg, "group", "lane").agg(F.sort_array(F.collect_list(item)).alias("all"))
        digests = F.array_join(F.transform("all", lambda x: x.node), "")
        met = met.select(*seg, "all", digests.alias("joined"), F.sha2(digests.cast("binary"), 256).alias("up"),
                         F.explode(F.filter("all", lambda x: x.here)).alias("x"))
        at = F.array_position(F.transform("all", lambda x: x.child), F.col("x.child")).cast("int")
        step = F.struct(F.expr(f"substring(joined, 1, (at - 1) * {_HEX})").alias("before"),
                        F.expr(f"substring(joined, at * {_HEX} + 1)").alias("behind"))
        raised = met.withColumn("at", at).select(*seg, "x.idx", "x.total", F.col("up").alias("node"),
                                                 F.concat("x.path", F.array(step)).cast(path).alias("path"))
        now = materialise(raised.unionByName(now.where(F.col("total") <= stride)), "round")
        stride *= fanout
    return now.select(*seg, "idx", F.col("node").alias("top"), "path")


def merkle_manifest(docs: DataFrame, fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), key: str = "doc_id",
                    source: str = "source", shown: Column | None = None, fanout: int = FANOUT, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified): one row per row of ``docs``.

    A leaf digests ``fields``; a source's leaves ascend by key (null first; repeated keys by
    digest).  Each ``fanout`` consecutive nodes hash to one until one is left, the source's
    subroot; the subroots, by source (null first, bytewise), likewise to ``root``.  ``proof_sha256``
    digests the siblings of all levels, from the leaf up, left to right.  ``shown`` is the leaf
    digest (hex) that is presented for verification, by default the leaf itself: it is folded
    with the siblings to ``folded_root``, and ``verified`` tells whether that is the root.

    Repeated rows are leaves of their own; an empty table gives an empty result; other columns
    are not read.  A task holds some blocks of fanout ** block_levels digests, whatever a
    source's size.
    """
    leaf = digest_of(*[F.col(f) for f in fields])
    rows = docs.select(F.col(key).alias("key"), F.col(source).isNull().alias("nosrc"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("src"),
                       F.unhex(leaf).alias("leaf"), (F.lit(None).cast("binary") if shown is None else F.unhex(shown)).alias("shown"))
    rows = materialise(rows.withColumn("row", F.monotonically_increasing_id()), "leaves")
    seg = ["nosrc", "src"]
    by_source = [F.col("nosrc").desc(), F.col("src").asc()]
    rows = numbered(rows, seg, [*by_source, F.col("key").asc_nulls_first(), F.col("leaf"), F.col("row")]).drop("row")
    block = fanout ** block_levels
    rows = rows.withColumn("blk", F.expr(f"tl_pos div {block}")).withColumn("nblk", F.expr(f"(tl_total + {block - 1}) div {block}"))
    slots = max(1, -(-rows.count() // block))

    def in_slot(df: DataFrame) -> DataFrame:
        return df.withColumn("slot", F.pmod(F.xxhash64("nosrc", "src", "blk"), F.lit(slots))).groupBy("slot")

    def blocks(table: pa.Table):
        """(nosrc, src, blk, levels above the leaves, rows in order) of each block of a task's rows."""
        table = table.sort_by([("nosrc", "ascending"), ("src", "ascending"), ("tl_pos", "ascending")])
        names = list(zip(*(table[c].to_pylist() for c in ("nosrc", "src", "blk", "nblk"))))
        lo = 0
        for hi in range(1, len(names) + 1):
            if hi == len(names) or names[hi] != names[lo]:
                part = table.slice(lo, hi - lo)
                nodes = [d.hex() for d in part["leaf"].to_pylist()]
                yield names[lo], part, climb(nodes, fanout, block_levels if names[lo][3] > 1 else None)
                lo = hi

    def fold(keys: tuple, table: pa.Table) -> pa.Table:
        done = [(*name, levels[-1][0]) for name, _, levels in blocks(table)]
        return pa.table(dict(zip(("nosrc", "src", "idx", "total", "node"), zip(*done))))

    tops = in_slot(rows.select(*seg, "blk", "nblk", "tl_pos", "leaf")).applyInArrow(fold, "nosrc boolean, src string, idx bigint, total bigint, node string")
    uppers = butterfly(tops, seg, fanout)
    sources = uppers.where("idx = 0").select(*seg, F.col("top").alias("node"))
    sources = numbered(sources, [], by_source).select(*seg, F.col("tl_pos").alias("idx"), F.col("tl_total").alias("total"), "node")
    sources = materialise(sources, "subroots")
    upmost = butterfly(sources.select("idx", "total", "node"), [], fanout).select("idx", F.col("top").alias("root"), F.col("path").alias("rest"))
    sources = sources.join(upmost, "idx").select(*seg, F.col("node").alias("subroot"), "root", "rest")
    small = sources.limit(BROADCAST_ROWS // 64 + 1).count() <= BROADCAST_ROWS // 64
    uppers = uppers.join(F.broadcast(sources) if small else sources, seg)
    uppers = uppers.select(*seg, F.col("idx").alias("blk"), "subroot", "root", F.concat("path", "rest").alias("path"))
    key_type = docs.schema[key].dataType.simpleString()
    schema = f"key {key_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"

    def prove(table: pa.Table, above: pa.Table) -> pa.Table:
        upper = {(r["nosrc"], r["src"], r["blk"]): r for r in above.to_pylist()}
        out: list[tuple] = []
        keys: list[pa.ChunkedArray] = []
        for (nosrc, src, blk, _), part, levels in blocks(table):
            up = upper[nosrc, src, blk]
            keys += part["key"].chunks
            beyond = [(p["before"], p["behind"]) for p in up["path"]]
            rest = "".join(a + b for a, b in beyond)
            joined = [["".join(level[i:i + fanout]) for i in range(0, len(level), fanout)] for level in levels[:-1]]
            for i, (own, shown) in enumerate(zip(levels[0], part["shown"].to_pylist())):
                steps, at = [], i
                for groups in joined:
                    group, child = groups[at // fanout], at % fanout * _HEX
                    steps.append((group[:child], group[child + _HEX:]))
                    at //= fanout
                folded = own if shown is None else shown.hex()
                for a, b in [*steps, *beyond]:
                    folded = _h(a + folded + b)
                out.append((own, up["subroot"], up["root"], _h("".join(a + b for a, b in steps) + rest), folded, folded == up["root"]))
        names = ["key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        return pa.table([pa.chunked_array(keys, table["key"].type), *[pa.array(c) for c in zip(*out)]], names=names)

    proofs = in_slot(rows.select("key", *seg, "blk", "nblk", "tl_pos", "leaf", "shown")).cogroup(in_slot(uppers)).applyInArrow(prove, schema)
    return proofs.withColumnRenamed("key", key)
