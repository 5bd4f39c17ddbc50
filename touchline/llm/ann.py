"""Nearest neighbours by largest inner product, by a forest of hash prefixes.

1. Equal vectors become one class.  A class is scaled by the largest length and given one
   more part that makes its length one; a query is scaled to length one: then the largest
   inner product is the smallest angle.
2. Every tree gives each class a string of 63 bits: nine symbols, each the axis (and its
   sign) that a random projection of the vector lies nearest to.  A tree is its strings in
   sorted order, cut into cells of one prefix that hold at most ``CELL_ROWS`` strings.
3. A query descends each tree to its longest matching prefix, and ascends in step in all
   trees: at each depth the strings that share so long a prefix are one stretch of the sorted
   array.  It stops at the depth where the stretches of all trees hold ``m`` candidates.
4. Candidates are dealt to the blocks that hold their vectors and compared there by inner
   product in double precision.
5. ``m`` is the least of a doubling row at which a bounded sample of queries finds
   ``TARGET`` of its true neighbours.  Queries that no depth serves (more than ``DENSE * m``
   candidates at the first depth with enough, as among thousands of near copies, or too few
   in the cells) are compared with all rows, in blocks; so are all, if no ``m`` does.
"""

from __future__ import annotations

import logging

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import BROADCAST_ROWS, materialise

log = logging.getLogger(__name__)

TREES, PROJECTIONS, WIDTH, SYMBOLS = 32, 32, 64, 9
SYMBOL_BITS = 7  # one of 2 * WIDTH directions
BITS = SYMBOLS * SYMBOL_BITS
#: Strings in a cell at most; candidates of a query in all trees, at first and at most; and how far a depth may exceed them.
FIRST, MOST, DENSE = 512, 16_384, 4
CELL_ROWS = DENSE * MOST
#: Queries that are compared with all rows to choose the number of candidates, and the share of neighbours they must find.
SAMPLE, TARGET = 128, 0.95
#: Vectors in a block, queries in a block, candidate pairs in a block (about).
BLOCK_ROWS, BLOCK_QUERIES, BLOCK_PAIRS = 8192, 1024, 1 << 18


class Hasher:
    """Strings of vectors of one length, the same on every worker."""

    def __init__(self, dim: int, seed: int = 7):
        rnd = np.random.default_rng([seed, dim])
        self.axes = rnd.normal(size=(dim + 1, PROJECTIONS * WIDTH)).astype(np.float32)
        order = [rnd.permutation(PROJECTIONS) for _ in range(TREES)]
        self.order = [[t % PROJECTIONS, *(p for p in own.tolist() if p != t % PROJECTIONS)][:SYMBOLS] for t, own in enumerate(order)]

    def strings(self, x: np.ndarray, top: float | None) -> np.ndarray:
        """(rows, TREES) strings; of classes scaled by ``top``, or of queries for None."""
        scale = np.abs(x).max(axis=1, keepdims=True)
        norm = np.linalg.norm(x / scale, axis=1, keepdims=True) * scale
        if top is None:
            x, rest = x / norm, np.zeros_like(norm)
        else:
            x, rest = x / top, np.sqrt(np.maximum(0, 1 - np.square(norm / top)))
        out = np.empty((len(x), TREES), dtype=np.int64)
        for lo in range(0, len(x), 1024):
            part = np.hstack([x[lo:lo + 1024], rest[lo:lo + 1024]]).astype(np.float32) @ self.axes
            part = part.reshape(-1, PROJECTIONS, WIDTH)
            axis = np.abs(part).argmax(axis=2)
            symbols = 2 * axis + (np.take_along_axis(part, axis[:, :, None], 2)[:, :, 0] > 0)
            for t, own in enumerate(self.order):
                bits = np.zeros(len(part), dtype=np.int64)
                for p in own:
                    bits = (bits << SYMBOL_BITS) | symbols[:, p]
                out[lo:lo + 1024, t] = bits
        return out


def _usable(key: str, embedding: str) -> Column:
    x = F.col(embedding)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(F.col(key).isNotNull() & ~bad & F.exists(x, lambda v: v != 0), F.lit(False))


def vector_classes(vectors: DataFrame, key: str, embedding: str) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): rows (id, class); classes (class, vec, dim, top), class being its least id, top its dim's largest length."""
    rows = vectors.where(_usable(key, embedding)).select(F.col(key).alias("id"), F.col(embedding).alias("vec"))
    rows = rows.groupBy("id", "vec").agg(F.lit(1).alias("one"))
    classes = rows.groupBy("vec").agg(F.min("id").alias("class"))
    length = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double")))
    classes = materialise(classes.withColumn("dim", F.size("vec")).withColumn("length", length), "classes")
    tops = classes.groupBy("dim").agg(F.max("length").alias("top"))
    classes = classes.join(tops, "dim").select("class", "vec", "dim", "top")
    rows = materialise(rows.join(classes.select("class", "vec"), "vec").select("id", "class"), "rows")
    return rows, classes


def hash_strings(classes: DataFrame) -> DataFrame:
    """(dim, tree, bits, id, query): a string a tree for each class, and one more for each that is a query."""
    def run(batches):
        hashers: dict[int, Hasher] = {}
        for batch in batches:
            ids, dims, asked, tops = (np.array(batch.column(c).to_pylist()) for c in ("class", "dim", "query", "top"))
            for dim in np.unique(dims).tolist():
                hasher = hashers.setdefault(dim, Hasher(dim))
                of_dim = np.flatnonzero(dims == dim)
                for lo in range(0, len(of_dim), 1024):
                    at = of_dim[lo:lo + 1024]
                    x = np.array(batch.column("vec").take(pa.array(at)).to_pylist(), dtype=np.float64)
                    for given, own, top in ((False, np.arange(len(at)), tops[at[0]]), (True, np.flatnonzero(asked[at]), None)):
                        n = len(own) * TREES
                        if n:
                            yield pa.RecordBatch.from_pydict({
                                "dim": pa.array(np.full(n, dim), pa.int32()), "tree": pa.array(np.tile(np.arange(TREES), len(own)), pa.int32()),
                                "bits": hasher.strings(x[own], top).reshape(-1), "id": np.repeat(ids[at][own], TREES),
                                "query": np.full(n, given)})

    schema = "dim int, tree int, bits bigint, id bigint, query boolean"
    return materialise(classes.select("class", "vec", "dim", "top", "query").mapInArrow(run, schema), "strings")


CELL = ["dim", "tree", "depth", "cell"]


def cut_cells(strings: DataFrame, depth: int, most: int = CELL_ROWS) -> tuple[DataFrame, DataFrame]:
    """``strings`` with depth and cell (its prefix of so many bits), and those in cells beyond ``most`` even at full length."""
    pending, done = strings, []
    while True:
        pending = pending.withColumn("depth", F.lit(depth)).withColumn("cell", F.shiftright("bits", BITS - depth))
        big = materialise(pending.groupBy(*CELL).count().where(F.col("count") > most).drop("count"), "big_cells")
        if big.limit(1).count() == 0:
            done.append(pending)
            crowded = pending.where("false")
            break
        big = F.broadcast(big) if big.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else big
        done.append(pending.join(big, CELL, "left_anti"))
        pending = pending.join(big, CELL, "left_semi")
        if depth == BITS:
            crowded = pending
            break
        depth = min(BITS, depth + SYMBOL_BITS)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out, crowded


def _stretch(held: np.ndarray, asked: np.ndarray, depth) -> tuple[np.ndarray, np.ndarray]:
    """For each asked string the stretch of the sorted ``held`` ones that share its first ``depth`` bits."""
    mask = np.int64(-1) << (BITS - depth)
    return np.searchsorted(held, asked & mask, "left"), np.searchsorted(held, asked | ~mask, "right")


def depth_counts(cells: DataFrame, crowded: DataFrame, least: int, most: int = CELL_ROWS) -> DataFrame:
    """(id, total): candidates of each query in all trees, by depth 0 to BITS; more than ``most`` where a cell was cut deeper."""
    def count(keys: tuple, table: pa.Table) -> pa.Table:
        depth, query = keys[2].as_py(), table["query"].to_numpy()
        bits, ids = table["bits"].to_numpy(), table["id"].to_numpy()[query]
        held, by = np.sort(bits[~query]), np.argsort(bits[query])
        asked = bits[query][by]
        counts = np.zeros((len(asked), BITS + 1), dtype=np.int64)
        counts[:, :depth] = most + 1 if depth > least else 0
        for d in range(depth, BITS + 1):
            low, high = _stretch(held, asked, d)
            counts[:, d] = high - low
        flat = pa.ListArray.from_arrays(pa.array(np.arange(0, counts.size + 1, BITS + 1), pa.int32()), pa.array(counts.reshape(-1)))
        return pa.table({"id": ids[by], "counts": flat})

    found = cells.groupBy(*CELL).applyInArrow(count, "id bigint, counts array<bigint>")
    full = F.array(*[F.lit(0 if d < least else most + 1).cast("long") for d in range(BITS + 1)])
    found = found.unionByName(crowded.where("query").select("id", full.alias("counts")))
    total = F.array(*[F.sum(F.col("counts")[d]) for d in range(BITS + 1)])
    return materialise(found.groupBy("id").agg(total.alias("total")), "depth_counts")


def stop_depth(m: int, least: int) -> Column:
    """The deepest depth with ``m`` candidates; null if there is none."""
    return F.array_max(F.filter(F.sequence(F.lit(least), F.lit(BITS)), lambda d: F.element_at("total", d + 1) >= m))


def _prime(n: int) -> int:
    n = max(2, n)
    while any(n % p == 0 for p in range(2, int(n ** 0.5) + 1)):
        n += 1
    return n


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to the smaller id."""
    at = np.arange(len(score))
    if len(score) > k:
        at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    return at[np.lexsort((ids[at], -score[at]))][:k]


FOUND = "id bigint, class bigint, score double"


def _found(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.Table:
    ids = np.repeat([q for q, _, _ in rows], [len(c) for _, c, _ in rows]).astype(np.int64)
    empty = np.zeros(0)
    return pa.table({"id": ids, "class": np.concatenate([c for _, c, _ in rows] or [empty]).astype(np.int64),
                     "score": np.concatenate([s for _, _, s in rows] or [empty]).astype(np.float64)})


def compare_all(queries: DataFrame, classes: DataFrame, k: int, n_queries: int, n_classes: int) -> DataFrame:
    """(id, class, score): the k best classes of each query (id, vec) within each block of classes; no class is left out."""
    qn, cn = -(-n_queries // BLOCK_QUERIES), -(-n_classes // BLOCK_ROWS)
    asked = queries.select("id", "vec", F.size("vec").alias("dim"), F.pmod(F.xxhash64("id"), F.lit(qn)).alias("qb"),
                           F.explode(F.sequence(F.lit(0), F.lit(cn - 1))).alias("cb"))
    held = classes.select("class", "vec", "dim", F.pmod(F.xxhash64("class"), F.lit(cn)).cast("int").alias("cb"),
                          F.explode(F.sequence(F.lit(0).cast("long"), F.lit(qn - 1).cast("long"))).alias("qb"))
    block = ["dim", "qb", "cb"]

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _found([])
        ids, names = left["id"].to_numpy(), right["class"].to_numpy()
        x = np.array(right["vec"].to_pylist(), dtype=np.float64)
        y = np.array(left["vec"].to_pylist(), dtype=np.float64)
        out = []
        for lo in range(0, len(y), 128):
            for q, score in zip(ids[lo:lo + 128].tolist(), y[lo:lo + 128] @ x.T):
                at = _best(score, names, k)
                out.append((q, names[at], score[at]))
        return _found(out)

    return asked.groupBy(*block).cogroup(held.groupBy(*block)).applyInArrow(compare, FOUND)


def compare_found(chosen: DataFrame, cells: DataFrame, classes: DataFrame, k: int, n_pairs: int, n_queries: int, n_classes: int) -> DataFrame:
    """(id, class, score): the k best of each block among the candidates of each query (id, at: the depth to ascend to)."""
    def gather(keys: tuple, table: pa.Table) -> pa.Table:
        query = ~table["at"].is_null().to_numpy()
        bits, ids = table["bits"].to_numpy(), table["id"].to_numpy()
        by = np.argsort(bits[~query])
        held, names = bits[~query][by], ids[~query][by]
        low, high = _stretch(held, bits[query], table["at"].to_numpy()[query].astype(np.int64))
        size = high - low
        at = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        lists = pa.LargeListArray.from_arrays(pa.array(np.append(0, np.cumsum(size))), pa.array(names[at])).cast(pa.list_(pa.int64()))
        return pa.table({"id": ids[query], "ids": lists}).filter(pa.array(size > 0))

    asked = cells.where("query").join(chosen, "id").select(*CELL, "bits", "id", "at")
    held = cells.where("not query").select(*CELL, "bits", "id", F.lit(None).cast("int").alias("at"))
    lists = asked.unionByName(held).groupBy(*CELL).applyInArrow(gather, "id bigint, ids array<bigint>")
    blocks = _prime(max(-(-n_classes // BLOCK_ROWS), n_pairs // BLOCK_PAIRS))  # class ids are dealt by their remainder
    slots = max(1, -(-n_queries // 64))

    def deal(left: pa.Table, right: pa.Table) -> pa.Table:
        vectors = dict(zip(right["id"].to_pylist(), right["vec"].to_pylist()))
        names = left["id"].to_numpy()
        by = np.argsort(names, kind="stable")
        ends = np.flatnonzero(np.append(np.diff(names[by]) != 0, True)) + 1 if len(names) else []
        out: dict[str, list] = {"block": [], "id": [], "vec": [], "ids": []}
        for lo, hi in zip([0, *ends[:-1]], ends):
            q = int(names[by[lo]])
            ids = np.unique(np.concatenate([left["ids"][int(i)].values.to_numpy() for i in by[lo:hi]]))
            block = ids % blocks
            order = np.argsort(block, kind="stable")
            cuts = np.flatnonzero(np.diff(block[order])) + 1
            for part in np.split(order, cuts):
                out["block"].append(int(block[part[0]]))
                out["id"].append(q)
                out["vec"].append(vectors[q])
                out["ids"].append(ids[part])
        return pa.table({c: pa.array(v, t) for (c, v), t in zip(out.items(), (pa.int64(), pa.int64(), right.schema.field("vec").type, pa.list_(pa.int64())))})

    def slot(df: DataFrame):
        return df.withColumn("slot", F.pmod(F.xxhash64("id"), F.lit(slots))).groupBy("slot")

    kind = classes.schema["vec"].dataType.simpleString()
    vectors = classes.join(chosen.select(F.col("id").alias("class")), "class").select(F.col("class").alias("id"), "vec")
    dealt = slot(lists).cogroup(slot(vectors)).applyInArrow(deal, f"block bigint, id bigint, vec {kind}, ids array<bigint>")
    stored = classes.select(F.pmod("class", F.lit(blocks)).alias("block"), "class", "vec")

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _found([])
        names = right["class"].to_numpy()
        by = np.argsort(names)
        names, stored = names[by], right["vec"].to_pylist()
        width = np.array([len(v) for v in stored])[by]
        x = np.zeros((len(names), int(width.max())))
        for i, j in enumerate(by.tolist()):
            x[i, :width[i]] = stored[j]
        out = []
        for q, vec, ids in zip(left["id"].to_pylist(), left["vec"].to_pylist(), left["ids"]):
            ids = ids.values.to_numpy()
            score = x[np.searchsorted(names, ids), :len(vec)] @ np.array(vec, dtype=np.float64)
            at = _best(score, ids, k)
            out.append((q, ids[at], score[at]))
        return _found(out)

    return dealt.groupBy("block").cogroup(stored.groupBy("block")).applyInArrow(compare, FOUND)


def k_best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("id").orderBy(F.desc("score"), "class")
    return found.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= k).drop("rn")


def choose_candidates(asked: DataFrame, counts: DataFrame, classes: DataFrame, k: int, least: int, n_classes: int) -> int | None:
    """The least m at which a bounded sample of queries finds TARGET of its true neighbours; null if none does."""
    sample = asked.select("id").orderBy(F.xxhash64(F.lit(5), "id"), "id").limit(SAMPLE)
    given = classes.withColumnRenamed("class", "id").join(sample, "id").select("id", "vec", "dim", "top")
    given = materialise(given, "sample")
    true = k_best(compare_all(given, classes, k + 1, SAMPLE, n_classes), k + 1).where("id != class").select("id", "class")
    true = true.join(classes.select("class", "vec"), "class").collect()  # at most SAMPLE * (k + 1) vectors
    rows = given.join(counts, "id").collect()
    if not true:
        return FIRST
    near: dict[int, list] = {}
    for r in true:
        near.setdefault(r["id"], []).append(r["vec"])
    depths, totals = [], []  # of each true neighbour the longest prefix shared in any tree; its query's counts
    for r in (r for r in rows if r["id"] in near):
        hasher = Hasher(r["dim"])
        own = hasher.strings(np.array([r["vec"]], dtype=np.float64), None)
        theirs = hasher.strings(np.array(near[r["id"]], dtype=np.float64), r["top"])
        differ = np.bitwise_xor(own, theirs).min(axis=1)
        for bits in differ.tolist():
            depths.append(BITS - bits.bit_length())
            totals.append(r["total"])
    m = FIRST
    while m <= MOST:
        hit = 0
        for depth, total in zip(depths, totals):
            stop = max((d for d in range(least, BITS + 1) if total[d] >= m), default=None)
            hit += stop is None or total[stop] > DENSE * m or depth >= stop  # those without a depth are compared with all
        log.info("sampled recall %.4f at %d candidates", hit / len(depths), m)
        if hit >= TARGET * len(depths):
            return m
        m *= 2
    return None


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, key, score): the ``k`` nearest found of every row for which ``is_query`` (on column ``id``) holds.

    Nearness is the inner product of the original vectors in double precision; the largest
    comes first, ties go to the smaller key; a query's own row is no candidate.  Fewer than k
    candidates are all returned.  Vectors that are null, zero, or hold null or non-finite
    parts, and rows with a null key, take no part; vectors of different lengths are not
    compared.  Repeated rows (key and vector) count once; a key with several vectors is a
    candidate with each, but not of itself.  An empty table gives an empty result; columns
    besides key and vector are not read.
    """
    spark, kind = vectors.sparkSession, vectors.schema[key].dataType.simpleString()
    rows, classes = vector_classes(vectors, key, embedding)
    queries = rows.where(is_query)
    asked = materialise(queries.groupBy(F.col("class").alias("id")).agg(F.lit(True).alias("query")), "query_classes")
    n_classes, n_queries = classes.count(), asked.count()
    if not n_queries:
        return spark.createDataFrame([], f"query_id {kind}, rank int, {key} {kind}, score double")
    marked = classes.join(asked.withColumnRenamed("id", "class"), "class", "left").withColumn("query", F.coalesce("query", F.lit(False)))
    marked = materialise(marked, "marked")
    classes = marked.drop("query")
    strings = hash_strings(marked)
    least = max(0, (n_classes - 1) // CELL_ROWS).bit_length()
    cells, crowded = cut_cells(strings, least)
    counts = depth_counts(cells, crowded, least)
    m = choose_candidates(asked, counts, classes, k, least, n_classes)
    chosen = counts.select("id", stop_depth(MOST if m is None else m, least).alias("at"), "total")
    served = F.lit(m is not None) & F.coalesce(F.element_at("total", F.col("at") + 1) <= DENSE * (m or 0), F.lit(False))
    chosen = materialise(chosen.select("id", "at", F.element_at("total", F.col("at") + 1).alias("n"), served.alias("served")), "depths")
    n_served, n_pairs = chosen.where("served").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    found = []
    if n_served:
        found.append(compare_found(chosen.where("served").select("id", "at"), cells, classes, k + 1, n_pairs, n_served, n_classes))
    if n_queries > n_served:
        rest = classes.withColumnRenamed("class", "id").join(chosen.where("not served").select("id"), "id").select("id", "vec")
        found.append(compare_all(materialise(rest, "unserved"), classes, k + 1, n_queries - n_served, n_classes))
    log.info("%s candidates; %d of %d query vectors by the forest", m, n_served, n_queries)
    best = k_best(found[0] if len(found) == 1 else found[0].unionByName(found[1]), k + 1)
    order = Window.partitionBy("class").orderBy("id")
    members = rows.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= k + 1).select("class", F.col("id").alias("member"))
    listed = best.join(members, "class").groupBy("id").agg(
        F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "member"))), 1, k + 1).alias("list"))
    listed = materialise(listed.withColumnRenamed("id", "class"), "listed")
    own = queries.select(F.col("id").alias("query_id"), "class").join(listed, "class")
    left = F.slice(F.filter("list", lambda x: x.member != F.col("query_id")), 1, k)
    out = own.select("query_id", F.posexplode(left).alias("at", "x"))
    return out.select(F.col("query_id").cast(kind), (F.col("at") + 1).cast("int").alias("rank"), F.col("x.member").alias(key), (-F.col("x.minus")).alias("score"))
