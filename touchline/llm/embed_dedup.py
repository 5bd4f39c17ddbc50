"""Embedding near-duplicates by a robust-pruned flat graph.

1. Equal vectors of one label become one class, with its number of rows.
2. Classes are dealt to overlapping shards: a label with more than ``PIVOT_ROWS`` classes
   gets pivots from a bounded sample, and a class goes to its ``NEAREST`` pivots, however
   many there are, so that work follows the number of classes.  A shard above ``SHARD_ROWS``
   is cut into blocks, each pair of blocks a shard of its own, so no task holds more.
3. Each shard builds a flat graph: near candidates, robustly pruned to ``DEGREE`` edges.
   The adjacency lists of a class are united over its shards.
4. Each shard searches the united graph for every member: greedy from the medoid, then the
   range is expanded through all neighbours near the threshold.  Candidates are verified
   by cosine in double precision, and a comparison of the shard's members with each other
   adds the links that the search did not reach.  Only link counts and a spanning forest leave
   a shard; a pair that meets in several shards is counted in the first of them.
5. Recall, of pairs that may not have met in any shard, is audited against brute force on a
   bounded sample of classes.  Below ``RECALL`` the deal is repeated with twice as many pivots
   a class, up to all of them.
"""

from __future__ import annotations

import logging
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import materialise
from touchline.llm.components import connected_components

log = logging.getLogger(__name__)

#: Classes per pivot; rows of a shard at most; pivots broadcast at most (all labels).
PIVOT_ROWS, SHARD_ROWS, MOST_PIVOTS = 256, 2048, 16_384
DEGREE, CANDIDATES, BEAM, ALPHA = 16, 48, 16, 1.2
#: Pivots that a class is dealt to.
NEAREST = 3
#: Range expansion goes on through neighbours this far below the threshold.
SLACK = 0.06
AUDIT_CLASSES, RECALL = 200, 0.995


def unit_rows(vectors: list) -> np.ndarray:
    """Vectors scaled to length one, in double precision (scaled by their largest part first, against overflow)."""
    x = np.array(vectors, dtype=np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _usable(embedding: str, label: str) -> Column:
    x = F.col(embedding)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(F.col(label).isNotNull() & ~bad & F.exists(x, lambda v: v != 0), F.lit(False))


def vector_classes(vectors: DataFrame, key: str, embedding: str, label: str) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): rows (key, class) of usable vectors; classes (class, grp, vec, n, least).

    Usable: label and vector not null, parts neither null, NaN nor infinite, not all zero.
    grp tells labels (and vector lengths) apart.
    """
    x = F.col(embedding)
    rows = vectors.where(_usable(embedding, label))
    rows = rows.select(key, F.xxhash64(label, embedding).alias("class"), F.xxhash64(F.col(label), F.size(x)).alias("grp"), x.alias("vec"))
    classes = rows.groupBy("class").agg(F.first("grp").alias("grp"), F.first("vec").alias("vec"), F.count("*").alias("n"),
                                        F.min(key).alias("least"))
    return rows.select(key, "class"), classes


def choose_pivots(classes: DataFrame) -> dict[int, np.ndarray]:
    """Pivots of each group that needs more than one shard: a bounded sample by hash, near-equal ones left out."""
    sizes = classes.groupBy("grp").count().where(F.col("count") > PIVOT_ROWS)
    total = sizes.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    per = max(PIVOT_ROWS, math.ceil(total / MOST_PIVOTS))
    want = sizes.select("grp", F.ceil(F.col("count") / per).alias("want"))
    order = Window.partitionBy("grp").orderBy(F.xxhash64(F.lit(3), "class"), "class")
    share = F.least(F.lit(1.0), F.lit(4.0) / per)  # of all hashes; four times the wish on average
    drawn = classes.join(want, "grp").where(F.pmod(F.xxhash64(F.lit(4), "class"), F.lit(1 << 30)) < share * (1 << 30))
    drawn = drawn.withColumn("at", F.row_number().over(order)).where(F.col("at") <= F.col("want"))
    found: dict[int, list] = {}
    for row in drawn.select("grp", "vec").orderBy("grp", "at").collect():
        found.setdefault(row["grp"], []).append(row["vec"])
    out = {}
    for grp, rows in found.items():
        x, apart = unit_rows(rows), []
        for v in x:
            if not apart or max(np.array(apart) @ v) < 0.9:
                apart.append(v)
        out[grp] = np.array(apart)
    return out


def deal(classes: DataFrame, pivots: dict[int, np.ndarray], nearest: int) -> DataFrame:
    """(class, grp, vec, n, shards, shard): one row per class and shard; shards lists all of a class's shards."""
    shared = classes.sparkSession.sparkContext.broadcast(pivots)  # at most MOST_PIVOTS vectors

    def place(batches):
        for batch in batches:
            grps, vectors = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            cells: list = [[0]] * len(grps)
            for grp in set(grps) & shared.value.keys():
                at = [i for i, g in enumerate(grps) if g == grp]
                for lo in range(0, len(at), 1024):
                    part = at[lo:lo + 1024]
                    cosines = unit_rows([vectors[i] for i in part]) @ shared.value[grp].T
                    k = min(nearest, cosines.shape[1])
                    best = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
                    for i, row in zip(part, best.tolist()):
                        cells[i] = row
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cells, pa.list_(pa.int64()))],
                                             names=["class", "grp", "cells"])

    placed = classes.select("class", "grp", "vec").mapInArrow(place, "class bigint, grp bigint, cells array<bigint>")
    placed = placed.select("class", "grp", F.explode("cells").alias("cell"))
    sizes = placed.groupBy("grp", "cell").count()
    half = SHARD_ROWS // 2
    parts = F.when(F.col("count") > SHARD_ROWS, F.ceil(F.col("count") / half)).otherwise(F.lit(1))
    placed = placed.join(sizes.select("grp", "cell", parts.cast("int").alias("parts")), ["grp", "cell"])
    own = F.pmod(F.xxhash64(F.lit(9), "class"), F.col("parts")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: j != F.col("own"))
    pair = F.transform(others, lambda j: F.xxhash64("grp", "cell", F.least(j, F.col("own")), F.greatest(j, F.col("own"))))
    shards = F.when(F.col("parts") == 1, F.array(F.xxhash64("grp", "cell"))).otherwise(pair)
    lists = placed.withColumn("own", own).select("class", F.explode(shards).alias("shard"))
    lists = lists.groupBy("class").agg(F.sort_array(F.collect_set("shard")).alias("shards"))
    dealt = classes.select("class", "grp", "vec", "n").join(lists, "class")
    return materialise(dealt.withColumn("shard", F.explode("shards")), "shards")


def robust_prune(x: np.ndarray, degree: int = DEGREE, candidates: int = CANDIDATES, alpha: float = ALPHA) -> np.ndarray:
    """Flat graph over unit rows: per row up to ``degree`` neighbours, -1 where fewer.

    The nearest candidate is taken, and all candidates that it is ``alpha`` times closer to
    than the row is are dropped, again and again; all rows take each step together.
    """
    n = len(x)
    out = np.full((n, degree), -1, dtype=np.int64)
    width = min(candidates, n - 1)
    if width < 1:
        return out
    for lo in range(0, n, 256):
        rows = x[lo:lo + 256]
        cosine = rows @ x.T
        cosine[np.arange(len(rows)), np.arange(lo, lo + len(rows))] = -np.inf
        near = np.argpartition(-cosine, width - 1, axis=1)[:, :width]
        distance = np.sqrt(np.maximum(0, 2 - 2 * np.take_along_axis(cosine, near, 1)))
        between = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("rid,rjd->rij", x[near], x[near])))
        alive, every = np.ones(near.shape, dtype=bool), np.arange(len(rows))
        for k in range(degree):
            left = np.where(alive, distance, np.inf)
            best = left.argmin(axis=1)
            going = np.isfinite(left[every, best])
            if not going.any():
                break
            out[lo:lo + len(rows)][going, k] = near[every, best][going]
            alive &= ~((alpha * between[every, best] <= distance) & going[:, None])
            alive[every, best] = False
    return out


def with_reverse(near: list[list[int]], most: int = DEGREE) -> list[list[int]]:
    """Adjacency lists plus up to ``most`` reverse edges a node, those to the least reachable nodes first."""
    into = np.bincount(np.array([j for own in near for j in own], dtype=np.int64), minlength=len(near))
    out, room = [list(own) for own in near], [most] * len(near)
    held = [set(own) for own in near]
    for i in np.argsort(into, kind="stable").tolist():
        for j in near[i]:
            if room[j] and i not in held[j]:
                out[j].append(i)
                room[j] -= 1
    return out


def range_search(x: np.ndarray, graph: np.ndarray, floor: float, beam: int = BEAM) -> np.ndarray:
    """Boolean (n, n): rows that the search for each row reaches with cosine >= ``floor``.

    All rows are searched in step: greedily from the medoid until the ``beam`` best seen
    are expanded, then through every unexpanded row at or above the floor (a row's own
    place included) until none is left.
    """
    n = len(x)
    y = x.astype(np.float32)  # candidates only; links are verified in double precision
    reached = np.zeros((n, n), dtype=bool)
    medoid = int((y @ y.mean(axis=0)).argmax())
    for lo in range(0, n, 256):
        queries = np.arange(lo, min(n, lo + 256))
        m = len(queries)
        seen = np.full((m, n), -np.inf, dtype=np.float32)
        done = np.zeros((m, n), dtype=bool)

        def expand(q: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Neighbours of each node, and their cosines with the query (-inf for those already seen)."""
            done[q, nodes] = True
            near = graph[nodes]
            fresh = (near >= 0) & np.isneginf(seen[q[:, None], near])
            cosine = np.full(near.shape, -np.inf, dtype=np.float32)
            rows, at = np.nonzero(fresh)
            for k in range(0, len(rows), 1 << 15):
                r, c = rows[k:k + (1 << 15)], at[k:k + (1 << 15)]
                cosine[r, c] = np.einsum("kd,kd->k", y[queries[q[r]]], y[near[r, c]])
            seen[q[rows], near[rows, at]] = cosine[rows, at]
            return near, cosine

        every = np.arange(m)
        ids = np.full((m, beam), medoid)
        best = np.full((m, beam), -np.inf, dtype=np.float32)
        best[:, 0] = seen[:, medoid] = y[queries] @ y[medoid]
        active = every
        while len(active):
            left = np.where(done[active[:, None], ids[active]], -np.inf, best[active])
            pick = left.argmax(axis=1)
            going = np.isfinite(left[np.arange(len(active)), pick])
            active, pick = active[going], pick[going]
            if not len(active):
                break
            near, cosine = expand(active, ids[active, pick])
            both, value = np.hstack([ids[active], near]), np.hstack([best[active], cosine])
            top = np.argpartition(-value, beam - 1, axis=1)[:, :beam]
            ids[active], best[active] = np.take_along_axis(both, top, 1), np.take_along_axis(value, top, 1)
        seen[every, queries] = 1.0
        while True:
            q, nodes = np.nonzero((seen >= floor) & ~done)
            if not len(q):
                break
            for k in range(0, len(q), 1 << 14):
                expand(q[k:k + (1 << 14)], nodes[k:k + (1 << 14)])
        reached[lo:lo + m] = seen >= floor
    return reached


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric boolean matrix."""
    n = len(linked)
    free, edges = np.ones(n, dtype=bool), []
    for root in range(n):
        if not free[root]:
            continue
        free[root], front = False, [root]
        while front:
            at = front.pop()
            new = np.flatnonzero(linked[at] & free)
            free[new] = False
            edges += [(at, int(b)) for b in new]
            front += new.tolist()
    return edges


def verified(x: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Whether rows a and b of ``x`` have a cosine of at least ``threshold``, in double precision."""
    keep = np.zeros(len(a), dtype=bool)
    for at in range(0, len(a), 1 << 16):
        s = slice(at, at + (1 << 16))
        keep[s] = np.einsum("kd,kd->k", x[a[s]], x[b[s]]) >= threshold
    return keep


def links_of_shard(ids: np.ndarray, x: np.ndarray, graph: np.ndarray, counts: np.ndarray, shards: list[list[int]],
                   shard: int, threshold: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Rows linked to each member, of the pairs whose first common shard is this one; and a forest of all links."""
    reached = range_search(x, graph, threshold - SLACK)
    np.fill_diagonal(reached, False)
    a, b = np.nonzero(reached | reached.T)
    linked = np.zeros_like(reached)
    linked[a, b] = verified(x, a, b, threshold)
    for at in range(0, len(x), 512):  # what the search did not reach
        p, q = np.nonzero((x[at:at + 512] @ x.T >= threshold - 1e-9) & ~linked[at:at + 512])
        p, q = p[p + at != q] + at, q[p + at != q]
        linked[p, q] = verified(x, p, q, threshold)
    a, b = np.nonzero(linked)
    width = max(map(len, shards))
    table = np.full((len(ids), width), np.iinfo(np.int64).max)
    for i, own in enumerate(shards):
        table[i, :len(own)] = own
    total = np.zeros(len(ids), dtype=np.int64)
    for at in range(0, len(a), 1 << 14):
        p, q = a[at:at + (1 << 14)], b[at:at + (1 << 14)]
        first = np.full(len(p), np.iinfo(np.int64).max)
        for k in range(width):  # the least shard in both lists
            mine = table[p, k]
            common = (table[q] == mine[:, None]).any(axis=1)
            first = np.where(common & (mine < first), mine, first)
        own = first == shard
        np.add.at(total, p[own], counts[q[own]])
    return total, _forest(linked)


def shard_links(dealt: DataFrame, threshold: float) -> DataFrame:
    """(a, b, n): per class its number of linked rows (b null), and forest edges between classes (n null)."""

    def build(keys: tuple, rows: pa.Table) -> pa.Table:
        ids = rows["class"].to_numpy()
        graph = robust_prune(unit_rows(rows["vec"].to_pylist()))
        lists = [ids[g[g >= 0]] for g in graph]
        return pa.table({"class": rows["class"], "near": pa.array(lists, pa.list_(pa.int64()))})

    graphs = dealt.select("class", "vec", "shard").groupBy("shard").applyInArrow(build, "class bigint, near array<bigint>")
    united = graphs.groupBy("class").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))

    def search(keys: tuple, rows: pa.Table) -> pa.Table:
        ids = rows["class"].to_numpy()
        x = unit_rows(rows["vec"].to_pylist())
        place = {int(c): i for i, c in enumerate(ids)}
        near = with_reverse([[place[c] for c in own or () if c in place] for own in rows["near"].to_pylist()])
        graph = np.full((len(ids), max(1, max(map(len, near)))), -1, dtype=np.int64)
        for i, own in enumerate(near):
            graph[i, :len(own)] = own
        total, edges = links_of_shard(ids, x, graph, rows["n"].to_numpy(), rows["shards"].to_pylist(), keys[0].as_py(), threshold)
        hit = np.flatnonzero(total)
        return pa.table({"a": pa.array([*ids[hit], *(ids[i] for i, _ in edges)], pa.int64()),
                         "b": pa.array([*([None] * len(hit)), *(ids[j] for _, j in edges)], pa.int64()),
                         "n": pa.array([*total[hit].tolist(), *([None] * len(edges))], pa.int64())})

    return dealt.join(united, "class").groupBy("shard").applyInArrow(search, "a bigint, b bigint, n bigint")


def audit(classes: DataFrame, counted: DataFrame, threshold: float, bound: int = AUDIT_CLASSES) -> float:
    """Share of the links of a bounded sample of classes that were found; brute force over all classes.

    Half of the sample are classes with links found, so that there is something to miss.  The
    lesser of two shares counts: of all links, in which a large group weighs much, and the mean
    over the sampled classes, in which a small one weighs as much.
    """
    known = classes.join(counted, "class", "left").select("class", "grp", "vec", F.coalesce("linked", F.lit(0)).alias("linked"))
    mix = F.xxhash64(F.lit(8), "class")
    sample = (known.orderBy(mix).limit(bound // 2).unionByName(known.where("linked > 0").orderBy(mix).limit(bound // 2))).distinct().collect()
    if not sample:
        return 1.0
    by_group: dict[int, list] = {}
    for r in sample:
        by_group.setdefault(r["grp"], []).append(r)
    queries = {g: (np.array([r["class"] for r in rows]), unit_rows([r["vec"] for r in rows])) for g, rows in by_group.items()}
    shared = classes.sparkSession.sparkContext.broadcast(queries)  # at most ``bound`` vectors

    def brute(batches):
        total: dict[int, int] = {}
        for batch in batches:
            grps, ids, n = (np.array(batch.column(i).to_pylist()) for i in (0, 1, 3))
            vectors = batch.column(2).to_pylist()
            for g, (wanted, x) in shared.value.items():
                at = np.flatnonzero(grps == g)
                for lo in range(0, len(at), 4096):
                    part = at[lo:lo + 4096]
                    near = (x @ unit_rows([vectors[i] for i in part]).T >= threshold) & (wanted[:, None] != ids[part])
                    for w, k in zip(wanted.tolist(), near @ n[part]):
                        total[w] = total.get(w, 0) + int(k)
        yield pa.RecordBatch.from_pydict({"class": pa.array(total.keys(), pa.int64()), "linked": pa.array(total.values(), pa.int64())})

    rows = classes.select("grp", "class", "vec", "n").mapInArrow(brute, "class bigint, linked bigint")
    true = {r["class"]: r["linked"] for r in rows.groupBy("class").agg(F.sum("linked").alias("linked")).collect()}
    there = sum(true.values())
    if not there:
        return 1.0
    found = {r["class"]: min(r["linked"], true.get(r["class"], 0)) for r in sample}
    return min(sum(found.values()) / there, float(np.mean([found[c] / n for c, n in true.items() if n])))


def embedding_links(vectors: DataFrame, threshold: float = 0.98, key: str = "vec_id", embedding: str = "embedding",
                    label: str = "label", nearest: int = NEAREST) -> DataFrame:
    """(key, n_links, component_id, kept): one row per row of ``vectors``.

    n_links: other rows of the same label with cosine >= ``threshold``; component_id: the
    smallest key reachable over links, itself included; kept: key = component_id.  Null,
    zero or non-finite vectors and null labels link with nothing, and vectors of different
    length do not link.  Rows with a null key count as rows and get the component's
    smallest key, with kept false.  Repeated rows link with each other; an empty
    table gives an empty result; columns besides the three are not read.
    """
    rows, classes = vector_classes(vectors, key, embedding, label)
    classes = materialise(classes, "classes")
    pivots = choose_pivots(classes)
    most = max(map(len, pivots.values()), default=0)
    while True:
        found = materialise(shard_links(deal(classes, pivots, nearest), threshold), "links")
        counted = found.where("b is null").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("linked"))
        recall = audit(classes, counted, threshold)
        log.info("audited recall %.4f at %d pivots a class", recall, nearest)
        if recall >= RECALL or nearest >= most:
            break
        nearest *= 2
    roots = connected_components(found.where("b is not null"), "a", "b").withColumnRenamed("node", "class")
    placed = (classes.select("class", "n", "least").join(roots, "class", "left").join(counted, "class", "left")
              .withColumn("root", F.coalesce("root", "class")))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    placed = placed.join(least, "root").select("class", (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), "component_id")
    placed = materialise(placed, "components")
    linked = rows.join(placed, "class").select(key, "n_links", "component_id")
    alone = vectors.where(~_usable(embedding, label)).select(key, F.lit(0).cast("long").alias("n_links"), F.col(key).alias("component_id"))
    out = linked.unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(False)))
