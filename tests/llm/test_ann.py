"""The hash-prefix forest against brute force: recall, exact scores and order, crowded prefixes, awkward rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.llm import ann, queries


def brute(rows, k, is_query):
    """query id -> [(id, score)], from (id, vector) rows, which may repeat."""
    rows = [(i, np.array(v, dtype=np.float64)) for i, v in dict.fromkeys((i, tuple(v)) for i, v in rows)]
    out = {}
    for q, x in rows:
        if is_query(q):
            out.setdefault(q, [])
            out[q].append(sorted(((-float(x @ v), i) for i, v in rows if i != q and len(v) == len(x)))[:k])
    return {q: [(i, -s) for s, i in lists[0]] for q, lists in out.items()}


def listed(out, key="vec_id"):
    got = {}
    for r in sorted(out.collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r[key], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    return got


def table(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return df.withColumns({c: F.lit("x") for c in ("id", "class", "vec", "query", "tree", "score", "rank", "block")})


def test_recall_on_the_table(spark):
    sf = "/root/testdata/sf0.1"
    got = listed(queries.op13_nearest(spark, sf))
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    true = brute(rows, 20, lambda q: q % 20 == 0)
    assert got.keys() == true.keys() and all(len(g) == 20 for g in got.values())
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in true[q]}) / 20 for q in true]) >= 0.93
    vectors = {i: np.array(v, dtype=np.float64) for i, v in rows}
    for q, own in got.items():
        assert [s for _, s in own] == sorted((s for _, s in own), reverse=True)
        if q != rows[-1][0]:
            assert all(abs(s - vectors[q] @ vectors[i]) < 1e-12 for i, s in own[:3])


def test_lengths_count(spark):
    rnd = np.random.default_rng(3)
    rows = [(i, (rnd.normal(size=8) * rnd.exponential()).tolist()) for i in range(600)]
    got = listed(ann.nearest(table(spark, rows), F.col("id") % 10 == 0, k=5))
    true = brute(rows, 5, lambda q: q % 10 == 0)
    assert np.mean([len(dict(got[q]).keys() & dict(true[q]).keys()) / 5 for q in true]) >= 0.9


@pytest.mark.parametrize("cell, most", [(64, 16_384), (ann.CELL_ROWS, 256)])
def test_crowded_prefixes_and_hard_samples_are_compared_with_all(spark, monkeypatch, cell, most):
    rnd = np.random.default_rng(4)
    centre = rnd.normal(size=16)
    near = centre + 1e-6 * rnd.normal(size=(300, 16))  # one string in every tree
    rows = [(i, v.tolist()) for i, v in enumerate(np.vstack([near, rnd.normal(size=(500, 16))]))]
    rows += [(1000 + i, near[7].tolist()) for i in range(40)]
    monkeypatch.setattr(ann, "MOST", most)
    cut = ann.cut_cells
    monkeypatch.setattr(ann, "cut_cells", lambda strings, depth: cut(strings, depth, cell))
    monkeypatch.setattr(ann, "depth_counts", lambda cells, crowded, least, f=ann.depth_counts: f(cells, crowded, least, max(cell, 4 * most)))
    got = listed(ann.nearest(table(spark, rows), F.col("id") % 20 == 0))
    true = brute(rows, 20, lambda q: q % 20 == 0)
    assert got.keys() == true.keys()
    for q in (q for q in true if q < 300):
        assert np.allclose([s for _, s in got[q]], [s for _, s in true[q]], rtol=0, atol=1e-9)
    assert np.mean([len(dict(got[q]).keys() & dict(true[q]).keys()) / 20 for q in true if 300 <= q < 1000]) >= 0.9


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [2.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (None, [5.0, 5.0]), (7, []), (40, [1.0, 0.0, 0.0]), (60, [0.0, 0.0]), (8, [0.0, -3.0]), (9, [2.0, 0.0]), (80, [0.0, 1.0, 2.0])]
    got = listed(ann.nearest(table(spark, rows), F.col("id") % 20 == 0, k=3))
    assert got == {0: [(9, 2.0), (20, 2.0), (1, 1.0)], 20: [(9, 4.0), (0, 2.0), (1, 2.0)], 40: [(80, 0.0)], 80: [(40, 0.0)]}
    assert ann.nearest(table(spark, rows).where("false"), F.col("id") % 20 == 0).collect() == []
    assert ann.nearest(table(spark, rows), F.lit(False)).collect() == []
