"""Periodic runs against a plain search, and awkward documents."""

import hashlib
import random
import time
import zlib
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from touchline.llm import periodic, queries

SF = "/root/testdata/sf0.001"


def plain_runs(words, min_length=6, min_periods=4):
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i >= q:
                found.setdefault((i, j - i + q), q)  # periods ascend: the smallest stays
            i = max(i + 1, j)
    return sorted(((s, n, q) for (s, n), q in found.items() if n >= max(min_length, min_periods * q)), key=lambda r: (r[0], r[2]))


def test_runs_like_the_plain_search():
    rnd = random.Random(1)
    for _ in range(400):
        docs = []
        for _ in range(rnd.randint(1, 6)):
            words = [rnd.randrange(rnd.randint(1, 3)) for _ in range(rnd.randint(0, 40))]
            if words and rnd.random() < 0.5:
                words = words[:5] + words[:rnd.randint(1, 4)] * rnd.randint(2, 9) + words[-3:]
            docs.append(words)
        least = rnd.choice([(6, 4), (2, 2), (4, 3)])
        flat, doc = np.array(sum(docs, []), dtype=np.int32), np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        expected, at = [], 0
        for words in docs:
            expected += [(s + at, n, q) for s, n, q in plain_runs(words, *least)]
            at += len(words)
        assert list(zip(*(x.tolist() for x in periodic.find_runs(flat, doc, *least)))) == expected


def test_query_like_the_contract(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in queries.op11_periodic_runs(spark, SF).collect()}
    assert len(got) == len(rows) and any(r["n_runs"] for r in got.values())
    for doc_id, text in rows:
        words = (text or "").encode().split()
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = plain_runs(words)
        gone = {i for s, size, q in runs for i in range(s + q, s + size)}
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        expected = (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                    sha("".join("%d,%d,%d\n" % r for r in runs).encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))
        assert tuple(got[doc_id]) == expected


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "x x x x x x"), (5, "x x x x x x"), (None, "a b a b a b a b"), (6, "é b " * 6),
            (7, "a\x0bb\x0ca\x0db\x1ca b a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("z") for c in ("runs", "collapsed", "start", "key")})
    out = periodic.collapse_runs(docs).collect()
    by = {r["doc_id"]: ([tuple(x) for x in r["runs"]], r["collapsed"]) for r in out}
    assert len(out) == len(rows)
    assert by[1] == by[2] == by[3] == ([], "") and by[4] == ([], "a") and by[5] == ([(0, 6, 1)], "x")
    assert by[None] == ([(0, 8, 2)], "a b") and by[6] == ([(0, 6, 1)], "é b") and by[7][0] == []
    assert periodic.collapse_runs(docs.where("false")).collect() == []


def test_long_texts_take_little_time():
    rnd = random.Random(2)
    for words in ([b"w"] * 200_000, [b"a", b"b", b"c"] * 70_000, [rnd.choice([b"x", b"y"]) for _ in range(150_000)], [b"a" * 300_000] * 9):
        began = time.time()
        periodic._runs_of_texts([words], 6, 4)
        assert time.time() - began < 10
