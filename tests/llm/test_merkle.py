"""The butterfly's manifest against plain trees, also where trees end early; awkward rows; changed rows are found."""

import hashlib

import pytest
from pyspark.sql import functions as F

from touchline.llm import merkle

DOC = "doc_id long, text string, lang string, source string, n_chars long"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return h("".join("-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in FIELDS))


def plain_tree(nodes, fanout):
    """The top, and for each node the (before, behind) of its levels."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, place in enumerate(at):
            lo = place // fanout * fanout
            ways[i].append(("".join(nodes[lo:place]), "".join(nodes[place + 1:lo + fanout])))
        at = [place // fanout for place in at]
        nodes = [h("".join(nodes[i:i + fanout])) for i in range(0, len(nodes), fanout)]
    return nodes[0], ways


def plain_manifest(rows, fanout):
    rows = sorted(rows, key=lambda r: (r["source"] is not None, (r["source"] or "").encode(), r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r)))
    names = list(dict.fromkeys(r["source"] for r in rows))
    own = {s: plain_tree([plain_leaf(r) for r in rows if r["source"] == s], fanout) for s in names}
    root, upper = plain_tree([own[s][0] for s in names], fanout)
    out = []
    for s, rest in zip(names, upper):
        for r, way in zip([r for r in rows if r["source"] == s], own[s][1]):
            proof = h("".join(a + b for a, b in way + rest))
            out.append((r["doc_id"], plain_leaf(r), own[s][0], root, proof, root, True))
    return sorted(map(str, out))


@pytest.mark.parametrize("fanout, levels", [(2, 1), (3, 1), (3, 2), (16, 1), (16, 3)])
def test_like_plain_trees(spark, fanout, levels):
    sizes = {None: 7, "": 1, "hot": 83, "é": 2, "z": 3, "A": 27, "a": 9, "b": 10}
    rows = [(None if i == 5 else i * 3 % 97, None if i % 7 == 0 else f"text {i}", None if i % 2 else "en", s, None if i % 3 else i)
            for s, n in sizes.items() for i in range(n)]
    rows += [(4, "the same row", "en", "hot", 1)] * 3
    docs = spark.createDataFrame(rows, DOC)
    out = merkle.merkle_manifest(docs.withColumns({c: F.lit("x") for c in ("key", "leaf", "root", "slot", "idx", "src", "blk")}),
                                 fanout=fanout, block_levels=levels).collect()
    assert sorted(map(str, map(tuple, out))) == plain_manifest(docs.collect(), fanout)


def test_every_lane_is_served(spark):
    for n in (1, 4, 10, 28, 37):
        nodes = spark.createDataFrame([("s", i, n, h(str(i))) for i in range(n)], "seg string, idx long, total long, node string")
        got = {r["idx"]: (r["top"], [tuple(p) for p in r["path"]]) for r in merkle.butterfly(nodes, ["seg"], 3).collect()}
        top, ways = plain_tree([h(str(i)) for i in range(n)], 3)
        assert got == {i: (top, way) for i, way in enumerate(ways)}


def test_changed_rows_are_found(spark):
    docs = spark.createDataFrame([(i, f"Text {i}", "en", f"s{i % 3}", i) for i in range(60)], DOC)
    lowered = [F.lower("text") if f == "text" else F.col(f) for f in FIELDS]
    shown = F.when(F.col("doc_id") % 4 == 0, merkle.digest_of(*lowered))
    out = merkle.merkle_manifest(docs, shown=shown, fanout=4, block_levels=1).collect()
    assert len(out) == 60 and all(r["verified"] == (r["doc_id"] % 4 != 0) == (r["folded_root"] == r["root"]) for r in out)


def test_edges(spark):
    none = spark.createDataFrame([], DOC)
    assert merkle.merkle_manifest(none).collect() == []
    one = merkle.merkle_manifest(spark.createDataFrame([(None, None, None, None, None)], DOC)).collect()[0]
    assert one["leaf"] == one["subroot"] == one["root"] == one["folded_root"] == h("-----") and one["proof_sha256"] == h("")
    long = merkle.merkle_manifest(spark.createDataFrame([(1, "x" * 2_000_000, "en", "s", 5)], DOC)).collect()[0]
    assert long["leaf"] == h("1:1" + "1:s" + "2:en" + "1:5" + "2000000:" + "x" * 2_000_000)
