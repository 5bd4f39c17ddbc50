"""Nulls, empty and very long texts, repeats, empty tables and clashing columns, for every operator and stage."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from touchline.llm import bpe, embed_dedup, langid, line_dedup, packing, pii, queries, quality, simhash, toxicity, url_filter

# names that the operators use inside, as a table's own columns
CLASH = ("fp", "bucket", "score", "probability", "prediction", "rawPrediction", "features", "line", "pos", "shard", "chars",
         "doc", "hash", "mix", "spans", "host", "path", "found", "n_words", "lang_group", "component_id", "count", "class", "shards")
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    docs = spark.createDataFrame([(i, t, la, s, len(t) if t else None) for i, t, la, s in rows], DOC)
    return docs.withColumns({c: F.lit("x") for c in CLASH})


def awkward():
    rnd = random.Random(4)
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "you", "fool"]
    prose = [" ".join(rnd.choice(words) for _ in range(80)) + "." for _ in range(12)]
    rows = [(i, t, "en", f"s{i % 3}") for i, t in enumerate(prose)]
    rows += [(20, None, "en", "s0"), (21, "", "en", "s1"), (22, " \t\n ", None, None), (23, "x" * 200_000, "en", "s2"),
             (24, "word " * 30_000, None, "s0"), (None, prose[0], "en", None), (None, None, None, None),
             (25, prose[1], "de", "s1"), (25, prose[1], "de", "s1"), (26, "\U0001f600 \x00 \u00e9", "fr", "s2"),
             (27, "mail a.b@c.example.org now\nsecond line here\n\n", "en", "s0")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, awkward()).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2) for i in range(12)] + [(25, None), (None, 1), (3, 1), (3, 1)], "doc_id long, toxic int")


def model_bytes():
    with open(queries.vocabulary(queries.PIECES), "rb") as f:
        return f.read()


def per_row(docs, labels):
    import public_tokenizers

    ranks = bpe.read_ranks(queries.vocabulary(queries.RANKS))
    return {
        "line_dedup": lambda: line_dedup.dedup_lines(docs, min_sites=2),
        "pii": lambda: pii.pii_table(docs),
        "toxicity": lambda: toxicity.toxicity_table(docs, labels),
        "quality": lambda: quality.quality_table(docs, model_bytes()),
        "langid": lambda: langid.language_table(docs, n_docs=4, usual=(50, 10_000)),
        "bpe": lambda: bpe.bpe_table(docs, ranks, public_tokenizers.PATTERN),
        "simhash": lambda: simhash.simhash_components(docs),
    }


@pytest.mark.parametrize("name", ["line_dedup", "pii", "toxicity", "quality", "langid", "bpe", "simhash"])
def test_one_row_per_row(docs, labels, name):
    out = per_row(docs, labels)[name]().collect()
    assert sorted(str(r["doc_id"]) for r in out) == sorted(str(r[0]) for r in awkward())


@pytest.mark.parametrize("name", ["line_dedup", "pii", "toxicity", "quality", "langid", "bpe", "simhash"])
def test_empty_table(docs, labels, name):
    assert per_row(docs.where("false"), labels.where("false"))[name]().collect() == []


def test_defined_results(docs, labels):
    sims = {r["doc_id"]: r for r in simhash.simhash_components(docs).collect() if r["doc_id"] is not None}
    assert {sims[i]["fp"] for i in (20, 21, 22)} == {0} and {sims[i]["component_id"] for i in (20, 21, 22)} == {20}
    assert sims[25]["component_id"] == 1
    langs = {r["doc_id"]: r for r in langid.language_table(docs, n_docs=4, usual=(50, 10_000)).collect()}
    assert all(langs[i]["lang_pred"] == "und" and langs[i]["score"] == 0.0 for i in (20, 21, 22))
    rules = {r["doc_id"]: r for r in quality.quality_table(docs, model_bytes()).collect()}
    assert all(rules[i]["n_words"] == 0 and rules[i]["base_failed"] and not rules[i]["kept"] for i in (20, 21, 22))
    assert rules[24]["n_repeat_words"] == 30_000 and rules[23]["n_words"] == 1
    toxic = toxicity.toxicity_table(docs, labels).collect()
    assert all(0 <= r["score"] <= 1 for r in toxic)
    no_labels = toxicity.toxicity_table(docs, labels.where("false")).collect()
    assert {r["score"] for r in no_labels} == {0.0}


def test_pack_edges(spark, docs):
    out = packing.pack(docs, capacity=1000).collect()
    assert {r["doc_id"] for r in out}.isdisjoint({20, 21})
    assert sum(r["length"] for r in out if r["doc_id"] == 23) == 200_000
    assert packing.pack(docs.where("false")).collect() == []
    bins = {}
    for r in out:
        bins[r["bin_id"]] = bins.get(r["bin_id"], 0) + r["length"]
    assert max(bins.values()) <= 1000


def test_urls_edges(spark):
    rows = [(1, "http://A.example.ORG/es/x?q"), (2, None), (3, "no scheme"), (4, "://"), (5, "x://h"), (5, "x://h"), (None, "y://m.h/"),
            (6, "z://www.h#f"), (7, "z://h" + "/p" * 50_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({c: F.lit("x") for c in CLASH})
    listed = spark.createDataFrame([("h",), ("h",), (None,), ("other/x",)], "url string")
    out = {}
    for r in url_filter.judge_urls(pages, listed).collect():
        out.setdefault(r["page_id"], []).append((r["host"], r["path"][:5], r["rule"], r["verdict"]))
    assert out[1] == [("a.example.org", "/es/x", "example.org/es/", "block")]
    assert out[2] == out[3] == out[4] == [("", "", None, "allow")]
    assert out[5] == [("h", "", None, "block")] * 2 and out[6] == [("www.h", "", None, "block")]
    assert out[None] == [("m.h", "/", None, "block")] and out[7][0][3] == "allow"
    assert url_filter.judge_urls(pages.where("false"), listed).collect() == []
    assert {r["verdict"] for r in url_filter.judge_urls(pages, listed.where("false")).collect()} == {"allow", "block"}


def test_vectors_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [1.0, 0.0], 1), (4, None, 0), (5, [0.0, 0.0], 0), (6, [1.0, None], 0), (7, [nan, 1.0], 0),
            (8, [inf, 1.0], 0), (9, [1.0, 0.0], None), (10, [1.0, 0.0, 0.0], 0), (11, [], 0), (None, [1.0, 0.0], 0), (12, [0.0, 1.0], 1),
            (12, [0.0, 1.0], 1), (13, [1e38, 1e30], 1)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({c: F.lit("x") for c in CLASH})
    out = sorted(embed_dedup.embedding_links(vectors).collect(), key=lambda r: (r["vec_id"] is None, r["vec_id"] or 0))
    got = [(r["vec_id"], r["n_links"], r["component_id"]) for r in out]
    alone = [(i, 0, i) for i in (4, 5, 6, 7, 8, 9, 10, 11)]
    assert got == sorted([(1, 2, 1), (2, 2, 1), (3, 1, 3), *alone, (12, 1, 12), (12, 1, 12), (13, 1, 3)]) + [(None, 2, 1)]
    assert embed_dedup.embedding_links(vectors.where("false")).collect() == []


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages(spark, docs, labels, tmp_path, name, stage):
    labels.coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    for given in (docs, docs.where("false")):
        out = stage(spark, given, str(tmp_path))
        rows = out.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == given.columns and [f.dataType for f in out.schema] == [f.dataType for f in given.schema]
        assert bool(rows) == (given is docs)
