"""Whole results: no document, line or near copy is left out by a shortcut."""

import time

import pytest

from touchline.llm import line_dedup, packing, queries, simhash, url_filter


def test_short_own_text_among_boilerplate_stays(spark):
    shared = "\n".join(f"shared header line number {k} of every site here" for k in range(5))
    rows = [(i, shared, f"s{i}") for i in range(8)] + [(20, f"{shared}\nmy own three words", "s3")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r["doc_id"]: r["text"] for r in line_dedup.strip_boilerplate(docs).collect()}
    assert out == {0: shared, 20: "my own three words"}


def test_short_lines_and_lines_without_blanks_go(spark):
    rows = [(i, f"Home\n\u8fd9\u662f\u5171\u540c\u7684\u4e00\u53e5\u8bdd\ntext of page {i} alone", f"s{i}") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r["doc_id"]: r["text"] for r in line_dedup.strip_boilerplate(docs).collect()}
    assert out == {0: rows[0][1]} | {i: f"text of page {i} alone" for i in range(1, 8)}


def test_near_copies_never_share_a_bin(spark, tmp_path):
    base = " ".join(f"word{k}" for k in range(400))
    rows = [(i, f"{base} end{i}", f"s{i}") for i in range(12)]
    rows += [(100 + i, " ".join(f"other{i}x{k}" for k in range(40)), f"t{i}") for i in range(12)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    group = {r["doc_id"]: r["component_id"] for r in simhash.simhash_components(docs).collect()}
    assert len({group[i] for i in range(12)}) < 12
    bins = {}
    for r in queries.op9_packing(spark, str(tmp_path)).collect():
        bins.setdefault(r["bin_id"], []).append(group[r["doc_id"]])
    assert all(len(set(held)) == len(held) for held in bins.values())


def test_list_of_all_harmful_labels_blocks_them(spark):
    sf = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url")
    listed = url_filter.urls_on_labels(pages, url_filter.HARMFUL_LABELS)
    rows = queries.op8_urls(spark, sf, listed).where("rule is null").collect()
    bad = [r["verdict"] for r in rows if set(r["host"].split(".")) & set(url_filter.HARMFUL_LABELS)]
    assert len(bad) == 8 and set(bad) == {"block"}


@pytest.mark.parametrize("near", [False, True])
def test_repeated_rows_spread_over_shards(spark, near):
    docs = spark.createDataFrame([(7, "the same text again", "s")] * 400, "doc_id long, text string, source string")
    out = packing.pack(docs, shard_pieces=50, near=near).selectExpr("bin_id >> 24 as shard", "bin_id").collect()
    shards = [r["shard"] for r in out]
    assert len(out) == len({r["bin_id"] for r in out}) == 400
    assert max(map(shards.count, set(shards))) <= 100


def test_texts_of_many_lines_take_linear_time(spark):
    def text(n, own):
        return "\n".join(f"shared line {k}" if k % 2 else f"{own} line {k}" for k in range(n))

    took = {}
    for n in (20_000, 100_000):
        docs = spark.createDataFrame([(i, text(n, f"own{i}"), f"s{i}") for i in range(9)], "doc_id long, text string, source string")
        began = time.time()
        out = {r["doc_id"]: (r["tl_removed"], r["left"]) for r in line_dedup.dedup_lines(docs).selectExpr("doc_id", "tl_removed", "size(split(tl_text, '\n')) as left").collect()}
        took[n] = time.time() - began
        assert out == {0: (0, n)} | {i: (n // 2, n // 2) for i in range(1, 9)}
    assert took[100_000] < 8 * max(took[20_000], 3)


def test_the_query_considers_lines_of_every_length(spark, tmp_path):
    rows = [(i, f"Menu\n\u8fd9\u662f\u4e00\u53e5\u8bdd\nown {i}", f"s{i}") for i in range(8)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    out = {r["doc_id"]: (r["n_lines"], r["n_removed"]) for r in queries.op1_line_dedup(spark, str(tmp_path)).collect()}
    assert out == {0: (3, 0)} | {i: (3, 2) for i in range(1, 8)}
