"""Cross-site boilerplate lines by distinct-site spread.

Every line becomes a hash.  A HyperLogLog sketch of the sites it occurs on is built per
line hash with map-side merging, so a line on a third of all pages costs one small sketch
per task.  Estimates well away from ``min_sites`` decide at once; lines whose estimate
lies in a band around it get an exact distinct count.  A boilerplate line stays where it
first occurs and goes everywhere else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import BROADCAST_ROWS, materialise

#: Relative half-width of the band that is counted exactly: over ten standard errors at lg k = 12.
BAND = 0.25
LG_K = 12


def normal_line(line: Column) -> Column:
    """A line with runs of blanks, tabs and carriage returns made one blank, ends trimmed."""
    return F.trim(F.regexp_replace(line, "[ \\t\\r]+", " "))


def line_table(docs: DataFrame, min_words: int, text: str, key: str, site: str) -> DataFrame:
    """(doc, doc_hash, pos, line_a, line_b, site_hash): each line with ``min_words`` or more words.

    Two independent hashes (96 bits) identify a line; the document is identified by its key
    and text hash, so that rows that share a key but not the text stay apart.
    """
    whole = docs.select(F.col(key).alias("doc"), F.xxhash64(key, text).alias("doc_hash"),
                        F.xxhash64(F.coalesce(F.col(site).cast("string"), F.lit(""))).alias("site_hash"),
                        F.split(F.coalesce(text, F.lit("")), "\n").alias("lines"))
    lines = whole.select("doc", "doc_hash", "site_hash", F.posexplode("lines").alias("pos", "line"))  # hashes once a text, not once a line
    lines = lines.withColumn("line", normal_line("line"))
    words = F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit(""))) + 1
    lines = lines.where((F.col("line") != "") & (words >= min_words))
    return lines.select("doc", "doc_hash", "pos", F.xxhash64("line").alias("line_a"),
                        F.hash("line").alias("line_b"), "site_hash")


def spread_lines(lines: DataFrame, min_sites: int) -> DataFrame:
    """(line_a, line_b, first): lines on ``min_sites`` or more distinct sites, with their first occurrence.

    ``first`` is the least (doc, doc_hash, pos), a null key last.
    """
    place = F.struct(F.col("doc").isNull().alias("keyless"), "doc", "doc_hash", "pos")
    sketched = lines.groupBy("line_a", "line_b").agg(
        F.hll_sketch_agg("site_hash", LG_K).alias("sketch"), F.min(place).alias("first"))
    about = sketched.select("line_a", "line_b", "first", F.hll_sketch_estimate("sketch").alias("sites"))
    about = materialise(about.where(F.col("sites") >= min_sites * (1 - BAND)), "spread_estimates")
    sure = about.where(F.col("sites") > min_sites * (1 + BAND))
    near = about.where(F.col("sites") <= min_sites * (1 + BAND))
    exact = (lines.join(near.select("line_a", "line_b"), ["line_a", "line_b"])
             .groupBy("line_a", "line_b").agg(F.countDistinct("site_hash").alias("exact")))
    near = near.join(exact.where(F.col("exact") >= min_sites), ["line_a", "line_b"], "left_semi")
    return sure.unionByName(near).select("line_a", "line_b", "first")


def removals(docs: DataFrame, min_sites: int = 8, min_words: int = 1, text: str = "text", key: str = "doc_id",
             site: str = "source") -> DataFrame:
    """(doc, doc_hash, gone): positions of the lines to remove, for documents that lose any."""
    lines = materialise(line_table(docs, min_words, text, key, site), "lines")
    spread = spread_lines(lines, min_sites)
    hit = lines.join(spread, ["line_a", "line_b"])
    here = F.struct(F.col("doc").isNull().alias("keyless"), "doc", "doc_hash", "pos")
    return (hit.where(here != F.col("first")).groupBy("doc", "doc_hash")
            .agg(F.sort_array(F.collect_set("pos")).alias("gone")))


def dedup_lines(docs: DataFrame, min_sites: int = 8, min_words: int = 1, text: str = "text", key: str = "doc_id",
                site: str = "source") -> DataFrame:
    """Every row of ``docs`` with four more columns.

    tl_text: the text without its removed lines (null stays null); tl_lines, tl_removed:
    number of lines and of removed lines; tl_words_left: share of the words that stay (1.0
    for a text without words).

    A null site counts as one site of its own, the empty name.  A null or empty text has
    no lines to lose.  Repeated rows (same key and text) are one document and lose the same
    lines.  An empty table gives an empty result.
    """
    gone = materialise(removals(docs, min_sites, min_words, text, key, site), "removals")
    gone = gone.select(F.col("doc").alias("tl_doc"), F.col("doc_hash").alias("tl_hash"), F.col("gone").alias("tl_gone"))
    small = gone.agg(F.coalesce(F.sum(F.size("tl_gone") + 4), F.lit(0))).first()[0] <= BROADCAST_ROWS
    side = F.broadcast(gone) if small else gone.hint("shuffle_hash")
    joined = docs.join(side, docs[key].eqNullSafe(F.col("tl_doc")) & (F.xxhash64(key, text) == F.col("tl_hash")), "left")
    none = F.col("tl_gone").isNull()
    lines = F.split(text, "\n")

    def without(own: Column) -> Column:  # by place: linear in the lines, however many go
        kept = F.array_except(F.sequence(F.lit(0), F.size(own) - 1), F.col("tl_gone"))
        return F.array_join(F.transform(kept, lambda i: F.get(own, i)), "\n")

    left = F.get(F.transform(F.array(lines), without), F.lit(0))  # the lambda's name keeps the text from being split once a line
    out = joined.withColumn("tl_text", F.when(none, F.col(text)).otherwise(left))
    before, after = _words(F.col(text)), _words(F.col("tl_text"))
    out = (out.withColumn("tl_lines", F.when(F.length(text) > 0, F.size(lines)).otherwise(0).cast("long"))
           .withColumn("tl_removed", F.when(none, 0).otherwise(F.size("tl_gone")).cast("long"))
           .withColumn("tl_words_left", F.when(none, 1.0).otherwise(F.coalesce(F.try_divide(after, before), F.lit(1.0)))))
    return out.drop("tl_doc", "tl_hash", "tl_gone")


def _words(text: Column) -> Column:
    return F.regexp_count(text, F.lit("[^ \\t\\n\\x0B\\f\\r]+")).cast("double")


def strip_boilerplate(docs: DataFrame, min_sites: int = 8, min_words: int = 1, text: str = "text",
                      key: str = "doc_id", site: str = "source") -> DataFrame:
    """Documents (same columns) without their boilerplate lines, short ones and those without blanks included.

    Only documents left without any word go: all they held was found first elsewhere on
    many sites.  ``n_chars``, if present, follows the new text.
    """
    out = dedup_lines(docs, min_sites, min_words, text, key, site)
    out = out.where(F.col("tl_words_left") > 0).withColumn(text, F.col("tl_text"))
    if "n_chars" in docs.columns:
        fresh = F.length(text).cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("tl_removed") > 0, fresh).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
