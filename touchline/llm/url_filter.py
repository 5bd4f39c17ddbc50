"""URL filters: host and path rules, then a list of canonical URLs.

Listed URLs are held in a blocked Bloom filter: each URL sets eight bits within one
256-bit block, so that one lookup by block number answers it.  Pages whose bits are all set
are possible hits; only those go on to an exact hash join with the list, which removes
the false positives.  All other pages never leave their partition.

Built from DataFrame functions alone.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import materialise

#: Bits per listed URL; with eight probes in 256-bit blocks under 1 in 200 others passes.
BITS_PER_URL = 16
#: Largest filter that is broadcast; above it pages' hashes are shuffled by block.
BROADCAST_BYTES = 64 << 20
_WORDS, _UPPER, _LOWER = 4, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rules as verdict, host, path (fixed values of the query's contract).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Host labels known to be harmful; without a list of its own the query lists the pages on any of them.
HARMFUL_LABELS = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one, or for a null."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """Up to the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def canonical(host: Column, path: Column) -> Column:
    """Host without a leading ``www.`` or ``m.``, path without a trailing ``/``; null without a host.

    Scheme, query and fragment do not tell listed pages apart.
    """
    bare = F.regexp_replace(host, "^(?:www|m)\\.", "")
    return F.when(host != "", F.concat(bare, F.regexp_replace(path, "/$", "")))


def matching_rule(host: Column, path: Column, rules: Iterable[tuple[str, str, str]]) -> Column:
    """The longest rule that fits as struct(rule, verdict); null without one.

    A rule fits its host and all subdomains if the path starts with the rule's.
    """
    out = F.lit(None)
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _masks(url: Column) -> list[Column]:
    """Two bits in each of the block's words, from one hash."""
    bits = F.xxhash64(F.lit(1), url)
    one = F.lit(1).cast("long")

    def bit(i: int) -> Column:  # six bits of the hash choose one of 64
        return F.call_function("shiftleft", one, F.shiftright(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int"))

    return [bit(2 * w).bitwiseOR(bit(2 * w + 1)) for w in range(_WORDS)]


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(2), url), F.lit(blocks))


def bloom_filter(listed: DataFrame, n: int) -> tuple[DataFrame, int]:
    """(block, w0..w3) for the URLs in ``listed.url``, and the number of blocks."""
    blocks = max(1, -(-n * BITS_PER_URL // (64 * _WORDS)))
    masked = listed.select(_block(F.col("url"), blocks).alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(_masks(F.col("url")))])
    return masked.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(_WORDS)]), blocks


def possible_hits(pages: DataFrame, listed: DataFrame, url: str) -> DataFrame:
    """``pages`` with tl_hit: whether the Bloom filter of ``listed.url`` holds all bits of ``url``."""
    n = listed.count()
    held, blocks = bloom_filter(listed, n)
    held = held.select(F.col("block").alias("tl_block"), *[F.col(f"w{i}").alias(f"tl_w{i}") for i in range(_WORDS)])
    small = blocks * 8 * (_WORDS + 1) <= BROADCAST_BYTES
    placed = pages.withColumn("tl_at", F.when(F.col(url).isNull(), F.lit(-1)).otherwise(_block(F.col(url), blocks)))
    placed = placed.join(F.broadcast(held) if small else held, F.col("tl_at") == F.col("tl_block"), "left")
    full = F.lit(True)
    for i, mask in enumerate(_masks(F.col(url))):
        full = full & (F.col(f"tl_w{i}").bitwiseAND(mask) == mask)
    hit = F.coalesce(full & F.col(url).isNotNull(), F.lit(False))
    return placed.withColumn("tl_hit", hit).drop("tl_at", "tl_block", *[f"tl_w{i}" for i in range(_WORDS)])


def judge_urls(pages: DataFrame, listed: DataFrame, rules: Iterable[tuple[str, str, str]] = RULES, url: str = "url",
               key: str = "page_id") -> DataFrame:
    """(key, host, path, rule, verdict) of each row of ``pages``.

    A fitting rule decides; else ``block`` if the canonical URL is among ``listed.url``
    (canonical URLs, repeats and nulls allowed), else ``allow``.  A null url, or one without
    ``://``, has an empty host and path, fits no rule and is allowed.  Repeated rows give
    repeated rows; empty tables give an empty result or an empty list; columns besides key
    and url are not read.
    """
    listed = materialise(listed.select("url").where("url is not null").distinct(), "listed_urls")
    rows = pages.select(F.col(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    found = matching_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("found", found).select(key, "host", "path", F.col("found.rule").alias("rule"),
                                                   F.col("found.verdict").alias("ruled"))
    rows = rows.withColumn("tl_url", F.when(F.col("rule").isNull(), canonical(F.col("host"), F.col("path"))))
    settled = rows.where("tl_url is null").withColumn("verdict", F.coalesce("ruled", F.lit("allow")))  # never meet the filter
    probed = possible_hits(rows.where("tl_url is not null"), listed, "tl_url")
    clear = probed.where(~F.col("tl_hit")).withColumn("verdict", F.lit("allow"))
    exact = listed.withColumnRenamed("url", "tl_listed")
    hits = probed.where("tl_hit").join(exact.hint("shuffle_hash"), F.col("tl_url") == F.col("tl_listed"), "left")
    hits = hits.withColumn("verdict", F.when(F.col("tl_listed").isNotNull(), "block").otherwise("allow"))
    columns = [key, "host", "path", "rule", "verdict"]
    return settled.select(*columns).unionByName(clear.select(*columns)).unionByName(hits.select(*columns))


def urls_on_labels(pages: DataFrame, labels: Iterable[str] = HARMFUL_LABELS, url: str = "url") -> DataFrame:
    """(url): canonical URLs of the pages whose host has one of ``labels`` among its labels."""
    rows = pages.select(host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rows = rows.where(F.arrays_overlap(F.split("host", "\\."), F.array(*map(F.lit, labels))))
    return rows.select(canonical(F.col("host"), F.col("path")).alias("url"))
