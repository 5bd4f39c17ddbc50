"""Connected components of a link table, without gathering it anywhere.

Alternating large-star and small-star steps (Kiveris et al., 2014).  Every step is a
group-by-min with map-side combine and a join; nothing grows beyond the number of
links, and a hub's rows are split by the adaptive skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.session import cut_lineage


def _pairs(rows: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """(u, v) of each of the given column pairs of every row, where they differ."""
    both = F.array(*[F.struct(F.col(a).alias("u"), F.col(b).alias("v")) for a, b in pairs])
    return rows.select(F.explode(both).alias("x")).select("x.u", "x.v").where("u != v")


def _smallest(rows: DataFrame) -> DataFrame:
    return rows.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = _pairs(links, ("u", "v"), ("v", "u"))
    least = _smallest(both).select("u", F.least("u", "m").alias("m"))
    return _pairs(both.join(least, "u").where("v > u"), ("v", "m"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    return _pairs(down.join(_smallest(down), "u"), ("v", "m"), ("u", "m"))


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that occurs in ``links``; root is the component's smallest node.

    Ids are compared by value; null ids and self links are ignored.  No links: no rows.
    """
    now = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u != v")
    now = cut_lineage(now.distinct())
    seen = _state(now)
    while seen[0]:
        now = cut_lineage(_small_star(_large_star(now).distinct()).distinct())
        state = _state(now)
        if state == seen:
            break
        seen = state
    ends = F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("root")), F.struct(F.col("v").alias("node"), F.col("v").alias("root")))
    return now.select(F.explode(ends).alias("x")).select("x.node", "x.root").distinct()
