"""Driver contract: entry runs, every query has a builder, a few oracles agree at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events".split()


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["player", "team", "rec", "rec_yds", "rec_td", "points"]


def test_registry_shape():
    q, o = entry.queries(), entry.oracle_sql()
    assert len(q) >= 35 and set(o) <= set(q)


@pytest.mark.parametrize("name", ["season_totals", "score_formats", "dim_games", "primary_category", "starter_counts",
                                  "vegas_lines", "canonical_codes", "skew_safe_join", "team_game_stats"])
def test_oracle_agrees_small(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    sdf = entry.queries()[name](spark, SF_SMALL)
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(ocols)
    key = sorted(ocols)
    def nsort(rows):  # NULL-safe ordering for rows that mix None with values
        return sorted(rows, key=lambda t: tuple((v is None, str(v)) for v in t))
    srows = nsort(tuple(r[c] for c in key) for r in sdf.collect())
    orows = nsort(tuple(row[ocols.index(c)] for c in key) for row in res.fetchall())
    assert srows == orows
