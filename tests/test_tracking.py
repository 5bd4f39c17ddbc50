"""The fact's tracking enrichment, on the graded tables against its SQL."""

import datetime as dt

import duckdb

import __spark_entry__ as entry
from conftest import SF_SMALL


def test_tracking_reaches_the_fact(spark):
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    out = entry.queries()["player_game_fact_tracked"](spark, SF_SMALL)
    rows = out.collect()
    cols = ", ".join(out.columns)
    want = con.execute(f"SELECT {cols} FROM ({entry.oracle_sql()['player_game_fact_tracked']})").fetchall()
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))
    for c in ("rush_yards_over_expected", "avg_separation", "avg_cushion"):
        assert any(r[c] is not None for r in rows)
    assert any(r["avg_separation"] is None and r["rush_yards_over_expected"] is not None for r in rows)  # full outer


def test_plays_are_the_touches(spark, tmp_path):
    """Lines that touch nobody are left out before the plays are dealt, joined and written."""
    from touchline.plans.catalog_marts import plays_feed

    at = dt.datetime(2023, 9, 20)
    lines = [(1, 5.0, "R", at), (1, 7.0, "A", at), (1, 9.0, "N", at), (2, 1.0, None, at), (3, 1.0, "R", at), (9, 1.0, "R", at)]
    spark.createDataFrame(lines, "l_orderkey long, l_quantity double, l_returnflag string, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 4), (2, 4), (3, None)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    got = sorted(map(tuple, plays_feed(spark, str(tmp_path)).select("yardline_100", "rusher_player_id", "receiver_player_id").collect()))
    assert got == [(1, None, None), (5, "00-4", None), (7, None, "00-4")]
