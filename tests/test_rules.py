"""Stored scoring rules: decimals and NULLs; snapshots typed by the contract."""

import datetime as dt
import decimal

from touchline.plans.projection import write_snapshot
from touchline.sources import rules
from touchline.sources.contracts import FCT_PROJECTIONS
from touchline.sources.generations import GenerationTable, read_table


def test_null_and_missing_weights_count_nothing(spark):
    stored = spark.createDataFrame([("odd", decimal.Decimal("0.040"), None)], "scoring_format string, pass_yard_pts decimal(4,3), rec_pts decimal(4,1)")
    row = rules.load_scoring_settings(stored).first()
    assert row["pass_yard_pts"] == 0.04 and row["rec_pts"] == 0.0 and row["te_premium"] == 0.0
    assert rules.load_scoring_settings(stored).columns == rules.scoring_settings(spark).columns


def test_snapshots_are_stored_as_the_contract_types_them(spark, tmp_path):
    rows = [(dt.date(2026, 9, 1), "m", 7, 2026, 0, "ppr", 123.456, 1.0, 2.0, *[10.005] * 7)]
    assert write_snapshot(spark, spark.createDataFrame(rows, FCT_PROJECTIONS), f"{tmp_path}/t") == 1
    out = read_table(spark, f"{tmp_path}/t")
    assert dict(out.dtypes)["projected_points"] == "decimal(5,2)" and dict(out.dtypes)["player_id"] == "int"
    assert out.first()["projected_points"] == decimal.Decimal("123.46")
    assert [c.partition_by for c in GenerationTable(spark, f"{tmp_path}/t").commits()] == [("snapshot_date",)]
