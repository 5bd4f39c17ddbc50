"""Registered single-operator queries: events filters/dedup/casts, code maps, upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.scalars import (
    blank_to_null, canonical_code, clean_id, try_int_from_double, try_int_from_text,
)
from touchline.operators.filters import distinct_rows, drop_null_keys, latest_per_key, latest_rows
from touchline.operators.upsert import merge_insert_only, merge_upsert
from touchline.plans import binding
from touchline.plans.catalog import register
from touchline.sources import rules


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return binding.table(spark, sf, "events")


def _mode_sql(src: str, key: str, value: str) -> str:
    return f"""SELECT {key}, {value} AS mode_value FROM (
    SELECT {key}, {value}, row_number() OVER (PARTITION BY {key} ORDER BY n DESC, {value}) AS rn
    FROM (SELECT {key}, {value}, count(*) AS n FROM {src} GROUP BY {key}, {value}) c) r WHERE rn = 1"""


@register("primary_category", f"""
WITH m AS ({_mode_sql('events', 'user_id', 'event_type')})
SELECT e.user_id, m.mode_value AS primary_type, count(*) AS n_events
FROM events e JOIN m ON m.user_id = e.user_id GROUP BY e.user_id, m.mode_value""")
def q_primary_category(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-5: the most frequent category per entity; ties go to the lowest value (D2)."""
    return _events(spark, sf).groupBy("user_id").agg(
        F.mode("event_type", True).alias("primary_type"), F.count(F.lit(1)).alias("n_events"))


@register("latest_snapshot", """
SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS snapshot_date FROM events
WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""")
def q_latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """FLT-6: the rows of the newest daily snapshot."""
    e = _events(spark, sf).select("event_id", "user_id", "event_type", "value",
                                  F.to_date("ts").alias("snapshot_date"))
    return latest_rows(e, "snapshot_date")


@register("latest_per_group", """
SELECT e.event_id, e.user_id, e.event_type, CAST(e.ts AS DATE) AS snapshot_date
FROM events e JOIN (SELECT user_id, event_type, max(CAST(ts AS DATE)) AS d FROM events GROUP BY 1, 2) m
  ON m.user_id = e.user_id AND m.event_type = e.event_type AND m.d = CAST(e.ts AS DATE)""")
def q_latest_per_group(spark: SparkSession, sf: str) -> DataFrame:
    """FLT-7: per (entity, category) the rows of its own latest day."""
    e = _events(spark, sf).select("event_id", "user_id", "event_type", F.to_date("ts").alias("snapshot_date"))
    return latest_per_key(e, ["user_id", "event_type"], "snapshot_date")


@register("full_row_dedup", "SELECT DISTINCT * FROM (SELECT * FROM events UNION ALL SELECT * FROM events) u")
def q_full_row_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-6: exact duplicate rows collapse (the table unioned with itself)."""
    e = _events(spark, sf)
    return distinct_rows(e.unionByName(e))


@register("dedup_natural_key", """
SELECT event_id, ts, user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY value DESC, src) AS rn FROM (
    SELECT event_id, ts, user_id, event_type, value, 0 AS src FROM events
    UNION ALL SELECT event_id, ts, user_id, event_type, value + 1.0, 1 FROM events WHERE event_type = 'view'
  ) u
) r WHERE rn = 1""")
def q_dedup_natural_key(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-6 / WIN-4: one row per natural key with a total-order tie-break (late corrections win)."""
    e = _events(spark, sf).select("event_id", "ts", "user_id", "event_type", "value")
    fixes = e.filter(F.col("event_type") == "view").withColumn("value", F.col("value") + 1.0)
    u = e.withColumn("src", F.lit(0)).unionByName(fixes.withColumn("src", F.lit(1)))
    out = distinct_rows(u, ["event_id"], [F.col("value").desc(), F.col("src")])
    return out.drop("src")


@register("null_key_drop", """
SELECT event_id, nullif(event_type, 'error') AS event_key, CAST(ts AS DATE) AS day FROM events
WHERE nullif(event_type, 'error') IS NOT NULL AND CAST(ts AS DATE) IS NOT NULL""")
def q_null_key_drop(spark: SparkSession, sf: str) -> DataFrame:
    """FLT-1: rows whose partition keys are NULL are dropped before a partitioned write."""
    e = _events(spark, sf).select("event_id", F.nullif(F.col("event_type"), F.lit("error")).alias("event_key"),
                                  F.to_date("ts").alias("day"))
    return drop_null_keys(e, ["event_key", "day"])


@register("safe_casts", """
SELECT event_id,
  try_cast(json_extract_string(props, '$.k') AS INTEGER) AS k_int,
  CAST(value AS INTEGER) AS value_half_even,
  CAST(round(try_cast(trim(CAST(value AS VARCHAR)) AS DOUBLE)) AS INTEGER) AS value_text_int,
  CAST(round(try_cast(trim(event_type) AS DOUBLE)) AS INTEGER) AS junk_int,
  try_cast(substr(CAST(ts AS VARCHAR), 1, 10) AS DATE) AS day
FROM events""")
def q_safe_casts(spark: SparkSession, sf: str) -> DataFrame:
    """SCA-4 + D1/D1b: text and double casts with the reference's rounding; junk -> NULL."""
    e = _events(spark, sf).select(
        "event_id", "value", "event_type",
        F.get_json_object("props", "$.k").alias("k_txt"),
        F.col("value").cast("string").alias("value_txt"),
        F.substring(F.col("ts").cast("string"), 1, 10).alias("day_txt"))
    return e.select(
        "event_id",
        F.expr("try_cast(k_txt as int)").alias("k_int"),
        try_int_from_double(F.col("value")).alias("value_half_even"),
        try_int_from_text("value_txt").alias("value_text_int"),
        try_int_from_text("event_type").alias("junk_int"),
        F.expr("try_cast(day_txt as date)").alias("day"))


@register("clean_ids", """
SELECT event_id,
  nullif(nullif(CASE event_type WHEN 'view' THEN '' WHEN 'click' THEN '0' ELSE CAST(user_id AS VARCHAR) END, ''), '0') AS id1,
  nullif(nullif(CAST(event_id % 7 AS VARCHAR), ''), '0') AS id2,
  nullif(CASE WHEN value < 2 THEN '' ELSE event_type END, '') AS label
FROM events""")
def q_clean_ids(spark: SparkSession, sf: str) -> DataFrame:
    """SCA-6 + SCA-7: ids as text with '' and '0' turned into NULL; blank text -> NULL."""
    e = _events(spark, sf)
    raw1 = (F.when(F.col("event_type") == "view", F.lit("")).when(F.col("event_type") == "click", F.lit("0"))
            .otherwise(F.col("user_id").cast("string")))
    return e.select(
        "event_id", clean_id(raw1).alias("id1"), clean_id(F.col("event_id") % 7).alias("id2"),
        blank_to_null(F.when(F.col("value") < 2, F.lit("")).otherwise(F.col("event_type"))).alias("label"))


_CODES = list(rules.TEAM_CODE_ALIASES) + [m[0] for m in rules.TEAM_META]


@register("canonical_codes", f"""
WITH coded AS (
  SELECT p_partkey, [{', '.join(f"'{c}'" for c in _CODES)}][(p_partkey % {len(_CODES)}) + 1] AS code FROM part
)
SELECT CASE code {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in rules.TEAM_CODE_ALIASES.items())} ELSE code END AS abbr,
  count(*) AS n_rows,
  count(*) FILTER (WHERE code IN ({', '.join(f"'{k}'" for k in rules.TEAM_CODE_ALIASES)})) AS n_legacy
FROM coded GROUP BY 1""")
def q_canonical_codes(spark: SparkSession, sf: str) -> DataFrame:
    """SCA-1 / DOM-19: legacy team codes mapped to the current code on every row."""
    p = binding.table(spark, sf, "part")
    arr = F.array(*[F.lit(c) for c in _CODES])
    coded = p.select(F.element_at(arr, (F.col("p_partkey") % len(_CODES) + 1).cast("int")).alias("code"))
    return coded.groupBy(canonical_code(F.col("code")).alias("abbr")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("code").isin(list(rules.TEAM_CODE_ALIASES))).alias("n_legacy"))


def _order_slices(spark: SparkSession, sf: str):
    o = binding.table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    target = o.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    updates = o.filter(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz")).select(
        "o_orderkey", "o_custkey", F.lit("U").alias("o_orderstatus"),
        (F.col("o_totalprice") + 100.0).alias("o_totalprice"), "o_orderdate")
    return target, updates


_SLICES_SQL = """
WITH target AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders
                WHERE o_orderdate < TIMESTAMP '1998-01-01'),
updates AS (SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice + 100.0 AS o_totalprice, o_orderdate
            FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01')"""


@register("upsert_natural_key", _SLICES_SQL + """
SELECT * FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM updates)
UNION ALL SELECT * FROM updates""")
def q_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-3: delete+insert on the natural key (overlapping slices; updates win)."""
    target, updates = _order_slices(spark, sf)
    return merge_upsert(target, updates, ["o_orderkey"])


@register("insert_only_new", _SLICES_SQL + """
SELECT * FROM target
UNION ALL SELECT * FROM updates WHERE o_orderkey NOT IN (SELECT o_orderkey FROM target)""")
def q_insert_only(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-4 + JOI-8: additive insert; existing rows are never touched."""
    target, updates = _order_slices(spark, sf)
    return merge_insert_only(target, updates, ["o_orderkey"])


@register("skew_safe_join", """
WITH per_type AS (SELECT event_type, avg(value) AS type_avg, count(*) AS type_n FROM events GROUP BY event_type)
SELECT e.event_id, e.event_type, round(e.value - p.type_avg, 6) AS vs_type_avg, p.type_n
FROM events e JOIN per_type p ON p.event_type = e.event_type""")
def q_skew_safe_join(spark: SparkSession, sf: str) -> DataFrame:
    """Salted join on hot keys: every event against its category's aggregate.

    A handful of categories own all rows, so a plain shuffle join would send
    each category to one task; the aggregate side (one row per key) is
    replicated over 16 salts and each event picks a salt from its own hash.
    """
    from touchline.operators.joins import salted_join
    e = _events(spark, sf).select("event_id", "event_type", "value")
    per_type = e.groupBy("event_type").agg(F.avg("value").alias("type_avg"), F.count(F.lit(1)).alias("type_n"))
    j = salted_join(e, per_type, ["event_type"], 16, salt_source=F.xxhash64("event_id"))
    return j.select("event_id", "event_type", F.round(F.col("value") - F.col("type_avg"), 6).alias("vs_type_avg"),
                    "type_n")
