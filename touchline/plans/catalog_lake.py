"""Registered queries of the lake: staged tables, scoped refreshes, drifting files, streams, contracts.

Each writes what it needs as Spark tables in the shared folder, from the whole given
tables, and reads it back by the operator under test.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.plans import binding, staging
from touchline.plans.catalog import register
from touchline.session import ensure_checkpoint_dir
from touchline.sources.contracts import Reference, contract, violations
from touchline.sources.drift import read_drifting
from touchline.sources.generations import GenerationTable, read_table
from touchline.sources.scan import DatasetSpec
from touchline.streaming.ingest import closed_windows


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder of the shared ones."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/lake-{uuid.uuid4().hex}/{name}"


EVENTS = DatasetSpec("events", "feed", "parquet", True, ("day",), ("event_id",))


@register("staged_events_by_day", """
SELECT DISTINCT event_id, user_id, event_type, value, props, ts, CAST(ts AS DATE) AS day FROM events
WHERE ts IS NOT NULL""")
def q_staged_events(spark: SparkSession, sf: str) -> DataFrame:
    """DOM-20 over SNK-2: the events landed by type, staged by day (distinct rows, keys required) and read by the pointer."""
    lake = scratch(spark, "events")
    raw = binding.table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    raw.unionByName(raw.where("event_type = 'click'")).write.partitionBy("event_type").parquet(EVENTS.raw_root(lake))  # a part lands twice
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in raw.schema.fields])
    staging.stage(spark, lake, EVENTS, schema)
    return read_table(spark, EVENTS.staged_root(lake))


@register("refreshed_event_days", """
SELECT event_id, user_id, CASE WHEN event_type = 'error' THEN 'fixed' ELSE event_type END AS event_type,
       CASE WHEN event_type = 'error' THEN value + 1 ELSE value END AS value, CAST(ts AS DATE) AS day
FROM events""")
def q_refreshed_days(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-3 / SNK-5 by generations: corrected rows replace those of their key; one commit, only touched days written."""
    events = binding.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", F.to_date("ts").alias("day"))
    table = GenerationTable(spark, scratch(spark, "event_days"))
    table.replace(events, ["day"])
    fixed = events.where("event_type = 'error'").withColumn("event_type", F.lit("fixed")).withColumn("value", F.col("value") + 1)
    table.upsert(fixed, ["day", "event_id"], ["day"], tag="1", writer="corrections")
    table.upsert(fixed.withColumn("value", F.lit(None).cast("double")), ["day", "event_id"], ["day"], tag="1", writer="corrections")  # run again: nothing
    return table.read()


ORDER_CONTRACTS = {c.name: c for c in (
    contract("accounts", "c_custkey bigint, c_name string not null", ("c_custkey",), (("c_name",),)),
    contract("orders", "o_orderkey bigint, o_custkey bigint not null, urgency string not null", ("o_orderkey",),
             references=(Reference(("o_custkey",), "accounts", ("c_custkey",)),)),
    contract("lines", "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint", ("l_orderkey", "l_linenumber"),
             (("l_orderkey", "l_partkey", "l_suppkey"),), (Reference(("l_orderkey",), "orders", ("o_orderkey",)),)),
)}


@register("contract_violations", """
WITH accounts AS (SELECT * FROM customer WHERE c_acctbal >= 0),
o AS (SELECT o_orderkey, o_custkey, nullif(o_orderpriority, '5-LOW') AS urgency FROM orders)
SELECT 'lines' AS "table", 'unique' AS kind, 'l_orderkey,l_linenumber' AS columns,
       length(CAST(l_orderkey AS VARCHAR)) || ':' || l_orderkey || ' ' || length(CAST(l_linenumber AS VARCHAR)) || ':' || l_linenumber || ' ' AS key, count(*) AS n
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL
SELECT 'lines', 'unique', 'l_orderkey,l_partkey,l_suppkey',
       length(CAST(l_orderkey AS VARCHAR)) || ':' || l_orderkey || ' ' || length(CAST(l_partkey AS VARCHAR)) || ':' || l_partkey || ' '
       || length(CAST(l_suppkey AS VARCHAR)) || ':' || l_suppkey || ' ', count(*)
FROM lineitem GROUP BY l_orderkey, l_partkey, l_suppkey HAVING count(*) > 1
UNION ALL
SELECT 'orders', 'refers', 'o_custkey', CAST(o_custkey AS VARCHAR), count(*) FROM o
WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM accounts a WHERE a.c_custkey = o.o_custkey) GROUP BY o_custkey
UNION ALL
SELECT 'orders', 'required', 'urgency', NULL, count(*) FROM o WHERE urgency IS NULL HAVING count(*) > 0
UNION ALL
SELECT 'orders', 'unique', 'o_orderkey', CAST(o_orderkey AS VARCHAR), count(*) FROM o WHERE o_orderkey IS NOT NULL GROUP BY o_orderkey HAVING count(*) > 1
UNION ALL
SELECT 'lines', 'refers', 'l_orderkey', CAST(l_orderkey AS VARCHAR), count(*) FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey) GROUP BY l_orderkey""")
def q_contract_violations(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-6: required, unique and referring columns of three tables, checked in one pass over each."""
    accounts = binding.table(spark, sf, "customer").where("c_acctbal >= 0").select("c_custkey", "c_name")
    orders = binding.table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("urgency"))
    lines = binding.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return violations({"accounts": accounts, "orders": orders, "lines": lines}, ORDER_CONTRACTS)


@register("drifting_line_files", """
SELECT l_orderkey, l_linenumber, CASE WHEN year(l_shipdate) <= 1993 THEN CAST(floor(l_quantity) AS DOUBLE)
         WHEN year(l_shipdate) <= 1995 THEN CAST(floor(l_quantity) * 3000000000 AS DOUBLE) ELSE l_quantity END AS quantity,
       CASE WHEN year(l_shipdate) <= 1993 THEN NULL WHEN year(l_shipdate) <= 1995 THEN CAST(CAST(l_suppkey AS BIGINT) AS VARCHAR) ELSE l_returnflag END AS flag,
       CASE WHEN year(l_shipdate) > 1995 THEN l_tax END AS tax, CAST(year(l_shipdate) AS BIGINT) AS season
FROM lineitem""")
def q_drifting_files(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-3 / D5: int, bigint and double files, and columns that come and go or change to text, read without a schema."""
    root = scratch(spark, "lines")
    lines = binding.table(spark, sf, "lineitem").withColumn("season", F.year("l_shipdate"))
    early, middle, late = lines.where("season <= 1993"), lines.where("season between 1994 and 1995"), lines.where("season > 1995")
    keys = ["l_orderkey", "l_linenumber"]
    for part, columns in (
            (early, [F.floor("l_quantity").cast("int").alias("quantity")]),
            (middle, [(F.floor("l_quantity") * 3_000_000_000).cast("bigint").alias("quantity"), F.col("l_suppkey").cast("bigint").alias("flag")]),
            (late, [F.col("l_quantity").alias("quantity"), F.col("l_returnflag").alias("flag"), F.col("l_tax").alias("tax")])):
        part.select(*keys, *columns, "season").write.mode("append").partitionBy("season").parquet(root)
    return read_drifting(spark, root).select(*keys, "quantity", "flag", "tax", "season")


@register("late_event_windows", """
WITH base AS (
  SELECT event_id, ts, event_type, value, (date_diff('day', (SELECT min(CAST(ts AS DATE)) FROM events), CAST(ts AS DATE))
    + CASE WHEN event_type = 'error' THEN 7 ELSE 0 END) // 7 AS run FROM events
), arrivals AS (
  SELECT * FROM base UNION ALL SELECT event_id, ts, event_type, value, run + 1 FROM base WHERE event_type = 'click'
), tops AS (SELECT run, max(ts) AS top FROM arrivals GROUP BY run),
marks AS (
  SELECT r.run, date_trunc('milliseconds', (SELECT max(top) FROM tops t WHERE t.run < r.run)) - INTERVAL 2 DAY AS mark FROM tops r
), kept AS (
  SELECT DISTINCT a.event_id, a.ts, a.event_type, a.value FROM arrivals a JOIN marks m ON m.run = a.run WHERE m.mark IS NULL OR a.ts > m.mark
)
SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, count(*) FILTER (WHERE value > 10) AS n_large FROM kept
WHERE CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP) <= (SELECT date_trunc('milliseconds', max(top)) - INTERVAL 2 DAY FROM tops)
GROUP BY 1, 2""")
def q_late_event_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Streaming: weekly landings, errors a week late, clicks delivered twice; one run a landing, each going on from the last.

    Every run takes in what has landed and appends the days that the watermark closes;
    errors older than it are dropped as late, second clicks as repeats.
    """
    landing, sink = scratch(spark, "landing"), scratch(spark, "windows")
    events = binding.table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    first = events.agg(F.min(F.to_date("ts")).alias("first"))
    age = F.datediff(F.to_date("ts"), "first") + F.when(F.col("event_type") == "error", 7).otherwise(0)
    runs = events.crossJoin(F.broadcast(first)).withColumn("run", (age / 7).cast("int")).drop("first")
    runs = runs.unionByName(runs.where("event_type = 'click'").withColumn("run", F.col("run") + 1))
    feed = scratch(spark, "feed")
    runs.write.partitionBy("run").parquet(feed)
    runs = spark.read.parquet(feed)
    schema = T.StructType([f for f in runs.schema.fields if f.name != "run"])
    name = f"windows-{uuid.uuid4().hex}"
    aggregates = [F.count("*").alias("n"), F.count_if(F.col("value") > 10).alias("n_large")]
    for number in sorted(r["run"] for r in runs.select("run").distinct().collect()):  # a few weeks
        runs.where(F.col("run") == number).drop("run").write.parquet(f"{landing}/run={number}")
        closed_windows(spark, f"{landing}/*", schema, sink, "event_id", "ts", ["event_type"], aggregates, name)
    return spark.read.parquet(sink).select(F.to_date("window_start").alias("day"), "event_type", "n", "n_large")
