"""Table engines' read semantics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog.engines import Engine, parse_engine, read as merged
from .base import query, read


@query("eng_mergetree", "SELECT o_orderkey, o_totalprice FROM orders")
def mergetree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merged(read(spark, sf_dir, "orders"), Engine("MergeTree", order_by=("o_orderkey",))).select("o_orderkey", "o_totalprice")


@query("eng_replacing", "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r = 1 AND event_type <> 'error'")
def replacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events").select("user_id", "event_id", "event_type", (F.col("event_type") == "error").cast("int").alias("gone"))
    return merged(rows, Engine("ReplacingMergeTree", order_by=("user_id",), arguments=("event_id", "gone"))).drop("gone")


@query("eng_summing", "SELECT l_returnflag, CAST(sum(l_linenumber) AS BIGINT) AS l_linenumber, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY 1")
def summing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "lineitem").select("l_returnflag", "l_linenumber", F.lit(1).cast("long").alias("n"))
    return merged(rows, Engine("SummingMergeTree", order_by=("l_returnflag",)))


@query("eng_collapsing", "SELECT o_orderkey, o_orderstatus, CAST(1 AS INTEGER) AS sign FROM orders WHERE o_orderstatus <> 'P'")
def collapsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order, and a row that cancels each with status P."""
    rows = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.lit(1).alias("sign"))
    return merged(rows.unionAll(rows.where("o_orderstatus = 'P'").withColumn("sign", F.lit(-1))), Engine("CollapsingMergeTree", order_by=("o_orderkey",), arguments=("sign",)))


@query("eng_aggregating", "SELECT l_returnflag, CAST(sum(l_linenumber) AS BIGINT) AS lines, max(l_partkey) AS last_part, min(l_extendedprice) AS cheapest FROM lineitem GROUP BY 1")
def aggregating(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_linenumber").cast("long").alias("lines"), F.col("l_partkey").alias("last_part"), F.col("l_extendedprice").alias("cheapest"))
    types = {"lines": "SimpleAggregateFunction(sum, Int64)", "last_part": "SimpleAggregateFunction(max, Int64)", "cheapest": "SimpleAggregateFunction(min, Float64)"}
    return merged(rows, Engine("AggregatingMergeTree", order_by=("l_returnflag",)), types)


@query("eng_versioned", "SELECT o_orderkey, o_orderstatus, CAST(1 AS INTEGER) AS sign, CAST(CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END AS INTEGER) AS version FROM orders")
def versioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order in its first version; for those with status P a row that cancels it, and a second version."""
    rows = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.lit(1).alias("sign"), F.lit(1).alias("version"))
    again = rows.where("o_orderstatus = 'P'")
    rows = rows.unionAll(again.withColumn("sign", F.lit(-1))).unionAll(again.withColumn("version", F.lit(2)))
    return merged(rows, Engine("VersionedCollapsingMergeTree", order_by=("o_orderkey",), arguments=("sign", "version")))


@query("eng_replicated", "SELECT user_id, max(event_id) AS event_id FROM events GROUP BY 1")
def replicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    engine = parse_engine("ReplicatedReplacingMergeTree('/tables/{shard}/t', '{replica}', event_id) ORDER BY user_id")
    return merged(read(spark, sf_dir, "events").select("user_id", "event_id"), engine)


@query("ttl", "SELECT event_id FROM events WHERE false")
def ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of these events ended long ago."""
    return merged(read(spark, sf_dir, "events"), Engine("MergeTree", order_by=("event_id",), ttl="ts + INTERVAL 30 DAYS")).select("event_id")


@query("engine_parse", "SELECT 'ReplacingMergeTree' AS name, 'k,d' AS order_by, 'toYYYYMM(d)' AS partition_by, 'v' AS arguments, '8192' AS granularity")
def engine_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = parse_engine("ReplacingMergeTree(v) PARTITION BY toYYYYMM(d) ORDER BY (k, d) SETTINGS index_granularity = 8192")
    return spark.createDataFrame([(e.name, ",".join(e.order_by), ",".join(e.partition_by), ",".join(e.arguments), e.settings["index_granularity"])], "name string, order_by string, partition_by string, arguments string, granularity string")
