"""Aggregates, windows, order and limits, CTEs, modifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import modifiers
from ..plans.select import select
from .base import REVENUE, query, read, revenue, views


@query("agg_global", f"SELECT count(*) AS n, {REVENUE} AS revenue, CAST(max(l_quantity) AS DOUBLE) AS most FROM lineitem")
def agg_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("n"), revenue().alias("revenue"), F.max("l_quantity").alias("most"))


@query("agg_group", f"SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS quantity, {REVENUE} AS revenue FROM lineitem GROUP BY 1, 2")
def agg_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"), revenue().alias("revenue"))


@query("agg_group_alias", "SELECT strftime(ts, '%Y-%m-%d') AS day, lower(event_type) AS kind, count(*) AS n FROM events GROUP BY day, kind")
def agg_group_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir, "events")
    return spark.sql("SELECT date_format(date_trunc('day', ts), 'yyyy-MM-dd') AS day, lower(event_type) AS kind, count(*) AS n FROM events GROUP BY day, kind")


@query("agg_avg", "SELECT o_orderpriority, CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) / count(*) AS mean FROM orders GROUP BY 1")
def agg_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact sum divided once, so that the order of rows does not show."""
    return read(spark, sf_dir, "orders").groupBy("o_orderpriority").agg((F.sum(F.col("o_totalprice").cast("decimal(14,2)")).cast("double") / F.count("o_totalprice")).alias("mean"))


@query("agg_min_max", "SELECT o_orderstatus, min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders GROUP BY 1")
def agg_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"))


@query("agg_argmax", "SELECT user_id, arg_max(event_type, event_id) AS last_type FROM events GROUP BY 1")
def agg_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("last_type"))


@query("agg_any", "SELECT n_regionkey, any_value(r_name) AS r_name FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def agg_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).groupBy("n_regionkey").agg(F.any_value("r_name").alias("r_name"))


@query("agg_uniq_exact", "SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def agg_uniq_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))


@query("agg_uniq")
def agg_uniq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate, by HyperLogLog."""
    return read(spark, sf_dir, "events").groupBy("event_type").agg(F.approx_count_distinct("user_id").alias("users"))


@query("agg_state", "SELECT event_type, count(*) AS n, max(value) AS most FROM events GROUP BY 1")
def agg_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial states by day, merged."""
    states = read(spark, sf_dir, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"), F.max("value").alias("most"))
    return states.groupBy("event_type").agg(F.sum("n").alias("n"), F.max("most").alias("most"))


@query("agg_state_uniq")
def agg_state_uniq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches by day, merged."""
    states = read(spark, sf_dir, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.hll_sketch_agg("user_id").alias("state"))
    return states.groupBy("event_type").agg(F.hll_sketch_estimate(F.hll_union_agg("state")).alias("users"))


@query("agg_distinct", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def agg_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select(read(spark, sf_dir, "orders")).columns("o_orderstatus", "o_orderpriority").distinct().frame()


@query("having", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 12")
def having(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select(read(spark, sf_dir, "orders")).group_by("o_custkey").aggregate(F.count("*").alias("n")).having(F.col("n") > 12).frame()


@query("win_row_number", "SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS place FROM events")
def win_row_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).cast("long")
    return read(spark, sf_dir, "events").select("event_id", place.alias("place"))


@query("sort", "SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal DESC, s_suppkey")
def sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select(read(spark, sf_dir, "supplier")).columns("s_suppkey", "s_acctbal").order_by(F.desc("s_acctbal"), "s_suppkey").frame()


@query("limit_offset", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10 OFFSET 5")
def limit_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select(read(spark, sf_dir, "orders")).columns("o_orderkey", "o_totalprice").order_by(F.desc("o_totalprice"), "o_orderkey").limit(10, 5).frame()


@query("limit_by", "SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS r FROM events) WHERE r <= 3")
def limit_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modifiers.limit_by(read(spark, sf_dir, "events").select("user_id", "event_id", "value"), ["user_id"], 3, [F.desc("value"), F.asc("event_id")])


@query("limit_by_offset", "SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS r FROM events) WHERE r > 2 AND r <= 4")
def limit_by_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modifiers.limit_by(read(spark, sf_dir, "events").select("user_id", "event_id", "value"), ["user_id"], 2, [F.desc("value"), F.asc("event_id")], 2).select("user_id", "event_id")


@query("cte", "WITH big AS (SELECT * FROM orders WHERE o_totalprice > 100000) SELECT a.o_orderstatus, count(*) AS n FROM big a JOIN (SELECT o_custkey, max(o_totalprice) AS m FROM big GROUP BY 1) b ON a.o_custkey = b.o_custkey AND a.o_totalprice = b.m GROUP BY 1")
def cte(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir, "orders")
    return spark.sql("WITH big AS (SELECT * FROM orders WHERE o_totalprice > 100000) SELECT a.o_orderstatus, count(*) AS n FROM big a JOIN (SELECT o_custkey, max(o_totalprice) AS m FROM big GROUP BY 1) b ON a.o_custkey = b.o_custkey AND a.o_totalprice = b.m GROUP BY 1")


@query("cte_materialized", "WITH k AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) SELECT c_custkey, n, (SELECT max(n) FROM k) AS most FROM customer JOIN k ON c_custkey = o_custkey WHERE n >= 10")
def cte_materialized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts are one subplan for both uses: Spark shuffles them once and reuses that exchange."""
    counts = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    c = read(spark, sf_dir, "customer").select("c_custkey")
    most = F.broadcast(counts.agg(F.max("n").alias("most")))  # one row
    return c.join(counts.where("n >= 10"), F.col("c_custkey") == F.col("o_custkey")).join(most, F.lit(True)).select("c_custkey", "n", "most")


@query("cte_recursive", "WITH RECURSIVE t(n, total) AS (SELECT CAST(1 AS BIGINT), CAST(1 AS BIGINT) UNION ALL SELECT n + 1, total + n + 1 FROM t WHERE n < 20) SELECT n, total FROM t")
def cte_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql("WITH RECURSIVE t(n, total) AS (SELECT CAST(1 AS BIGINT), CAST(1 AS BIGINT) UNION ALL SELECT n + 1, total + n + 1 FROM t WHERE n < 20) SELECT n, total FROM t")


@query("final", "SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS r FROM events) WHERE r = 1")
def final(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select(read(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value")).final(["user_id", "event_type"], "event_id").frame()


@query("final_deleted", "SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r = 1 AND event_type <> 'error'")
def final_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events").select("user_id", "event_id", (F.col("event_type") == "error").cast("int").alias("is_deleted"))
    return modifiers.final(rows, ["user_id"], "event_id", "is_deleted").select("user_id", "event_id")


_PLACE = "CAST(CAST(concat('0x', substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 13)) AS BIGINT) AS DOUBLE) / 4503599627370496"


@query("sample", f"SELECT o_orderkey FROM orders WHERE {_PLACE} < 0.1")
def sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modifiers.sample(read(spark, sf_dir, "orders").select("o_orderkey"), 0.1, "o_orderkey")


@query("sample_offset", f"SELECT o_orderkey FROM orders WHERE {_PLACE} >= 0.5 AND {_PLACE} < 0.6")
def sample_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modifiers.sample(read(spark, sf_dir, "orders").select("o_orderkey"), "1/10 OFFSET 1/2", "o_orderkey")


@query("sample_all", "SELECT o_orderkey FROM orders")
def sample_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modifiers.sample(read(spark, sf_dir, "orders").select("o_orderkey"), 1, "o_orderkey")


@query("settings", "SELECT count(*) AS n FROM orders")
def settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    with modifiers.settings(spark, max_threads=4):
        n = read(spark, sf_dir, "orders").count()
    return spark.range(1).select(F.lit(n).cast("long").alias("n"))


@query("with_hint", "SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def with_hint(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n = read(spark, sf_dir, "customer"), modifiers.with_hint(read(spark, sf_dir, "nation"), "shuffle_hash")
    return c.join(n, c.c_nationkey == n.n_nationkey).groupBy("n_name").agg(F.count("*").alias("n"))


@query("query_limit", "SELECT count(*) AS n FROM (SELECT * FROM orders LIMIT 25)")
def query_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..plans.params import query as run

    views(spark, sf_dir, "orders")
    return run(spark, "SELECT o_orderkey FROM orders", limit=25).agg(F.count("*").alias("n"))


@query("limit0_probe", "SELECT name, kind FROM (VALUES ('n_nationkey', 'int'), ('n_name', 'string'), ('n_regionkey', 'int')) t(name, kind)")
def limit0_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.tables import describe

    return spark.createDataFrame(describe(read(spark, sf_dir, "nation")), "name string, kind string")
