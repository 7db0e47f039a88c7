"""Projection, filters, parameters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import params
from ..plans.select import select
from .base import query, read, views


@query("project", "SELECT o_orderkey, o_totalprice * 2 AS twice, upper(o_orderstatus) AS status FROM orders")
def project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_totalprice") * 2).alias("twice"), F.upper("o_orderstatus").alias("status"))


@query("filter_where", "SELECT o_orderkey FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'O'")
def filter_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").where("o_totalprice > 100000 and o_orderstatus = 'O'").select("o_orderkey")


@query("prewhere", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND o_totalprice > 50000")
def prewhere(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = select(read(spark, sf_dir, "orders")).where(F.col("o_totalprice") > 50000).prewhere(F.col("o_orderstatus") == "F").prewhere(F.col("o_orderpriority") == "1-URGENT")
    return s.columns("o_orderkey").frame()


@query("filter_in", "SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('P') AND (o_orderstatus, o_orderpriority) IN (('F', '1-URGENT'), ('O', '2-HIGH'))")
def filter_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir, "orders")
    return spark.sql("SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('P') AND (o_orderstatus, o_orderpriority) IN (('F', '1-URGENT'), ('O', '2-HIGH'))")


@query("filter_in_empty", "SELECT o_orderkey FROM orders WHERE false")
def filter_in_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").where(F.col("o_orderstatus").isin([])).select("o_orderkey")


@query("filter_in_subquery", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)")
def filter_in_subquery(spark: SparkSession, sf_dir: str) -> DataFrame:
    big = read(spark, sf_dir, "orders").where("o_totalprice > 200000").select(F.col("o_custkey").alias("c_custkey"))
    return read(spark, sf_dir, "customer").select("c_custkey").join(big, "c_custkey", "left_semi")


@query("filter_between", "SELECT p_partkey FROM part WHERE p_size BETWEEN 10 AND 20")
def filter_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").where(F.col("p_size").between(10, 20)).select("p_partkey")


@query("filter_is_null", "SELECT c_custkey FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders) ON c_custkey = o_custkey WHERE o_custkey IS NULL")
def filter_is_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").select("o_custkey").distinct()
    c = read(spark, sf_dir, "customer").select("c_custkey")
    return c.join(o, F.col("c_custkey") == F.col("o_custkey"), "left").where(F.col("o_custkey").isNull()).select("c_custkey")


@query("filter_in_array", "SELECT s_suppkey FROM supplier WHERE list_contains([1, 3, 5, 7], s_nationkey)")
def filter_in_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir, "supplier")
    return params.query(spark, "SELECT s_suppkey FROM supplier WHERE array_contains({ids:Array(Int32)}, s_nationkey)", {"ids": [1, 3, 5, 7]})


@query("filter_duration", "SELECT CAST(range AS BIGINT) AS number FROM range(200) WHERE (range - 100) * 1800 IN (-5400, 0, 97200)")
def filter_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Durations, also negative and longer than a day, compared as intervals."""
    from ..sources.tables import numbers

    spans = numbers(spark, 200).withColumn("span", F.make_dt_interval(secs=(F.col("number") - 100) * 1800))
    wanted = [dt.timedelta(minutes=-90), dt.timedelta(0), dt.timedelta(hours=27)]
    return spans.where(F.col("span").isin([F.lit(x) for x in wanted])).select("number")


@query("alias_in_where", "SELECT o_orderkey, price FROM (SELECT o_orderkey, o_totalprice / 1000 AS price FROM orders) WHERE price > 150")
def alias_in_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_totalprice") / 1000).alias("price")).where("price > 150")


@query("with_scalar", "SELECT s_suppkey, 7 AS answer FROM supplier WHERE s_nationkey = 7")
def with_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "supplier").withColumn("answer", F.lit(7)).where("s_nationkey = answer").select("s_suppkey", "answer")


@query("filter_dynamic", "SELECT event_id FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-05' AND event_type = 'view' ORDER BY ts")
def filter_dynamic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conditions are added where a value is given."""
    given = {"event_type": "view", "user_id": None}
    s = select(read(spark, sf_dir, "events")).where(F.col("ts").between(F.lit("2024-01-03").cast("timestamp_ntz"), F.lit("2024-01-05").cast("timestamp_ntz")))
    for name, value in given.items():
        if value is not None:
            s = s.where(F.col(name) == value)
    return s.order_by("ts").frame().select("event_id")


@query("filter_like", "SELECT p_partkey FROM part WHERE p_type LIKE '%E%' AND p_brand NOT LIKE '%#1_'")
def filter_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").where(F.col("p_type").like("%E%") & ~F.col("p_brand").like("%#1_")).select("p_partkey")


@query("filter_ilike", "SELECT p_partkey FROM part WHERE p_type ILIKE '%eco%' AND p_name NOT ILIKE 'PART 1%'")
def filter_ilike(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").where(F.col("p_type").ilike("%eco%") & ~F.col("p_name").ilike("PART 1%")).select("p_partkey")


@query("cast", "SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS q, CAST(l_linenumber AS VARCHAR) AS n FROM lineitem")
def cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..types import spark_type

    c = lambda name, kind: F.col(name).cast(spark_type(kind))
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", c("l_quantity", "Int64").alias("q"), c("l_linenumber", "String").alias("n"))


@query("bind_client", "SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 500.5")
def bind_client(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir, "customer")
    return params.query(spark, "SELECT c_custkey FROM customer WHERE c_mktsegment = %(seg)s AND c_acctbal > %(low)s", {"seg": "BUILDING", "low": 500.5})


@query("bind_server", "SELECT o_orderkey FROM orders WHERE o_totalprice > 150000 AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderstatus = 'O'")
def bind_server(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir, "orders")
    return params.query(spark, "SELECT {c:Identifier} FROM {t:Identifier} WHERE o_totalprice > {k:UInt32} AND o_orderdate >= {d:DateTime} AND o_orderstatus = {s:String} -- all bound", {"c": "o_orderkey", "t": "orders", "k": 150_000, "d": dt.datetime(1996, 1, 1), "s": "O"})


@query("bind_quoted", "SELECT c_custkey, '100%s {x:UInt8} %(y)s' AS note FROM customer WHERE c_mktsegment = 'BUILDING'")
def bind_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markers inside quoted text are text."""
    views(spark, sf_dir, "customer")
    return params.query(spark, "SELECT c_custkey, '100%s {x:UInt8} %(y)s' AS note FROM customer WHERE c_mktsegment = {seg:String}", {"seg": "BUILDING"})


@query("bind_in_array", "SELECT n_name FROM nation WHERE n_nationkey IN (2, 4, 8)")
def bind_in_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir, "nation")
    return params.query(spark, "SELECT n_name FROM nation WHERE array_contains({keys:Array(Int32)}, n_nationkey)", {"keys": [2, 4, 8]})


@query("bind_binary", "SELECT 'DEADBEEF00' AS hex, CAST(5 AS BIGINT) AS size")
def bind_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return params.query(spark, "SELECT hex(%(data)s) AS hex, CAST(octet_length(%(data)s) AS BIGINT) AS size", {"data": b"\xde\xad\xbe\xef\x00"})


@query("ctx_reuse", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1")
def ctx_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir, "orders")
    context = params.QueryContext("SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus = {s:String} GROUP BY 1")
    return context.set_parameters(s="F").run(spark).unionAll(context.set_parameters(s="O").run(spark))


@query("stmt_classify", "SELECT sql, kind, limited FROM (VALUES ('SELECT 1 /* LIMIT */', 'select', false), ('-- x\nINSERT INTO t VALUES (1)', 'insert', false), ('DROP TABLE t', 'command', false), ('SELECT * FROM (SELECT 1 LIMIT 3) LIMIT 5', 'select', true)) t(sql, kind, limited)")
def stmt_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = ["SELECT 1 /* LIMIT */", "-- x\nINSERT INTO t VALUES (1)", "DROP TABLE t", "SELECT * FROM (SELECT 1 LIMIT 3) LIMIT 5"]
    return spark.createDataFrame([(x, params.classify(x), params.has_limit(x)) for x in texts], "sql string, kind string, limited boolean")


@query("quote_ident", "SELECT n_nationkey AS \"odd `name\" FROM nation")
def quote_ident(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir, "nation")
    return spark.sql(f"SELECT n_nationkey AS {params.quote_ident('odd `name')} FROM nation")
