"""Joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import asof_join, ch_join
from ..operators.modifiers import limit_by
from ..plans.select import select
from .base import REVENUE, query, read, revenue


@query("flagship_top_segments", f"""
SELECT n_name, c_mktsegment, CAST(revenue AS DOUBLE) AS revenue FROM (SELECT *, row_number() OVER (PARTITION BY n_name ORDER BY revenue DESC, c_mktsegment) AS r FROM (
SELECT n_name, c_mktsegment, {REVENUE} AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE l_discount <= 0.09 GROUP BY n_name, c_mktsegment)) WHERE r <= 3""")
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top segments by revenue of each nation. Revenue is added up by customer before names are joined."""
    lines = read(spark, sf_dir, "lineitem").where("l_discount <= 0.09").select("l_orderkey", "l_extendedprice", "l_discount")
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    customers = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    nations = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    by_customer = lines.join(orders, "l_orderkey").groupBy("o_custkey").agg(revenue().alias("r"))
    by_segment = by_customer.join(customers, "o_custkey").groupBy("c_nationkey", "c_mktsegment").agg(F.sum("r").cast("decimal(30,4)").alias("r")).join(nations, "c_nationkey")
    return limit_by(by_segment, ["n_name"], 3, [F.desc("r"), F.asc("c_mktsegment")]).select("n_name", "c_mktsegment", F.col("r").cast("double").alias("revenue"))


@query("join_inner", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    return ch_join(o, c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_name")


@query("join_left", "SELECT c_custkey, coalesce(o_orderkey, 0) AS o_orderkey, coalesce(o_orderpriority, '') AS o_orderpriority FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'F'")
def join_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, o = read(spark, sf_dir, "customer").select("c_custkey"), read(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select("o_custkey", "o_orderkey", "o_orderpriority")
    return ch_join(c, o, c.c_custkey == o.o_custkey, isouter=True, defaults=True).select("c_custkey", "o_orderkey", "o_orderpriority")


@query("join_right", "SELECT n_name, s_suppkey FROM supplier RIGHT JOIN nation ON s_nationkey = n_nationkey")
def join_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, s = read(spark, sf_dir, "nation"), read(spark, sf_dir, "supplier")
    return ch_join(n, s, n.n_nationkey == s.s_nationkey, isouter=True).select("n_name", "s_suppkey")


@query("join_full", "SELECT n_name, r_name FROM nation FULL JOIN (SELECT * FROM region WHERE r_regionkey > 0) r ON n_regionkey = r_regionkey")
def join_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region").where("r_regionkey > 0")
    return ch_join(n, r, n.n_regionkey == r.r_regionkey, full=True).select("n_name", "r_name")


@query("join_cross", "SELECT n_name, r_name FROM nation CROSS JOIN region")
def join_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables of fixed size."""
    return ch_join(read(spark, sf_dir, "nation").select("n_name"), read(spark, sf_dir, "region").select("r_name"), cross=True)


def _shared(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    c = read(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nationkey")).agg(F.count("*").alias("customers"))
    s = read(spark, sf_dir, "supplier").where("s_nationkey > 3").groupBy(F.col("s_nationkey").alias("nationkey")).agg(F.count("*").alias("suppliers"))
    return c.where("nationkey < 20"), s


_BOTH = "WITH c AS (SELECT c_nationkey AS nationkey, count(*) AS customers FROM customer WHERE c_nationkey < 20 GROUP BY 1), s AS (SELECT s_nationkey AS nationkey, count(*) AS suppliers FROM supplier WHERE s_nationkey > 3 GROUP BY 1) "


@query("join_using", _BOTH + "SELECT nationkey, customers, suppliers FROM c JOIN s USING (nationkey)")
def join_using(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, s = _shared(spark, sf_dir)
    return ch_join(c, s, using=["nationkey"])


@query("join_using_full", _BOTH + "SELECT nationkey, coalesce(customers, 0) AS customers, coalesce(suppliers, 0) AS suppliers FROM c FULL JOIN s USING (nationkey)")
def join_using_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, s = _shared(spark, sf_dir)
    return ch_join(c, s, using=["nationkey"], full=True, defaults=True)


@query("join_all", "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey")
def join_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, o = read(spark, sf_dir, "customer"), read(spark, sf_dir, "orders")
    return ch_join(c, o, c.c_custkey == o.o_custkey, isouter=True, strictness="ALL").select("c_custkey", "o_orderkey")


@query("join_any_left", "SELECT custkey, o_orderkey FROM (SELECT c_custkey AS custkey FROM customer) LEFT JOIN (SELECT custkey, o_orderkey FROM (SELECT o_custkey AS custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders) WHERE r = 1) USING (custkey)")
def join_any_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, o = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey")), read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"), "o_orderkey")
    return ch_join(c, o, using=["custkey"], isouter=True, strictness="ANY", order_by=["o_orderkey"])


@query("join_any_inner", "SELECT custkey, o_orderkey FROM (SELECT c_custkey AS custkey FROM customer) JOIN (SELECT o_custkey AS custkey, min(o_orderkey) AS o_orderkey FROM orders GROUP BY 1) USING (custkey)")
def join_any_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, o = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey")), read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"), "o_orderkey")
    return ch_join(c, o, using=["custkey"], strictness="ANY", order_by=["o_orderkey"])


@query("join_semi", "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def join_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, o = read(spark, sf_dir, "customer"), read(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    return ch_join(c, o, c.c_custkey == o.o_custkey, isouter=True, strictness="SEMI").select("c_custkey", "c_name")


@query("join_anti", "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def join_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, o = read(spark, sf_dir, "customer"), read(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    return ch_join(c, o, c.c_custkey == o.o_custkey, isouter=True, strictness="ANTI").select("c_custkey", "c_name")


def _asof_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = read(spark, sf_dir, "events")
    purchases = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    views = events.where("event_type = 'view'").groupBy("user_id", F.col("ts").alias("view_ts")).agg(F.max("event_id").alias("view_id"))
    return purchases, views


_ASOF = "FROM (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase') p ASOF {} JOIN (SELECT user_id, ts AS view_ts, max(event_id) AS view_id FROM events WHERE event_type = 'view' GROUP BY 1, 2) v ON p.user_id = v.user_id AND p.ts {} v.view_ts"


@query("join_asof_inner", "SELECT event_id, p.user_id, view_id " + _ASOF.format("", ">="))
def join_asof_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys' runs are divided by day, so that no user is a single task."""
    p, v = _asof_sides(spark, sf_dir)
    return asof_join(p, v, ["user_id"], "ts", "view_ts", bucket=F.date_trunc("day", "_t")).select("event_id", "user_id", "view_id")


@query("join_asof_left", "SELECT event_id, p.user_id, coalesce(view_id, 0) AS view_id " + _ASOF.format("LEFT", ">="))
def join_asof_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, v = _asof_sides(spark, sf_dir)
    return asof_join(p, v, ["user_id"], "ts", "view_ts", isouter=True, defaults=True, bucket=F.date_trunc("day", "_t")).select("event_id", "user_id", "view_id")


@query("join_asof_next", "SELECT event_id, p.user_id, view_id " + _ASOF.format("LEFT", "<"))
def join_asof_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, v = _asof_sides(spark, sf_dir)
    return asof_join(p, v, ["user_id"], "ts", "view_ts", op="<", isouter=True, bucket=F.date_trunc("day", "_t")).select("event_id", "user_id", "view_id")


_NULLS_L = "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS k, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS t FROM orders"
_NULLS_R = "SELECT CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_custkey END AS k, max(CASE WHEN c_acctbal > 0 THEN c_name END) AS name FROM customer GROUP BY 1"


@query("join_left_nulls", f"SELECT o_orderkey, l.k, CASE WHEN r.k IS NULL THEN '' ELSE name END AS name FROM ({_NULLS_L}) l LEFT JOIN ({_NULLS_R}) r ON l.k = r.k")
def join_left_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null keys meet nothing; a null of a matched row stays null, a cell without a match takes the default."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("k"))
    c = read(spark, sf_dir, "customer").groupBy(F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_custkey")).alias("k")).agg(F.max(F.when(F.col("c_acctbal") > 0, F.col("c_name"))).alias("name"))
    return ch_join(o, c, using=["k"], isouter=True, defaults=True).select("o_orderkey", "k", "name")


@query("join_asof_nulls", f"SELECT o_orderkey, k, CASE WHEN before IS NULL THEN 0 ELSE amount END AS amount FROM (SELECT l.o_orderkey, l.k, r.t AS before, r.amount FROM ({_NULLS_L}) l ASOF LEFT JOIN (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS k, o_orderdate AS t, max(CASE WHEN o_totalprice > 100000 THEN o_totalprice END) AS amount FROM orders WHERE o_orderstatus = 'F' OR o_orderstatus = 'P' GROUP BY 1, 2) r ON l.k = r.k AND l.t > r.t)")
def join_asof_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order before each; null keys and null times match nothing, nulls of the matched row stay."""
    k = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("k")
    orders = read(spark, sf_dir, "orders")
    left = orders.select("o_orderkey", k, F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate")).alias("t"))
    right = orders.where("o_orderstatus in ('F', 'P')").groupBy(k, F.col("o_orderdate").alias("before")).agg(F.max(F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice"))).alias("amount"))
    return asof_join(left, right, ["k"], "t", "before", op=">", isouter=True, defaults=True, bucket=F.date_trunc("month", "_t")).select("o_orderkey", "k", "amount")


@query("join_global", "SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def join_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n = read(spark, sf_dir, "supplier"), read(spark, sf_dir, "nation")
    return ch_join(s, n, s.s_nationkey == n.n_nationkey, distribution="GLOBAL").select("s_suppkey", "n_name")


@query("join_on_extra", "SELECT o_orderkey, c_custkey FROM orders JOIN customer ON o_custkey = c_custkey AND c_mktsegment = 'BUILDING' AND o_totalprice > c_acctbal * 10")
def join_on_extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    return ch_join(o, c, (o.o_custkey == c.c_custkey) & (c.c_mktsegment == "BUILDING") & (o.o_totalprice > c.c_acctbal * 10)).select("o_orderkey", "c_custkey")


@query("join_chain", "SELECT r_name, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def join_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c, n, r = (read(spark, sf_dir, x) for x in ("orders", "customer", "nation", "region"))
    chained = select(o).ch_join(c, o.o_custkey == c.c_custkey).ch_join(n, c.c_nationkey == n.n_nationkey).ch_join(r, n.n_regionkey == r.r_regionkey)
    return chained.group_by("r_name").aggregate(F.count("*").alias("orders")).frame()
