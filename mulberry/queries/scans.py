"""Scans and sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import tables as src
from .base import query, read, views


@query("scan_table", "SELECT c_custkey, c_name FROM customer")
def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select("c_custkey", "c_name")


@query("scan_star", "SELECT * FROM nation")
def scan_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "nation").select("*")


@query("scan_subquery", "SELECT t.s, t.n FROM (SELECT o_orderstatus AS s, count(*) AS n FROM orders GROUP BY 1) t WHERE t.n > 10")
def scan_subquery(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = read(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("s")).agg(F.count("*").alias("n")).alias("t")
    return t.where("t.n > 10").select("t.s", "t.n")


@query("src_numbers", "SELECT range AS number, range * range AS square FROM range(1000)")
def src_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.numbers(spark, 1000).withColumn("square", F.col("number") * F.col("number"))


@query("src_values", "SELECT CAST(a AS BIGINT) AS a, b, c FROM (VALUES (1, 'x', 1.5::DOUBLE), (2, 'y', NULL), (3, 'it''s', 2.5::DOUBLE)) t(a, b, c)")
def src_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.values(spark, "a Int64, b String, c Nullable(Float64)", (1, "x", 1.5), (2, "y", None), (3, "it's", 2.5))


@query("src_values_cte", "WITH v AS (SELECT * FROM (VALUES ('BUILDING', 1::BIGINT), ('MACHINERY', 2)) t(seg, code)) SELECT code, count(*) AS n FROM customer JOIN v ON c_mktsegment = seg GROUP BY 1")
def src_values_cte(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir, "customer")
    return spark.sql("WITH v AS (SELECT * FROM VALUES ('BUILDING', 1L), ('MACHINERY', 2L) AS t(seg, code)) SELECT code, count(*) AS n FROM customer JOIN v ON c_mktsegment = seg GROUP BY 1")


@query("src_random")
def src_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.random_rows(spark, "a Int32, b String, c Float64, d Array(Int64), e Bool", 500)


@query("src_inline_format", "SELECT name, CAST(qty AS BIGINT) AS qty FROM (VALUES ('bolt', 12), ('nut, hex', 7)) t(name, qty)")
def src_inline_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.inline(spark, b'name,qty\nbolt,12\n"nut, hex",7\n', "CSVWithNames", "name String, qty Int64")


@query("src_external", "SELECT n_name, w AS weight FROM nation JOIN (VALUES (1, 10::BIGINT), (3, 30), (24, 5)) t(k, w) ON n_nationkey = k")
def src_external(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation")
    with src.External(spark).add_file("weights", data=b"1\t10\n3\t30\n24\t5\n", types="k Int32, weight Int64"):
        w = spark.table("weights")
        return n.join(w, n.n_nationkey == w.k).select("n_name", "weight")


@query("src_file_parquet", "SELECT p_partkey, p_size FROM part")
def src_file_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.read_file(spark, f"{sf_dir}/part.parquet", "Parquet", "p_partkey Int64, p_size Int32")


@query("src_file_ndjson", "SELECT CAST(a AS BIGINT) AS a, b FROM (VALUES (121, 'x'), (-3, 'y')) t(a, b)")
def src_file_ndjson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """377 does not fit 8 bits and wraps around to 121."""
    from ..types import wrapped

    rows = src.inline(spark, b'{"a": 377, "b": "x"}\n{"a": -3, "b": "y"}\n', "JSONEachRow", "a Int64, b String")
    return rows.select(wrapped(F.col("a"), 8).alias("a"), "b")


@query("src_file_csv", "SELECT n_nationkey, n_name FROM nation")
def src_file_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as compressed CSV to the shared folder, and read back."""
    from ..sinks.tables import shared_path

    path = shared_path(spark, "csv")
    read(spark, sf_dir, "nation").select("n_nationkey", "n_name").write.option("header", True).option("compression", "gzip").csv(path)
    return src.read_file(spark, path, "CSVWithNames", "n_nationkey Int32, n_name String")


@query("src_dictionary_nulls", "SELECT n_name, CASE WHEN r_regionkey IS NULL THEN '' ELSE label END AS label FROM nation LEFT JOIN (SELECT r_regionkey, CASE WHEN r_regionkey <> 1 THEN r_name END AS label FROM region WHERE r_regionkey < 4) ON n_regionkey = r_regionkey")
def src_dictionary_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A missing key gives the default, a null value of a key that is there stays null."""
    labels = read(spark, sf_dir, "region").where("r_regionkey < 4").select("r_regionkey", F.when(F.col("r_regionkey") != 1, F.col("r_name")).alias("label"))
    return src.Dictionary(labels, ["r_regionkey"]).lookup(read(spark, sf_dir, "nation"), {"r_regionkey": "n_regionkey"}).select("n_name", "label")


@query("src_dictionary", "SELECT c_custkey, coalesce(r_name, '') AS r_name FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN (SELECT * FROM region WHERE r_regionkey < 4) ON n_regionkey = r_regionkey")
def src_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = src.Dictionary(read(spark, sf_dir, "region").where("r_regionkey < 4"), ["r_regionkey"])
    c, n = read(spark, sf_dir, "customer"), read(spark, sf_dir, "nation")
    return regions.lookup(c.join(n, c.c_nationkey == n.n_nationkey), {"r_regionkey": "n_regionkey"}).select("c_custkey", "r_name")


@query("src_system_tables", "SELECT name FROM (VALUES ('sys_nation'), ('sys_region')) t(name)")
def src_system_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    for name in ("nation", "region"):
        read(spark, sf_dir, name).createOrReplaceTempView(f"sys_{name}")
    return src.system_tables(spark).where("name like 'sys\\\\_%'").select("name")


@query("src_merge", "SELECT n_nationkey, n_name FROM nation")
def src_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    for i in range(3):
        n.where(f"n_nationkey % 3 = {i}").createOrReplaceTempView(f"merge_part_{i}")
    return src.merge_tables(spark, r"merge_part_\d")


@query("src_file_engine", "SELECT r_regionkey, r_name FROM region")
def src_file_engine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(f"SELECT r_regionkey, r_name FROM parquet.`{sf_dir}/region.parquet`")


@query("src_distributed", "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1")
def src_distributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts are added up where the rows are and dealt out by the sharding key."""
    return read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
