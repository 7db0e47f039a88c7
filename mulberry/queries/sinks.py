"""Sinks, catalog changes and results, each shown by what a table holds afterwards."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import ddl
from ..catalog.engines import Engine, create_table
from ..client import Client, connect
from ..sinks import results, tables
from .base import query, read


@query("sink_compression", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def sink_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written with a codec to the shared folder by the executors, and read back."""
    path = tables.shared_path(spark, "compressed")
    results.write_raw(read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), path, "Parquet", "zstd")
    return spark.read.parquet(path)


def _with_table(spark: SparkSession, described: str, work: Callable[[str], None], engine: Engine | None = None) -> DataFrame:
    """Rows of a table that ``work`` changes; the table goes, its few rows stay in the plan."""
    name = f"t_{uuid.uuid4().hex}"
    create_table(spark, name, described, engine or Engine("MergeTree", order_by=("a",)))
    try:
        work(name)
        df = spark.table(name)
        return spark.createDataFrame(df.collect(), df.schema)
    finally:
        ddl.drop_table(spark, name)


@query("sink_insert", "SELECT a, b FROM (VALUES (1::BIGINT, 'x'), (2, 'it''s'), (3, NULL)) t(a, b)")
def insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_table(spark, "a Int64, b Nullable(String)", lambda t: (tables.insert(spark, t, [[1, "x"], [2, "it's"]]), tables.insert(spark, t, [[3]], ["a"])))


@query("sink_insert_columns", "SELECT a, b FROM (VALUES (1::BIGINT, 'x'), (2, 'y')) t(a, b)")
def insert_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_table(spark, "a Int64, b String", lambda t: tables.insert(spark, t, [[1, 2], ["x", "y"]], column_oriented=True))


@query("sink_insert_df", "SELECT a, b FROM (VALUES (2::BIGINT, 'x'), (4, 'y')) t(a, b)")
def insert_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Floats are rounded where the table has integers."""
    return _with_table(spark, "a Int64, b String", lambda t: tables.insert_df(spark, t, pd.DataFrame({"a": [1.6, 4.2], "b": ["x", "y"]})))


@query("sink_insert_numpy", "SELECT a, b FROM (VALUES (1::BIGINT, 2::BIGINT), (3, 4)) t(a, b)")
def insert_numpy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_table(spark, "a Int64, b Int64", lambda t: tables.insert_numpy(spark, t, np.array([[1, 2], [3, 4]])))


@query("sink_insert_arrow", "SELECT a, b FROM (VALUES (1::BIGINT, 'x'), (2, 'y')) t(a, b)")
def insert_arrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_table(spark, "a Int64, b String", lambda t: tables.insert_arrow(spark, t, pa.table({"a": [1, 2], "b": ["x", "y"]})))


@query("sink_raw_insert", "SELECT a, b FROM (VALUES (1::BIGINT, 'x'), (2, 'y')) t(a, b)")
def raw_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_table(spark, "a Int64, b String", lambda t: tables.raw_insert(spark, t, b"1,x\n2,y\n", "CSV", ["a", "b"]))


@query("sink_insert_select", "SELECT n_nationkey AS a, n_name AS b FROM nation WHERE n_regionkey = 2")
def insert_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "nation").where("n_regionkey = 2").select(F.col("n_nationkey").alias("a"), F.col("n_name").alias("b"))
    return _with_table(spark, "a Int32, b String", lambda t: tables.insert_frame(rows, t))


@query("sink_ctas_empty", "SELECT n_nationkey, n_name FROM nation WHERE false")
def ctas_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"t_{uuid.uuid4().hex}"
    tables.create_as_empty(read(spark, sf_dir, "nation").select("n_nationkey", "n_name"), name)
    try:
        return spark.createDataFrame(spark.table(name).collect(), spark.table(name).schema)
    finally:
        ddl.drop_table(spark, name)


@query("sink_delete", "SELECT n_nationkey AS a, n_name AS b FROM nation WHERE n_regionkey = 2 AND n_nationkey >= 12")
def delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "nation").where("n_regionkey = 2").select(F.col("n_nationkey").alias("a"), F.col("n_name").alias("b"))
    return _with_table(spark, "a Int32, b String", lambda t: (tables.insert_frame(rows, t), tables.delete(spark, t, "a < 12")))


@query("sink_truncate", "SELECT 1::BIGINT AS a WHERE false")
def truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_table(spark, "a Int64", lambda t: (tables.insert(spark, t, [[1], [2]]), tables.truncate(spark, t)))


@query("sink_bulk_dbapi", "SELECT a, b FROM (VALUES (1::BIGINT, 'x'), (2, 'y')) t(a, b)")
def bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_table(spark, "a Int64, b String", lambda t: connect(spark).cursor().executemany(f"INSERT INTO {t} (a, b) VALUES", [(1, "x"), (2, "y")]))


@query("ddl_alter_columns", "SELECT a, CAST(5 AS BIGINT) AS added, '2' AS c FROM (VALUES (1::BIGINT)) t(a)")
def alter(spark: SparkSession, sf_dir: str) -> DataFrame:
    def work(t: str) -> None:
        tables.insert(spark, t, [[1, 2, "gone"]])
        ddl.add_column(spark, t, "added", "Int64", default=5, after="a")
        ddl.rename_column(spark, t, "b", "c")
        ddl.modify_column(spark, t, "c", "String")
        ddl.drop_column(spark, t, "d")

    return _with_table(spark, "a Int64, b Int32, d String", work)


def _kept_by(spark: SparkSession, sf_dir: str, change: Callable[[str], object]) -> DataFrame:
    """Partition columns, comments and properties of a table over nation after a change that writes it anew, and its number of rows."""
    name = f"t_{uuid.uuid4().hex}"
    create_table(spark, name, "n_nationkey Int32, n_name String, n_regionkey Int32", Engine("MergeTree", order_by=("n_nationkey",), partition_by=("n_regionkey",)), comment="it's")
    try:
        tables.insert_frame(read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"), name)
        ddl.comment_column(spark, name, "n_name", "a name")
        change(name)
        found = ddl.reflect(spark, name)
        rows = [("comment", spark.catalog.getTable(name).description or ""), ("rows", str(spark.table(name).count()))]
        rows += [("partition", c.name) for c in spark.catalog.listColumns(name) if c.isPartition] + [("column", f"{n}: {x}") for n, _, _, x in found["columns"] if x]
        rows += [(k, v) for k, v in found["properties"].items() if k.startswith(("setting.", "parquet.")) or k == "engine.name"]
        return spark.createDataFrame(rows, "name string, value string")
    finally:
        ddl.drop_table(spark, name)


_KEPT = "SELECT name, value FROM (VALUES ('comment', 'it''s'), ('partition', 'n_regionkey'), ('column', 'n_name: a name'), ('engine.name', 'MergeTree'), {}) t(name, value) UNION ALL SELECT 'rows', CAST(count(*) AS VARCHAR) FROM nation"


@query("alter_index", _KEPT.format("('parquet.bloom.filter.enabled#n_name', 'true')"))
def alter_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept_by(spark, sf_dir, lambda t: ddl.add_skip_index(spark, t, ["n_name"]))


@query("alter_settings", _KEPT.format("('setting.ttl_only_drop_parts', '1')"))
def alter_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept_by(spark, sf_dir, lambda t: (ddl.modify_settings(spark, t, ttl_only_drop_parts=1, index_granularity=1024), ddl.reset_settings(spark, t, "index_granularity"), ddl.modify_column(spark, t, "n_nationkey", "Int64")))


@query("ddl_reflect", "SELECT name, kind FROM (VALUES ('a', 'bigint'), ('b', 'string')) t(name, kind)")
def reflect(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"t_{uuid.uuid4().hex}"
    create_table(spark, name, "a Int64, b String", Engine("MergeTree", order_by=("a",)), comment="it's")
    try:
        return spark.createDataFrame([(n, k) for n, k, *_ in ddl.reflect(spark, name)["columns"]], "name string, kind string")
    finally:
        ddl.drop_table(spark, name)


@query("ddl_column_attrs", "SELECT n_nationkey, coalesce(CASE WHEN n_nationkey > 9 THEN n_name END, 'none') AS n_name, n_nationkey * 2 AS twice FROM nation")
def column_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "nation").select("n_nationkey", F.when(F.col("n_nationkey") > 9, F.col("n_name")).alias("n_name"))
    return ddl.column_attributes(rows, {"n_name": {"default": "'none'"}, "twice": {"materialized": "n_nationkey * 2"}})


@query("ddl_from_arrow", "SELECT name, kind FROM (VALUES ('i', 'Int32'), ('s', 'String'), ('f', 'Float64'), ('l', 'Array(Int64)')) t(name, kind)")
def from_arrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = pa.schema([("i", pa.int32()), ("s", pa.string()), ("f", pa.float64()), ("l", pa.list_(pa.int64()))])
    return spark.createDataFrame(list(ddl.from_arrow(kinds).items()), "name string, kind string")


@query("ddl_projection", "SELECT event_type, count(*) AS count FROM events GROUP BY 1")
def projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"t_{uuid.uuid4().hex}"
    read(spark, sf_dir, "events").select("event_id", "event_type").write.saveAsTable(name)
    try:
        copy = spark.table(ddl.add_projection(spark, name, "kinds", group_by=["event_type"]))
        return spark.createDataFrame(copy.collect(), copy.schema)
    finally:
        ddl.drop_projection(spark, name, "kinds")
        ddl.drop_table(spark, name)


@query("out_rows", "SELECT r_regionkey AS k, r_name AS n FROM region")
def out_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = results.QueryResult(read(spark, sf_dir, "region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("n")))
    return spark.createDataFrame([tuple(x.values()) for x in found.named_results()], found.df.schema)


@query("out_blocks", "SELECT o_orderkey FROM orders")
def out_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What blocks of at most 1000 rows, made inside the tasks, give."""
    return results.task_blocks(read(spark, sf_dir, "orders").select("o_orderkey"), 1000)


@query("out_pandas", "SELECT n_nationkey, n_name FROM nation")
def out_pandas(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return spark.createDataFrame(results.to_pandas(df), df.schema)


@query("out_arrow", "SELECT n_nationkey, n_name FROM nation")
def out_arrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame(results.to_arrow(read(spark, sf_dir, "nation").select("n_nationkey", "n_name")))


@query("out_command", "SELECT count(*) AS n FROM orders")
def out_command(spark: SparkSession, sf_dir: str) -> DataFrame:
    read(spark, sf_dir, "orders").createOrReplaceTempView("orders")
    return spark.range(1).select(F.lit(Client(spark).command("SELECT count(*) FROM orders")).cast("long").alias("n"))


@query("rename_columns", "SELECT n_nationkey AS nNationkey, n_name AS nName, n_regionkey AS nRegionkey FROM nation")
def rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results.rename_columns(read(spark, sf_dir, "nation"), "to_camelcase")
