"""Operators on small inputs: edge cases and what they reject."""

import asyncio
import datetime as dt

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mulberry import errors
from mulberry.catalog import ddl
from mulberry.catalog.engines import Engine, create_table, engine_of, parse_engine, read, table
from mulberry.client import AsyncClient, Client, connect
from mulberry.functions import scalar as fn
from mulberry.operators import modifiers
from mulberry.operators.arrays import array_join
from mulberry.operators.joins import asof_join, ch_join
from mulberry.operators.sets import combine
from mulberry.plans import params
from mulberry.plans.select import select
from mulberry.sinks import results, tables
from mulberry.sources import tables as src
from mulberry.streaming.views import materialized_view
from mulberry.types import checked, schema, spark_type, wrapped


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def sides(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, x string")
    b = spark.createDataFrame([(1, 10), (1, 5), (4, 7)], "k int, y int")
    return a, b


def test_any_keeps_the_least(sides):
    assert rows(ch_join(*sides, using=["k"], isouter=True, strictness="ANY", order_by=["y"], defaults=True)) == [(1, "a", 5), (2, "b", 0), (3, None, 0)]


def test_full_join_has_defaults(sides):
    assert (4, "", 7) in rows(ch_join(*sides, using=["k"], full=True, defaults=True))


@pytest.mark.parametrize("given", [
    {"cross": True, "using": ["k"]}, {}, {"using": ["k"], "strictness": "MOST"}, {"using": ["k"], "strictness": "SEMI"}, {"using": ["k"], "full": True, "strictness": "ANY"},
    {"using": ["k"], "strictness": "ASOF"}, {"using": ["k"], "distribution": "LOCAL"}])
def test_joins_that_are_rejected(sides, given):
    with pytest.raises(ValueError):
        ch_join(*sides, **given)


@pytest.mark.parametrize("op", [">=", ">", "<=", "<"])
@pytest.mark.parametrize("bucketed", [False, True])
def test_asof_against_brute_force(spark, op, bucketed):
    import operator

    left = [(i % 4, (i * 37) % 50, i) for i in range(60)]
    right = [(i % 4 if i % 7 else None, (i * 53) % 50, 100 + i) for i in range(60)]
    test = {">=": operator.ge, ">": operator.gt, "<=": operator.le, "<": operator.lt}[op]
    expected = []
    for k, t, i in left:
        near = [(u, n) for g, u, n in right if g == k and test(t, u)]
        if near:
            best = max(u for u, _ in near) if op[0] == ">" else min(u for u, _ in near)
            expected.append((i, max(n for u, n in near if u == best)))
        else:
            expected.append((i, None))
    got = asof_join(spark.createDataFrame(left, "k int, t int, i int"), spark.createDataFrame(right, "k int, u int, n int"), ["k"], "t", "u", op=op, isouter=True, bucket=F.floor(F.col("_t") / 10) if bucketed else None)
    assert sorted(got.select("i", "n").collect()) == sorted(expected)


def test_array_join(spark):
    df = spark.createDataFrame([(1, ["a", "b"], [1, 2]), (2, [], []), (3, None, None)], "k int, x array<string>, y array<int>")
    assert rows(array_join(df, "x", "y")) == [(1, "a", 1), (1, "b", 2)]
    assert rows(array_join(df, "x", "y", left=True)) == [(1, "a", 1), (1, "b", 2), (2, "", 0), (3, "", 0)]
    assert array_join(df, "x", alias="one").columns == ["k", "x", "y", "one"]
    uneven = spark.createDataFrame([(1, ["a"], [1, 2])], df.schema)
    with pytest.raises(Exception, match="unequal"):
        array_join(uneven, "x", "y").collect()
    assert rows(array_join(uneven, "x", "y", unequal=True)) == [(1, "", 2), (1, "a", 1)]
    with pytest.raises(ValueError):
        array_join(df, "k")


def test_final_and_samples(spark):
    df = spark.createDataFrame([(1, 1, 0, "old"), (1, 2, 0, "new"), (2, 1, 1, "gone")], "k int, v int, d int, x string")
    assert rows(modifiers.final(df, ["k"], "v", "d")) == [(1, 2, 0, "new")]
    n = spark.range(1000)
    assert 80 <= modifiers.sample(n, 0.1, "id").count() <= 120
    assert sum(modifiers.sample(n, f"1/10 OFFSET {i}/10", "id").count() for i in range(10)) == 1000
    assert modifiers.sample(n, 1).count() == 1000
    for bad in ("half", -1):
        with pytest.raises(ValueError):
            modifiers.sample(n, bad, "id")


def test_select_applies_clauses_in_order(spark):
    df = spark.createDataFrame([(1, 3), (1, 2), (2, 9), (2, 1)], "g int, v int")
    s = select(df).limit(3).limit_by(["g"], 1).order_by(F.desc("v")).where(F.col("v") > 1)
    assert [tuple(r) for r in s.frame().collect()] == [(2, 9), (1, 3)]


def test_sets_reject_other_shapes(spark):
    with pytest.raises(ValueError):
        combine("UNION", spark.range(1), spark.range(1).withColumn("b", F.lit(1)))


def test_settings_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with modifiers.settings(spark, max_threads=3):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    with pytest.raises(ValueError), modifiers.settings(spark, unheard_of=1):
        pass
    with pytest.raises(ValueError):
        modifiers.with_hint(spark.range(1), "nolock")


@pytest.mark.parametrize("text, kind", [
    ("Nullable(UInt8)", "smallint"), ("LowCardinality(Nullable(String))", "string"), ("Array(Tuple(a Int8, b Array(String)))", "array<struct<a:tinyint,b:array<string>>>"),
    ("Map(String, Decimal(10, 2))", "map<string,decimal(10,2)>"), ("UInt64", "decimal(20,0)"), ("Nested(x Float32)", "array<struct<x:float>>"), ("Enum8('a, b' = 1, 'c' = 2)", "string"), ("DateTime64(3, 'UTC')", "timestamp")])
def test_types(text, kind):
    assert spark_type(text).simpleString() == kind


def test_types_without_counterpart():
    for bad in ("Decimal(40, 2)", "AggregateFunction(uniq, String)", "Thing"):
        with pytest.raises(ValueError):
            spark_type(bad)
    assert schema("a UInt8, `b c` Array(String)").names == ["a", "b c"]


def test_ranges(spark):
    df = spark.createDataFrame([(255,), (377,)], "n int")
    assert [r[0] for r in df.select(wrapped(F.col("n"))).collect()] == [-1, 121]
    with pytest.raises(Exception, match="UInt8"):
        df.select(checked(F.col("n"), "UInt8")).collect()


def test_parameters(spark):
    assert params.query(spark, "SELECT {s:String} AS s, {n:Nullable(Int32)} AS n", {"s": "'; DROP TABLE x", "n": None}).first() == ("'; DROP TABLE x", None)
    assert params.query(spark, "SELECT %s + %s AS n", [1, 2]).first()[0] == 3
    assert params.query(spark, "SELECT {m:Map(String, Int32)}['b'] AS m", {"m": {"a": 1, "b": 2}}).first()[0] == 2
    with pytest.raises(ValueError):
        params.bound("SELECT {a:Int8}", {})
    assert params.strip_comments("SELECT '--no' -- yes\n/* x */ , 1") == "SELECT '--no'  \n  , 1"
    assert params.quote_ident("a`b") == "`a``b`"


def test_functions(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(fn.format_datetime(F.lit(dt.datetime(2024, 2, 3, 4, 5, 6)), "%d.%m.%y at %H:%M")) == "03.02.24 at 04:05"
    with pytest.raises(ValueError):
        fn.spark_pattern("%Q")
    assert one(fn.json_path(fn.parse_json(F.lit('{"a.b": {"c": "5"}}')), "a.b", "c", kind="Int32")) == 5
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        one(fn.int_div(F.lit(1).cast("long"), F.lit(0).cast("long")))
    assert one(fn.array_sort(F.array(F.lit("bb"), F.lit("a")), F.length)) == ["a", "bb"]
    with pytest.raises(Exception, match="too large"):
        one(fn.throw_if(F.lit(True), "too large"))


def test_files(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "a.csv.gz", "wt") as f:
        f.write("k,s\n1,x\n2,y\n")
    assert rows(src.read_file(spark, str(tmp_path / "a.csv.gz"), "CSVWithNames", "k Int64, s String")) == [(1, "x"), (2, "y")]
    (tmp_path / "b.ndjson").write_text('{"k": 377, "s": "x"}\n')
    assert rows(src.read_file(spark, str(tmp_path / "b.ndjson"), "JSONEachRow", "k Int8, s String", wrap=True)) == [(121, "x")]
    (tmp_path / "c.csv").write_text("1,x\nbad,y\n")
    assert rows(src.read_file(spark, str(tmp_path / "c.csv"), "CSV", "k Int64, s String", errors=1)) == [(1, "x")]
    with pytest.raises(Exception):
        src.read_file(spark, str(tmp_path / "c.csv"), "CSV", "k Int64, s String").collect()
    assert asyncio.run(src.read_file_async(spark, str(tmp_path / "c.csv"), "CSV")).columns == ["_1", "_2"]
    results.write_raw(spark.range(5), str(tmp_path / "out"), "Parquet", "zstd")
    assert src.read_file(spark, str(tmp_path / "out"), "Parquet").count() == 5
    buffer = pa.BufferOutputStream()
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"a": [1, 2]}), buffer)
    assert rows(src.inline(spark, buffer.getvalue().to_pybytes(), "Parquet")) == [(1,), (2,)]
    with pytest.raises(ValueError):
        src.read_file(spark, "x", "Excel")


def test_external_views_go(spark):
    with src.External(spark).add_file("outer_rows", data=b"1\tx\n"):
        assert spark.table("outer_rows").columns == ["_1", "_2"]
    assert not spark.catalog.tableExists("outer_rows")


def test_client(spark):
    client = Client(spark, query_limit=3)
    assert client.query("SELECT id FROM range(10)").row_count == 3
    assert client.query("SELECT id FROM range(10) LIMIT 5").columns == [(0, 1, 2, 3, 4)]
    assert client.query_df("SELECT 1 AS a").a.tolist() == [1]
    assert client.query_np("SELECT id, id * 2 AS b FROM range(2)").tolist() == [[0, 0], [1, 2]]
    assert client.query_arrow("SELECT 1 AS a").num_rows == 1
    assert isinstance(client.query_df_arrow("SELECT 1 AS a").a.dtype, pd.ArrowDtype)
    assert [len(b) for b in Client(spark).query_row_block_stream("SELECT id FROM range(10)", rows=4)] == [4, 4, 2]
    assert client.raw_query("SELECT 1 AS a, 'x' AS b", fmt="CSVWithNames") == b"a,b\n1,x\n"
    assert client.raw_query("SELECT 1 AS a", fmt="JSONEachRow") == b'{"a":1}\n'
    assert client.ping()
    with pytest.raises(errors.ProgrammingError):
        client.query("SELECT nothing FROM nowhere")
    with pytest.raises(errors.OperationalError):
        client.query("SELECT 1 div (id - id) FROM range(1)")
    assert asyncio.run(AsyncClient(client).command("SELECT 7")) == 7
    cursor = connect(spark).cursor()
    cursor.execute("SELECT id FROM range(3) WHERE id > %(n)s", {"n": 0})
    assert cursor.description[0][0] == "id" and cursor.fetchone() == (1,) and cursor.fetchall() == [(2,)] and cursor.fetchone() is None


def test_tables(spark):
    name = "test_engine_table"
    ddl.drop_table(spark, name)
    engine = Engine("ReplacingMergeTree", order_by=("k",), arguments=("v",), settings={"index_granularity": "8192"})
    create_table(spark, name, "k Int64, v Int64, s Nullable(String)", engine, comment="it's")
    summary = tables.insert(spark, name, [[1, 1, "a"], [1, 2, "b"], [2, 1, None]])
    assert summary.written_rows == 3
    assert engine_of(spark, name) == engine and parse_engine(engine.text()) == engine
    assert rows(table(spark, name)) == [(1, 2, "b"), (2, 1, None)]
    with pytest.raises(ValueError):
        tables.delete(spark, name, "")
    tables.delete(spark, name, "s = 'a'")
    assert rows(spark.table(name)) == [(1, 2, "b"), (2, 1, None)]
    with pytest.raises(ValueError):
        tables.insert_df_arrow(spark, name, pd.DataFrame({"k": [1]}))
    with pytest.raises(ValueError):
        tables.insert(spark, name, [[1]], ["nothing"]) if "nothing" in spark.table(name).columns else tables.insert(spark, name, [[1, 2]], ["k"])
    ddl.add_skip_index(spark, name, ["k"])
    assert engine_of(spark, name) == engine
    ddl.modify_settings(spark, name, index_granularity=4)
    ddl.reset_settings(spark, name, "index_granularity")
    ddl.comment_column(spark, name, "s", "text")
    assert ddl.reflect(spark, name)["columns"][2][3] == "text"
    ddl.drop_table(spark, name)


def test_engines(spark):
    with pytest.raises(ValueError):
        Engine("MergeTree")
    with pytest.raises(ValueError):
        Engine("Turbo", order_by=("a",))
    df = spark.createDataFrame([(1, 1, 2), (1, 1, 5), (2, -1, 1)], "k int, s int, n int")
    assert rows(read(df, Engine("SummingMergeTree", order_by=("k",), arguments=("n",)))) == [(1, 1, 7), (2, -1, 1)]


def test_aggregating_engine(spark):
    name = "test_aggregating_table"
    ddl.drop_table(spark, name)
    kinds = "k Int64, total SimpleAggregateFunction(sum, Int32), bits SimpleAggregateFunction(groupBitOr, Int32), s Nullable(String)"
    create_table(spark, name, kinds, Engine("AggregatingMergeTree", order_by=("k",)))
    assert rows(table(spark, name)) == []
    tables.insert(spark, name, [[1, 2, 1, "b"], [1, 3, 4, "a"], [2, None, 8, None], [None, 7, 1, "x"], [None, 1, 1, "x"]])
    merged = table(spark, name)
    assert set(rows(merged)) == {(1, 5, 5, "a"), (2, None, 8, None), (None, 8, 1, "x")}
    assert merged.schema["total"].dataType.simpleString() == "int"
    ddl.drop_table(spark, name)
    with pytest.raises(ValueError):
        read(spark.range(1), Engine("AggregatingMergeTree", order_by=("k",)), {"id": "SimpleAggregateFunction(median, Int64)"})
    keys = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert rows(read(keys, Engine("AggregatingMergeTree", order_by=("k",)))) == [(1,), (2,)]


def test_materialized_view(spark, tmp_path):
    source, target, checkpoint = str(tmp_path / "source"), str(tmp_path / "target"), str(tmp_path / "checkpoint")
    spark.range(5).write.parquet(source)
    for expected in (5, 8):
        materialized_view(spark, source, target, lambda df: df.withColumn("twice", F.col("id") * 2), checkpoint).awaitTermination()
        assert spark.read.parquet(target).count() == expected
        if expected == 5:
            spark.range(3).write.mode("append").parquet(source)


def test_renaming(spark):
    df = spark.createDataFrame([(1, 2)], "`t.userName` int, other_name int")
    assert results.rename_columns(df, "to_underscore_without_prefix").columns == ["user_name", "other_name"]
    with pytest.raises(ValueError):
        results.rename_columns(df, "upside_down")


def test_plans_push_down(spark, sf_dir):
    """Filters and columns reach the scan; LIMIT BY cuts before the shuffle."""
    df = modifiers.prewhere(spark.read.parquet(f"{sf_dir}/orders.parquet"), F.col("o_custkey") < 5).select("o_orderkey")
    plan = df._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(o_custkey), LessThan(o_custkey,5)]" in plan and "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
    top = modifiers.limit_by(spark.read.parquet(f"{sf_dir}/events.parquet"), ["user_id"], 2, ["event_id"])
    assert "WindowGroupLimit" in top._jdf.queryExecution().toString()


def test_out_blocks_stays_off_the_driver(spark, sf_dir, monkeypatch):
    from mulberry.queries import QUERIES
    from mulberry.sinks import results

    def refuse(*args):
        raise AssertionError("rows stream through the driver")

    monkeypatch.setattr(results, "rows_stream", refuse)
    want = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey")
    got = QUERIES["out_blocks"](spark, sf_dir)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 and want.count() > 1000
    assert results.task_blocks(spark.range(2500, numPartitions=1), 1000).count() == 2500
