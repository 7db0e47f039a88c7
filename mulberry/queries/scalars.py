"""Scalar functions, lambdas, JSON, vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as fn
from ..sources.tables import numbers, values
from .base import query, read


@query("fn_text", "SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS s, concat(c_name, '/', c_mktsegment) AS j, lower(c_mktsegment) AS l, CAST(strlen(c_name) AS BIGINT) AS n, repeat('ab', 3) AS r FROM customer")
def text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select(
        "c_custkey", fn.to_string(F.col("c_custkey")).alias("s"), F.concat("c_name", F.lit("/"), "c_mktsegment").alias("j"), F.lower("c_mktsegment").alias("l"),
        fn.length("c_name").cast("long").alias("n"), F.repeat(F.lit("ab"), 3).alias("r"))


@query("fn_to_uint", "SELECT p_partkey, CAST(p_size AS SMALLINT) AS small, CAST(p_partkey AS BIGINT) AS big FROM part")
def to_uint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey", fn.to_uint(F.col("p_size"), 8).alias("small"), fn.to_uint(F.col("p_partkey"), 64).cast("long").alias("big"))


@query("fn_arith", "SELECT range AS n, range + 3 AS a, range * 2 AS m, range % 7 AS r, range // 5 AS d FROM range(100)")
def arith(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n")
    return spark.range(100).toDF("n").select("n", (n + 3).alias("a"), (n * 2).alias("m"), (n % 7).alias("r"), fn.int_div(n, F.lit(5).cast("long")).alias("d"))


@query("fn_hash")
def hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select("c_custkey", F.xxhash64("c_custkey", "c_name").alias("h"))


@query("fn_random_string")
def random_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbers(spark, 100).select("number", F.randstr(F.lit(12), F.lit(7)).alias("s"))


@query("fn_dates", "SELECT event_id, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS day, CAST(year(ts) * 100 + month(ts) AS BIGINT) AS ym, strftime(ts, '%m/%d/%Y %H:%M') AS f, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS d, strftime(ts + INTERVAL 3 DAY, '%Y-%m-%d') AS later FROM events")
def dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    return read(spark, sf_dir, "events").select(
        "event_id", fn.format_datetime(fn.start_of_day(ts), "%Y-%m-%d %H:%M:%S").alias("day"), fn.yyyymm(ts).alias("ym"), fn.format_datetime(ts, "%m/%d/%Y %H:%M").alias("f"),
        F.to_date(ts).cast("string").alias("d"), fn.format_datetime(ts + F.expr("INTERVAL 3 DAY"), "%Y-%m-%d").alias("later"))


@query("fn_to_datetime", "SELECT '2024-03-10 12:30:00' AS plain, '2024-03-10 16:30:00' AS zoned")
def to_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.lit("2024-03-10 12:30:00")
    show = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return spark.range(1).select(show(fn.to_datetime(t)).alias("plain"), show(fn.to_datetime(t, "America/New_York")).alias("zoned"))


@query("fn_format", "SELECT n_nationkey, concat('<', n_name, '> ', CAST(n_nationkey AS VARCHAR), '{}') AS s FROM nation")
def template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "nation").select("n_nationkey", fn.format_template("<{1}> {0}{{}}", F.col("n_nationkey"), F.col("n_name")).alias("s"))


@query("fn_has", "SELECT p_partkey, list_contains(string_split(p_type, ' '), 'STANDARD') AS h FROM part")
def has(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey", fn.has(F.split("p_type", " "), F.lit("STANDARD")).alias("h"))


@query("fn_wkt_polygon", "SELECT CAST(2 AS BIGINT) AS rings, CAST(4 AS BIGINT) AS points, 10.5::DOUBLE AS x, -1.0::DOUBLE AS y")
def wkt(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fn.wkt_polygon(F.lit("POLYGON((0 0, 10.5 -1, 10 10, 0 0), (1 1, 2 2, 1 2, 1 1))"))
    return spark.range(1).select(F.size(p).cast("long").alias("rings"), F.size(p[0]).cast("long").alias("points"), p[0][1]["x"].alias("x"), p[0][1]["y"].alias("y"))


@query("fn_now")
def now(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.range(1).select(F.current_timestamp().alias("now"))


@query("fn_array_map", "SELECT p_partkey, array_to_string(list_transform(string_split(p_type, ' '), lambda x: lower(x)), '|') AS low, array_to_string(list_transform(string_split(p_type, ' '), lambda x, i: concat(x, CAST(i AS VARCHAR))), '|') AS numbered FROM part")
def array_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.split("p_type", " ")
    return read(spark, sf_dir, "part").select(
        "p_partkey", F.array_join(fn.array_map(F.lower, words), "|").alias("low"),
        F.array_join(fn.array_map(lambda k, v: F.concat(k, v.cast("string")), words, fn.array_enumerate(words)), "|").alias("numbered"))


@query("fn_array_filter", "SELECT p_partkey, array_to_string(list_filter(string_split(p_type, ' '), lambda x: len(x) > 5), '|') AS long FROM part")
def array_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(fn.array_filter(lambda x: F.length(x) > 5, F.split("p_type", " ")), "|").alias("long"))


@query("fn_array_sort", "SELECT p_partkey, array_to_string(list_sort(string_split(p_type, ' ')), '|') AS s FROM part")
def array_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(fn.array_sort(F.split("p_type", " ")), "|").alias("s"))


@query("fn_array_enumerate", "SELECT p_partkey, CAST(list_sum(range(1, len(string_split(p_type, ' ')) + 1)) AS BIGINT) AS s FROM part")
def array_enumerate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey", F.aggregate(fn.array_enumerate(F.split("p_type", " ")), F.lit(0).cast("long"), lambda a, x: a + x).alias("s"))


@query("fn_json_array_raw", "SELECT '\"a\"' AS x, '{\"b\":1}' AS y, CAST(3 AS BIGINT) AS n")
def json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fn.json_array_raw(F.lit('["a", {"b": 1}, 2.5]'))
    return spark.range(1).select(raw[0].alias("x"), raw[1].alias("y"), F.size(raw).cast("long").alias("n"))


@query("fn_json_path", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select("event_id", fn.json_path(fn.parse_json(F.col("props")), "k", kind="Int64").alias("k"))


@query("fn_json_typed", "SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS digit, count(*) AS n FROM events GROUP BY 1")
def json_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A typed path is a column that may be grouped by."""
    typed = read(spark, sf_dir, "events").select(F.get_json_object("props", "$.k").cast("long").alias("k"))
    return typed.groupBy((F.col("k") % 10).alias("digit")).agg(F.count("*").alias("n"))


@query("fn_json_nulls", "SELECT 'x' AS a, '7' AS dotted, CAST(NULL AS VARCHAR) AS gone")
def json_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = fn.parse_json(F.lit('{"a": {"b": "x"}, "c.d": 7, "e": null}'))
    return spark.range(1).select(fn.json_path(v, "a", "b").alias("a"), fn.json_path(v, "c.d").alias("dotted"), fn.json_path(v, "e").alias("gone"))


@query("fn_variant_type", "SELECT 'BIGINT' AS a, 'STRING' AS b")
def variant_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.range(1).select(fn.variant_type(fn.parse_json(F.lit("5"))).alias("a"), fn.variant_type(fn.parse_json(F.lit('"x"'))).alias("b"))


@query("fn_l2_distance", "SELECT vec_id FROM (SELECT a.vec_id, row_number() OVER (ORDER BY list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), a.vec_id) AS r FROM embeddings a, (SELECT embedding FROM embeddings WHERE vec_id = 7) b) WHERE r <= 10")
def l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten vectors nearest to one, which is a literal of the plan."""
    e = read(spark, sf_dir, "embeddings")
    one = e.where("vec_id = 7").first()["embedding"]
    reference = F.array(*[F.lit(float(x)) for x in one])
    return e.select("vec_id", fn.l2_distance(F.col("embedding"), reference).alias("d")).orderBy("d", "vec_id").limit(10).select("vec_id")


@query("fn_l2_reduced")
def l2_reduced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by the first 16 bits of each component."""
    e = read(spark, sf_dir, "embeddings")
    one = e.where("vec_id = 7").first()["embedding"]
    reference = F.array(*[F.lit(float(x)) for x in one])
    return e.select("vec_id", fn.l2_distance(fn.reduced(16)(F.col("embedding")), reference).alias("d")).orderBy("d", "vec_id").limit(10)


@query("fn_empty_map", "SELECT CAST(0 AS BIGINT) AS n")
def empty_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.range(1).select(F.size(fn.empty_map("String", "UInt8")).cast("long").alias("n"))


@query("fn_meta", "SELECT 'UTC' AS zone, true AS has_version")
def meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    zone = F.lit(spark.conf.get("spark.sql.session.timeZone"))
    return spark.range(1).select(F.when(zone.isin("UTC", "Etc/UTC"), "UTC").otherwise(zone).alias("zone"), F.version().isNotNull().alias("has_version"))


@query("fn_error", "SELECT CAST(0 AS INTEGER) AS ok")
def error(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.range(1).select(fn.throw_if(F.col("id") > 5, "too large").alias("ok"))


@query("fmt_ip", "SELECT '10.1.2.3' AS back, CAST(167838211 AS BIGINT) AS number")
def ip(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = fn.ip_to_int(F.lit("10.1.2.3"))
    return spark.range(1).select(fn.int_to_ip(number).alias("back"), number.alias("number"))


@query("fmt_date_int", "SELECT o_orderkey, CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS days FROM orders")
def date_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select("o_orderkey", F.datediff(F.to_date("o_orderdate"), F.lit("1970-01-01").cast("date")).cast("long").alias("days"))


@query("fmt_tuple_json", "SELECT n_nationkey, concat('{\"a\":', CAST(n_nationkey AS VARCHAR), ',\"b\":\"', n_name, '\"}') AS j FROM nation")
def tuple_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "nation").select("n_nationkey", F.to_json(F.struct(F.col("n_nationkey").alias("a"), F.col("n_name").alias("b"))).alias("j"))


@query("types_values", "SELECT '123.45' AS d, 'b' AS e, '18446744073709551615' AS u")
def types_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = values(spark, "d Decimal(10, 2), e Enum8('a' = 1, 'b' = 2), u UInt64", ("123.45", "b", "18446744073709551615"))
    return v.select(*[F.col(c).cast("string").alias(c) for c in v.columns])


@query("types_defaults", "SELECT 0 AS i, '' AS s, 'false' AS b, '1970-01-01' AS d, 0.0::DOUBLE AS f")
def types_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..types import with_defaults

    v = with_defaults(values(spark, "i Int32, s String, b Bool, d Date, f Float64", (None, None, None, None, None)), ["i", "s", "b", "d", "f"])
    return v.withColumn("b", F.col("b").cast("string")).withColumn("d", F.col("d").cast("string"))
