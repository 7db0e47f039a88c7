"""Array joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import array_enumerate, json_array_raw
from ..operators.arrays import array_join
from .base import query, read


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each part's type; none for sizes that divide by 5."""
    words = F.when(F.col("p_size") % 5 == 0, F.array().cast("array<string>")).otherwise(F.split("p_type", " "))
    lengths = F.transform(words, lambda w: F.length(w).cast("long"))
    return read(spark, sf_dir, "part").select("p_partkey", words.alias("word"), lengths.alias("len"))


_WORDS = "(SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN [] ELSE string_split(p_type, ' ') END AS a FROM part)"


@query("array_join", f"SELECT p_partkey, unnest(a) AS word FROM {_WORDS}")
def inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return array_join(_parts(spark, sf_dir), "word").select("p_partkey", "word")


@query("left_array_join", f"SELECT p_partkey, unnest(CASE WHEN len(a) = 0 THEN [''] ELSE a END) AS word FROM {_WORDS}")
def left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return array_join(_parts(spark, sf_dir), "word", left=True).select("p_partkey", "word")


@query("array_join_multi", f"SELECT p_partkey, w AS word, CAST(len(w) AS BIGINT) AS len FROM (SELECT p_partkey, unnest(a) AS w FROM {_WORDS})")
def several(spark: SparkSession, sf_dir: str) -> DataFrame:
    return array_join(_parts(spark, sf_dir), "word", "len")


@query("array_join_multi_left", f"SELECT p_partkey, w AS word, CAST(len(w) AS BIGINT) AS len FROM (SELECT p_partkey, unnest(CASE WHEN len(a) = 0 THEN [''] ELSE a END) AS w FROM {_WORDS})")
def several_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return array_join(_parts(spark, sf_dir), "word", "len", left=True)


@query("array_join_alias", f"SELECT p_partkey, CAST(len(a) AS BIGINT) AS words, unnest(a) AS one FROM {_WORDS}")
def aliased(spark: SparkSession, sf_dir: str) -> DataFrame:
    return array_join(_parts(spark, sf_dir), "word", alias="one").select("p_partkey", F.size("word").cast("long").alias("words"), "one")


@query("array_join_expr", """SELECT event_id, x AS item, i AS place FROM (SELECT event_id, unnest([k, CAST(event_id % 3 AS VARCHAR)]) AS x, unnest([CAST(1 AS BIGINT), 2]) AS i
FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k FROM events))""")
def expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over JSON arrays made from the events, with the places of the elements."""
    made = F.concat(F.lit("["), F.get_json_object("props", "$.k"), F.lit(","), (F.col("event_id") % 3).cast("string"), F.lit("]"))
    events = read(spark, sf_dir, "events").select("event_id", made.alias("items"))
    raw = json_array_raw(F.col("items"))
    return array_join(events, raw, array_enumerate(raw), alias=["item", "place"]).select("event_id", "item", "place")
