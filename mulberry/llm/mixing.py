"""Mixing sources to target weights.

Sizes are summed by source, a target is worked out for each source, and the repetition rate target / size decides how often
each document is emitted: ``floor(rate)`` times, and once more if a number in [0, 1) hashed from seed and id is below the
fraction. The draw depends on seed and id alone, so reruns and retried tasks agree.

Edge cases: a null or empty text has size 0 and is emitted like any other row of its source; a null source is a source of its
own, the last in order; repeated rows draw alike; a source whose size is 0 has target 0; an empty table gives an empty result.
Other columns pass through; those named ``size``, ``source_size``, ``target``, ``rate``, ``copies`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
SEED = 20240607
#: Exact sums of products of sizes and weights.
WIDE = "decimal(38,0)"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """sizes (source, source_size), a row for each source -> source, source_size, target.

    Sources by code point, null last, take ``weights`` in turn. They share the sum of all sizes; a target stops at ``most`` times
    its source's size and the rest is shared again by weight until no target is above. Each round is one aggregate over the
    sources, of which two sums reach the driver; the order comes from range partitions, so no task holds all sources.
    """
    spark = sizes.sparkSession
    order = F.col("source").asc_nulls_last()
    parted = written(sizes.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "mix-sources")
    before = parted.groupBy("part").count().withColumn("before", F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    rank = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1 + F.coalesce("before", F.lit(0))
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    ranked = parted.join(before.select("part", "before"), "part").select(
        "source", "source_size", weight.cast(WIDE).alias("w"), (F.col("source_size") * most).cast(WIDE).alias("cap"))
    ranked = written(ranked, "mix-ranked")
    total, weighed = ranked.agg(F.sum("source_size"), F.sum("w")).first()
    total, full, open_ = int(total or 0), 0, int(weighed or 0)

    def above() -> Column:
        return F.col("cap") * F.lit(open_).cast("decimal(19,0)") < F.lit(total - full).cast("decimal(19,0)") * F.col("w")

    while open_:
        row = ranked.agg(F.sum(F.when(above(), F.col("cap"))), F.sum(F.when(~above(), F.col("w")))).first()
        now = int(row[0] or 0), int(row[1] or 0)
        if now == (full, open_):
            break
        full, open_ = now
    share = (total - full) / open_ if open_ else 0.0
    target = F.when(above(), F.col("cap").cast("double")).otherwise(F.lit(share) * F.col("w").cast("double"))
    return spark.createDataFrame([], "source string, source_size long, target double") if not weighed else ranked.select("source", "source_size", target.alias("target"))


def draw(key: Column, seed: int) -> Column:
    """A number in [0, 1) of 52 hashed bits."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))), 1, 13), 16, 10)
    return bits.cast("double") / float(1 << 52)


def mix_plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", size_col: str | None = None) -> DataFrame:
    """Each row of ``docs`` with size, source_size, target, rate and copies; ``size_col`` names sizes that are already counted.

    The few sums of each source come back by a null-safe equality join, which Spark may split where one source is hot.
    """
    ours = ("size", "source_size", "target", "rate", "copies")
    kept = [c for c in docs.columns if c.lower() not in ours]
    size = F.col(size_col) if size_col else word_count(F.col(text_col))
    sized = docs.select(*kept, size.alias("size"))
    sizes = written(sized.groupBy(F.col(source_col).alias("source")).agg(F.sum("size").alias("source_size")), "mix-sizes")
    targets = source_targets(sizes, weights, most).withColumnRenamed("source", "_source")
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    planned = sized.join(targets, sized[source_col].eqNullSafe(F.col("_source"))).withColumn("rate", rate)
    copies = F.floor("rate") + (draw(F.col(id_col), seed) < F.col("rate") - F.floor("rate")).cast("long")
    return planned.withColumn("copies", copies).select(*kept, *ours)


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as its plan says, with the columns of ``docs``; those named like the plan's own come out as the plan's."""
    planned = mix_plan(docs, **options).where("copies > 0")
    return planned.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sized")
    return mix_plan(sized, size_col="size").select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


ORACLE = r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w, CAST(3 * source_size AS HUGEINT) AS cap FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY cap * (6 // w), source NULLS LAST) AS k FROM w),
c AS (SELECT *, (SELECT sum(source_size) FROM s) AS total, coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS taken_before, sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_w FROM o),
l AS (SELECT total - taken_before AS rest, open_w FROM c WHERE cap * open_w >= (total - taken_before) * w ORDER BY k LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN cap * open_w < rest * w THEN CAST(cap AS DOUBLE) ELSE CAST(rest AS DOUBLE) / CAST(open_w AS DOUBLE) * CAST(w AS DOUBLE) END AS target FROM w, l),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target, d.source, CASE WHEN t.source_size > 0 THEN least(t.target / t.source_size, 3.0::DOUBLE) ELSE 0::DOUBLE END AS rate,
  CAST(CAST(concat('0x', substr(md5(concat('20240607:', coalesce(CAST(doc_id AS VARCHAR), ''))), 1, 13)) AS BIGINT) AS DOUBLE) / 4503599627370496 AS draw
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CAST(floor(rate) AS BIGINT) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END AS copies FROM r)
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken, source, CAST(copies AS BIGINT) AS copies FROM e
"""
