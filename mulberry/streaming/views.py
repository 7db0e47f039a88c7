"""Materialised views: what is appended to a source is transformed and appended to a target, once for each batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def materialized_view(spark: SparkSession, source: str, target: str, transform: Callable[[DataFrame], DataFrame], checkpoint: str, fmt: str = "parquet", once: bool = True) -> StreamingQuery:
    """Files of ``source`` that came since the last run -> ``transform`` -> ``target``. Batches are known by number, so one that is run again replaces itself."""
    kinds = spark.read.format(fmt).load(source).schema
    stream = spark.readStream.schema(kinds).format(fmt).load(source)

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").format("parquet").save(f"{target}/batch={number}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def windowed_counts(stream: DataFrame, time: str, width: str, late: str, keys: list[str]) -> DataFrame:
    """Counts by time window and key of a stream, with late rows taken up to ``late`` (an extension)."""
    from pyspark.sql import functions as F

    return stream.withWatermark(time, late).groupBy(F.window(time, width).alias("window"), *keys).count()
