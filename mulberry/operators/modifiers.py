"""FINAL, SAMPLE, PREWHERE, LIMIT BY, LIMIT OFFSET, materialised intermediate results, hints, settings."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from fractions import Fraction

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def final(df: DataFrame, key: list[str], version: str | None = None, is_deleted: str | None = None) -> DataFrame:
    """The newest row of each key (of equal versions the greatest by the other columns), without deleted ones. Aggregated before the shuffle."""
    rest = [c for c in df.columns if c not in key]
    order = ([version] if version else []) + [c for c in rest if c != version]
    if not order:
        return df.distinct()
    newest = df.groupBy(*key).agg(F.max(F.struct(*order)).alias("_row")).select(*[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in df.columns])
    return newest.where(F.col(is_deleted) == 0) if is_deleted else newest


def _ratio(text: str) -> Fraction:
    return Fraction(text.strip())


def sample(df: DataFrame, amount: float | int | str, key: str | None = None, seed: int = 42) -> DataFrame:
    """A fraction, a number of rows, or 'a/b [OFFSET c/d]'.

    With a key the sample is a range of 52 bits of the MD5 of the key as text, so it is the same each time, joins with other samples
    of the key and is even whatever the keys are (a null key counts as empty text); without one it is drawn by seed. A number of rows becomes the fraction that it is of all rows.
    """
    offset = Fraction(0)
    if isinstance(amount, str):
        m = re.fullmatch(r"\s*([\d./]+)(?:\s+OFFSET\s+([\d./]+))?\s*", amount, re.I)
        if not m:
            raise ValueError(f"no such sample: {amount}")
        part, offset = _ratio(m[1]), _ratio(m[2] or "0")
    elif isinstance(amount, int) and amount > 1:
        part = Fraction(amount, max(1, df.count()))
    else:
        part = Fraction(str(amount))
    if part < 0 or offset < 0:
        raise ValueError("samples are not negative")
    if part >= 1 and not offset:
        return df
    if key is None:
        if offset:
            raise ValueError("an offset needs a sampling key")
        return df.sample(fraction=float(part), seed=seed)
    bits = F.conv(F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), 1, 13), 16, 10)
    place = bits.cast("double") / float(1 << 52)
    return df.where((place >= float(offset)) & (place < float(offset + part)))


def prewhere(df: DataFrame, *conditions: Column) -> DataFrame:
    """Filters that belong next to the scan; several hold together. Catalyst pushes them down."""
    for condition in conditions:
        df = df.where(condition)
    return df


def limit_by(df: DataFrame, by: list[str], n: int, order_by: list[Column | str], offset: int = 0) -> DataFrame:
    """Rows ``offset`` to ``offset + n`` of each group by order; Spark cuts groups before the shuffle."""
    if n < 0 or offset < 0:
        raise ValueError("limits are not negative")
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order_by))
    return df.withColumn("_n", place).where((F.col("_n") > offset) & (F.col("_n") <= offset + n)).drop("_n")


def limit_offset(df: DataFrame, n: int, offset: int = 0) -> DataFrame:
    return (df.offset(offset) if offset else df).limit(n)


@contextmanager
def materialized(df: DataFrame) -> Iterator[DataFrame]:
    """An intermediate result that is worked out once and kept, spilling to disk, while it is used; lost parts are worked out again."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


#: Join hints that may be given to Spark; others are rejected.
HINTS = ("broadcast", "merge", "shuffle_hash", "shuffle_replicate_nl", "repartition", "coalesce", "rebalance")


def with_hint(df: DataFrame, name: str, *parameters: object) -> DataFrame:
    if name.lower() not in HINTS:
        raise ValueError(f"no such hint: {name}")
    return df.hint(name, *parameters)


#: Settings with a counterpart in Spark.
SETTINGS = {"max_threads": "spark.sql.shuffle.partitions", "session_timezone": "spark.sql.session.timeZone", "max_block_size": "spark.sql.execution.arrow.maxRecordsPerBatch", "join_use_nulls": None}


@contextmanager
def settings(spark: SparkSession, unknown: str = "error", **values: object) -> Iterator[None]:
    """Settings for the block's actions, put back afterwards. Unknown ones: 'error', 'drop', or 'send' to Spark by their own name."""
    before: dict[str, str | None] = {}
    for name, value in values.items():
        if name not in SETTINGS and unknown == "error":
            raise ValueError(f"no such setting: {name}")
        key = SETTINGS.get(name) or (name if name not in SETTINGS and unknown == "send" else None)
        if key:
            before[key] = spark.conf.get(key, None)
            spark.conf.set(key, str(value))
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
