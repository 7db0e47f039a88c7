"""Values, numbers, random rows, external data, files, dictionaries, catalog listings."""

from __future__ import annotations

import asyncio
import io
import re
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..types import schema, wrapped

#: Names of formats and the Spark reader and options for them.
FORMATS: dict[str, tuple[str, dict[str, str]]] = {
    "CSV": ("csv", {}), "CSVWithNames": ("csv", {"header": "true"}), "TSV": ("csv", {"sep": "\t"}), "TabSeparated": ("csv", {"sep": "\t"}),
    "TSVWithNames": ("csv", {"sep": "\t", "header": "true"}), "TabSeparatedWithNames": ("csv", {"sep": "\t", "header": "true"}),
    "JSONEachRow": ("json", {}), "Parquet": ("parquet", {}), "ORC": ("orc", {}),
}


def numbers(spark: SparkSession, n: int, start: int = 0) -> DataFrame:
    return spark.range(start, start + n).withColumnRenamed("id", "number")


def values(spark: SparkSession, described: str | dict[str, str], *rows: tuple) -> DataFrame:
    """Rows with names and types; each value is cast to its column's type by Spark."""
    kinds = schema(described)
    if any(len(r) != len(kinds) for r in rows):
        raise ValueError("rows and columns differ in number")
    if not rows:
        return spark.createDataFrame([], kinds)
    cells = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, kinds, strict=True)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*cells)))


def random_rows(spark: SparkSession, described: str | dict[str, str], n: int, seed: int = 42, longest: int = 10) -> DataFrame:
    """n rows of random values."""
    def one(kind: T.DataType, k: int) -> Column:
        if isinstance(kind, T.StringType):
            return F.randstr(F.lit(longest), F.lit(k))
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            return F.randn(k).cast(kind)
        if isinstance(kind, T.BooleanType):
            return F.rand(k) < 0.5
        if isinstance(kind, T.DateType):
            return F.date_add(F.lit("1970-01-01").cast("date"), (F.rand(k) * 20000).cast("int"))
        if isinstance(kind, T.TimestampType):
            return F.timestamp_seconds((F.rand(k) * 2e9).cast("long"))
        if isinstance(kind, T.ArrayType):
            return F.transform(F.sequence(F.lit(1), (F.rand(k) * 3 + 1).cast("int")), lambda _: one(kind.elementType, k + 1))
        return (F.rand(k) * 100).cast(kind)

    return spark.range(n).select(*[one(f.dataType, seed + 101 * i).alias(f.name) for i, f in enumerate(schema(described).fields)])


def read_file(spark: SparkSession, path: str | list[str], fmt: str = "CSV", described: str | dict[str, str] | None = None, *, errors: int = 0, wrap: bool = False) -> DataFrame:
    """Files of a format; compression by suffix. ``errors``: 0 fails at the first bad row, more drops bad rows. ``wrap``: integers too large for their type wrap around, as in JSON rows."""
    if fmt not in FORMATS:
        raise ValueError(f"no such format: {fmt}")
    kind, options = FORMATS[fmt]
    reader = spark.read.format(kind).options(**options)
    if kind in ("csv", "json"):
        reader = reader.option("mode", "DROPMALFORMED" if errors else "FAILFAST")
    if described is None:
        return reader.load(path) if kind != "csv" or "header" in options else _unnamed(reader.load(path))
    wanted = schema(described)
    small = {"tinyint": 8, "smallint": 16, "int": 32}
    if wrap and kind in ("csv", "json"):
        wide = T.StructType([T.StructField(f.name, T.LongType() if f.dataType.simpleString() in small else f.dataType) for f in wanted.fields])
        df = reader.schema(wide).load(path)
        return df.select(*[wrapped(F.col(f.name), small[f.dataType.simpleString()]).cast(f.dataType).alias(f.name) if f.dataType.simpleString() in small else F.col(f.name) for f in wanted.fields])
    df = reader.schema(wanted).load(path) if kind != "parquet" else reader.load(path)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted.fields])


def _unnamed(df: DataFrame) -> DataFrame:
    return df.toDF(*[f"_{i}" for i in range(1, len(df.columns) + 1)])


async def read_file_async(spark: SparkSession, *args: Any, **more: Any) -> DataFrame:
    return await asyncio.to_thread(read_file, spark, *args, **more)


def inline(spark: SparkSession, data: bytes | str, fmt: str = "CSVWithNames", described: str | dict[str, str] | None = None, structure: list[str] | None = None) -> DataFrame:
    """Data of a format given as bytes, small enough to stand in a request. It becomes rows of the plan, so no executor needs the driver's files."""
    octets = data.encode() if isinstance(data, str) else data
    kind, options = FORMATS[fmt]
    if kind in ("csv", "json"):
        lines = spark.createDataFrame([(x,) for x in octets.decode().splitlines() if x.strip()], "value string")
        if kind == "json":
            wanted = schema(described) if described else None
            if wanted is None:
                return spark.read.json(lines.rdd.map(lambda r: r.value))
            return lines.select(F.from_json("value", wanted).alias("j")).select("j.*")
        rows = [x for x in octets.decode().splitlines() if x]
        sep = options.get("sep", ",")
        named = "header" in options
        head = pd.read_csv(io.StringIO(rows[0]), sep=sep, header=None).iloc[0].astype(str).tolist() if rows else []
        if described:
            wanted = schema(described)
        else:
            names = head if named else [f"_{i}" for i in range(1, len(head) + 1)]
            wanted = T.StructType([T.StructField(n, T.StringType()) for n in (structure or names)])
        body = spark.createDataFrame([(x,) for x in (rows[1:] if named else rows)], "value string")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wanted.fields)
        parsed = body.select(F.from_csv("value", columns, {"sep": sep}).alias("c"))
        return parsed.select("c.*")
    import pyarrow as pa
    import pyarrow.parquet as pq

    table = pq.read_table(pa.BufferReader(octets))
    df = spark.createDataFrame(table)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema(described).fields]) if described else df


class External:
    """Data of one request, visible as temporary views within a block."""

    def __init__(self, spark: SparkSession):
        self.spark, self.names = spark, []

    def add_file(self, name: str, path: str | None = None, data: bytes | None = None, fmt: str = "TSV", types: str | dict[str, str] | None = None, structure: list[str] | None = None) -> External:
        if (path is None) == (data is None):
            raise ValueError("either a path or data")
        df = inline(self.spark, data, fmt, types, structure) if path is None else read_file(self.spark, path, fmt, types)
        df.createOrReplaceTempView(name)
        self.names.append(name)
        return self

    def __enter__(self) -> External:
        return self

    def __exit__(self, *_: object) -> None:
        for name in self.names:
            self.spark.catalog.dropTempView(name)


class Dictionary:
    """A key-value table for lookups. Joined by broadcast while Spark's estimate of its size is below the bound, else by shuffle.
    Of rows with one key that with the least values counts. A missing key gives defaults; null values of a key stay null."""

    def __init__(self, df: DataFrame, key: list[str], most: int = 64 << 20):
        self.key, self.most = key, most
        self.values = [c for c in df.columns if c not in key]
        self.reload(df)

    def lookup(self, df: DataFrame, on: dict[str, str], defaults: bool = True) -> DataFrame:
        from ..operators.joins import size_estimate
        from ..types import with_defaults

        table = self.df.select(*[F.col(k).alias(f"_k_{k}") for k in self.key], *self.values, F.lit(True).alias("_found"))
        table = F.broadcast(table) if size_estimate(self.df) <= self.most else table
        condition = None
        for k in self.key:
            part = df[on[k]] == table[f"_k_{k}"]
            condition = part if condition is None else condition & part
        out = df.join(table, condition, "left").drop(*[f"_k_{k}" for k in self.key])
        return (with_defaults(out, self.values, F.col("_found").isNull()) if defaults else out).drop("_found")

    def reload(self, df: DataFrame) -> None:
        from ..operators.joins import first_per_key

        self.df = first_per_key(df, self.key, [])

    def drop(self) -> None:
        self.df = self.df.limit(0)


def merge_tables(spark: SparkSession, pattern: str, database: str | None = None) -> DataFrame:
    """Rows of all tables and views whose whole name matches a pattern, columns by name."""
    found = sorted(t.name for t in spark.catalog.listTables(database) if re.fullmatch(pattern, t.name))
    if not found:
        raise ValueError(f"no table matches {pattern}")
    df = spark.table(found[0])
    for name in found[1:]:
        df = df.unionByName(spark.table(name), allowMissingColumns=True)
    return df


def system_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    rows = [(t.database or "", t.name, t.tableType, t.isTemporary) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(rows, "database string, name string, engine string, is_temporary boolean")


def system_databases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(d.name,) for d in spark.catalog.listDatabases()], "name string")


def system_settings(spark: SparkSession) -> DataFrame:
    return spark.sql("SET").select(F.col("key").alias("name"), "value")


def describe(df: DataFrame) -> list[tuple[str, str]]:
    """Names and types without running a job."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]

