"""Inserts into, and changes of, catalog tables."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.params import quote_ident


@dataclass(frozen=True)
class Summary:
    """What an insert wrote."""

    written_rows: int
    query_id: str


def ident(name: str) -> str:
    return ".".join(quote_ident(x) for x in name.split("."))


def _append(df: DataFrame, table: str, names: list[str] | None = None) -> Summary:
    """Append by column name; columns that are not given take null."""
    spark = df.sparkSession
    target = spark.table(table).schema
    given = dict(zip(names or df.columns, df.columns, strict=True))
    unknown = set(given) - set(target.names)
    if unknown:
        raise ValueError(f"no such columns in {table}: {sorted(unknown)}")
    aligned = df.select(*[(F.col(f"`{given[f.name]}`").cast(f.dataType) if f.name in given else F.lit(None).cast(f.dataType)).alias(f.name) for f in target.fields])
    seen = Observation()
    aligned.observe(seen, F.count(F.lit(1)).alias("n")).write.insertInto(table)
    return Summary(int(seen.get["n"]), str(uuid.uuid4()))


def insert(spark: SparkSession, table: str, data: list, column_names: list[str] | None = None, column_oriented: bool = False) -> Summary:
    """Rows, or columns, of Python values."""
    rows = list(zip(*data, strict=True)) if column_oriented else [tuple(r) for r in data]
    target = spark.table(table).schema
    names = column_names or target.names
    if any(len(r) != len(names) for r in rows):
        raise ValueError("rows and columns differ in number")
    kinds = T.StructType([T.StructField(n, target[n].dataType) for n in names])
    return _append(spark.createDataFrame(rows, kinds, verifySchema=True), table)


def insert_df(spark: SparkSession, table: str, frame: pd.DataFrame) -> Summary:
    """A pandas frame; floats are rounded where the table has integers."""
    target = spark.table(table).schema
    df = spark.createDataFrame(frame)
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    for name in frame.columns:
        if isinstance(target[name].dataType, whole) and pd.api.types.is_float_dtype(frame[name].dtype):
            df = df.withColumn(name, F.round(F.nanvl(F.col(name), F.lit(None).cast("double"))).cast(target[name].dataType))
    return _append(df, table)


def insert_numpy(spark: SparkSession, table: str, data: np.ndarray, column_names: list[str] | None = None) -> Summary:
    frame = pd.DataFrame.from_records(data) if data.dtype.names else pd.DataFrame(data, columns=column_names or spark.table(table).columns[: data.shape[1]])
    return insert_df(spark, table, frame)


def insert_arrow(spark: SparkSession, table: str, data: pa.Table) -> Summary:
    return _append(spark.createDataFrame(data), table)


def insert_df_arrow(spark: SparkSession, table: str, frame: pd.DataFrame) -> Summary:
    """A pandas frame whose columns are all of Arrow types."""
    other = [c for c in frame.columns if not isinstance(frame[c].dtype, pd.ArrowDtype)]
    if other:
        raise ValueError(f"not of Arrow types: {other}")
    return insert_arrow(spark, table, pa.Table.from_pandas(frame, preserve_index=False))


def insert_frame(df: DataFrame, table: str, names: list[str] | None = None) -> Summary:
    """INSERT ... SELECT."""
    return _append(df, table, names)


def raw_insert(spark: SparkSession, table: str, data: bytes | str, fmt: str = "CSV", column_names: list[str] | None = None) -> Summary:
    """A block of a text or binary format."""
    from ..sources.tables import inline

    target = spark.table(table).schema
    names = column_names or target.names
    if fmt.endswith("Parquet"):
        return _append(inline(spark, data, fmt), table)
    df = inline(spark, data, fmt, None, names if "WithNames" not in fmt else None) if not fmt.startswith("JSON") else inline(spark, data, fmt)
    return _append(df, table)


def insert_file(spark: SparkSession, table: str, path: str, fmt: str = "CSV", column_names: list[str] | None = None, **more: Any) -> Summary:
    """Files read by the executors."""
    from ..sources.tables import read_file

    df = read_file(spark, path, fmt, **more)
    return _append(df, table, column_names or (spark.table(table).columns if df.columns[0] == "_1" else None))


def create_as_empty(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    """CREATE TABLE ... EMPTY AS SELECT."""
    df.limit(0).write.format(fmt).saveAsTable(table)


def _shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only where it is unset, as in tests, a folder of our own."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where is None:
        import tempfile

        where = tempfile.mkdtemp(prefix="mulberry-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{_shared_dir(spark)}/mulberry/{name}-{uuid.uuid4().hex}"


def _staged(df: DataFrame) -> DataFrame:
    """A reliable copy in the shared checkpoint folder, so that a table may be written over from itself."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(_shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def delete(spark: SparkSession, table: str, condition: Column | str | None) -> None:
    """DELETE with a condition, which is needed; rows where it is null stay. The table is written anew."""
    if condition is None or (isinstance(condition, str) and not condition.strip()):
        raise ValueError("DELETE needs a condition")
    test = F.expr(condition) if isinstance(condition, str) else condition
    _staged(spark.table(table).where(~F.coalesce(test, F.lit(False)))).write.insertInto(table, overwrite=True)


def truncate(spark: SparkSession, table: str) -> None:
    spark.sql(f"TRUNCATE TABLE {ident(table)}")


def rewrite(spark: SparkSession, table: str, change: Any, renamed: dict[str, str] | None = None) -> None:
    """Replace a table by ``change`` of its rows, which may alter columns; partitions, properties and comments stay.

    A copy is written under a new name; then the old table is renamed away, the copy takes its name, and the old one is dropped, so
    that the rows are in some table at any moment. ``renamed``: old names of columns -> new ones.
    """
    renamed, new, old = renamed or {}, f"{table}_{uuid.uuid4().hex[:8]}", f"{table}_{uuid.uuid4().hex[:8]}"
    text = lambda x: "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {ident(table)}").collect()}
    properties = {k: v for k, v in properties.items() if k not in ("comment", "transient_lastDdlTime") and not k.startswith("spark.sql.")}
    comment = spark.catalog.getTable(table).description
    columns = [(renamed.get(c.name, c.name), c.description, c.isPartition) for c in spark.catalog.listColumns(table)]
    rows = change(spark.table(table))
    # files follow the table's Parquet settings, as Bloom filters
    writer = rows.write.format("parquet").options(**{k: v for k, v in properties.items() if k.startswith("parquet.")})
    partitions = [c for c, _, parted in columns if parted and c in rows.columns]
    (writer.partitionBy(*partitions) if partitions else writer).saveAsTable(new)
    if properties:
        spark.sql(f"ALTER TABLE {ident(new)} SET TBLPROPERTIES ({', '.join(f'{text(k)} = {text(v)}' for k, v in properties.items())})")
    if comment:
        spark.sql(f"COMMENT ON TABLE {ident(new)} IS {text(comment)}")
    for name, described, _ in columns:
        if described and name in rows.columns:
            spark.sql(f"ALTER TABLE {ident(new)} ALTER COLUMN `{name.replace('`', '``')}` COMMENT {text(described)}")
    spark.sql(f"ALTER TABLE {ident(table)} RENAME TO {ident(old)}")
    spark.sql(f"ALTER TABLE {ident(new)} RENAME TO {ident(table)}")
    if partitions:  # a rename moves files, and leaves the places of partitions as they were
        for what in ("DROP", "ADD"):
            spark.sql(f"MSCK REPAIR TABLE {ident(table)} {what} PARTITIONS")
    spark.sql(f"DROP TABLE {ident(old)}")
