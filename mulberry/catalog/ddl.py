"""Databases, tables, columns, views, indexes, projections."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.params import quote_ident
from ..sinks.tables import ident, rewrite
from ..types import spark_type
from .engines import Engine, create_table

#: Arrow types and the names of the column types for them.
ARROW = {
    pa.int8(): "Int8", pa.int16(): "Int16", pa.int32(): "Int32", pa.int64(): "Int64", pa.uint8(): "UInt8", pa.uint16(): "UInt16", pa.uint32(): "UInt32", pa.uint64(): "UInt64",
    pa.float32(): "Float32", pa.float64(): "Float64", pa.bool_(): "Bool", pa.string(): "String", pa.large_string(): "String", pa.binary(): "String", pa.date32(): "Date32",
}


def create_database(spark: SparkSession, name: str, if_not_exists: bool = True) -> None:
    spark.sql(f"CREATE DATABASE {'IF NOT EXISTS ' * if_not_exists}{ident(name)}")


def drop_database(spark: SparkSession, name: str, if_exists: bool = True) -> None:
    spark.sql(f"DROP DATABASE {'IF EXISTS ' * if_exists}{ident(name)} CASCADE")


def from_arrow(kinds: pa.Schema) -> dict[str, str]:
    """Column types for an Arrow schema."""
    out = {}
    for f in kinds:
        if pa.types.is_timestamp(f.type):
            out[f.name] = "DateTime64(6)"
        elif pa.types.is_list(f.type):
            out[f.name] = f"Array({ARROW[f.type.value_type]})"
        elif f.type in ARROW:
            out[f.name] = ARROW[f.type]
        else:
            raise ValueError(f"no column type for {f.type}")
    return out


def create_from_arrow(spark: SparkSession, table: str, kinds: pa.Schema, engine: Engine) -> None:
    create_table(spark, table, from_arrow(kinds), engine)


def drop_table(spark: SparkSession, table: str, if_exists: bool = True) -> None:
    spark.sql(f"DROP TABLE {'IF EXISTS ' * if_exists}{ident(table)}")


def rename_table(spark: SparkSession, table: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {ident(table)} RENAME TO {ident(new)}")


def add_column(spark: SparkSession, table: str, name: str, kind: str, default: object = None, after: str | None = None) -> None:
    """A new column; with a default or a place the table is written anew."""
    if default is None and after is None:
        spark.sql(f"ALTER TABLE {ident(table)} ADD COLUMNS ({quote_ident(name)} {spark_type(kind).simpleString()})")
        return
    value = (default if hasattr(default, "alias") else F.lit(default)).cast(spark_type(kind)).alias(name)

    def change(df: DataFrame) -> DataFrame:
        place = df.columns.index(after) + 1 if after else len(df.columns)
        return df.select(*df.columns[:place], value, *df.columns[place:])

    rewrite(spark, table, change)


def drop_column(spark: SparkSession, table: str, name: str) -> None:
    rewrite(spark, table, lambda df: df.drop(name))


def rename_column(spark: SparkSession, table: str, name: str, new: str) -> None:
    rewrite(spark, table, lambda df: df.withColumnRenamed(name, new), {name: new})


def modify_column(spark: SparkSession, table: str, name: str, kind: str) -> None:
    rewrite(spark, table, lambda df: df.withColumn(name, F.col(name).cast(spark_type(kind))))


def comment_column(spark: SparkSession, table: str, name: str, comment: str) -> None:
    text = comment.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE {ident(table)} ALTER COLUMN {quote_ident(name)} COMMENT '{text}'")


def modify_settings(spark: SparkSession, table: str, **values: object) -> None:
    spark.sql(f"ALTER TABLE {ident(table)} SET TBLPROPERTIES ({', '.join(f'{chr(39)}setting.{k}{chr(39)} = {chr(39)}{v}{chr(39)}' for k, v in values.items())})")


def reset_settings(spark: SparkSession, table: str, *names: str) -> None:
    listed = ", ".join(f"'setting.{n}'" for n in names)
    spark.sql(f"ALTER TABLE {ident(table)} UNSET TBLPROPERTIES IF EXISTS ({listed})")


def add_skip_index(spark: SparkSession, table: str, columns: list[str], materialize: bool = True) -> None:
    """Data skipping: Bloom filters of these columns in the files written from now on; existing files are written anew if asked."""
    names = ", ".join(f"'parquet.bloom.filter.enabled#{c}' = 'true'" for c in columns)
    spark.sql(f"ALTER TABLE {ident(table)} SET TBLPROPERTIES ({names})")
    if materialize:
        rewrite(spark, table, lambda df: df.sortWithinPartitions(*columns))


def drop_skip_index(spark: SparkSession, table: str, columns: list[str]) -> None:
    names = ", ".join(f"'parquet.bloom.filter.enabled#{c}'" for c in columns)
    spark.sql(f"ALTER TABLE {ident(table)} UNSET TBLPROPERTIES IF EXISTS ({names})")


def add_projection(spark: SparkSession, table: str, name: str, order_by: list[str] | None = None, group_by: list[str] | None = None, aggregates: list | None = None) -> str:
    """A second copy of a table, ordered or aggregated, under ``table__name``. Queries name it themselves."""
    df = spark.table(table)
    if group_by:
        df = df.groupBy(*group_by).agg(*(aggregates or [F.count("*").alias("count")]))
    elif order_by:
        df = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    else:
        raise ValueError("a projection orders or groups")
    copy = f"{table}__{name}"
    df.write.mode("overwrite").format("parquet").saveAsTable(copy)
    return copy


def drop_projection(spark: SparkSession, table: str, name: str) -> None:
    drop_table(spark, f"{table}__{name}")


def column_attributes(df: DataFrame, attributes: dict[str, dict[str, str]]) -> DataFrame:
    """Columns by attribute: 'default' fills nulls, 'materialized' is worked out at writing, 'alias' at reading. One of them for each column."""
    for name, given in attributes.items():
        kinds = [k for k in ("default", "materialized", "alias") if k in given]
        if len(kinds) > 1:
            raise ValueError(f"{name}: {' and '.join(kinds)} exclude each other")
        if not kinds:
            continue
        value = F.expr(given[kinds[0]])
        df = df.withColumn(name, F.coalesce(F.col(name), value) if kinds[0] == "default" and name in df.columns else value)
    return df


def reflect(spark: SparkSession, table: str) -> dict[str, object]:
    """Columns, comment and properties of a table."""
    columns = [(c.name, c.dataType, c.nullable, c.description) for c in spark.catalog.listColumns(table)]
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {ident(table)}").collect()}
    return {"columns": columns, "engine": properties.get("engine.full"), "comment": properties.get("comment"), "properties": properties}


def standard_index(*_: object) -> None:
    raise NotImplementedError("secondary indexes do not exist; use add_skip_index")
