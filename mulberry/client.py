"""A client's methods over a Spark session, its asynchronous twin, and a DB-API connection."""

from __future__ import annotations

import asyncio
import re
from collections.abc import Iterator
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from . import errors
from .operators.modifiers import settings as scoped
from .plans import params
from .sinks import results, tables


class Client:
    def __init__(self, spark: SparkSession, query_limit: int = 0):
        self.spark, self.query_limit = spark, query_limit

    def frame(self, sql: str, parameters: Any = None) -> DataFrame:
        try:
            return params.query(self.spark, sql, parameters, self.query_limit)
        except PySparkException as e:
            raise errors.wrapped(e) from e

    def query(self, sql: str, parameters: Any = None, settings: dict[str, Any] | None = None) -> results.QueryResult:
        with scoped(self.spark, **(settings or {})):
            result = results.QueryResult(self.frame(sql, parameters))
            try:
                _ = result.rows
            except PySparkException as e:
                raise errors.wrapped(e) from e
        return result

    def command(self, sql: str, parameters: Any = None) -> Any:
        return results.command(self.frame(sql, parameters))

    def query_df(self, sql: str, parameters: Any = None) -> Any:
        return results.to_pandas(self.frame(sql, parameters))

    def query_df_arrow(self, sql: str, parameters: Any = None, dataframe_library: str = "pandas") -> Any:
        if dataframe_library == "polars":
            import polars

            return polars.from_arrow(results.to_arrow(self.frame(sql, parameters)))
        return results.to_pandas(self.frame(sql, parameters), arrow_types=True)

    def query_np(self, sql: str, parameters: Any = None) -> Any:
        return results.to_numpy(self.frame(sql, parameters))

    def query_arrow(self, sql: str, parameters: Any = None) -> Any:
        return results.to_arrow(self.frame(sql, parameters))

    def query_rows_stream(self, sql: str, parameters: Any = None) -> Iterator[tuple]:
        return results.rows_stream(self.frame(sql, parameters))

    def query_row_block_stream(self, sql: str, parameters: Any = None, rows: int = 10_000) -> Iterator[list[tuple]]:
        return results.row_blocks(self.frame(sql, parameters), rows)

    def query_column_block_stream(self, sql: str, parameters: Any = None, rows: int = 10_000) -> Iterator[list[list]]:
        return results.column_blocks(self.frame(sql, parameters), rows)

    def query_df_stream(self, sql: str, parameters: Any = None, rows: int = 10_000) -> Iterator[Any]:
        return results.pandas_blocks(self.frame(sql, parameters), rows)

    def query_arrow_stream(self, sql: str, parameters: Any = None, rows: int = 10_000) -> Iterator[Any]:
        return results.arrow_batches(self.frame(sql, parameters), rows)

    def query_np_stream(self, sql: str, parameters: Any = None, rows: int = 10_000) -> Iterator[Any]:
        for block in self.query_df_stream(sql, parameters, rows):
            yield block.to_numpy() if len({str(x) for x in block.dtypes}) == 1 else block.to_records(index=False)

    def raw_query(self, sql: str, parameters: Any = None, fmt: str = "TSV") -> bytes:
        return results.raw(self.frame(sql, parameters), fmt).encode()

    def insert(self, table: str, data: list, column_names: list[str] | None = None, column_oriented: bool = False) -> tables.Summary:
        return tables.insert(self.spark, table, data, column_names, column_oriented)

    def insert_df(self, table: str, frame: Any) -> tables.Summary:
        return tables.insert_df(self.spark, table, frame)

    def insert_arrow(self, table: str, data: Any) -> tables.Summary:
        return tables.insert_arrow(self.spark, table, data)

    def insert_df_arrow(self, table: str, frame: Any) -> tables.Summary:
        return tables.insert_df_arrow(self.spark, table, frame)

    def raw_insert(self, table: str, data: bytes | str, fmt: str = "CSV", column_names: list[str] | None = None) -> tables.Summary:
        return tables.raw_insert(self.spark, table, data, fmt, column_names)

    def insert_file(self, table: str, path: str, fmt: str = "CSV", **more: Any) -> tables.Summary:
        return tables.insert_file(self.spark, table, path, fmt, **more)

    def ping(self) -> bool:
        return self.spark.sql("SELECT 1").first()[0] == 1

    def close(self) -> None:
        """The session stays open; it belongs to the caller."""


class AsyncClient:
    """Each of the client's methods in a thread of its own; streams are read whole."""

    def __init__(self, client: Client):
        self.client = client

    def __getattr__(self, name: str) -> Any:
        method = getattr(self.client, name)

        async def run(*args: Any, **more: Any) -> Any:
            def call() -> Any:
                found = method(*args, **more)
                return list(found) if name.endswith("_stream") else found

            return await asyncio.to_thread(call)

        return run


class Cursor:
    """PEP 249."""

    arraysize = 1

    def __init__(self, client: Client):
        self.client, self._rows, self._at = client, [], 0
        self.description: list[tuple] | None = None
        self.rowcount = -1

    def execute(self, sql: str, parameters: Any = None) -> None:
        df = self.client.frame(sql, parameters)
        self.description = [(f.name, f.dataType.simpleString(), None, None, None, None, True) for f in df.schema.fields]
        try:
            self._rows, self._at = [tuple(r) for r in df.collect()], 0
        except PySparkException as e:
            raise errors.wrapped(e) from e
        self.rowcount = len(self._rows)

    def executemany(self, sql: str, rows: list) -> None:
        """INSERT ... VALUES becomes one insert of all rows; other statements run row by row."""
        m = re.match(r"\s*INSERT\s+INTO\s+(?:TABLE\s+)?([\w.`]+)\s*(?:\(([^)]*)\))?\s*VALUES", sql, re.I)
        if not m:
            for row in rows:
                self.execute(sql, row)
            return
        names = [x.strip(" `") for x in m[2].split(",")] if m[2] else None
        data = [list(r.values()) for r in rows] if rows and isinstance(rows[0], dict) else rows
        if rows and isinstance(rows[0], dict):
            names = list(rows[0])
        self.rowcount = self.client.insert(m[1].replace("`", ""), data, names).written_rows

    def fetchone(self) -> tuple | None:
        if self._at >= len(self._rows):
            return None
        self._at += 1
        return self._rows[self._at - 1]

    def fetchmany(self, size: int | None = None) -> list[tuple]:
        some = self._rows[self._at : self._at + (size or self.arraysize)]
        self._at += len(some)
        return some

    def fetchall(self) -> list[tuple]:
        return self.fetchmany(len(self._rows) or 1)

    def close(self) -> None:
        self._rows = []


class Connection:
    def __init__(self, client: Client):
        self.client = client

    def cursor(self) -> Cursor:
        return Cursor(self.client)

    def commit(self) -> None:
        """Each statement commits itself."""

    def rollback(self) -> None:
        raise errors.NotSupportedError("no transactions")

    def close(self) -> None:
        self.client.close()


apilevel, threadsafety, paramstyle = "2.0", 2, "pyformat"


def connect(spark: SparkSession) -> Connection:
    return Connection(Client(spark))
