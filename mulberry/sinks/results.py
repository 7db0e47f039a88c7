"""Ways to take a result: rows, columns, blocks, NumPy, pandas, Arrow, raw text."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F


class QueryResult:
    """A result that is fetched when first asked for."""

    def __init__(self, df: DataFrame):
        self.df = df
        self._rows: list[Row] | None = None

    @property
    def rows(self) -> list[tuple]:
        if self._rows is None:
            self._rows = self.df.collect()
        return [tuple(r) for r in self._rows]

    @property
    def columns(self) -> list[tuple]:
        return list(zip(*self.rows, strict=True)) if self.rows else [() for _ in self.df.columns]

    @property
    def column_names(self) -> tuple[str, ...]:
        return tuple(self.df.columns)

    def named_results(self) -> Iterator[dict[str, Any]]:
        yield from (dict(zip(self.df.columns, r, strict=True)) for r in self.rows)

    @property
    def first_row(self) -> tuple | None:
        row = self.df.first()
        return None if row is None else tuple(row)

    @property
    def first_item(self) -> dict[str, Any] | None:
        row = self.df.first()
        return None if row is None else row.asDict()

    @property
    def row_count(self) -> int:
        return len(self._rows) if self._rows is not None else self.df.count()


def rows_stream(df: DataFrame) -> Iterator[tuple]:
    """Rows one by one, a partition at a time on the driver."""
    yield from (tuple(r) for r in df.toLocalIterator(prefetchPartitions=True))


def row_blocks(df: DataFrame, rows: int = 10_000) -> Iterator[list[tuple]]:
    held: list[tuple] = []
    for row in rows_stream(df):
        held.append(row)
        if len(held) >= rows:
            yield held
            held = []
    if held:
        yield held


def column_blocks(df: DataFrame, rows: int = 10_000) -> Iterator[list[list]]:
    for block in row_blocks(df, rows):
        yield [list(c) for c in zip(*block, strict=True)]


def to_arrow(df: DataFrame) -> pa.Table:
    return df.toArrow()


def arrow_batches(df: DataFrame, rows: int = 10_000) -> Iterator[pa.RecordBatch]:
    """Arrow batches as the partitions come, without the whole table on the driver."""
    kinds = pa.schema(df.limit(0).toArrow().schema)
    for block in row_blocks(df, rows):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*block, strict=True), kinds, strict=True)], schema=kinds)


def task_blocks(df: DataFrame, rows: int = 10_000) -> DataFrame:
    """The same rows, cut into Arrow batches of at most ``rows`` inside the tasks; nothing reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, rows):
                yield batch.slice(low, rows)

    return df.mapInArrow(run, df.schema)


def to_pandas(df: DataFrame, arrow_types: bool = False) -> pd.DataFrame:
    return df.toArrow().to_pandas(types_mapper=pd.ArrowDtype) if arrow_types else df.toPandas()


def pandas_blocks(df: DataFrame, rows: int = 10_000) -> Iterator[pd.DataFrame]:
    for batch in arrow_batches(df, rows):
        yield batch.to_pandas()


def to_numpy(df: DataFrame) -> np.ndarray:
    """Columns of one type: a matrix; of several: a structured array."""
    frame = df.toPandas()
    if len({str(x) for x in frame.dtypes}) == 1:
        return frame.to_numpy()
    return frame.to_records(index=False).view(np.ndarray)


def raw(df: DataFrame, fmt: str = "TSV") -> str:
    """A result as text; for small results."""
    if fmt == "JSONEachRow":
        return "".join(x[0] + "\n" for x in df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).collect())
    sep = "," if fmt.startswith("CSV") else "\t"
    columns = ", ".join(df.columns)
    body = "".join((x[0] or "") + "\n" for x in df.select(F.to_csv(F.struct("*"), {"sep": sep})).collect())
    return (sep.join(columns.split(", ")) + "\n" if fmt.endswith("WithNames") else "") + body


def write_raw(df: DataFrame, path: str, fmt: str = "Parquet", compression: str | None = None) -> None:
    """A result as files of a format, by the executors."""
    from ..sources.tables import FORMATS

    kind, options = FORMATS[fmt]
    writer = df.write.format(kind).options(**options)
    (writer.option("compression", compression) if compression else writer).save(path)


def command(df: DataFrame) -> Any:
    """A single cell as itself, a single row as a list, nothing as None."""
    rows = df.limit(2).collect()
    if not rows:
        return None
    return rows[0][0] if len(rows[0]) == 1 else list(rows[0])


#: Ways to rename columns.
RENAMES = {
    "remove_prefix": lambda n: n.rsplit(".", 1)[-1],
    "to_camelcase": lambda n: re.sub(r"[_ .]+(\w)", lambda m: m[1].upper(), n[:1].lower() + n[1:]),
    "to_underscore": lambda n: re.sub(r"[ .]+", "_", re.sub(r"(?<=[a-z0-9])([A-Z])", r"_\1", n)).lower(),
}
RENAMES["to_camelcase_without_prefix"] = lambda n: RENAMES["to_camelcase"](RENAMES["remove_prefix"](n))
RENAMES["to_underscore_without_prefix"] = lambda n: RENAMES["to_underscore"](RENAMES["remove_prefix"](n))


def rename_columns(df: DataFrame, how: str) -> DataFrame:
    if how not in RENAMES:
        raise ValueError(f"no such renaming: {how}")
    names = [RENAMES[how](c) for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError("renamed columns clash")
    return df.toDF(*names)


def metadata(df: DataFrame) -> tuple[tuple[str, str], ...]:
    """Names and types only; no job runs."""
    return tuple((f.name, f.dataType.simpleString()) for f in df.schema.fields)


