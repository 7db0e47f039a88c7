"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of text handled at once inside a task.
ROWS = 512
#: Bytes of text handled at once inside a task; one longer text is handled alone.
TEXT_BYTES = 4 << 20
#: Limit of the bytes that Spark hands to a Python worker at once, which a session may set otherwise.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Files of a table that is written after a shuffle: one for so many shuffle partitions, yet so many for each core.
PARTS_EACH, FILES_EACH = 8, 4

_made: list[str] = []
_tables: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``. Only where it is unset, as in tests, a folder of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = "file://" + tempfile.mkdtemp(prefix="mulberry-")
        spark.conf.set("spark.checkpoint.dir", found)
        _made.append(found)
    return found if "://" in found or found.startswith("file:") else "file://" + os.path.abspath(found)


def fresh_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/mulberry/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it again: cuts the lineage, and any executor may be lost afterwards."""
    spark, path = df.sparkSession, fresh_path(df.sparkSession, name)
    df.write.parquet(path, compression=codec)
    back = spark.read.schema(df.schema).parquet(path)
    back._mulberry_path = path
    return back


def fewer(df: DataFrame) -> DataFrame:
    """``df`` in fewer partitions, for writing: shuffle partitions are often many and small, and each would be a file. Local disks start two
    processes for a file (chmod, of it and of its checksums). Not for what a join of skewed keys gives: the parts of a key would meet again."""
    spark = df.sparkSession
    return df.coalesce(max(FILES_EACH * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // PARTS_EACH))


def forget(df: DataFrame) -> None:
    """Delete what ``written`` wrote, when nothing reads it any more."""
    path = getattr(df, "_mulberry_path", None)
    if path:
        _delete(df.sparkSession, path)
        _made.remove(path)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that grows with the corpus: it is sorted and merged, never broadcast through the driver."""
    return df.hint("merge")


def drop_later(name: str) -> None:
    """Note a catalog table that ``drop_tables`` is to drop."""
    _tables.append(name)


def drop_tables(spark: SparkSession) -> None:
    """Drop the catalog tables made so far, with their files: call it when nothing reads them any more."""
    while _tables:
        name = _tables.pop()
        where = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first()
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        if where is not None:
            _delete(spark, where["data_type"])


@atexit.register
def _sweep() -> None:
    for path in _made:
        if path.startswith("file:"):
            shutil.rmtree(path.removeprefix("file://").removeprefix("file:"), ignore_errors=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def raw(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return column.cast(pa.binary()).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], text: int, rows: int = ROWS, most: int = TEXT_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of few rows and few bytes of column number ``text``; a single text is never cut."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(lengths):
            if i > start and (i - start >= rows or held + n > most):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def ship(spark: SparkSession) -> None:
    """Let the executors' Python workers import this package wherever the driver's code lies: it is sent as a zip file, once for each context.
    Batches of long texts are handed to workers in parts of ``TEXT_BYTES``, unless the session sets a limit of its own."""
    sc = spark.sparkContext
    if spark.conf.get(BATCH_BYTES, "1") == "1":
        spark.conf.set(BATCH_BYTES, TEXT_BYTES)
    if getattr(sc, "_mulberry_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    folder = tempfile.mkdtemp(prefix="mulberry-code-")
    with zipfile.ZipFile(f"{folder}/mulberry_code.zip", "w") as out:
        for at, _, names in os.walk(os.path.join(top, "mulberry")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(at, name)
                    out.write(full, os.path.relpath(full, top))
    sc.addPyFile(f"{folder}/mulberry_code.zip")
    sc._mulberry_shipped = True
