"""Token ids in binary files of fixed-width packed bits.

Documents are ordered by id across range partitions; each partition writes one shard. A shard file is

    magic ``MBPK``, version u32, width u32, ids in a block u32, ids u64, documents u64, blocks u64    (little-endian)
    byte offset of each block within the data, and their end                                          u64 x (blocks + 1)
    first id of each document within the shard, and their end                                         u64 x (documents + 1)
    doc_id of each document                                                                           i64 x documents
    1 where the doc_id is null                                                                        u8 x documents
    data: blocks of ids of ``width`` bits each, most significant bit first, padded to whole bytes

``width`` is the least number of bits that holds every id of the vocabulary. Any run of ids is read by seeking to its blocks and
unpacking them with numpy. A task holds the ids of few documents: packed blocks wait in a temporary file. Files are written under a temporary name and renamed, so that retried or doubled tasks do no harm.

Edge cases: a null or empty text holds the end id alone; rows with null ids come first, rows with equal ids are ordered by their
text; repeated rows each have an entry; an empty table gives no documents; extra columns are not read.
"""

from __future__ import annotations

import shutil
import struct
import tempfile
import uuid
import zlib
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunks import PieceStore
from .common import fresh_path, slices, table

MAGIC, VERSION, BLOCK, END = b"MBPK", 1, 4096, 0
#: The letter that stands for a space in byte-level vocabularies (a fixed value), and pieces encoded at once.
SPACE, JOINED = "\u0120", 128
#: Texts whose pieces are looked up together, if they are short.
TOGETHER = 2048
#: Pieces kept in memory by a worker, some 200 bytes each.
KEPT = 600_000
_HEAD = struct.Struct("<4sIIIQQQ")
SHARDS = "path string, part int, n_ids long, n_docs long"
DOCS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def width_of(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids as ``width`` bits each, padded to a whole byte."""
    octets = np.ascontiguousarray(ids, ">u4").view(np.uint8).reshape(-1, 4)
    if width % 8 == 0:
        return octets[:, 4 - width // 8 :].tobytes()
    return np.packbits(np.unpackbits(octets, axis=1)[:, 32 - width :].ravel()).tobytes()


def unpack(data: bytes, n: int, width: int) -> np.ndarray:
    octets = np.frombuffer(data, np.uint8)
    whole = np.zeros((n, 4), np.uint8)
    if width % 8 == 0:
        whole[:, 4 - width // 8 :] = octets[: n * width // 8].reshape(n, -1)
    else:
        bits = np.zeros((n, 32), np.uint8)
        bits[:, 32 - width :] = np.unpackbits(octets, count=n * width).reshape(n, width)
        whole = np.packbits(bits, axis=1)
    return whole.reshape(-1).view(">u4").astype(np.uint32)


def head_bytes(doc_ids: list[int | None], lengths: list[int], width: int, block: int = BLOCK) -> Iterator[bytes]:
    """The parts of a shard file before its data."""
    n_ids = sum(lengths)
    n_blocks = -(-n_ids // block)
    sizes = [(min(block, n_ids - i * block) * width + 7) // 8 for i in range(n_blocks)]
    yield _HEAD.pack(MAGIC, VERSION, width, block, n_ids, len(doc_ids), n_blocks)
    yield np.cumsum([0, *sizes], dtype="<u8").tobytes()
    yield np.cumsum([0, *lengths], dtype="<u8").tobytes()
    yield np.array([x or 0 for x in doc_ids], "<i8").tobytes()
    yield np.array([x is None for x in doc_ids], np.uint8).tobytes()


def data_bytes(ids: np.ndarray, width: int, block: int = BLOCK) -> Iterator[bytes]:
    """Packed blocks of ids."""
    for low in range(0, len(ids), block):
        yield pack(ids[low : low + block], width)


def shard_bytes(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, width: int, block: int = BLOCK) -> Iterator[bytes]:
    """The parts of a shard file."""
    yield from head_bytes(doc_ids, lengths, width, block)
    yield from data_bytes(ids, width, block)


class Shard:
    """Random access to a shard file."""

    def __init__(self, uri: str):
        where, path = fs.FileSystem.from_uri(uri)
        self.file = where.open_input_file(path)
        magic, version, self.width, self.block, self.n_ids, self.n_docs, n_blocks = _HEAD.unpack(self.file.read(_HEAD.size))
        if magic != MAGIC or version != VERSION:
            raise ValueError(f"{uri} is no shard of token ids")
        take = lambda n, kind: np.frombuffer(self.file.read(n * np.dtype(kind).itemsize), kind)
        self.blocks, self.starts, self.doc_ids = take(n_blocks + 1, "<u8"), take(self.n_docs + 1, "<u8"), take(self.n_docs, "<i8")
        self.null = take(self.n_docs, np.uint8)
        self.data = self.file.tell()

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the shard, from the blocks that hold them."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (stop - 1) // self.block
        low, high = int(self.blocks[first]), int(self.blocks[last + 1])
        data = self.file.read_at(high - low, self.data + low)
        if self.block * self.width % 8 == 0:  # every block but the last is full and ends on a byte
            out = unpack(data, min((last + 1) * self.block, self.n_ids) - first * self.block, self.width)
        else:
            out = np.concatenate([unpack(data[int(self.blocks[b]) - low : int(self.blocks[b + 1]) - low], min(self.block, self.n_ids - b * self.block), self.width) for b in range(first, last + 1)])
        return out[start - first * self.block : stop - first * self.block]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1]))


_stores: dict[str, PieceStore] = {}


def library_store(tokenizer_file: str) -> PieceStore:
    """A worker's store of pieces encoded by the tokenizers library."""
    if tokenizer_file not in _stores:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_file)
        tokenizer.no_truncation()
        tokenizer.no_padding()

        names = tokenizer.get_vocab(with_added_tokens=True)
        spaced = np.zeros(max(names.values()) + 1, bool)
        spaced[[i for x, i in names.items() if x.startswith(SPACE)]] = True

        def one_by_one(texts: list[str]) -> Iterator[bytes]:
            for low in range(0, len(texts), 4096):
                for x in tokenizer.encode_batch_fast(texts[low : low + 4096], add_special_tokens=False):
                    yield array("I", x.ids).tobytes()

        def joined(texts: list[str]) -> Iterator[bytes]:
            """Texts whose only space is their first character, encoded many at once: only there does an id start with a space."""
            cut = [texts[low : low + JOINED] for low in range(0, len(texts), JOINED)]
            for low in range(0, len(cut), 64):
                some = cut[low : low + 64]
                for own, x in zip(some, tokenizer.encode_batch_fast(["".join(own) for own in some], add_special_tokens=False), strict=True):
                    ids = np.array(x.ids, "<u4")
                    starts = np.flatnonzero(spaced[ids])
                    if len(starts) != len(own):
                        yield from one_by_one(own)
                        continue
                    data, at = ids.tobytes(), (4 * starts).tolist()
                    yield from map(data.__getitem__, map(slice, at, [*at[1:], len(data)]))

        def encode(texts: list[str]) -> list[bytes]:
            alone = [i for i, x in enumerate(texts) if not (x[:1] == " " and x.count(" ") == 1 and len(x.strip()) == len(x) - 1 > 0)]
            out, at = [], 0
            some = set(alone)
            many = joined([x for i, x in enumerate(texts) if i not in some])
            for i, ids in zip(alone, one_by_one([texts[i] for i in alone]), strict=True):
                out += islice(many, i - at)
                out.append(ids)
                at = i + 1
            return [*out, *many]

        _stores[tokenizer_file] = PieceStore(encode, KEPT)
    return _stores[tokenizer_file]


def write_shards(docs: DataFrame, path: str, tokenizer_file: str, vocabulary: int, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write all documents in ascending order of id as shards under ``path``; gives path, part, n_ids and n_docs of each shard."""
    width = width_of(vocabulary)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    placed = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order, "text").select("doc_id", "text")

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, doc_ids, lengths, rest = library_store(tokenizer_file), [], [], np.zeros(0, "<u4")
        data = tempfile.TemporaryFile()  # the head comes first in a file, and holds sums of all documents
        for batch in slices(batches, 1, TOGETHER):
            ids, n = store.flat_ids(batch.column(1))
            doc_ids += batch.column(0).to_pylist()
            lengths += (n + 1).tolist()
            whole = np.concatenate([rest, np.insert(ids, np.cumsum(n), end)])
            full = len(whole) // BLOCK * BLOCK
            data.writelines(data_bytes(whole[:full], width))
            rest = whole[full:]
        if not doc_ids:
            return
        data.writelines(data_bytes(rest, width))
        data.seek(0)
        part = TaskContext.get().partitionId()
        uri = f"{path}/shard-{part:06d}.bin"
        where, name = fs.FileSystem.from_uri(uri)
        where.create_dir(name.rpartition("/")[0])
        own = f"{name}.{uuid.uuid4().hex}.part"
        with data, where.open_output_stream(own) as out:
            for piece in head_bytes(doc_ids, lengths, width):
                out.write(piece)
            shutil.copyfileobj(data, out, 1 << 20)
        where.move(own, name)
        yield pa.RecordBatch.from_pydict({"path": [uri], "part": pa.array([part], pa.int32()), "n_ids": [sum(lengths)], "n_docs": [len(doc_ids)]})

    return placed.mapInArrow(shard, SHARDS)


def read_shards(shards: DataFrame) -> DataFrame:
    """shards (path, before) -> documents read back from the files: doc_id, start (``before`` and the ids before it within the shard), n_tokens, ids_crc32."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = Shard(uri)
                for low in range(0, shard.n_docs, 1024):
                    some = range(low, min(low + 1024, shard.n_docs))
                    starts = shard.starts[low : some.stop + 1].astype(np.int64)
                    ids = shard.ids(int(starts[0]), int(starts[-1])).astype("<u4")
                    rel = starts - starts[0]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(shard.doc_ids[low : some.stop], pa.int64(), mask=shard.null[low : some.stop].astype(bool)),
                        "start": starts[:-1] + before, "n_tokens": np.diff(starts),
                        "ids_crc32": pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(rel[:-1], rel[1:], strict=True)], pa.int64())})

    return shards.select("path", "before").mapInArrow(read, DOCS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = fresh_path(spark, "token-ids")
    shards = write_shards(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), 50257)
    listed = sorted(shards.collect(), key=lambda x: x["part"])  # a row for each file, not for each document
    before, rows = 0, []
    for x in listed:
        rows.append((x["path"], before))
        before += x["n_ids"]
    return read_shards(spark.createDataFrame(rows, "path string, before long").repartition(max(1, len(rows))))
