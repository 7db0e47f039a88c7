"""Media columns: binary payloads held losslessly in progressive JPEG files, and RGB tensors decoded from such files.

Writing. A payload is padded to a positive multiple of 64 bytes; each 64 bytes are the 64 quantised coefficients of a block, in
zigzag order: the first as ``byte + 256``, the others as ``byte + 128`` below 128 and ``byte - 383`` from there on, so that none is
zero and the sign tells a bit. Six blocks make a unit of four luma blocks and one of each chroma (4:2:0). Each component is
written by five scans: its DC with the lowest bit left out, coefficients 1 to 5 and 6 to 63 likewise (spectral selection), then
the lowest bit of DC and of the others (successive approximation). Huffman tables are chosen so that every symbol with its extra
bits has one width, so that numpy reads and writes whole scans at once. A comment segment holds the payload's length.

Reading accumulates any progressive file's scans, in their order, into coefficient arrays: scans of one width by numpy, all others
(runs, end-of-band runs, interleaved DC, restart intervals) symbol by symbol. Coefficients are dequantised, inverse-transformed by
one matrix product, chroma is upsampled by repetition, and full-resolution RGB tensors come out.

Edge cases: a null or empty text has a payload of 64 zero bytes; texts of any length are held whole; repeated rows and ties come
out alike; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import raw, slices, table, written


def zigzag() -> np.ndarray:
    """Row-major index of each coefficient in zigzag order."""
    cells = [(y, x) for y in range(8) for x in range(8)]
    return np.array([8 * y + x for y, x in sorted(cells, key=lambda c: (sum(c), c[0] if sum(c) % 2 else c[1]))])


def inverse_transform() -> np.ndarray:
    """64 x 64: coefficients in zigzag order times this give the samples of a block, row by row."""
    k = np.arange(8)
    one = np.cos((2 * k[None, :] + 1) * k[:, None] * math.pi / 16) / 2
    one[0] /= math.sqrt(2)
    return np.kron(one, one)[zigzag()]


INVERSE = inverse_transform()
#: Code lengths of the tables written: (symbols, lengths). DC categories 8 to 0 take 1 to 9 bits, so that each with its extra bits takes 9.
DC_TABLE = (list(range(8, -1, -1)), list(range(1, 10)))
FIRST_TABLE, REFINE_TABLE = ([0x07], [1]), ([0x00], [1])
BANDS = ((1, 5), (6, 63))


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _huffman(kind: int, number: int, spelled: tuple[list[int], list[int]]) -> bytes:
    symbols, lengths = spelled
    return _segment(0xC4, bytes([kind << 4 | number, *[lengths.count(n) for n in range(1, 17)], *symbols]))


def _bits(bits: np.ndarray) -> bytes:
    """Bits as entropy-coded bytes: the last byte filled with ones, 0xFF followed by 0."""
    bits = bits.ravel()
    if fill := -len(bits) % 8:
        bits = np.concatenate([bits, np.ones(fill, np.uint8)])
    return np.packbits(bits).tobytes().replace(b"\xff", b"\xff\x00")


def _scan(component: int, start: int, stop: int, high: int, low: int, dc: int, ac: int, bits: np.ndarray) -> bytes:
    return _segment(0xDA, bytes([1, component, dc << 4 | ac, start, stop, high << 4 | low])) + _bits(bits)


def write_jpeg(payload: bytes) -> bytes:
    """A progressive JPEG that holds ``payload``, whose length is a positive multiple of 64."""
    n = len(payload) // 64
    units = -(-n // 6)
    wide = math.isqrt(units - 1) + 1
    high = -(-units // wide)
    blocks = np.zeros((high * wide * 6, 64), np.uint8)
    blocks[:n] = np.frombuffer(payload, np.uint8).reshape(n, 64)
    blocks = blocks.reshape(high, wide, 6, 64)
    luma = blocks[:, :, :4].reshape(high, wide, 2, 2, 64).transpose(0, 2, 1, 3, 4).reshape(-1, 64)
    parts = [luma, blocks[:, :, 4].reshape(-1, 64), blocks[:, :, 5].reshape(-1, 64)]
    frame = struct.pack(">BHHB", 8, 16 * high, 16 * wide, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])
    out = [b"\xff\xd8", _segment(0xFE, struct.pack(">Q", len(payload))), _segment(0xDB, b"\0" + b"\1" * 64), _segment(0xC2, frame),
           _huffman(0, 0, DC_TABLE), _huffman(1, 0, FIRST_TABLE), _huffman(1, 1, REFINE_TABLE)]
    for component, own in enumerate(parts, 1):
        halves = own >> 1 ^ np.uint8(0x40)  # code 0 and the seven bits of a coefficient, of 64 to 127 below 0x80 and -127 to -64 above
        steps = np.diff((own[:, 0] >> 1).astype(np.int32) + 128, prepend=np.int32(0))
        size = np.ceil(np.log2(np.abs(steps) + 1)).astype(np.int32)
        extra = np.where(steps >= 0, steps, steps + (1 << size) - 1)
        field = ((1 << (8 - size)) - 1 << (size + 1)) | extra
        out.append(_scan(component, 0, 0, 0, 1, 0, 0, (field[:, None] >> np.arange(8, -1, -1) & 1).astype(np.uint8)))
        for start, stop in BANDS:
            out.append(_segment(0xDA, bytes([1, component, 0, start, stop, 1])) + halves[:, start : stop + 1].tobytes())  # below 0x80, so nothing is stuffed
        lowest = (own ^ (own >> 7)) & 1
        lowest[:, 0] = own[:, 0] & 1
        out.append(_scan(component, 0, 0, 1, 0, 0, 0, lowest[:, 0]))
        lowest[:, 0] = 0  # the symbol that ends the band stands before the 63 correction bits
        out.append(_scan(component, 1, 63, 1, 0, 0, 1, lowest))
    out.append(b"\xff\xd9")
    return b"".join(out)


class _Table:
    def __init__(self, counts: bytes, symbols: bytes):
        self.codes: dict[tuple[int, int], int] = {}
        code, at, self.lengths = 0, 0, {}
        for length, n in enumerate(counts, 1):
            for _ in range(n):
                self.codes[length, code] = symbols[at]
                self.lengths[symbols[at]] = length
                code, at = code + 1, at + 1
            code <<= 1


class _Component:
    def __init__(self, across: int, down: int, quantiser: int):
        self.across, self.down, self.quantiser = across, down, quantiser


class _Reader:
    """Symbol-by-symbol reading of one restart interval."""

    def __init__(self, data: bytes):
        self.bits, self.at = np.unpackbits(np.frombuffer(data, np.uint8)).tolist(), 0
        self.run, self.before = 0, {}

    def bit(self) -> int:
        self.at += 1
        return self.bits[self.at - 1] if self.at <= len(self.bits) else 0

    def receive(self, n: int) -> int:
        value = 0
        for _ in range(n):
            value = value << 1 | self.bit()
        return value

    def signed(self, n: int) -> int:
        value = self.receive(n)
        return value if not n or value >> (n - 1) else value - (1 << n) + 1

    def symbol(self, table: _Table) -> int:
        code = 0
        for length in range(1, 17):
            code = code << 1 | self.bit()
            if (length, code) in table.codes:
                return table.codes[length, code]
        raise ValueError("no such Huffman code")

    def dc(self, block: np.ndarray, component: int, table: _Table | None, high: int, low: int) -> None:
        if high:
            block[0] |= self.bit() << low
        else:
            self.before[component] = self.before.get(component, 0) + self.signed(self.symbol(table))
            block[0] = self.before[component] << low

    def ac_first(self, block: np.ndarray, table: _Table, k: int, stop: int, low: int) -> None:
        if self.run:
            self.run -= 1
            return
        while k <= stop:
            run, size = divmod(self.symbol(table), 16)
            if size:
                k += run
                block[k] = self.signed(size) * (1 << low)
                k += 1
            elif run == 15:
                k += 16
            else:
                self.run = (1 << run) - 1 + self.receive(run)
                return

    def correct(self, block: np.ndarray, k: int, low: int) -> None:
        if self.bit() and not abs(int(block[k])) >> low & 1:
            block[k] += (1 << low) if block[k] > 0 else -(1 << low)

    def ac_refine(self, block: np.ndarray, table: _Table, k: int, stop: int, low: int) -> None:
        while not self.run and k <= stop:
            run, size = divmod(self.symbol(table), 16)
            if not size and run < 15:
                self.run = (1 << run) + self.receive(run)
                break
            value = ((1 << low) if self.bit() else -(1 << low)) if size else 0
            while k <= stop:
                if block[k]:
                    self.correct(block, k, low)
                elif run:
                    run -= 1
                else:
                    break
                k += 1
            if size and k <= stop:
                block[k] = value
            k += 1
        if self.run:
            for j in range(k, stop + 1):
                if block[j]:
                    self.correct(block, j, low)
            self.run -= 1


class Jpeg:
    """Coefficient arrays of a progressive JPEG: for each component (rows of blocks, blocks in a row, 64), in zigzag order."""

    def __init__(self, data: bytes):
        self.comment, self.interval, self.tables, self.quantisers = b"", 0, {}, {}
        at = 2
        if data[:2] != b"\xff\xd8":
            raise ValueError("no JPEG")
        while True:
            marker = data[at + 1]
            if marker == 0xD9:
                return
            size = int.from_bytes(data[at + 2 : at + 4])
            body, at = data[at + 4 : at + 2 + size], at + 2 + size
            if marker == 0xFE:
                self.comment = body
            elif marker == 0xDB:
                while body:
                    wide = body[0] >> 4
                    self.quantisers[body[0] & 15] = np.frombuffer(body[1 : 65 + 64 * wide], ">u2" if wide else np.uint8).astype(np.float64)
                    body = body[65 + 64 * wide :]
            elif marker == 0xC2:
                self._frame(body)
            elif 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                raise ValueError("not a progressive Huffman-coded JPEG")
            elif marker == 0xC4:
                while body:
                    n = sum(body[1:17])
                    self.tables[body[0] >> 4, body[0] & 15] = _Table(body[1:17], body[17 : 17 + n])
                    body = body[17 + n :]
            elif marker == 0xDD:
                self.interval = int.from_bytes(body)
            elif marker == 0xDA:
                end = re.compile(rb"\xff[^\x00\xd0-\xd7]").search(data, at).start()
                self._scan(body, data[at:end])
                at = end

    def _frame(self, body: bytes) -> None:
        _, self.height, self.width, n = struct.unpack(">BHHB", body[:6])
        self.parts = {body[6 + 3 * i]: _Component(body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)}
        self.most = max(c.across for c in self.parts.values()), max(c.down for c in self.parts.values())
        self.units = -(-self.width // (8 * self.most[0])), -(-self.height // (8 * self.most[1]))
        for c in self.parts.values():
            c.blocks = np.zeros((self.units[1] * c.down, self.units[0] * c.across, 64), np.int16)
            c.own = -(-(-(-self.height * c.down // self.most[1])) // 8), -(-(-(-self.width * c.across // self.most[0])) // 8)

    def _scan(self, head: bytes, data: bytes) -> None:
        n = head[0]
        chosen = [(head[1 + 2 * i], head[2 + 2 * i] >> 4, head[2 + 2 * i] & 15) for i in range(n)]
        start, stop, high, low = head[1 + 2 * n], head[2 + 2 * n], head[3 + 2 * n] >> 4, head[3 + 2 * n] & 15
        if n == 1 and not self.interval and self._whole(*chosen[0], start, stop, high, low, data):
            return
        pieces = [x.replace(b"\xff\x00", b"\xff") for x in re.split(rb"\xff[\xd0-\xd7]", data)]
        units = list(self._order([i for i, _, _ in chosen]))
        each = self.interval or len(units)
        for k, piece in enumerate(pieces):
            reader = _Reader(piece)
            for unit in units[k * each : (k + 1) * each]:
                for (component, dc, ac), row, column in ((chosen[j], r, c) for j, r, c in unit):
                    block = self.parts[component].blocks[row, column]
                    if start == 0:
                        reader.dc(block, component, self.tables.get((0, dc)), high, low)
                    elif high:
                        reader.ac_refine(block, self.tables[1, ac], start, stop, low)
                    else:
                        reader.ac_first(block, self.tables[1, ac], start, stop, low)

    def _order(self, components: list[int]) -> Iterator[list[tuple[int, int, int]]]:
        """Units of a scan: which component of it, block row, block column."""
        if len(components) == 1:
            rows, columns = self.parts[components[0]].own
            yield from ([(0, r, c)] for r in range(rows) for c in range(columns))
        else:
            for y in range(self.units[1]):
                for x in range(self.units[0]):
                    yield [(j, y * p.down + v, x * p.across + h) for j, i in enumerate(components) for p in [self.parts[i]] for v in range(p.down) for h in range(p.across)]

    def _whole(self, component: int, dc: int, ac: int, start: int, stop: int, high: int, low: int, data: bytes) -> bool:
        """Read a scan whose symbols with their extra bits all have one width; False where they have not."""
        part = self.parts[component]
        rows, columns = part.own
        blocks, n = part.blocks[:rows, :columns], rows * columns
        table = self.tables.get((0, dc) if start == 0 else (1, ac))
        if start == 0 and high:
            width, count = 1, n
        elif start == 0:
            widths = {length + symbol for symbol, length in table.lengths.items()}
            if len(widths) != 1:
                return False
            width, count = widths.pop(), n
        elif high:
            if table.lengths != {0: 1} or not blocks[:, :, start : stop + 1].all():
                return False
            width, count = stop - start + 2, n
        else:
            if len(table.lengths) != 1 or not 1 <= (symbol := next(iter(table.lengths))) <= 15:
                return False
            width, count = table.lengths[symbol] + symbol, n * (stop - start + 1)
        octets = np.frombuffer(data.replace(b"\xff\x00", b"\xff"), np.uint8)
        if width == 8 and start and not high:
            value = (octets[:count] & ((1 << symbol) - 1)).astype(np.int16)
            value = np.where(value >> (symbol - 1), value, value - (1 << symbol) + 1)
            blocks[:, :, start : stop + 1] = (value << low).reshape(rows, columns, -1)
            return True
        bits = np.unpackbits(octets, count=width * count).reshape(count, width)
        if start == 0 and high:
            blocks[:, :, 0] |= (bits.astype(np.int16) << low).reshape(rows, columns)
        elif start == 0:
            blocks[:, :, 0] = (np.cumsum(self._differences(table, bits, width)) << low).reshape(rows, columns)
        elif high:
            if bits[:, 0].any():
                return False
            signs = np.sign(blocks[:, :, start : stop + 1])
            unset = (np.abs(blocks[:, :, start : stop + 1]) >> low & 1) == 0
            blocks[:, :, start : stop + 1] += signs * unset * (bits[:, 1:].astype(np.int16) << low).reshape(rows, columns, -1)
        else:
            value = self._numbers(bits[:, table.lengths[symbol] :], symbol)
            value = np.where(value >> (symbol - 1), value, value - (1 << symbol) + 1)
            blocks[:, :, start : stop + 1] = (value * (1 << low)).reshape(rows, columns, -1)
        return True

    @staticmethod
    def _numbers(bits: np.ndarray, n: int) -> np.ndarray:
        if n == 8:
            return np.packbits(np.ascontiguousarray(bits)).astype(np.int16)
        return bits.astype(np.int32) @ (1 << np.arange(n - 1, -1, -1))

    @staticmethod
    def _differences(table: _Table, bits: np.ndarray, width: int) -> np.ndarray:
        field = Jpeg._numbers(bits, width)
        out = np.zeros(len(field), np.int64)
        for (length, code), size in table.codes.items():
            mine = field >> (width - length) == code
            extra = field[mine] & ((1 << size) - 1)
            out[mine] = np.where(extra >> max(size - 1, 0) & 1, extra, extra - (1 << size) + 1) if size else 0
        return out

    def payload(self) -> bytes:
        """The bytes that ``write_jpeg`` stored."""
        n = struct.unpack(">Q", self.comment)[0]
        luma, blue, red = (self.parts[i].blocks for i in (1, 2, 3))
        wide, high = self.units
        blocks = np.concatenate([luma.reshape(high, 2, wide, 2, 64).transpose(0, 2, 1, 3, 4).reshape(high, wide, 4, 64), blue[:, :, None], red[:, :, None]], 2)
        out = (blocks + 127 + (blocks > 0)).astype(np.uint8)
        out[..., 0] = blocks[..., 0] - 256
        return out.tobytes()[:n]

    def samples(self, part: _Component) -> np.ndarray:
        """Samples of a component at its own resolution."""
        rows, columns, _ = part.blocks.shape
        values = part.blocks.reshape(-1, 64).astype(np.float32) @ (self.quantisers[part.quantiser][:, None] * INVERSE).astype(np.float32)
        values += 128
        np.rint(values, out=values)
        np.clip(values, 0, 255, out=values)
        return values.reshape(rows, columns, 8, 8).transpose(0, 2, 1, 3).reshape(rows * 8, columns * 8)

    def full(self, plane: np.ndarray, part: _Component) -> np.ndarray:
        """A plane upsampled to the size of the image."""
        across, down = self.most[0] // part.across, self.most[1] // part.down
        if across > 1:
            plane = plane.repeat(across, 1)
        if down > 1:
            plane = plane.repeat(down, 0)
        return plane[: self.height, : self.width]

    def rgb(self) -> np.ndarray:
        """height x width x 3, unsigned 8-bit; one component gives grey."""
        parts = list(self.parts.values())
        luma = self.full(self.samples(parts[0]), parts[0])
        out = np.empty((self.height, self.width, 3), np.uint8)
        if len(parts) == 1:
            out[:] = luma[:, :, None]
            return out
        blue, red = self.samples(parts[1]) - 128, self.samples(parts[2]) - 128
        same = parts[1].blocks.shape == parts[2].blocks.shape
        if same:
            green = self.full(0.344136 * blue + 0.714136 * red, parts[1])
        else:
            green = 0.344136 * self.full(blue, parts[1]) + 0.714136 * self.full(red, parts[2])
        for k, channel in enumerate((luma + self.full(1.402 * red, parts[2]), luma - green, luma + self.full(1.772 * blue, parts[1]))):
            np.rint(channel, out=channel)
            np.clip(channel, 0, 255, out=channel)
            out[:, :, k] = channel
        return out


def padded(data: bytes) -> bytes:
    return data + bytes(64 if not data else -len(data) % 64)


def feature(rgb: np.ndarray) -> str:
    """Size, mean of each channel and a checksum of the whole tensor."""
    means = rgb.reshape(-1, 3).sum(0, dtype=np.int64) / (rgb.shape[0] * rgb.shape[1])
    return f"{rgb.shape[1]}x{rgb.shape[0]} r={means[0]:.3f} g={means[1]:.3f} b={means[2]:.3f} crc={zlib.crc32(rgb):08x}"


def to_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes and media: each text's UTF-8 bytes, padded, as a progressive JPEG."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            data = [x or b"" for x in raw(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in data], pa.int64()), pa.array([write_jpeg(padded(x)) for x in data], pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def to_tensors(media: DataFrame) -> DataFrame:
    """doc_id, height, width, rgb: the tensors decoded from the column ``media``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1, rows=32):
            tensors = [Jpeg(x).rgb() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.shape[0] for x in tensors], pa.int32()), pa.array([x.shape[1] for x in tensors], pa.int32()), pa.array([x.tobytes() for x in tensors], pa.binary())], ["doc_id", "height", "width", "rgb"])

    return media.where("media is not null").select("doc_id", "media").mapInArrow(run, "doc_id long, height int, width int, rgb binary")


def digests(media: DataFrame) -> DataFrame:
    """What is read back from the column ``media``: checksums of the payload, and a feature of the RGB tensor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2, rows=128):
            out = []
            for stored in batch.column(2).to_pylist():
                image = Jpeg(stored)
                payload = image.payload()
                out.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(stored), hashlib.sha256(stored).hexdigest(), feature(image.rgb())))
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c) for c in columns)], ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files are stored in the shared folder, and all but n_bytes is what is read back from there."""
    return digests(written(to_media(table(spark, sf_dir, "documents")), "media", "zstd"))
