"""SimHash near-duplicates by segment popcounts.

A fingerprint has the bits that are set in over half of the XXH64 values (seed 42) of a text's word shingles. The 64 bits make 32
segments of two; the vector of their popcounts is the embedding. The Manhattan distance of two embeddings is at most the number
of differing bits, so fingerprints that differ in at most 3 bits have embeddings within 3, and one half of their embeddings within
1. Each half is a cell of a grid: every fingerprint is stored in its two cells, looks into these and the cells one step away, and
what it finds is held against the Manhattan bound and then against the bits themselves.

A popcount of 0, 1, 2 is kept as 00, 01, 11, so that Manhattan distances are counts of differing bits and steps flip one bit. All
of this is bit arithmetic of Spark SQL over distinct fingerprints: copies meet no join, and the join may be split where a cell is
full. Links become components without leaving the executors.

``keep_near`` is for near-duplicate stages: links are word-shingle sets whose Jaccard similarity, computed exactly, is high enough.
Candidates come from several independent fingerprints of the set, embedded as above by the popcounts of 32 segments. Fingerprints
within 11 bits have embeddings within 11, and of 4 groups of 8 segments one within 2. A group is a cell of a grid: every fingerprint is
stored in its cells and those one step away, so that such two share a cell, where they are held against the Manhattan bound and then
against the bits themselves. A pair over 11 bits apart in every fingerprint is missed (see README for the recall).
Cells travel in bundles that share their first bits, and a task lays out the cells of one bundle; bundles with too many members are
cut into blocks that meet pair by pair. A first pass tells which sets have candidates at all. Of these, bitmaps tell at once pairs
that cannot be similar: a bit that one set has and the other lacks is a shingle that they don't share. Pairs of a group of near copies
are never all made: each bundle names a spanning forest of its candidates, and these are verified and joined. Candidates that are not
joined then may be as many as pairs, where a group is alike and yet not similar, so they are never rows: each bundle names its members
that have one, these meet again with their values, block by block, and the task that verifies their pairs gives a spanning forest of links.

Edge cases: a text with fewer words than a shingle is one shingle, one without words (null, empty) has fingerprint zero and is
linked like any other; repeated rows share a component; null ids are never the smallest unless all are null; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fewer, raw, shuffled, slices, table, written
from .components import components, forest

SHINGLE, BITS, SEED = 3, 3, 42
NEAR_WORDS, NEAR_BITS, SIMILARITY, TABLES = 5, 11, 0.8, 3
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(data: bytes | None, words_each: int = SHINGLE, seed: int = SEED) -> int:
    from xxhash import xxh64_intdigest

    words = (data or b"").translate(_LOWER).split()
    if not words:
        return 0
    shingles = zip(*(words[i:] for i in range(words_each)), strict=False) if len(words) >= words_each else [words]
    hashes = np.fromiter(map(xxh64_intdigest, map(b" ".join, shingles), repeat(seed)), ">u8")
    octets, total = hashes.view(np.uint8).reshape(-1, 8), np.zeros(64, np.int64)
    for low in range(0, len(octets), 1 << 16):
        total += np.unpackbits(octets[low : low + (1 << 16)], axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, text_col: str = "text", words_each: int = SHINGLE, into: str = "_fp") -> DataFrame:
    """All columns of ``docs`` and the fingerprint as a signed long."""
    from pyspark.sql.types import LongType, StructField, StructType

    kept = [c for c in docs.columns if c != into]
    place = kept.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, place):
            found = pa.array([fingerprint(x, words_each) for x in raw(batch.column(place))], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*kept, into])

    return docs.select(*kept).mapInArrow(run, StructType([*docs.select(*kept).schema.fields, StructField(into, LongType())]))


def embedding(fp: Column) -> Column:
    """Popcounts of 32 two-bit segments, each as 00, 01 or 11."""
    even, next_ = F.lit(0x5555555555555555), F.shiftrightunsigned(fp, 1)
    any_, both = fp.bitwiseOR(next_).bitwiseAND(even), fp.bitwiseAND(next_).bitwiseAND(even)
    return any_.bitwiseOR(F.shiftleft(both, 1))


def embeddings(fps: np.ndarray) -> np.ndarray:
    """What ``embedding`` gives, inside a task."""
    even, next_ = np.int64(0x5555555555555555), fps >> 1
    return (fps | next_) & even | (fps & next_ & even) << 1


def steps(cell: np.ndarray, flip: np.ndarray | int) -> np.ndarray:
    """Where flipping a bit of a cell (none: 0) is a step of the grid: 00 may become 01, 01 may become 00 or 11, 11 may become 01."""
    return np.where(np.equal(flip, 0), True, np.where(np.bitwise_and(flip, 0x5555) != 0, cell & (flip << 1) == 0, cell & (flip >> 1) != 0))


def links(distinct: DataFrame, bits: int = BITS) -> DataFrame:
    """Pairs of fingerprints (column fp) that differ in at most ``bits`` (up to 3) bits; a pair may come more than once."""
    if not 0 <= bits <= 3:
        raise ValueError("one half within a step holds for up to 3 bits")
    embedded = distinct.select("fp", embedding(F.col("fp")).alias("e"))
    low, high = F.col("e").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("e", 32)
    halves = embedded.select("fp", F.explode(F.array(F.struct(F.lit(0).cast("long").alias("half"), low.alias("cell")), F.struct(F.lit(1).cast("long").alias("half"), high.alias("cell")))).alias("h")).select("fp", F.col("h.half").alias("half"), F.col("h.cell").alias("cell"))
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i).cast("long") for i in range(32)])
    flip, first = F.col("flip"), F.lit(0x55555555).cast("long")
    # 00 may become 01, 01 may become 00 or 11, 11 may become 01
    valid = (flip == 0) | F.when(flip.bitwiseAND(first) != 0, F.col("cell").bitwiseAND(F.shiftleft(flip, 1)) == 0).otherwise(F.col("cell").bitwiseAND(F.shiftright(flip, 1)) != 0)
    looks = halves.withColumn("flip", F.explode(flips)).where(valid).select(F.col("fp").alias("b"), "half", F.col("cell").bitwiseXOR(flip).alias("cell"))
    stored = halves.withColumnRenamed("fp", "a")
    a, b = F.col("a"), F.col("b")
    near = (F.bit_count(embedding(a).bitwiseXOR(embedding(b))) <= bits) & (F.bit_count(a.bitwiseXOR(b)) <= bits)
    return stored.join(shuffled(looks), (stored.half == looks.half) & (stored.cell == looks.cell) & (a < b) & near).select("a", "b")


def groups(marked: DataFrame, id_col: str = "doc_id", fp_col: str = "_fp", bits: int = BITS) -> DataFrame:
    """fp, root, least_id, least_fp: for each distinct fingerprint its component, the smallest id there and that row's fingerprint."""
    distinct = written(marked.groupBy(F.col(fp_col).alias("fp")).agg(F.min(id_col).alias("least")), "fingerprints")
    found = components(links(distinct, bits)).withColumnRenamed("node", "fp")
    rooted = distinct.join(shuffled(found), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    best = rooted.groupBy("root").agg(F.min(F.struct(F.col("least").isNull().alias("none"), "least", "fp")).alias("x")).select("root", F.col("x.least").alias("least_id"), F.col("x.fp").alias("least_fp"))
    return rooted.select("fp", "root").join(shuffled(best), "root")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_each: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """The rows of ``docs`` with one row of each group of near-duplicates, that with the smallest id (of equal ones, any text of the first fingerprint); same columns."""
    marked = fingerprints(docs, text_col, words_each)
    narrow = written(fingerprints(docs.select(id_col, text_col), text_col, words_each).select(id_col, "_fp"), "marked")
    chosen = groups(narrow, id_col, bits=bits).where("fp = least_fp").select(F.col("fp").alias("_kept_fp"), F.col("least_id").alias("_kept_id"))
    kept = marked.join(shuffled(chosen), (F.col("_fp") == F.col("_kept_fp")) & F.col(id_col).eqNullSafe(F.col("_kept_id")))
    first = F.row_number().over(Window.partitionBy("_fp", id_col).orderBy(text_col))
    return kept.withColumn("_row", first).where("_row = 1").select(*docs.columns)


def shingles(data: bytes | None, words_each: int = NEAR_WORDS) -> np.ndarray:
    """XXH64 values of the distinct word shingles, sorted."""
    from xxhash import xxh64_intdigest

    words = (data or b"").translate(_LOWER).split()
    found = zip(*(words[i:] for i in range(words_each)), strict=False) if len(words) >= words_each else [words] if words else []
    return np.unique(np.fromiter(map(xxh64_intdigest, map(b" ".join, found), repeat(SEED)), np.uint64))


def sketch(hashes: np.ndarray) -> bytes:
    """Number of a set's values, and a bitmap with a bit for each."""
    bits = np.zeros(64 * (SKETCH - 1), np.uint8)
    bits[(hashes >> np.uint64(40)).astype(np.int64) % len(bits)] = 1
    return len(hashes).to_bytes(8, "little") + np.packbits(bits).tobytes()


def may_be_similar(x: np.ndarray, y: np.ndarray, similarity: float) -> np.ndarray:
    """Rows of sketches -> False where the Jaccard similarity is certainly lower."""
    apart = x[:, 1:] ^ y[:, 1:]
    own = np.bitwise_count((apart & x[:, 1:]).view(np.uint64)).sum(1, dtype=np.int64)
    other = np.bitwise_count((apart & y[:, 1:]).view(np.uint64)).sum(1, dtype=np.int64)
    both = np.minimum(x[:, 0] - own, y[:, 0] - other)
    return both >= similarity * (x[:, 0] + y[:, 0] - both) - 1e-9


def set_id(hashes: np.ndarray) -> int:
    from xxhash import xxh64_intdigest

    return int(np.uint64(xxh64_intdigest(hashes.tobytes(), SEED)).view(np.int64))


def set_fingerprints(hashes: np.ndarray, tables: int = TABLES) -> list[int]:
    """Independent fingerprints of one set; the first is of the values themselves, the others of values mixed anew."""
    found, values = [], hashes
    for _ in range(tables):
        total = np.zeros(64, np.int64)
        octets = values.astype(">u8").view(np.uint8).reshape(-1, 8)
        for low in range(0, len(octets), 1 << 16):
            total += np.unpackbits(octets[low : low + (1 << 16)], axis=1).sum(0, dtype=np.int64)
        found.append(int.from_bytes(np.packbits(2 * total > len(values)).tobytes(), "big", signed=True))
        values = values + np.uint64(0x9E3779B97F4A7C15)
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        values = values ^ (values >> np.uint64(31))
    return found


def _sets(docs: DataFrame, text_col: str, words_each: int, more: str) -> DataFrame:
    """All columns of ``docs``, _set and, as ``more`` says, the fingerprints (_fps) or the values of the set (_hashes)."""
    from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

    kept, place = docs.columns, docs.columns.index(text_col)
    fields = [StructField("_set", LongType())] + {"": [], "_fps": [StructField("_fps", ArrayType(LongType()))], "_hashes": [StructField("_hashes", BinaryType())]}[more]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, place):
            found = [shingles(x, words_each) for x in raw(batch.column(place))]
            columns = [pa.array([set_id(x) for x in found], pa.int64())]
            if more == "_fps":
                columns.append(pa.array([set_fingerprints(x) for x in found], pa.list_(pa.int64())))
            elif more == "_hashes":
                columns.append(pa.array([x.tobytes() for x in found], pa.binary()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*kept, *(x.name for x in fields)])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *fields]))


#: Members of a bundle of cells that one task lays out, at most; rows of a run that are compared at once.
MEMBERS, RUN = 500_000, 128
BUNDLES = "key int, low int, high int, side int, ids binary, fps binary, roots binary, sketches binary"
#: 64-bit words of a set's sketch: its size, and a bitmap of its values.
SKETCH = 9
#: Bytes of sets' values in a block; a task verifies the pairs between two blocks.
VALUES = 4 << 20


def _bundle_keys(fps: np.ndarray, first: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each fingerprint and group of 8 segments: the number of both, and rows with a bundle that each is in: those of the ``first`` bits of its cell and of up to one step from it."""
    flips, embedded = np.array([0, *(1 << i for i in range(first))], np.int64), embeddings(fps)
    for t in range(fps.shape[1]):
        for g in range(4):
            own = (embedded[:, t] >> (16 * g + 16 - first) & ((1 << first) - 1))[:, None]
            rows, which = np.nonzero(steps(own, flips))
            yield t * 4 + g, rows, own[rows, 0] ^ flips[which]


def _merged(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches put together until they have so many rows."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield pa.concat_batches(held)


def _bundles(distinct: DataFrame, first: int, blocks: dict[int, int]) -> DataFrame:
    """distinct (_set, _fps, root, sketch) -> rows of bundles; those in ``blocks`` are cut into so many blocks, and come once for each pair of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _merged(batches, 10_000):
            for at in range(0, whole.num_rows, 10_000):
                batch = whole.slice(at, 10_000)
                ids, roots = batch.column(0).to_numpy(), batch.column(2).to_numpy()
                fps = np.array(batch.column(1).to_pylist(), np.int64)
                sketches = None if batch.column(3).null_count else np.frombuffer(b"".join(batch.column(3).to_pylist()), np.int64).reshape(-1, SKETCH)
                for number, rows, keys in _bundle_keys(fps, first):
                    order, out = np.argsort(keys, kind="stable"), []
                    flat, rows = keys[order], rows[order]
                    starts = np.flatnonzero(np.diff(flat, prepend=-1))
                    for low, high in zip(starts.tolist(), [*starts[1:].tolist(), len(flat)], strict=True):
                        key, own = number << first | int(flat[low]), rows[low:high]
                        m = blocks.get(key, 1)
                        block = ids[own] % m
                        for s in np.unique(block).tolist():
                            some = own[block == s]
                            packed = ids[some].tobytes(), fps[some, number >> 2].tobytes(), roots[some].tobytes(), None if sketches is None else sketches[some].tobytes()
                            out += [(key, min(s, other), max(s, other), s, *packed) for other in range(m)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(),) * 4 + (pa.binary(),) * 4, strict=True)], ["key", "low", "high", "side", "ids", "fps", "roots", "sketches"])

    return distinct.select("_set", "_fps", "root", "sketch").mapInArrow(run, BUNDLES)


def _large_bundles(distinct: DataFrame, first: int) -> dict[int, int]:
    """Numbers of blocks of the bundles with over ``MEMBERS`` members; there are at most 2^(first + 2) bundles for each fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, _, keys in _bundle_keys(np.array(batch.column(0).to_pylist(), np.int64).reshape(batch.num_rows, -1), first):
                total[number] = total.get(number, 0) + np.bincount(keys, minlength=1 << first)
        for number, n in total.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array((number << first | some).astype(np.int32)), pa.array(n[some])], ["key", "n"])

    counted = distinct.select("_fps").mapInArrow(run, "key int, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") > MEMBERS)
    return {x["key"]: -(-2 * x["n"] // MEMBERS) for x in counted.collect()}


def _laid_out(fps: np.ndarray, key: int, first: int, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of a bundle's members within ``bits`` (places x < y, and their distances), each once: in the first group of segments,
    and the least cell, that have them within two steps."""
    g, inner = (key >> first) & 3, 16 - first
    embedded = embeddings(fps)
    own = embedded >> (16 * g) & 0xFFFF
    here = np.flatnonzero(own >> inner == key & ((1 << first) - 1)).astype(np.int32)
    moved = [here[steps(own[here], 1 << i)] for i in range(inner)]
    cells = (np.concatenate([own, *(own[m] ^ (1 << i) for i, m in enumerate(moved))]) & ((1 << inner) - 1)).astype(np.uint16)
    place = np.concatenate([np.arange(len(fps), dtype=np.int32), *moved])
    order = np.lexsort((place, cells))
    cells, place = cells[order], place[order]
    starts = np.flatnonzero(np.diff(cells.astype(np.int64), prepend=-1))
    ends = np.append(starts[1:], len(cells))
    prefix = (key & ((1 << first) - 1)) << inner

    def kept(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """x, y: places in the order of the cells."""
        cell, a, b = cells[x].astype(np.int64) | prefix, place[x], place[y]
        apart, distance = embedded[a] ^ embedded[b], np.bitwise_count((fps[a] ^ fps[b]).view(np.uint64))
        ok = (distance <= bits) & (a != b)
        for before in range(g):
            ok &= np.bitwise_count(apart >> (16 * before) & 0xFFFF) > 2
        flips = apart >> (16 * g) & 0xFFFF
        low = flips & -flips
        high = flips ^ low  # 0, or for two flips the other one
        twice = (high == low << 1) & (low & 0x5555 != 0)  # both steps in one segment: 01 lies between
        ok &= cell == np.where(high == 0, np.minimum(own[a], own[b]), np.where(twice, own[a] & ~high | low, np.minimum(own[a] ^ low, own[a] ^ high)))
        return a[ok], b[ok], distance[ok].astype(np.int64)

    short = ends - starts <= RUN
    stop = np.repeat(np.where(short, ends, starts), ends - starts)
    left = np.arange(len(cells))
    for step in range(1, RUN):
        left = left[left + step < stop[left]]
        if not len(left):
            break
        for i in range(0, len(left), 1 << 18):
            x = left[i : i + (1 << 18)]
            near = np.bitwise_count((embedded[place[x]] ^ embedded[place[x + step]]).view(np.uint64)) <= bits
            if near.any():
                yield kept(x[near], x[near] + step)
    for low, high in zip(starts[~short].tolist(), ends[~short].tolist(), strict=True):
        f = embedded[place[low:high]]
        for i in range(0, len(f), 128):
            for j in range(i, len(f), 1024):
                x, y = np.nonzero(np.bitwise_count((f[i : i + 128, None] ^ f[None, j : j + 1024]).view(np.uint64)) <= bits)
                ok = x + i < y + j
                if ok.any():
                    yield kept(x[ok] + (low + i), y[ok] + (low + j))


def _spanning(x: np.ndarray, y: np.ndarray, distance: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The pairs that join what ``label`` tells apart, nearest first, and the labels then: in each round every part takes its nearest pair."""
    taken = [(x[:0], y[:0], distance[:0])]
    while True:
        cross = label[x] != label[y]
        x, y, distance = x[cross], y[cross], distance[cross]
        if not len(x):
            return *(np.concatenate(c) for c in zip(*taken, strict=True)), label
        best, code = np.full(len(label), 2**62), distance << 32 | np.arange(len(x))
        np.minimum.at(best, label[x], code)
        np.minimum.at(best, label[y], code)
        some = np.unique(best[best < 2**62] & 0xFFFFFFFF)
        taken.append((x[some], y[some], distance[some]))
        node, low = forest(label[x[some]], label[y[some]])
        now = np.arange(len(label))
        now[node] = low
        label = now[label]


def _members(parts: list[tuple], sketched: bool) -> tuple[np.ndarray, ...]:
    """Rows of a bundle (side, ids, fps, roots, sketches) -> the same of all its members, in the order of their ids."""
    ids, fps, roots = (np.concatenate([np.frombuffer(p[i], np.int64) for p in parts]) for i in (1, 2, 3))
    side = np.repeat([p[0] for p in parts], [len(p[1]) // 8 for p in parts])
    order = np.argsort(ids)
    sketches = np.concatenate([np.frombuffer(p[4], np.int64) for p in parts]).reshape(-1, SKETCH)[order] if sketched else None
    return side[order], ids[order], fps[order], roots[order], sketches


def _allowed(laid_out: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], roots: np.ndarray, side: np.ndarray | None, sketches: np.ndarray | None, similarity: float | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of the pairs of a bundle's members those with different roots, different sides, and sketches that allow the similarity."""
    for x, y, distance in laid_out:
        ok = roots[x] != roots[y]
        if side is not None:
            ok &= side[x] != side[y]
        x, y, distance = x[ok], y[ok], distance[ok]
        if similarity is not None and len(x):
            ok = may_be_similar(sketches[x], sketches[y], similarity)
            x, y, distance = x[ok], y[ok], distance[ok]
        if len(x):
            yield x, y, distance


def _cover(nearest: np.ndarray) -> np.ndarray:
    """Each member's nearest other (none: -1) -> members whose pair with it is enough to name every member that has one."""
    some = np.flatnonzero(nearest >= 0)
    alone = some[~np.isin(some, nearest[some])]  # nobody's nearest
    rest = np.setdiff1d(some, np.concatenate([alone, nearest[alone]]))
    twice = (nearest[nearest[rest]] == rest) & (rest > nearest[rest]) & np.isin(nearest[rest], rest)  # the other names it
    return np.concatenate([alone, rest[~twice]])


def _in_bundles(distinct: DataFrame, first: int, found: Callable[[int, int, int, list[tuple]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """What ``found`` gives for each bundle of distinct (_set, _fps, root, sketch): its key, its pair of blocks and its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for batch in batches:
            for *key, side, ids, fps, roots, sketches in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != now:
                    if parts:
                        yield from found(*now, parts)
                    now, parts = key, []
                parts.append((side, ids, fps, roots, sketches))
        if parts:
            yield from found(*now, parts)

    bundles = _bundles(distinct, first, _large_bundles(distinct, first)).repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    return bundles.mapInArrow(run, schema)


def _first_bits(distinct: DataFrame) -> int:
    """Bits of a cell that tell bundles apart: whole segments, more for more sets."""
    return min(12, max(4, (distinct.count() >> 15).bit_length() + 1 & ~1))


def candidates(distinct: DataFrame, bits: int = NEAR_BITS, similarity: float | None = None, spanning: bool = False) -> DataFrame:
    """distinct (_set, _fps, root, sketch) -> a, b, distance: pairs of sets of which some fingerprint differs in at most ``bits`` (up to 11) bits.

    With a similarity: every pair of sets with different roots whose sketches allow it, perhaps more than once; of these, if
    ``spanning``, only a spanning forest in each bundle. Else, in each bundle, some sets with the nearest such b, so that every set
    with a candidate is in some row. But for all pairs, rows grow with the sets, not with their pairs.
    """
    if not 0 <= bits <= 11:
        raise ValueError("one group within two steps holds for up to 11 bits")
    first = _first_bits(distinct)

    def found(key: int, low: int, high: int, parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        side, ids, fps, roots, sketches = _members(parts, similarity is not None)
        nearest, label = np.full(len(ids), 2**62), np.arange(len(ids))
        for x, y, distance in _allowed(_laid_out(fps, key, first, bits), roots, side if low != high else None, sketches, similarity):
            if similarity is not None:
                if spanning:
                    x, y, distance, label = _spanning(x, y, distance, label)
                a, b = np.minimum(ids[x], ids[y]), np.maximum(ids[x], ids[y])
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(distance)], ["a", "b", "distance"])
            else:
                np.minimum.at(nearest, x, distance << 32 | y)
                np.minimum.at(nearest, y, distance << 32 | x)
        if similarity is None:
            other = np.where(nearest < 2**62, nearest & 0xFFFFFFFF, -1)
            a = _cover(other)
            yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[other[a]]), pa.array(nearest[a] >> 32)], ["a", "b", "distance"])

    return _in_bundles(distinct, first, found, "a long, b long, distance long")


def _blocks(side: np.ndarray, size: np.ndarray, most: int) -> np.ndarray:
    """Members -> numbers of blocks, each of one side and of about ``most`` bytes."""
    block, n = np.zeros(len(side), np.int64), 0
    for s in np.unique(side):
        own = np.flatnonzero(side == s)
        before = np.cumsum(size[own]) - size[own]
        block[own] = n + before // most
        n = int(block[own[-1]]) + 1
    return block


def meetings(distinct: DataFrame, bits: int = NEAR_BITS, similarity: float = SIMILARITY) -> DataFrame:
    """distinct as in ``candidates`` -> key, low, high, x, y, block, _set: for each bundle, and each pair x, y of blocks of its members, those
    that have a candidate there. Rows grow with the members and their blocks of ``VALUES`` bytes, not with their pairs."""
    first = _first_bits(distinct)

    def found(key: int, low: int, high: int, parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        side, ids, fps, roots, sketches = _members(parts, True)
        block = _blocks(side, 8 * sketches[:, 0], VALUES)
        n, met = int(block.max()) + 1, {}
        for x, y, _ in _allowed(_laid_out(fps, key, first, bits), roots, side if low != high else None, sketches, similarity):
            pair = np.minimum(block[x], block[y]) * n + np.maximum(block[x], block[y])
            for p in np.unique(pair).tolist():
                own = met.setdefault(p, np.zeros(len(ids), bool))
                own[x[pair == p]] = own[y[pair == p]] = True
        for p, own in met.items():
            some = np.flatnonzero(own)
            same = [pa.array(np.full(len(some), v, np.int32)) for v in (key, low, high, p // n, p % n)]
            yield pa.RecordBatch.from_arrays([*same, pa.array(block[some].astype(np.int32)), pa.array(ids[some])], ["key", "low", "high", "x", "y", "block", "_set"])

    return _in_bundles(distinct, first, found, "key int, low int, high int, x int, y int, block int, _set long")


def met_links(met: DataFrame, distinct: DataFrame, sets: DataFrame, bits: int = NEAR_BITS, similarity: float = SIMILARITY) -> DataFrame:
    """``meetings`` of distinct, and sets (_set, _hashes) -> a, b: similar pairs that join what their candidates' links would, a spanning
    forest for each pair of blocks. A pair that is near in an earlier fingerprint is left to that one."""
    first, group = _first_bits(distinct), ["key", "low", "high", "x", "y"]

    def links(key: int, low: int, high: int, left: int, right: int, rows: list[tuple]) -> pa.RecordBatch:
        block, ids, roots = (np.array([r[i] for r in rows], np.int64) for i in (0, 1, 3))
        fps, sketches = np.array([r[2] for r in rows], np.int64), np.frombuffer(b"".join(r[4] for r in rows), np.int64).reshape(-1, SKETCH)
        values, label = [np.frombuffer(r[5], np.uint64) for r in rows], np.unique(roots, return_inverse=True)[1]
        out, table = [], key >> first >> 2
        for x, y, distance in _allowed(_laid_out(fps[:, table], key, first, bits), roots, block if left != right else None, sketches, similarity):
            ok = np.ones(len(x), bool)
            for before in range(table):
                ok &= np.bitwise_count((fps[x, before] ^ fps[y, before]).view(np.uint64)) > bits
            order = np.flatnonzero(ok)[np.argsort(distance[ok], kind="stable")]
            for i, j in zip(x[order].tolist(), y[order].tolist(), strict=True):
                if label[i] != label[j] and jaccard_reaches(values[i], values[j], similarity):
                    label[label == label[i]] = label[j]
                    out.append((min(rows[i][1], rows[j][1]), max(rows[i][1], rows[j][1])))
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:5] != now:
                    if rows:
                        yield links(*now, rows)
                    now, rows = row[:5], []
                rows.append(row[5:])
        if rows:
            yield links(*now, rows)

    joined = met.join(shuffled(distinct), "_set").join(shuffled(sets), "_set").select(*group, "block", "_set", "_fps", "root", "sketch", "_hashes")
    return joined.repartition(*group).sortWithinPartitions(*group).mapInArrow(run, "a long, b long")


def jaccard_reaches(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    """Whether two sets' Jaccard similarity is at least ``similarity``."""
    both = 0
    if min(len(x), len(y)) >= similarity * max(len(x), len(y)) - 1e-9:
        both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= similarity * (len(x) + len(y) - both) - 1e-9


def similar(pairs: DataFrame, sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose sets (_set, _hashes) have a Jaccard similarity of at least ``similarity``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column(2), batch.column(3), strict=True)
            keep = [jaccard_reaches(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), similarity) for x, y in both]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(shuffled(sets.select(F.col("_set").alias("a"), F.col("_hashes").alias("_x"))), "a").join(shuffled(sets.select(F.col("_set").alias("b"), F.col("_hashes").alias("_y"))), "b")
    return joined.select("a", "b", "_x", "_y").mapInArrow(run, "a long, b long")


def _sketched(sets: DataFrame) -> DataFrame:
    """sets (_set, _hashes) -> _set, sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([sketch(np.frombuffer(x.as_buffer(), np.uint64)) for x in batch.column(1)], pa.binary())], ["_set", "sketch"])

    return sets.select("_set", "_hashes").mapInArrow(run, "_set long, sketch binary")


def near_links(docs: DataFrame, distinct: DataFrame, text_col: str = "text", words_each: int = NEAR_WORDS, bits: int = NEAR_BITS, similarity: float = SIMILARITY) -> DataFrame:
    """Verified links of the distinct sets (_set, _fps), with the components that all similar candidates give: a spanning forest of
    the candidates is verified first, then, where they meet, the candidates that its links don't connect."""
    some = candidates(distinct.withColumn("root", F.col("_set")).withColumn("sketch", F.lit(None).cast("binary")), bits)
    needed = written(fewer(some.select(F.explode(F.array("a", "b")).alias("_set")).distinct()), "needed")
    sets = written(fewer(_sets(docs.select(text_col), text_col, words_each, "_hashes").select("_set", "_hashes").join(shuffled(needed), "_set", "left_semi").groupBy("_set").agg(F.first("_hashes").alias("_hashes"))), "sets")
    left = written(fewer(_sketched(sets).join(shuffled(distinct), "_set").select("_set", "_fps", F.col("_set").alias("root"), "sketch")), "left")
    links = written(similar(written(fewer(candidates(left, bits, similarity, spanning=True).select("a", "b").distinct()), "spanning"), sets, similarity), "near")
    root = components(links).select(F.col("node").alias("_set"), F.col("root").alias("_root"))
    left = written(fewer(left.join(shuffled(root), "_set", "left").select("_set", "_fps", F.coalesce("_root", "root").alias("root"), "sketch")), "rooted")
    rest = met_links(written(meetings(left, bits, similarity), "met"), left, sets, bits, similarity)
    return written(links.unionByName(rest), "links")


def keep_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_each: int = NEAR_WORDS, bits: int = NEAR_BITS, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` with one row of each group of texts linked by Jaccard similarity, that with the smallest id (of equal ones, any text of one set); same columns."""
    key = F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    narrow = docs.select(F.col(id_col).alias("_id"), key.alias("_key"), F.col(text_col).alias("_text"))
    marked = written(_sets(narrow, "_text", words_each, "_fps").select("_id", "_key", "_set", "_fps"), "marked")
    distinct = written(fewer(marked.groupBy("_set").agg(F.min("_id").alias("least"), F.first("_fps").alias("_fps"))), "distinct")
    found = components(near_links(docs, distinct, text_col, words_each, bits, similarity)).withColumnRenamed("node", "_set")
    rooted = distinct.join(shuffled(found), "_set", "left").select("_set", F.coalesce("root", "_set").alias("root"), "least")
    best = rooted.groupBy("root").agg(F.min(F.struct(F.col("least").isNull().alias("none"), "least", "_set")).alias("x"))
    chosen = best.select(F.col("x._set").alias("_set"), F.col("x.least").alias("_kept_id"))
    # of rows with the same id and set, the text with the least MD5
    chosen = marked.join(shuffled(chosen), (marked["_set"] == chosen["_set"]) & F.col("_id").eqNullSafe(F.col("_kept_id"))).groupBy("_kept_id", chosen["_set"]).agg(F.min("_key").alias("_kept_key"))
    chosen = written(fewer(chosen.select("_kept_id", "_kept_key")), "kept")
    kept = docs.withColumn("_key", key).join(shuffled(chosen), (F.col("_key") == F.col("_kept_key")) & F.col(id_col).eqNullSafe(F.col("_kept_id")))
    first = F.row_number().over(Window.partitionBy("_key", id_col).orderBy(F.lit(0)))
    return kept.withColumn("_row", first).where("_row = 1").select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = written(fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "_fp"), "marked")
    found = groups(marked).select(F.col("fp").alias("_fp"), F.col("least_id").alias("component_id"))
    return marked.join(shuffled(found), "_fp").select("doc_id", F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id")
