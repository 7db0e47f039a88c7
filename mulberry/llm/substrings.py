"""Removal of repeated substrings, found by merging Burrows-Wheeler transforms.

1. Texts are brought to one row for equal bytes, with their number, in a table bucketed by the texts' MD5.
2. Anchors: the least hash of the 32-byte grams in each window of ``length`` bytes (the leftmost of equals). Equal windows have
   equal anchors, so a window whose anchor's hash occurs once cannot repeat. Neighbouring windows of one anchor make a segment.
   Segments of anchors that occur twice or more go on; equal segments become one with a number.
3. Segments are dealt out by anchor, and each batch of anchors' segments goes through ``bwt_merge.repeated``: transforms of the
   batch's shards, merged by interleave refinement, whose intervals are the repeated windows. A text that is there more than once
   goes through the same merge with its number as its weight.
4. Ranges of repeated windows go back to the texts, which lose the bytes covered.

Very common anchors. A bounded sample of texts tells which anchors are in one text of a hundred or more; occurrences of these are
counted in salted parts, which changes where rows lie and no result. An anchor whose different segments hold more than ``GROUP``
bytes is divided in Spark, in halves of how far windows start before the anchor, by the hash of the bytes that all windows of a half
share; groups that are alike or small enough go to the merge, the others are halved again, at most eight times. Within a task, a
group with more segments than a batch holds is divided in the same way by the bytes themselves.

Edge cases: null and empty texts, and texts shorter than ``length``, lose nothing (an empty text keeps the empty string); matches
never cross texts; repeated rows lose all of a text of ``length`` bytes or more, each of them; an empty table gives no rows; extra
columns are not read by ``spans`` and pass through ``remove``.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .bwt_merge import repeated
from .common import drop_later, drop_tables, fewer, fresh_path, raw, shuffled, slices, table, written

LENGTH, GRAM = 200, 32
#: Bytes of segments merged at once: few enough that a batch has its symbols' widest form and its arrays stay in a core's cache.
BATCH = 60 << 10
#: Bytes of one anchor's different segments that may meet in one task; more are divided in Spark first.
GROUP = 4 << 20
#: Texts that tell which anchors are very common, and the share of them that makes an anchor so. They decide on salting alone.
SAMPLE, COMMON = 4096, 0.01
TEXTS = "key binary, n long, text string"
ANCHORS = "anchor long, segment long, key binary, start int, starts int, at int, salt int"
MARKS = "anchor long, segment long, ranges array<struct<a:int,b:int>>"
RESULTS = "key binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def distinct_texts(docs: DataFrame, text_col: str) -> DataFrame:
    """key, n, text: a row for each different text, in a table bucketed by key. Copies are counted within each task before the shuffle."""
    spark = docs.sparkSession

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        more: dict[bytes, int] = {}
        for batch in slices(batches, 1):
            keys = batch.column(0).to_pylist()
            new = []
            for i, key in enumerate(keys):
                if key in more:
                    more[key] += 1
                else:
                    more[key] = 0
                    new.append(i)
            own = batch.take(pa.array(new, pa.int32()))
            yield pa.RecordBatch.from_arrays([own.column(0), pa.array([1] * len(new), pa.int64()), own.column(1)], ["key", "n", "text"])
            if len(more) > 500_000:
                yield rest(more)
                more = {}
        yield rest(more)

    def rest(more: dict[bytes, int]) -> pa.RecordBatch:
        some = [(k, n) for k, n in more.items() if n]
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in some], pa.binary()), pa.array([n for _, n in some], pa.int64()), pa.nulls(len(some), pa.string())], ["key", "n", "text"])

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key, those with text first."""
        last: list = [None, 0, None]
        for batch in slices(batches, 2):
            out = []
            for key, n, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key == last[0]:
                    last[1] += n
                else:
                    if last[0] is not None:
                        out.append(tuple(last))
                    last = [key, n, text]
            if out:
                yield as_batch(out)
        if last[0] is not None:
            yield as_batch([tuple(last)])

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        keys, ns, texts = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ns, pa.int64()), pa.array(texts, pa.string())], ["key", "n", "text"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select(text_key(F.col(text_col)).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    once = keyed.mapInArrow(within, TEXTS).repartition(parts, "key").sortWithinPartitions("key", F.col("text").asc_nulls_last()).mapInArrow(across, TEXTS)
    name = f"mulberry_texts_{uuid.uuid4().hex}"
    once.write.bucketBy(parts, "key").option("path", fresh_path(spark, "texts")).format("parquet").saveAsTable(name)
    drop_later(name)
    return spark.table(name)


def gram_hashes(a: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of ``k`` bytes, a power of two."""
    h = (a.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    factor, step = 0x100000001B3, 1
    while step < k:
        h = h[:-step] * np.uint64(factor) + h[step:]
        factor, step = factor * factor % 2**64, step * 2
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def segments_of(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a text of ``length`` bytes or more: anchors' hashes, first window, number of windows, and place of the anchor in the segment."""
    h = gram_hashes(np.frombuffer(data, np.uint8), GRAM)
    wide = length - GRAM + 1
    least, step = h, 1
    while step * 2 <= wide:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if wide > step:
        least = np.minimum(least[: len(least) - (wide - step)], least[wide - step :])
    # the leftmost place that holds the least hash of each window: places of equal hashes are told apart
    starts = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    stops = np.append(starts[1:], len(least))
    first, value, where, count = [], [], [], []
    places = np.flatnonzero(np.isin(h, np.unique(least[starts])))
    hashes = h[places]
    for a, b in zip(starts.tolist(), stops.tolist(), strict=True):
        v = least[a]
        i = int(np.searchsorted(places, a))
        while a < b:
            while hashes[i] != v:
                i += 1
            place = int(places[i])
            end = min(b, place + 1)  # windows that start beyond it have the next equal place as their leftmost
            first.append(a)
            value.append(v)
            where.append(place - a)
            count.append(end - a)
            a = end
            i += 1
    return np.array(value, np.uint64).view(np.int64), np.array(first, np.int32), np.array(count, np.int32), np.array(where, np.int32)


def anchors(texts: DataFrame, length: int, common: np.ndarray | None = None) -> DataFrame:
    """A row for each segment of each different text. salt: -1, or for ``common`` anchors a number that spreads them."""
    common = np.zeros(0, np.int64) if common is None else common

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch in slices(batches, 1):
            parts = []
            for key, data in zip(batch.column(0).to_pylist(), raw(batch.column(1)), strict=True):
                if len(data) >= length:
                    value, first, count, where = segments_of(data, length)
                    hashed = np.fromiter((xxh64_intdigest(data[a : a + n + length - 1]) for a, n in zip(first.tolist(), count.tolist(), strict=True)), np.uint64, len(first)).view(np.int64)
                    parts.append((value, hashed ^ where, [key] * len(first), first, count, where))
            if parts:
                value, hashed, first, count, where = (np.concatenate([p[i] for p in parts]) for i in (0, 1, 3, 4, 5))
                keys = [k for p in parts for k in p[2]]
                salt = np.where(np.isin(value, common), np.fromiter((k[0] << 4 ^ k[1] for k in keys), np.int32, len(keys)), -1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(hashed), pa.array(keys, pa.binary()), pa.array(first), pa.array(count), pa.array(where), pa.array(salt)], ["anchor", "segment", "key", "start", "starts", "at", "salt"])

    return texts.select("key", "text").mapInArrow(run, ANCHORS)


def common_anchors(texts: DataFrame, length: int) -> np.ndarray:
    """Anchors that occur in many of a sample of about ``SAMPLE`` different texts, those with the least MD5: at most a few for each text."""
    share = min(1.0, SAMPLE / max(1, texts.count()))
    sample = texts if share == 1 else texts.where(F.col("key") < F.lit(bytearray(int(share * 2**64).to_bytes(8, "big"))))
    often = anchors(sample, length).select("anchor", "key").distinct().groupBy("anchor").count().where(F.col("count") >= max(2, COMMON * SAMPLE))
    return np.sort(np.array([x["anchor"] for x in often.collect()], np.int64))


def divided(group: list[tuple[int, bytes, int, int, int]], length: int, most: int = BATCH, low: int = 0, high: int | None = None) -> Iterator[list[tuple[int, bytes, int, int, int]]]:
    """Parts of one anchor's segments that hold together all windows that may be equal, each of at most ``most`` bytes.

    Items: owner, segment, windows, place of the anchor, number. A window starts ``low`` to ``high`` bytes before the anchor; all
    such windows of a segment share the bytes from ``high`` before it to ``length - low`` after, and parts are told apart by these.
    """
    if high is None:
        high = max(x[3] for x in group)
    if sum(len(x[1]) for x in group) <= most or low == high:
        yield group
        return
    middle = (low + high) // 2
    for a, b in ((low, middle), (middle + 1, high)):
        parts: dict[bytes, list[tuple[int, bytes, int, int, int]]] = {}
        for owner, data, windows, at, n in group:
            first, last = max(0, at - b), min(windows - 1, at - a)
            if first <= last:
                core = data[at - a : at - b + length] if at >= a else b""
                parts.setdefault(core, []).append((owner, (data[first : last + length]), last - first + 1, at - first, n, first))
        for part in parts.values():
            if len(part) > 1 or part[0][4] > 1:
                yield from _moved(part, length, most, a, b)


def _moved(part: list, length: int, most: int, low: int, high: int) -> Iterator[list]:
    """Divide on, with equal segments as one; owners become lists of (owner, windows cut off before)."""
    same: dict[tuple[bytes, int], list] = {}
    for owner, data, windows, at, n, cut in part:
        entry = same.setdefault((data, at), [[], data, windows, at, 0])
        entry[0] += [(o, c + cut) for o, c in owner]
        entry[4] += n
    yield from divided([tuple(x) for x in same.values()], length, most, low, high)


def marks(segments: DataFrame, length: int) -> DataFrame:
    """segments (anchor, segment, n, data, starts, at), dealt out and sorted by anchor -> ranges of repeated windows of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        size, now, group = 0, None, []

        def merged(items: list) -> Iterator[tuple[tuple[int, int], list[tuple[int, int]]]]:
            found = repeated([x[1] for x in items], np.array([x[4] for x in items]), length)
            for (owners, *_), ranges in zip(items, found, strict=True):
                for owner, cut in owners:
                    yield owner, [(a + cut, b + cut) for a, b in ranges]

        def flush(items: list) -> pa.RecordBatch:
            out: dict[tuple[int, int], list] = {}
            for owner, ranges in merged(items):
                if ranges:
                    out.setdefault(owner, []).extend({"a": a, "b": b} for a, b in ranges)
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k in out], pa.int64()), pa.array([k[1] for k in out], pa.int64()), pa.array(list(out.values()), pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))], ["anchor", "segment", "ranges"])

        def grouped() -> Iterator[list]:
            nonlocal now, group
            for batch in batches:
                for anchor, segment, n, data, windows, at in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if anchor != now:
                        if group:
                            yield group
                        now, group = anchor, []
                    group.append(([((anchor, segment), 0)], data, windows, at, n))
            if group:
                yield group

        for own in grouped():
            for part in divided(own, length):
                more = sum(len(x[1]) for x in part)
                if held and size + more > BATCH:
                    yield flush(held)
                    held, size = [], 0
                held += part
                size += more
        if held:
            yield flush(held)

    return segments.mapInArrow(run, MARKS)


def covered(ranges: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Ranges of windows' starts -> maximal runs of covered bytes."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        end = b - 1 + length
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((a, end))
    return out


def _shifted(by: str) -> Column:
    """Column ranges, moved by a column."""
    return F.transform("ranges", lambda r: F.struct((r["a"] + F.col(by)).alias("a"), (r["b"] + F.col(by)).alias("b")))


def _halves(pieces: DataFrame, length: int) -> DataFrame:
    """Pieces (windows that start ``low`` to ``high`` bytes before the anchor) -> two each, of the halves of that range, with g, the
    hash of the anchor, the range and the bytes that all windows of the range share."""
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    both = F.explode(F.array(F.struct(F.col("low").alias("a"), middle.alias("b")), F.struct((middle + 1).alias("a"), F.col("high").alias("b"))))
    parts = pieces.withColumn("half", both).withColumn("low", F.col("half.a")).withColumn("high", F.col("half.b")).drop("half").where("low <= high")
    first, last = F.greatest(F.lit(0), F.col("at") - F.col("high")), F.least(F.col("starts") - 1, F.col("at") - F.col("low"))
    parts = parts.withColumn("first", first).withColumn("last", last).where("first <= last")
    core = F.substring(F.col("data"), F.col("at") - F.col("low") + 1, F.lit(length) - (F.col("high") - F.col("low")))
    return parts.withColumn("g", F.xxhash64("anchor", "low", "high", core)).select(
        "g", "anchor", "segment", "n", F.substring(F.col("data"), F.col("first") + 1, F.col("last") - F.col("first") + length).alias("data"),
        (F.col("last") - F.col("first") + 1).alias("starts"), (F.col("at") - F.col("first")).alias("at"), (F.col("cut") + F.col("first")).alias("cut"), "low", "high")


def _common_marks(segments: DataFrame, length: int) -> list[DataFrame]:
    """``marks`` of anchors with many different segments: divided until groups are small or alike, round by round in the shared folder."""
    pieces, found = segments.withColumn("cut", F.lit(0)).withColumn("low", F.lit(0)).withColumn("high", F.lit(length - GRAM)), []
    while True:
        halves = written(_halves(pieces, length).withColumn("same", F.xxhash64("data", "at")), "halves")
        state = halves.groupBy("g").agg(F.sum("n").alias("_n"), F.sum(F.octet_length("data")).alias("_bytes"), F.min("same").alias("_a"), F.max("same").alias("_b")).where("_n > 1")
        state = written(state.select("g", ((F.col("_bytes") <= GROUP) | (F.col("_a") == F.col("_b"))).alias("ready")), "state")
        halves = halves.join(state, "g").withColumn("ready", F.col("ready") | (F.col("low") == F.col("high")))
        ready = halves.where("ready")
        kinds = ready.groupBy("g", "same").agg(F.sum("n").alias("n"), F.first("data").alias("data"), F.first("starts").alias("starts"), F.first("at").alias("at"))
        kinds = kinds.select(F.col("g").alias("anchor"), F.col("same").alias("segment"), "n", "data", "starts", "at").repartition("anchor").sortWithinPartitions("anchor")
        marked = _summed(marks(kinds, length)).select(F.col("anchor").alias("g"), F.col("segment").alias("same"), "ranges")
        found.append(written(ready.select("g", "same", "anchor", "segment", "cut").join(marked, ["g", "same"]).select("anchor", "segment", _shifted("cut").alias("ranges")), "marks"))
        if state.where("not ready").isEmpty():
            return found
        pieces = written(halves.where("not ready").drop("g", "same", "ready"), "pieces")
        if pieces.isEmpty():
            return found


def _summed(found: DataFrame) -> DataFrame:
    """One row for each segment: several parts of a divided anchor may have marked it."""
    return found.groupBy("anchor", "segment").agg(F.array_distinct(F.flatten(F.collect_list("ranges"))).alias("ranges"))


def copied(texts: list[tuple[bytes, int]], length: int) -> list[list[tuple[int, int]]]:
    """Texts and how often each occurs -> ranges of repeated windows, by merges of the texts' pieces with these weights."""
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    held: list[tuple[int, int, bytes, int]] = []

    def flush() -> None:
        for (i, low, _, _), ranges in zip(held, repeated([x[2] for x in held], np.array([x[3] for x in held]), length), strict=True):
            out[i] += [(a + low, b + low) for a, b in ranges]

    size = 0
    for i, (data, n) in enumerate(texts):
        for low in range(0, len(data) - length + 1, BATCH):
            piece = data[low : low + BATCH + length - 1]
            if held and size + len(piece) > BATCH:
                flush()
                held, size = [], 0
            held.append((i, low, piece, n))
            size += len(piece)
    if held:
        flush()
    return out


def spans(docs: DataFrame, text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """For each different text: key, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes left)."""
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    texts = distinct_texts(docs, text_col)
    every = anchors(texts, length, common_anchors(texts, length))
    # an anchor that occurs once cannot repeat; counted in the one shuffle that brings equal anchors together
    counted = every.withColumn("_n", F.count("*").over(Window.partitionBy("anchor", "salt")))
    occurring = written(fewer(counted.where("_n > 1 or salt >= 0").drop("_n", "salt")), "occurrences")
    kinds = occurring.groupBy("anchor", "segment").agg(F.count("*").alias("n"), F.min(F.struct("key", "start", "starts", "at")).alias("x"))
    kinds = written(fewer(kinds.select("anchor", "segment", "n", F.col("x.key").alias("key"), "x.start", "x.starts", "x.at")), "kinds")
    large = kinds.groupBy("anchor").agg(F.sum(F.col("starts") + (length - 1)).alias("bytes")).where(F.col("bytes") > GROUP).select("anchor", F.lit(True).alias("large"))
    large = written(large, "large")
    some = not large.isEmpty()
    if some:
        kinds = kinds.join(large, "anchor", "left")
    cut = texts.select("key", "text").join(kinds, "key").select(
        "anchor", "segment", "n", F.substring(F.col("text").cast("binary"), F.col("start") + 1, F.col("starts") + (length - 1)).alias("data"), "starts", "at", *["large"] * some)
    if some:
        cut = written(cut, "cut")
        small = cut.where("large is null").drop("large")
    else:
        small = cut
    found = written(fewer(marks(small.repartition("anchor").sortWithinPartitions("anchor"), length)), "marks")
    for more in _common_marks(cut.where("large").drop("large"), length) if some else []:
        found = found.unionByName(more)
    ranges = occurring.join(_summed(found), ["anchor", "segment"]).select("key", _shifted("start").alias("ranges"))
    by_text = ranges.groupBy("key").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            out = []
            ns, texts = batch.column(1).to_pylist(), raw(batch.column(2))
            owns: list = [[(r["a"], r["b"]) for r in own or []] for own in batch.column(3).to_pylist()]
            more = [i for i, n in enumerate(ns) if n > 1]
            for i, own in zip(more, copied([(texts[i], ns[i]) for i in more], length), strict=True):
                owns[i] = own
            for key, data, own in zip(batch.column(0).to_pylist(), texts, owns, strict=True):
                gone = covered(own, length)
                at, left = 0, []
                for a, b in gone:
                    left.append(data[at:a])
                    at = b
                kept = b"".join([*left, data[at:]])
                out.append((key, len(data), len(data) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()), strict=True)], ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return texts.join(by_text, "key", "left").select("key", "n", "text", "ranges").mapInArrow(run, RESULTS)


def remove(docs: DataFrame, text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """The rows of ``docs`` without the repeated substrings of their texts, same columns; bytes of characters that were cut apart go too. A null text stays null."""
    found = spans(docs, text_col, length).select(F.col("key").alias("_key"), F.col("n_removed").alias("_gone"), F.col("kept").alias("_kept"))
    whole = [c for c in docs.columns if c != text_col]

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, batch_place):
            left = [None if none else (x or b"").decode("utf-8", "ignore") for x, none in zip(batch.column(batch_place).to_pylist(), batch.column(batch_place + 1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:batch_place], pa.array(left, pa.string())], names=[*whole, text_col])

    batch_place = len(whole)

    keyed = docs.select(*whole, text_key(F.col(text_col)).alias("_key"), F.col(text_col).isNull().alias("_null"))
    # sorted and merged, so that no task runs the Python of both sides: each would keep a worker of its own
    joined = keyed.join(shuffled(found), "_key").select(*whole, "_kept", "_null")
    return joined.mapInArrow(clean, StructType([*docs.select(*whole).schema.fields, StructField(text_col, StringType())])).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = written(spans(docs).select("key", "n_bytes", "n_removed", "n_spans", "kept_sha256"), "spans")
    drop_tables(spark)
    return docs.select("doc_id", text_key(F.col("text")).alias("key")).join(found, "key").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
