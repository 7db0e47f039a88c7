"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

Features of a text: the share of each hashed word bucket (square roots, of length one), and a fixed list of structure statistics,
each cut into steps of which one is on; numeric metadata columns are cut likewise, with a step of their own for null. The score is

    sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2])

whose pairwise part takes linear time by the sum-of-squares identity. The model is fitted by AdaGrad on a bounded sample of
labelled rows: up to ``SAMPLE`` for each label, those whose hashed id comes first. Everything else covers all rows whole.

Edge cases: null and empty texts have statistics of nothing and get a score; rows without a label are scored alike; repeated rows
and ties score alike; with no labelled row of some label every score is the share of label 1 (0.5 with none at all); an empty
table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, raw, slices, table

BUCKETS, STEPS, FACTORS = 1 << 14, 12, 6
#: At most so many labelled rows of each label are learnt from.
SAMPLE = 4000
THRESHOLD = 0.7
STATS = ("words", "bytes", "mean_word", "distinct", "top_word", "symbol_ends", "punctuation", "upper", "digits", "symbols", "lines", "repeated_lines", "lone_marks", "high_bytes", "word_ends", "letters", "doubled")
#: Ranges over which each statistic is cut into steps; the first two are logarithms.
RANGES = {"words": (0, 12), "bytes": (0, 14), "mean_word": (0, 14), "symbol_ends": (0, 0.6), "punctuation": (0, 0.36), "digits": (0, 0.36), "symbols": (0, 0.24), "lines": (0, 0.24), "lone_marks": (0, 0.48), "top_word": (0, 0.6), "doubled": (0, 0.6)}

_CLASS = np.zeros(256, np.uint8)  # 0 control, 1 space, 2 line end, 3 lower, 4 upper, 5 digit, 6 sentence mark, 7 other symbol, 8 beyond ASCII
_CLASS[[9, 32]], _CLASS[[10, 13]] = 1, 2
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 3, 4, 5, 8
for _c in range(33, 127):
    if not _CLASS[_c]:
        _CLASS[_c] = 6 if chr(_c) in ".,;:!?'\"()-" else 7

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


class Buckets(dict):
    """Word -> bucket, kept while there is room."""

    def __missing__(self, word: bytes) -> int:
        bucket = zlib.crc32(word) % BUCKETS
        if len(self) < 100_000:
            self[word] = bucket
        return bucket


_buckets = Buckets()


def stats(data: bytes, words: list[bytes], counts: Counter) -> np.ndarray:
    """Structure statistics of a text, in the order of STATS."""
    kinds = np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=9).tolist()
    n, total = max(1, len(words)), max(1, len(data))
    lines = data.split(b"\n")
    ends = Counter([w[-1] for w in words])
    marks = sum(k for c, k in ends.items() if _CLASS[c] == 7)
    shouts = sum(ends.get(c, 0) for c in b"!?")
    letters = kinds[3] + kinds[4] + kinds[8]
    lone = sum(k for w, k in counts.items() if len(w) == 1 and _CLASS[w[0]] >= 6)
    return np.array([
        np.log1p(len(words)), np.log1p(len(data)), (len(data) - kinds[1] - kinds[2]) / n, len(counts) / n, max(counts.values(), default=0) / n, (marks + shouts) / n,
        kinds[6] / total, kinds[4] / max(1, kinds[3] + kinds[4]), kinds[5] / total, kinds[7] / total, (len(lines) - 1) / n, 1 - len(set(lines)) / len(lines), lone / n,
        kinds[8] / total, (ends.get(46, 0) + ends.get(44, 0)) / n, letters / total, sum(map(eq, words, words[1:])) / n])


def steps_of(value: float, low: float, high: float) -> int:
    return min(STEPS - 2, max(0, int((value - low) / (high - low) * (STEPS - 1))))


def features(data: bytes | None, meta: tuple = ()) -> tuple[np.ndarray, np.ndarray]:
    """Indices (distinct) and values of a text's features."""
    words = (data or b"").translate(_LOWER).split()
    counts = Counter(words)
    index = np.fromiter(map(_buckets.__getitem__, counts), np.int32, len(counts))
    if len(index):
        share = np.bincount(index, weights=np.fromiter(counts.values(), np.float64, len(counts)), minlength=0)
        index = np.flatnonzero(share).astype(np.int32)
        value = np.sqrt(share[index] / len(words))
    else:
        value = np.zeros(0)
    got = stats(data or b"", words, counts)
    on = [BUCKETS + k * STEPS + steps_of(got[k], *RANGES.get(name, (0, 1))) for k, name in enumerate(STATS)]
    for k, x in enumerate(meta, len(STATS)):
        on.append(BUCKETS + k * STEPS + (STEPS - 1 if x is None or x != x else steps_of(float(np.log1p(max(0.0, x))), 0, 16)))
    return np.concatenate([index, np.array(on, np.int32)]), np.concatenate([value, np.full(len(on), 0.5)]).astype(np.float32)


class Machine:
    """The factorisation machine."""

    def __init__(self, n_meta: int, seed: int = 7):
        n = BUCKETS + (len(STATS) + n_meta) * STEPS
        self.bias, self.linear = 0.0, np.zeros(n, np.float32)
        self.factors = (np.random.default_rng(seed).standard_normal((n, FACTORS)) * 0.02).astype(np.float32)

    def logit(self, index: np.ndarray, value: np.ndarray) -> float:
        spread = self.factors[index] * value[:, None]
        total = spread.sum(0)
        return float(self.bias + self.linear[index] @ value + 0.5 * (total @ total - (spread * spread).sum()))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 6, rate: float = 0.12, decay: float = 1e-4, seed: int = 11) -> None:
        order = np.random.default_rng(seed)
        linear_sum, factor_sum, bias_sum = np.full(len(self.linear), 0.05, np.float32), np.full(self.factors.shape, 0.05, np.float32), 0.05
        for _ in range(epochs):
            for i in order.permutation(len(rows)):
                index, value = rows[i]
                spread = self.factors[index] * value[:, None]
                total = spread.sum(0)
                z = self.bias + self.linear[index] @ value + 0.5 * (total @ total - (spread * spread).sum())
                slope = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[i]
                bias_sum += slope * slope
                self.bias -= rate * slope / np.sqrt(bias_sum)
                step = slope * value + decay * self.linear[index]
                linear_sum[index] += step * step
                self.linear[index] -= rate * step / np.sqrt(linear_sum[index])
                step = slope * value[:, None] * (total - spread) + decay * self.factors[index]
                factor_sum[index] += step * step
                self.factors[index] -= 0.5 * rate * step / np.sqrt(factor_sum[index])


def _feature_rows(rows: DataFrame, meta: tuple[str, ...]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            extra = list(zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True)) if meta else [()] * batch.num_rows
            got = [features(x, m) for x, m in zip(raw(batch.column(0)), extra, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([i.tobytes() for i, _ in got], pa.binary()), pa.array([v.tobytes() for _, v in got], pa.binary())], ["label", "index", "value"])

    return rows.mapInArrow(run, "label int, index binary, value binary")


def _meta(docs: DataFrame, meta: tuple[str, ...]) -> list:
    return [F.col(c).cast("double").alias(f"_meta{k}") for k, c in enumerate(meta)]


def train(docs: DataFrame, labels: DataFrame, meta: tuple[str, ...] = (), label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Machine:
    """Fit on at most ``sample`` rows of each label; what reaches the driver is their features alone.

    A document with several label rows counts once for each; rows with a null label or id are not learnt from.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"))
    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), *_meta(docs, meta))
    hashed = F.xxhash64(F.col("_id").cast("string"))
    chosen = None
    for label in (0, 1):
        some = known.where(F.col("_label") == label).orderBy(hashed, "_id").limit(sample)
        chosen = some if chosen is None else chosen.unionAll(some)
    # at most 2 x sample ids of 12 bytes: small enough to be sent to every executor
    found = texts.join(F.broadcast(chosen), "_id").select("_text", "_label", *[f"_meta{k}" for k in range(len(meta))])
    got = _feature_rows(found, meta).limit(4 * sample).collect()
    machine = Machine(len(meta))
    rows = sorted((x["label"], bytes(x["index"]), bytes(x["value"])) for x in got)
    truth = np.array([x[0] for x in rows], np.float64)
    if len(set(truth.tolist())) < 2:
        share = float(truth.mean()) if len(rows) else 0.5
        machine.factors[:], machine.bias = 0, float(np.log(max(share, 1e-3) / max(1 - share, 1e-3)))
        return machine
    # labels are far from equally frequent; equal weight would tilt scores, so the sample keeps the corpus's balance through the bias alone
    machine.fit([(np.frombuffer(i, np.int32), np.frombuffer(v, np.float32)) for _, i, v in rows], truth)
    return machine


def score(docs: DataFrame, machine: Machine, meta: tuple[str, ...] = (), text_col: str = "text", into: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score of each row."""
    from pyspark.sql.types import DoubleType, StructField, StructType

    shared = docs.sparkSession.sparkContext.broadcast(machine)  # of a fixed size, whatever the data
    kept = [c for c in docs.columns if c != into]
    taken = docs.select(*kept, F.col(text_col).alias("_text"), *_meta(docs, meta))
    place = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches, place):
            extra = list(zip(*(c.to_pylist() for c in batch.columns[place + 1 :]), strict=True)) if meta else [()] * batch.num_rows
            z = np.array([model.logit(*features(x, m)) for x, m in zip(raw(batch.column(place)), extra, strict=True)])
            yield pa.RecordBatch.from_arrays([*batch.columns[:place], pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))))], names=[*kept, into])

    return taken.mapInArrow(run, StructType([*docs.select(*kept).schema.fields, StructField(into, DoubleType())]))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, meta: tuple[str, ...] = ()) -> DataFrame:
    """The rows of ``docs`` that the classifier predicts as good, same columns."""
    columns = docs.columns
    return score(docs, train(docs, labels, meta), meta, into="_score").where(F.col("_score") >= threshold).select(*columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))
    machine = train(docs, labels.where(~held), ("n_chars",))
    scored = score(docs.select("doc_id", "text", "n_chars"), machine, ("n_chars",))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
