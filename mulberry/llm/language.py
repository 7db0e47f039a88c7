"""Language identification by sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased; character 1-, 2- and 3-grams are hashed into buckets. Inverse document frequencies are counted over all
training documents. A text's features are its n-grams' shares times their idf, scaled to a sum of one and by a constant. Weights
are fitted by follow-the-regularised-leader with elastic-net penalties, which leaves most at zero, on a bounded sample of the
training rows; a temperature fitted on another part of the sample then calibrates the probabilities.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; with no training row at all every text is ``und``; one
learned language gives that language; repeated rows and ties score alike; an empty table gives no rows; extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, slices, table

BITS = 16
BUCKETS = 1 << BITS
#: At most so many training rows of each language are fitted on, and half as many more calibrated on.
SAMPLE = 1500
SCALE = 30.0
UNKNOWN = "und"


def grams(text: str) -> np.ndarray:
    """Buckets of the 1-, 2- and 3-grams of a text, repeats included."""
    a = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(a):
        return np.zeros(0, np.int64)
    one = a * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ (a[1:] * np.uint32(0x85EBCA77) + np.uint32(0x165667B1))) * np.uint32(0xC2B2AE3D)
    three = (two[:-1] ^ (a[2:] * np.uint32(0x27D4EB2F) + np.uint32(0x9E3779B1))) * np.uint32(0x85EBCA6B)
    return (np.concatenate([one, two, three]) >> np.uint32(32 - BITS)).astype(np.int64)


def tf_idf(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets and their values."""
    seen, counts = np.unique(grams(text), return_counts=True)
    value = counts * idf[seen]
    return seen, SCALE * value / max(value.sum(), 1e-12)


class FtrlSoftmax:
    """Multinomial logistic regression by follow-the-regularised-leader: weights are worked out from sums, and are zero below the L1 penalty."""

    def __init__(self, languages: list[str], rate: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01):
        self.languages, self.rate, self.beta, self.l1, self.l2, self.temperature = languages, rate, beta, l1, l2, 1.0
        self.z, self.n = np.zeros((BUCKETS, len(languages))), np.zeros((BUCKETS, len(languages)))
        self.weights = np.zeros((BUCKETS, len(languages)), np.float32)

    def _weights(self, index: np.ndarray) -> np.ndarray:
        z = self.z[index]
        return np.where(np.abs(z) <= self.l1, 0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(self.n[index])) / self.rate + self.l2))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 2, seed: int = 5) -> None:
        order = np.random.default_rng(seed)
        for _ in range(epochs):
            for i in order.permutation(len(rows)):
                index, value = rows[i]
                now = self._weights(index)
                slope = softmax(value @ now)
                slope[labels[i]] -= 1
                step = value[:, None] * slope
                more = step * step
                self.z[index] += step - (np.sqrt(self.n[index] + more) - np.sqrt(self.n[index])) / self.rate * now
                self.n[index] += more
        self.weights = self._weights(np.arange(BUCKETS)).astype(np.float32)

    def calibrate(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> None:
        """The temperature with the least log loss, by golden-section search over its logarithm."""
        if not rows:
            return
        logits = np.array([value @ self.weights[index] for index, value in rows], np.float64)

        def loss(log_t: float) -> float:
            scaled = logits / np.exp(log_t)
            scaled -= scaled.max(1, keepdims=True)
            return float((np.log(np.exp(scaled).sum(1)) - scaled[np.arange(len(rows)), labels]).mean())

        low, high, ratio = -3.0, 3.0, (5**0.5 - 1) / 2
        for _ in range(40):
            a, b = high - ratio * (high - low), low + ratio * (high - low)
            low, high = (low, b) if loss(a) < loss(b) else (a, high)
        self.temperature = float(np.exp((low + high) / 2))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def document_frequencies(texts: DataFrame, text_col: str) -> tuple[int, np.ndarray]:
    """Documents, and documents of each bucket, over all rows: each task sums its own, one row a bucket reaches the shuffle from each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(BUCKETS, np.int64), 0
        for batch in slices(batches, 0):
            for text in batch.column(0).to_pylist():
                total[np.unique(grams(text))] += 1
                n += 1
        if n:
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], n))], ["bucket", "n"])

    counted = texts.select(text_col).where(F.col(text_col).isNotNull()).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out, n = np.zeros(BUCKETS), 0
    for bucket, k in counted.collect():  # at most BUCKETS + 1 rows
        if bucket < 0:
            n = k
        else:
            out[bucket] = k
    return n, out


def train(training: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", sample: int = SAMPLE) -> tuple[FtrlSoftmax, np.ndarray] | None:
    """Model and idf from rows with a text and a language. The sample: of each language the rows whose hashed id comes first."""
    known = training.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    n, frequency = document_frequencies(known, text_col)
    if not n:
        return None
    idf = np.log((1 + n) / (1 + frequency)) + 1
    languages = sorted(x[0] for x in known.select(lang_col).distinct().collect())
    hashed = F.xxhash64(F.col(id_col).cast("string"))
    keys, chosen = known.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"), hashed.alias("_hash")), None
    for language in languages:
        some = keys.where(F.col("_lang") == language).orderBy("_hash", "_id").limit(sample + sample // 2)
        chosen = some if chosen is None else chosen.unionAll(some)
    # at most 1.5 x sample ids for each language
    found = known.join(F.broadcast(chosen.select("_id", "_hash").where("_id is not null").distinct()), F.col(id_col) == F.col("_id")).select(F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang"), "_hash")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            got = [tf_idf(x, idf) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array([i.astype(np.int32).tobytes() for i, _ in got], pa.binary()), pa.array([v.astype(np.float32).tobytes() for _, v in got], pa.binary())], ["lang", "hash", "index", "value"])

    rows = found.mapInArrow(run, "lang string, hash long, index binary, value binary").limit(3 * sample * len(languages)).collect()
    model = FtrlSoftmax(languages)
    if len(languages) > 1 and rows:
        rows.sort(key=lambda x: (x["hash"], x["lang"], bytes(x["index"])))
        number = {x: i for i, x in enumerate(languages)}
        data = [(np.frombuffer(x["index"], np.int32), np.frombuffer(x["value"], np.float32)) for x in rows]
        labels = np.array([number[x["lang"]] for x in rows])
        held = np.arange(len(rows)) % 3 == 2
        model.fit([x for x, h in zip(data, held, strict=True) if not h], labels[~held])
        model.calibrate([x for x, h in zip(data, held, strict=True) if h], labels[held])
    return model, idf


def predict(docs: DataFrame, trained: tuple[FtrlSoftmax, np.ndarray] | None, text_col: str = "text") -> DataFrame:
    """All columns of ``docs``, with lang_pred and score."""
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType

    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = StructType([*docs.select(*kept).schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    if trained is None:
        return docs.select(*kept, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    model, idf = trained
    # the sums over n-grams of idf and of idf times weights are all that a prediction needs
    summed = np.concatenate([idf[:, None], idf[:, None] * model.weights], 1).astype(np.float32)
    shared = docs.sparkSession.sparkContext.broadcast((summed, model.languages, model.temperature))  # of a fixed size for each language
    place = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_, languages, temperature = shared.value
        for batch in slices(batches, place):
            names, scores = [], []
            for text in batch.column(place).to_pylist():
                if text is None or not any(map(str.isalpha, text)):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                at, total = grams(text), np.zeros(table_.shape[1])
                for low in range(0, len(at), 1 << 16):
                    total += table_[at[low : low + (1 << 16)]].sum(0, dtype=np.float64)
                chance = softmax(SCALE * total[1:] / max(total[0], 1e-12) / temperature)
                best = int(chance.argmax())
                names.append(languages[best])
                scores.append(float(chance[best]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:place], pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*kept, "lang_pred", "score"])

    return docs.select(*kept, F.col(text_col).alias("_text")).mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(crc_mod(doc_id, 3) == 1, F.lit(False))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    trained = train(docs.where(~held_out()))
    return predict(docs.select("doc_id", "text"), trained).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
