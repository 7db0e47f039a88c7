"""Language-model scoring of whole documents by a gated recurrent network (see ``gru``).

Words are counted over all training documents. The network's vocabulary is the ``VOCABULARY`` most frequent words and, for all others,
one token for each doubling of their count, and one for the rarest and unknown words; a word of such a token is scored as the token
times its smoothed share of the token's words, so that each text has a probability. These tokens grow in number with the counts.

Texts are looked up once; training and scoring read the tokens. Training goes over all training documents once, in ``ROUNDS`` parts:
in each part copies of the network are trained, each on the documents of one shard, and averaged by their numbers of tokens. A
document's shard and its place in it come from its id, and the number of shards from the number of tokens, so that the model does not
depend on how files are cut.

Counts of words have no bound: those of the ``HEAD`` most frequent words, a fixed number, are sent to every task; the others'
come by a join on the word.

Edge cases: a null or empty text has the end token alone; rows with a null id are learnt from; without any training token all
counts are zero and a base score is that of unknown tokens; repeated rows and ties score alike; an empty table gives no rows;
extra columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, raw, slices, table, written
from .gru import Gru, Trainer, groups

VOCABULARY, HEAD, ROUNDS = 4094, 200_000, 2
#: Distinct words counted in a task before their counts are passed on.
COUNTED = 400_000
#: Values in one piece of a network's parameters on their way to the average.
PIECE = 16_384
#: Training tokens of a shard, about, and tokens that a task scores at once.
SHARD, SCORED_AT_ONCE = 1_000_000, 4_000_000
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
TOKENS = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, head_log double, own_log double, tail array<struct<word:binary,n:long>>, tokens binary"


def words_of(data: bytes | None) -> list[bytes]:
    return (data or b"").translate(_LOWER).split()


def word_counts(texts: DataFrame) -> DataFrame:
    """word (binary), n over all rows of the column text; the empty word counts the rows, which are the end tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in slices(batches, 0):
            for data in raw(batch.column(0)):
                counts.update(words_of(data))
            counts[b""] += batch.num_rows
            if len(counts) > COUNTED:
                yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
                counts = Counter()
        if counts:
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    return texts.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Words(dict):
    """Frequent word -> its place by frequency; -1 for all others."""

    def __missing__(self, word: bytes) -> int:
        return -1


class Lexicon:
    """What every task needs of the counts; of a fixed size."""

    def __init__(self, words: list[bytes], counts: list[int], tokens: int, distinct: int, documents: int, vocabulary: int = VOCABULARY):
        self.words, self.counts = words, np.array(counts, np.float64)
        self.tokens, self.distinct, self.documents = tokens, distinct, documents
        self.inside = min(vocabulary, len(words))
        # token 1: words beyond the head; then one for each doubling of the counts of head words out of the vocabulary
        rest = self.counts[self.inside :]
        steps = np.log2(rest).astype(np.int64)
        highest = int(steps[0]) if len(steps) else 0
        lowest = int(steps[-1]) if len(steps) else 1
        self.steps = max(0, highest - lowest + 1)
        self.token_of = np.concatenate([np.arange(self.inside) + 2 + self.steps, highest - steps + 2]).astype(np.uint16)
        sums = np.bincount(highest - steps, weights=rest + 0.5, minlength=self.steps) if len(rest) else np.zeros(0)
        self.own_log = np.concatenate([np.zeros(self.inside), np.log10(rest + 0.5) - np.log10(sums[highest - steps])]) if len(rest) else np.zeros(self.inside)
        self.step_counts = np.bincount(highest - steps, weights=rest, minlength=self.steps) if len(rest) else np.zeros(0)
        self.outside = tokens - documents - float(self.counts.sum())
        self.outside_words = max(0, distinct - (documents > 0) - len(words))
        self.base_log = math.log10(tokens + 0.5 * (distinct + 1))
        self.outside_log = math.log10(self.outside + 0.5 * (self.outside_words + 1))
        self._index: Words | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_index": None}

    def places(self, words: list[bytes]) -> np.ndarray:
        if self._index is None:
            self._index = Words(zip(self.words, range(len(self.words)), strict=True))
        return np.fromiter(map(self._index.__getitem__, words), np.int32, len(words))

    def model_tokens(self, places: np.ndarray) -> np.ndarray:
        return np.where(places >= 0, np.append(self.token_of, np.uint16(1))[places], np.uint16(1))

    def model_counts(self) -> np.ndarray:
        return np.concatenate([[self.documents, self.outside], self.step_counts, self.counts[: self.inside]])


def lexicon(counts: DataFrame) -> Lexicon:
    """From written counts: their sums, and the most frequent words, at most HEAD, by falling count and then by their bytes.

    Counts fall into fixed steps (64 to a doubling), and the head takes whole steps from the highest while they fit: so what reaches the driver
    is one row for each step and then at most HEAD words in all, however many tasks there are. Words beyond the head come by the join.
    """
    total = counts.agg(F.sum("n"), F.count("*"), F.sum(F.when(F.octet_length("word") == 0, F.col("n")))).first()
    words = counts.where(F.octet_length("word") > 0).withColumn("step", F.floor(F.log2("n") * 64))
    least, held = None, 0
    for step, n in sorted(words.groupBy("step").count().collect(), reverse=True):  # at most 64 x 64 rows
        if held + n > HEAD:
            break
        least, held = step, held + n
    top = words.where(F.col("step") >= least).select("word", "n").collect() if held else []
    top = sorted(((bytes(x["word"]), x["n"]) for x in top), key=lambda x: (-x[1], x[0]))
    return Lexicon([w for w, _ in top], [n for _, n in top], int(total[0] or 0), int(total[1] or 0), int(total[2] or 0))


def tokenised(docs: DataFrame, words: Lexicon) -> DataFrame:
    """docs (doc_id, text, held_out) -> a written table of each document's tokens (TOKENS), its sums of logarithms, and its words beyond the head."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        lex = shared.value
        head_log, row = np.log10(lex.counts + 0.5), TaskContext.get().partitionId() << 40
        end_log, known_end = math.log10(lex.documents + 0.5), int(lex.documents > 0)
        for batch in slices(batches, 1, rows=4096):
            n_tokens, n_known, head, tail, tokens = [], [], [], [], []
            for data in raw(batch.column(1)):
                own = words_of(data)
                places = lex.places(own)
                missing = np.flatnonzero(places < 0)
                inside = places[places >= 0] if len(missing) else places
                n_tokens.append(len(own) + 1)
                n_known.append(len(inside) + known_end)
                # sums for the base score, and of the shares of words that have no token of their own; the rest comes by the join
                head.append((head_log[inside].sum() + end_log, lex.own_log[inside].sum() - len(missing) * lex.outside_log))
                tail.append([{"word": w, "n": n} for w, n in Counter([own[i] for i in missing.tolist()]).items()])
                tokens.append(lex.model_tokens(places).tobytes())
            head_base = np.array([x for x, _ in head]) - np.array(n_tokens) * lex.base_log
            rows = np.arange(row, row + batch.num_rows)
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays([
                pa.array(rows), batch.column(0), batch.column(2), pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array(head_base), pa.array([x for _, x in head]),
                pa.array(tail, pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))), pa.array(tokens, pa.binary())], ["row", "doc_id", "held_out", "n_tokens", "n_known", "head_log", "own_log", "tail", "tokens"])

    return written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "held_out").mapInArrow(run, TOKENS), "tokens")


def averaged(pieces: DataFrame) -> np.ndarray | None:
    """pieces (piece, salt, shard, weight, value) -> the weighted average of the shards' parameters, summed in two steps so that no task gets all copies."""

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("shard")  # one order of addition
        total = np.sum([np.frombuffer(x, np.float64) for x in rows["value"]], axis=0)
        return pd.DataFrame({"piece": [rows["piece"].iloc[0]], "shard": [rows["shard"].iloc[0]], "weight": [rows["weight"].sum()], "value": [total.tobytes()]})

    schema = "piece int, shard int, weight double, value binary"
    summed = pieces.groupBy("piece", "salt").applyInPandas(add, schema).groupBy("piece").applyInPandas(add, schema).collect()
    if not summed:
        return None
    return np.concatenate([np.frombuffer(x["value"], np.float64) / x["weight"] for x in sorted(summed, key=lambda x: x["piece"])])


def train(tokens: DataFrame, words: Lexicon, rounds: int = ROUNDS, shard: int | None = None) -> Gru:
    """tokens: columns doc_id and tokens of the training documents. ``shard``: tokens of a shard, about."""
    sc, model = tokens.sparkSession.sparkContext, Gru(words.model_counts())
    shards = max(1, -(-words.tokens // (rounds * (shard or SHARD))))
    hashed = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    turn = F.pmod(hashed, F.lit(rounds * shards))
    dealt = tokens.select(F.pmod(turn, F.lit(rounds)).alias("part"), F.floor(turn / rounds).cast("int").alias("shard"), hashed.alias("order"), "tokens")
    for part in range(rounds):
        shared = sc.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def copy() -> Trainer:
                own = Gru(np.ones(len(shared.value.class_of)))
                own.__dict__.update(bounds=shared.value.bounds, class_of=shared.value.class_of, p={k: x.copy() for k, x in shared.value.p.items()})
                return Trainer(own)

            def pieces(number: int, trainer: Trainer, n: int) -> pa.RecordBatch:
                flat = trainer.model.flat().astype(np.float64) * n
                cut = [flat[i : i + PIECE] for i in range(0, len(flat), PIECE)]
                return pa.RecordBatch.from_arrays([pa.array(range(len(cut)), pa.int32()), pa.array([number % 64] * len(cut), pa.int32()), pa.array([number] * len(cut), pa.int32()), pa.array([float(n)] * len(cut)), pa.array([x.tobytes() for x in cut], pa.binary())], ["piece", "salt", "shard", "weight", "value"])

            documents = ((number, np.frombuffer(x, np.uint16).astype(np.int32)) for batch in batches for number, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            for number, own in groupby(documents, key=itemgetter(0)):
                trainer = copy()
                n = sum(trainer.train(some) for some in groups(x for _, x in own))
                if n:
                    yield pieces(number, trainer, n)

        own = dealt.where(F.col("part") == part).repartition(shards, "shard").sortWithinPartitions("shard", "order", "tokens").select("shard", "tokens")
        flat = averaged(own.mapInArrow(run, "piece int, salt int, shard int, weight double, value binary"))
        if flat is not None:
            model.load(flat)
    return model


def score(tokens: DataFrame, model: Gru, words: Lexicon, counts: DataFrame) -> DataFrame:
    """tokens (``tokenised``) -> doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    shared = tokens.sparkSession.sparkContext.broadcast(model)
    passed = ["row", "doc_id", "held_out", "n_tokens", "n_known", "head_log"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def scored() -> Iterator[pa.RecordBatch]:
            documents = [np.frombuffer(x, np.uint16) for batch in held for x in batch.column(7).to_pylist()]
            logs, at = shared.value.score(documents) / math.log(10), 0
            for batch in held:
                own = logs[at : at + batch.num_rows] + batch.column(6).to_numpy()
                at += batch.num_rows
                yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(own)], [*passed, "network"])

        size = 0
        for whole in batches:
            for batch in slices(iter([whole]), 7, rows=100_000, most=2 * SCORED_AT_ONCE):
                held.append(batch)
                size += batch.column(7).nbytes // 2
                if size > SCORED_AT_ONCE:
                    yield from scored()
                    held, size = [], 0
        if held:
            yield from scored()

    out = tokens.select(*passed, "own_log", "tokens").mapInArrow(run, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, head_log double, network double")
    rest = tokens.select("row", F.explode("tail").alias("t")).select("row", "t.word", "t.n").join(counts.select("word", F.col("n").alias("c")), "word", "left")
    summed = rest.groupBy("row").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.5))).alias("tail_log"), F.sum(F.when(F.col("c") > 0, F.col("n"))).alias("tail_known"))
    more = F.coalesce("tail_log", F.lit(0.0))
    return written(out, "scored").join(summed, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"), F.lit(words.tokens).cast("long").alias("train_tokens"),
        (F.col("head_log") + more).alias("base_score"), (F.col("network") + more).alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.coalesce(crc_mod("doc_id", 5) == 1, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held.alias("held_out"))
    counts = written(word_counts(docs.where("not held_out").select("text")), "words")
    words = lexicon(counts)
    tokens = tokenised(docs, words)
    return score(tokens, train(tokens.where("not held_out"), words), words, counts)
