"""Byte-pair encoding and decoding by a tokenization automaton.

The states of the automaton are "just after token t" and the start; an arc labelled with a token leads to the state after it.
Before any merge there is an arc for every byte from every state. The merges are applied in order of rank, each as a gadget:
merging u v into w

- adds the state after w with the arcs that the state after v has at that moment,
- adds an arc labelled w to each state that has an arc u, where the state after u has an arc v,
- removes the arc v from the state after u (and, if u = v, gives that state no arc w).

What is left accepts, for each string of bytes, just the one sequence of tokens that byte-pair encoding gives. As every gadget
copies one row and one column, the table of arcs is kept as where each state was copied from and when: the arc x y holds if its
original held when the younger of x and y was made, and no merge of x y was applied since. Spellings of tokens are kept as a trie
of byte transitions. Both are tables that numpy reads for many words at once: from each place of a word that a token ends at,
the trie is walked, and an arc that the automaton has puts the next token's end. Each prefix has one such path.

Decoding emits the label of each arc: the bytes of the tokens, joined, as UTF-8 with replacement characters where invalid.

Edge cases: a null or empty text has no ids; a special token's own spelling inside a text becomes its id, as in the library's
default; repeated rows and ties are encoded alike; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunks import PieceStore
from .common import slices, table

#: The pre-tokenisation pattern that byte-level files of this kind imply (``use_regex``).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words up to so many bytes are encoded together; longer ones one by one with the same tables.
TOGETHER = 24
#: Encoded words kept in memory by a worker.
KEPT_WORDS = 300_000
FOREVER = np.int32(2**31 - 1)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 as itself, others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class IntTable:
    """A hash table from non-negative 64-bit to 32-bit integers that is read for whole arrays; -1 where a key is missing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(len(keys) * 3).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = keys[left[free]]  # of several for one slot the last wins
            won = self.keys[slot] == keys[left]
            self.values[slot[won]] = values[left[won]]
            left, slot = left[~won], (slot[~won] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], np.int32(-1))
        more = np.flatnonzero((found != keys) & (found != -1))
        while len(more):
            slot[more] = (slot[more] + 1) & self.mask
            found = self.keys[slot[more]]
            hit = found == keys[more]
            out[more[hit]] = self.values[slot[more[hit]]]
            more = more[~hit & (found != -1)]
        return out


class Automaton:
    def __init__(self, tokenizer_file: str):
        with open(tokenizer_file, encoding="utf-8") as file:
            described = json.load(file)
        model, letters = described["model"], byte_letters()
        vocabulary, merges = model["vocab"], [x if isinstance(x, list) else x.split(" ") for x in model["merges"]]
        self.special = {x["content"]: x["id"] for x in described.get("added_tokens", [])}
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        n = max([*vocabulary.values(), *self.special.values()]) + 1
        self.labels: list[bytes] = [b""] * n
        for spelled, i in vocabulary.items():
            self.labels[i] = bytes(letters[c] for c in spelled)
        for spelled, i in self.special.items():
            self.labels[i] = spelled.encode()
        self.left, self.right = np.full(n, -1, np.int32), np.full(n, -1, np.int32)
        self.born = np.full(n, -1, np.int32)
        pairs = np.zeros(len(merges), np.int64)
        for time, (u, v) in enumerate(merges):
            x, y, w = vocabulary[u], vocabulary[v], vocabulary[u + v]
            self.left[w], self.right[w], self.born[w], pairs[time] = x, y, time, x * n + y
        self.n, self.removed = n, IntTable(pairs, np.arange(len(merges), dtype=np.int32))
        self._spell([(self.labels[i], i) for i in vocabulary.values()])
        self.split = regex.compile(SPLIT)
        self.words = self._special_words()

    def _spell(self, spelled: list[tuple[bytes, int]]) -> None:
        """The trie: transitions node * 256 + byte -> node, and the token that each node spells."""
        nodes: dict[bytes, int] = {b"": 0}
        keys, to = [], []
        for text, _ in sorted(spelled):
            for end in range(1, len(text) + 1):
                if (head := text[:end]) not in nodes:
                    nodes[head] = len(nodes)
                    keys.append(nodes[text[: end - 1]] * 256 + text[end - 1])
                    to.append(nodes[head])
        self.steps = IntTable(np.array(keys, np.int64), np.array(to, np.int32))
        self.token = np.full(len(nodes), -1, np.int32)
        for text, i in spelled:
            self.token[nodes[text]] = i

    def arcs(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether the state after each x has an arc y. x = -1: the start, which has all."""
        has = np.ones(len(x), bool)
        at = np.flatnonzero(x >= 0)
        x, y = x[at].astype(np.int64), y[at].astype(np.int64)
        limit = np.full(len(at), FOREVER, np.int32)
        while len(at):
            time = self.removed.get(x * self.n + y)
            gone = (time >= 0) & (time < limit)
            bx, by = self.born[x], self.born[y]
            young = np.maximum(bx, by)
            twin = (by > bx) & (self.left[y] == self.right[y]) & (x == self.left[y])  # after u there is no u u
            has[at[gone | twin]] = False
            keep = ~(gone | twin) & (young >= 0)
            at, x, y, bx, by, young = at[keep], x[keep], y[keep], bx[keep], by[keep], young[keep]
            limit = young
            x, y = np.where(bx == young, self.right[x], x).astype(np.int64), np.where(by == young, self.left[y], y).astype(np.int64)
        return has

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Ids of pre-split words."""
        out: list[list[int]] = [[]] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-sizes, kind="stable")
        long = int((sizes > TOGETHER).sum())
        for i in order[:long].tolist():
            out[i] = self._path(words[i])
        short = order[long : long + int(((sizes > 0) & (sizes <= TOGETHER)).sum())]
        for low in range(0, len(short), 20_000):
            part = short[low : low + 20_000].tolist()
            for i, ids in zip(part, self._paths([words[i] for i in part]), strict=True):
                out[i] = ids
        return out

    def _paths(self, words: list[bytes]) -> list[list[int]]:
        """Words of many lengths, the longest first: those that reach a place are the first rows."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        rows, n = len(words), int(lengths[0])
        grid = np.frombuffer(b"".join([w.ljust(n, b"\0") for w in words]), np.uint8).reshape(-1, n)
        longer = np.searchsorted(-lengths, -np.arange(n))  # rows with more bytes than 0, 1, ...
        last, back = np.full((n + 1, rows), -1, np.int32), np.zeros((n + 1, rows), np.int32)
        for start in range(n):
            at = np.flatnonzero(last[start, : longer[start]] >= 0) if start else np.arange(rows)
            node = np.zeros(len(at), np.int64)
            for end in range(start, n):
                reach = int(np.searchsorted(at, longer[end]))
                at = at[:reach]
                if not reach:
                    break
                node = self.steps.get(node[:reach] * 256 + grid[at, end])
                on = node >= 0
                at, node = at[on], node[on].astype(np.int64)
                token = self.token[node]
                whole = np.flatnonzero(token >= 0)
                good = whole[self.arcs(last[start, at[whole]], token[whole])]
                last[end + 1, at[good]], back[end + 1, at[good]] = token[good], start
        ends, tokens = lengths, []
        every = np.arange(rows)
        while (ends > 0).any():
            tokens.append(np.where(ends > 0, last[ends, every], -1))
            ends = back[ends, every]
        table = np.array(tokens[::-1]).T.tolist()
        return [[t for t in ids if t >= 0] for ids in table]

    def _path(self, word: bytes) -> list[int]:
        """The same for one long word: every token that spells on from each place, checked together."""
        octets, n = np.frombuffer(word, np.uint8).astype(np.int64), len(word)
        node, at, spelled = np.zeros(n, np.int64), np.arange(n), []
        length = 0
        while len(at):
            keep = at + length < n
            at, node = at[keep], node[keep]
            node = self.steps.get(node * 256 + octets[at + length])
            on = node >= 0
            at, node, length = at[on], node[on].astype(np.int64), length + 1
            token = self.token[node]
            whole = token >= 0
            spelled.append(np.stack([at[whole], at[whole] + length, token[whole]], 1))
        found = np.concatenate(spelled)
        found = found[np.lexsort((found[:, 1], found[:, 0]))].tolist()
        last, back = [-1] * (n + 1), [0] * (n + 1)
        one = lambda x, y: x < 0 or self._arc(x, y)
        for start, end, token in found:
            if last[end] < 0 and one(last[start], token):
                last[end], back[end] = token, start
        ids = []
        while n:
            ids.append(last[n])
            n = back[n]
        return ids[::-1]

    def _arc(self, x: int, y: int) -> bool:
        return bool(self.arcs(np.array([x]), np.array([y]))[0])

    def encode_pieces(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers: special tokens cut out, the rest pre-split into words, each word encoded once."""
        split = self.split.findall
        if self.cut_special is not None and self.cut_special.search("\n".join(texts)):
            cut = [self._words(x) for x in texts]
        else:  # letters or digits alone, perhaps after a space, are one word
            cut = [[x] if x.isascii() and ((own := x.removeprefix(" ")).isalpha() or own.isdigit()) else split(x) for x in texts]
        new = set(chain.from_iterable(cut)).difference(self.words)
        if len(self.words) + len(new) > KEPT_WORDS:  # a full store is emptied, which changes no result
            self.words, new = self._special_words(), set(chain.from_iterable(cut)).difference(self.special)
        fresh = list(new)
        coded = self.encode_words([w.encode() for w in fresh])
        flat = np.fromiter(chain.from_iterable(coded), "<u4").tobytes()
        ends = np.cumsum([4 * len(ids) for ids in coded]).tolist()
        self.words.update(zip(fresh, (flat[x:y] for x, y in zip([0, *ends], ends, strict=False)), strict=True))
        known = self.words
        for words in cut:
            yield known[words[0]] if len(words) == 1 else b"".join([known[w] for w in words])

    def _words(self, text: str) -> list[str]:
        """Pre-split words of a text and the special tokens spelled in it."""
        return [w for part in self.cut_special.split(text) for w in ([part] if part in self.special else self.split.findall(part))]

    def _special_words(self) -> dict[str, bytes]:
        return {x: i.to_bytes(4, "little") for x, i in self.special.items()}

    def decode(self, ids: bytes) -> str:
        labels = self.labels
        return b"".join([labels[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


_automata: dict[str, tuple[Automaton, PieceStore]] = {}


def compiled(tokenizer_file: str) -> tuple[Automaton, PieceStore]:
    """A worker's automaton, compiled once, and its store of encoded pieces."""
    if tokenizer_file not in _automata:
        automaton = Automaton(tokenizer_file)
        _automata[tokenizer_file] = automaton, PieceStore(automaton.encode_pieces)
    return _automata[tokenizer_file]


def encode(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (binary: little-endian unsigned 32-bit integers) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, store = compiled(tokenizer_file)
        for batch in slices(batches, 1):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(store.ids(batch.column(1).to_pylist()), pa.binary())], ["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(run, "doc_id long, ids binary")


def decode(coded: DataFrame, tokenizer_file: str) -> DataFrame:
    """Adds text, the decoded ids; rows with doc_id and ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, _ = compiled(tokenizer_file)
        for batch in slices(batches, 1):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([automaton.decode(x or b"") for x in batch.column(1).to_pylist()])], ["doc_id", "ids", "text"])

    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")


def digests(docs: DataFrame, tokenizer_file: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, and ids if asked for: made and hashed in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, store = compiled(tokenizer_file)
        for batch in slices(batches, 1):
            coded = store.ids(batch.column(1).to_pylist())
            columns = {
                "doc_id": batch.column(0), "n_tokens": pa.array([len(x) // 4 for x in coded], pa.int64()), "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in coded]),
                "decoded_sha256": pa.array([hashlib.sha256(automaton.decode(x).encode()).hexdigest() for x in coded])}
            yield pa.RecordBatch.from_pydict(columns | ({"ids": pa.array(coded, pa.binary())} if with_ids else {}))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
