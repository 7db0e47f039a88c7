import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from mulberry.llm import bpe, token_files
from mulberry.llm.chunks import PieceStore, cut, pieces
from mulberry.llm.common import TEXT_BYTES, fresh_path

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def random_texts(n=3000):
    random.seed(3)
    letters = list("aeiounthsr  ''.,0123456789\n\n\t  éñß漢字か🙂 　\x85\x1c ABCdll-_!?")
    texts = ["".join(random.choice(letters) for _ in range(random.randint(0, 60))) for _ in range(n)]
    return texts + ["a" * k for k in range(0, 200, 7)] + [" " * k for k in range(30)] + ["ab" * 60, "hello <|endoftext|> x", "<|endoftext|>", " lead", "trail ", "a  b   c \n d", "don't we'll 'twas I'M", "-" * 333]


def test_pieces_join_again():
    for text in random_texts(500):
        assert " ".join(pieces(text)) == text


def test_texts_are_cut_as_one_by_one():
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    texts = [*random_texts(500), "", *(f"a{x}{y}b c" for x in spaces for y in (" ", "d")), *(f"a {x}b c" for x in spaces)]
    flat, bounds = cut(pa.array(texts))
    assert [flat.to_pylist()[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [pieces(x) for x in texts]


def test_pieces_in_use_outlast_those_seen_once():
    encoded = []

    def encode(texts):
        encoded.extend(texts)
        return [x.encode("utf-32-le") for x in texts]

    store = PieceStore(encode, kept=12)
    for i in range(40):
        texts = ["x" + " often" * (i % 2) + "".join(f" rare{i}-{j}" for j in range(3)), "x of"]
        assert store.ids(texts) == [x.encode("utf-32-le") for x in texts]
        assert len(store.known) + len(store.older) <= 12
    assert encoded.count(" often") == encoded.count(" of") == 1


def test_automaton_is_the_library(library):
    automaton, store = bpe.compiled(FILE)
    texts = random_texts()
    for text, ids in zip(texts, store.ids(texts), strict=True):
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected, text
        assert automaton.decode(ids) == library.decode(expected, skip_special_tokens=False)


def test_library_store(library):
    texts = random_texts(1000)
    for text, ids in zip(texts, token_files.library_store(FILE).ids(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_invalid_bytes_decode_with_replacement(library):
    automaton, _ = bpe.compiled(FILE)
    ids = library.encode("é🙂", add_special_tokens=False).ids
    assert automaton.decode(np.array(ids[:-1], "<u4").tobytes()) == library.decode(ids[:-1], skip_special_tokens=False)


def test_odd_documents(odd, none, library):
    expected = sorted(str((r["doc_id"], len(ids := library.encode(r["text"] or "", add_special_tokens=False).ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())) for r in odd.collect())
    assert sorted(str(tuple(r)) for r in bpe.digests(odd, FILE).collect()) == expected
    back = bpe.decode(bpe.encode(odd, FILE), FILE)
    assert sorted(r["text"] for r in back.collect()) == sorted(r["text"] or "" for r in odd.collect())
    assert bpe.digests(none, FILE).count() == 0 and bpe.encode(none, FILE).count() == 0


@pytest.mark.parametrize("width", range(1, 33))
def test_packing(width, tmp_path):
    rng = np.random.default_rng(width)
    lengths = [0, 1, 7, 500, 0, 93]
    ids = rng.integers(0, 1 << width, sum(lengths), dtype=np.uint64).astype(np.uint32)
    assert token_files.unpack(token_files.pack(ids, width), len(ids), width).tolist() == ids.tolist()
    (tmp_path / "x.bin").write_bytes(b"".join(token_files.shard_bytes([3, None, 5, 6, 7, 8], lengths, ids, width, block=37)))
    shard = token_files.Shard(f"file://{tmp_path}/x.bin")
    at = np.cumsum([0, *lengths])
    for i in range(len(lengths)):
        assert shard.document(i).tolist() == ids[at[i] : at[i + 1]].tolist()
    assert shard.ids(35, 300).tolist() == ids[35:300].tolist()
    with pytest.raises(ValueError):
        (tmp_path / "y.bin").write_bytes(b"nothing" * 20)
        token_files.Shard(f"file://{tmp_path}/y.bin")


def test_files_of_odd_documents(llm, odd, none, library):
    path = fresh_path(llm, "test-shards")
    shards = sorted(token_files.write_shards(odd, path, FILE, 50257).collect(), key=lambda x: x["part"])
    before, listing = 0, []
    for x in shards:
        listing.append((x["path"], before))
        before += x["n_ids"]
    got = [tuple(r) for r in token_files.read_shards(llm.createDataFrame(listing, "path string, before long")).orderBy("start").collect()]
    rows = [(r["doc_id"], [*library.encode(r["text"] or "", add_special_tokens=False).ids, 0]) for r in odd.collect()]
    assert len(got) == len(rows) and [g[0] for g in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    assert [g[1] for g in got] == np.cumsum([0, *[g[2] for g in got]])[:-1].tolist()
    assert sorted((str(g[0]), g[2], g[3]) for g in got) == sorted((str(i), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, ids in rows)
    assert token_files.write_shards(none, path + "-none", FILE, 50257).count() == 0


def test_queries(llm, sf_dir, library):
    rows = sorted((r["doc_id"], r["text"]) for r in llm.read.parquet(f"{sf_dir}/documents.parquet").collect())
    at, expected = 0, []
    for i, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        expected.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, token_files.query(llm, sf_dir).select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == expected
    assert {(r["doc_id"], r["n_tokens"] + 1) for r in bpe.query(llm, sf_dir).collect()} == {(i, n) for i, _, n, _ in expected}


def test_tasks_hold_few_ids_and_small_batches(llm, tmp_path, monkeypatch):
    """Packed blocks leave a task's memory as they come, whatever the size of its file."""
    most, pack = [], token_files.data_bytes
    monkeypatch.setattr(token_files, "data_bytes", lambda ids, width, block=token_files.BLOCK: most.append(len(ids)) or pack(ids, width, block))
    texts = [f"word{i} " * 2000 for i in range(60)]

    class Docs:
        """What ``write_shards`` asks of a DataFrame, with one task in this process."""

        def mapInArrow(self, run, schema):
            monkeypatch.setattr("pyspark.TaskContext.get", lambda: self)
            return list(run(iter([pa.RecordBatch.from_pydict({"doc_id": [i], "text": [t]}) for i, t in enumerate(texts)])))

        partitionId = lambda self: 0
        select = repartitionByRange = sortWithinPartitions = withColumn = lambda self, *_: self

    (row,) = token_files.write_shards(Docs(), f"file://{tmp_path}", FILE, 50257)
    shard = token_files.Shard(row.column(0)[0].as_py())
    ids = token_files.library_store(FILE).ids(texts)
    assert [shard.document(i).tobytes() for i in range(60)] == [x + bytes(4) for x in ids]
    assert sum(most) == shard.n_ids and max(most) < shard.n_ids // 10
    wide = llm.createDataFrame([(i, "x" * 100_000) for i in range(200)], "i long, text string").coalesce(1)
    sizes = wide.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long").collect()
    assert len(sizes) > 3 and max(r["n"] for r in sizes) < 2 * TEXT_BYTES


def test_words_of_all_lengths_are_encoded_together(monkeypatch):
    random.seed(11)
    path = public_tokenizers.path("byte_bpe_50k.json")
    automaton, library = bpe.Automaton(path), Tokenizer.from_file(path)
    words = ["".join(random.choice("etaoinshrdluETA") for _ in range(n)) for n in range(1, 40) for _ in range(20)] + ["9" * n for n in range(1, 30)] + ["é", "日本", "x"]
    calls, arcs = [], bpe.Automaton.arcs
    monkeypatch.setattr(bpe.Automaton, "arcs", lambda self, x, y: calls.append(len(x)) or arcs(self, x, y))
    short = [w for w in words if len(w.encode()) <= bpe.TOGETHER]
    assert automaton.encode_words([b"", *(w.encode() for w in short)]) == [[], *(library.encode(w, add_special_tokens=False).ids for w in short)]
    assert len(calls) <= bpe.TOGETHER * (bpe.TOGETHER + 1) // 2  # once for each place and end, not for each length as well
    assert automaton.encode_words([w.encode() for w in words]) == [library.encode(w, add_special_tokens=False).ids for w in words]
    pieces = [" one", "one", " 12", "12a", " a'll", "", " ", "  x", " é", " ab<|endoftext|>", "x\n"]
    assert [np.frombuffer(x, "<u4").tolist() for x in automaton.encode_pieces(pieces)] == [library.encode(x, add_special_tokens=False).ids for x in pieces]
    assert [np.frombuffer(x, "<u4").tolist() for x in automaton.encode_pieces(pieces[:9])] == [library.encode(x, add_special_tokens=False).ids for x in pieces[:9]]
