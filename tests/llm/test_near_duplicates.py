import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from helpers import components, lower, words

from mulberry.llm import covertree, simhash, substrings
from mulberry.llm.bwt_merge import repeated


def fingerprint(text):
    w = words(lower(text))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(odd):
    got = {(str(r["doc_id"]), r["text"]): r["_fp"] % 2**64 for r in simhash.fingerprints(odd).collect()}
    for (_, text), fp in list(got.items()):
        if len(text or "") < 20_000:
            assert fp == fingerprint(text)


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_links_against_all_pairs(llm, bits):
    random.seed(bits)
    fps = {0, 2**64 - 1}
    for _ in range(150):
        x = random.getrandbits(64)
        for _ in range(4):
            fps.add(x)
            for _ in range(random.randint(1, 3)):
                x ^= 1 << random.randrange(64)
    signed = [x - 2**64 if x >> 63 else x for x in sorted(fps)]
    got = {frozenset(map(int, r)) for r in simhash.links(llm.createDataFrame([(x,) for x in signed], "fp long"), bits).collect()}
    assert got == {frozenset((a, b)) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) % 2**64).bit_count() <= bits}


def test_components_of_a_chain_and_a_star(llm):
    from mulberry.llm.components import components as spark_components

    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 400)] + [(5, 5)]
    got = dict(tuple(r) for r in spark_components(llm.createDataFrame(edges, "a long, b long").repartition(7)).collect())
    assert got == {i: 0 for i in range(1, 301)} | {1000 + i: 1000 for i in range(1, 400)}
    assert spark_components(llm.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_query(llm, sf_dir):
    rows = sorted((r["doc_id"], r["text"]) for r in llm.read.parquet(f"{sf_dir}/documents.parquet").collect())
    fps = [fingerprint(t) for _, t in rows]
    least = components(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3])
    assert {tuple(r) for r in simhash.query(llm, sf_dir).collect()} == {(rows[i][0], f"{fps[i]:016x}", rows[least[i]][0]) for i in range(len(rows))}


def test_keep_one(odd, none):
    kept = simhash.keep_one(odd)
    rows = odd.collect()
    fps = [fingerprint(r["text"]) for r in rows]
    least = components(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3])
    assert kept.columns == odd.columns and kept.count() == len(set(least))
    groups = {}
    for r, g in zip(rows, least, strict=True):
        groups.setdefault(g, []).append(r["doc_id"])
    expected = sorted(str(min((i for i in ids if i is not None), default=None)) for ids in groups.values())
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == expected
    assert simhash.keep_one(none).count() == 0


def near_texts():
    """Texts with copies of which a few words were changed, so that similarities lie on both sides of 0.8."""
    random.seed(11)
    texts = ["", "one", "One ", "two words"]
    for _ in range(25):
        base = [f"w{random.randrange(5000)}" for _ in range(random.randint(60, 300))]
        texts.append(" ".join(base))
        for _ in range(5):
            changed = list(base)
            for _ in range(random.randint(1, max(1, len(base) // 40))):
                changed[random.randrange(len(base))] = f"x{random.randrange(5000)}"
            texts.append(" ".join(changed))
    return texts


def five_words(text):
    w = words(lower(text))
    return {" ".join(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {" ".join(w)} if w else set()


def jaccard_pairs(texts):
    sets = [five_words(t) for t in texts]
    return [(i, j) for i, x in enumerate(sets) for j, y in enumerate(sets[:i]) if 5 * len(x & y) >= 4 * len(x | y)]


@pytest.mark.parametrize("members", [500_000, 30])
def test_candidates_against_all_pairs(llm, monkeypatch, members):
    random.seed(5)
    monkeypatch.setattr(simhash, "MEMBERS", members)
    fps = []
    for _ in range(60):
        x = random.getrandbits(64)
        for _ in range(4):
            y = x
            for bit in random.sample(range(64), random.randint(0, 14)):
                y ^= 1 << bit
            fps.append(((y - 2**64 if y >> 63 else y), random.getrandbits(63)))
    expected = {(j, i) for i, x in enumerate(fps) for j, y in enumerate(fps[:i]) if any(((p ^ q) % 2**64).bit_count() <= 11 for p, q in zip(x, y, strict=True))}
    distinct = llm.createDataFrame([(i, list(x), i, bytearray(8 * simhash.SKETCH)) for i, x in enumerate(fps)], "_set long, _fps array<long>, root long, sketch binary")
    assert {(r["a"], r["b"]) for r in simhash.candidates(distinct, similarity=0.8).collect()} == expected
    some = [tuple(sorted((r["a"], r["b"]))) for r in simhash.candidates(distinct).collect()]
    assert set(some) <= expected and {i for pair in some for i in pair} == {i for pair in expected for i in pair}
    span = {(r["a"], r["b"]) for r in simhash.candidates(distinct, similarity=0.8, spanning=True).collect()}
    assert span <= expected and components(len(fps), span) == components(len(fps), expected)
    joined = distinct.selectExpr("_set", "_fps", "_set div 8 as root", "sketch")
    assert {(r["a"], r["b"]) for r in simhash.candidates(joined, similarity=0.8).collect()} == {(a, b) for a, b in expected if a // 8 != b // 8}


def test_sketches_only_exclude_what_is_not_similar():
    rng = np.random.default_rng(2)
    excluded = 0
    for n in (1, 5, 150, 4000):
        for _ in range(60):
            x = np.unique(rng.integers(0, 2**64, n, np.uint64))
            y = np.unique(np.concatenate([x[rng.random(len(x)) > rng.random() * 0.4], rng.integers(0, 2**64, int(rng.random() * 0.3 * n), np.uint64)]))
            both = len(np.intersect1d(x, y))
            may = simhash.may_be_similar(*(np.frombuffer(simhash.sketch(s), np.int64)[None] for s in (x, y)), 0.8)[0]
            assert may or both < 0.8 * (len(x) + len(y) - both)
            excluded += not may
    assert excluded > 60


def test_candidates_in_long_runs(llm, monkeypatch):
    """Cells with more members than are compared row by row."""
    random.seed(6)
    base = random.getrandbits(63)
    fps = [[base ^ sum(1 << b for b in random.sample(range(63), random.randint(0, 8)))] for _ in range(900)]
    distinct = llm.createDataFrame([(i, x, i, bytearray(8 * simhash.SKETCH)) for i, x in enumerate(fps)], "_set long, _fps array<long>, root long, sketch binary")
    pairs = [(r["a"], r["b"]) for r in simhash.candidates(distinct, similarity=0.8).collect()]
    assert len(pairs) == len(set(pairs))  # one fingerprint finds a pair once
    span = [(r["a"], r["b"]) for r in simhash.candidates(distinct, similarity=0.8, spanning=True).collect()]
    assert components(900, span) == components(900, pairs) and len(span) < 900 * 40 < len(pairs)
    assert set(pairs) == {(j, i) for i, x in enumerate(fps) for j, y in enumerate(fps[:i]) if (x[0] ^ y[0]).bit_count() <= 11}


@pytest.mark.parametrize("values", [4 << 20, 3000])
def test_a_group_alike_but_not_similar_makes_few_rows(llm, monkeypatch, values):
    """Sets that are all candidates of each other, few of them similar: rows grow with the sets, and links join what all similar pairs do."""
    monkeypatch.setattr(simhash, "VALUES", values)
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**64, 40, np.uint64)
    sets = [np.unique(np.concatenate([base[: 40 - i % 2], rng.integers(0, 2**64, 5 + i % 3, np.uint64)])) for i in range(120)]
    sets += [np.unique(np.concatenate([x[1:], rng.integers(0, 2**64, 1, np.uint64)])) for x in sets[:30]]
    n, fps = len(sets), [[i % 7, 1 << i % 5] for i in range(len(sets))]
    pairs = [(i, j) for i in range(n) for j in range(i) if 5 * (both := len(np.intersect1d(sets[i], sets[j]))) >= 4 * (len(sets[i]) + len(sets[j]) - both)]
    distinct = llm.createDataFrame([(i, fps[i], i, bytearray(simhash.sketch(x))) for i, x in enumerate(sets)], "_set long, _fps array<long>, root long, sketch binary")
    hashes = llm.createDataFrame([(i, bytearray(x.tobytes())) for i, x in enumerate(sets)], "_set long, _hashes binary")
    assert 0 < len(set(components(n, pairs))) - 1 and len(pairs) > 0
    met = simhash.meetings(distinct, similarity=0.8).cache()
    got = [tuple(r) for r in simhash.met_links(met, distinct, hashes, similarity=0.8).collect()]
    assert {(b, a) for a, b in got} <= set(pairs) and components(n, got) == components(n, pairs)
    blocks = {(r["key"], r["x"], r["y"]) for r in met.collect()}
    bundles = len({k for k, _, _ in blocks})
    assert met.count() <= n * bundles * (1 if values > 3000 else len(blocks) // bundles + 1)
    assert (len(blocks) > bundles) == (values == 3000)

def test_a_cover_names_every_member_with_another():
    rng = np.random.default_rng(4)
    for n in (2, 3, 6, 40):
        for _ in range(200):
            code = np.triu(rng.integers(0, 5, (n, n)) << 32 | np.arange(n * n).reshape(n, n), 1)
            code = np.where(rng.random((n, n)) < 2 / n, code, 0)
            code = np.maximum(code, code.T)
            code[code == 0] = 2**62
            nearest = np.where(code.min(1) < 2**62, code.argmin(1), -1)
            some, rows = set(np.flatnonzero(nearest >= 0).tolist()), simhash._cover(nearest)
            assert {*rows.tolist(), *nearest[rows].tolist()} == some and len(rows) <= max(0, len(some) - 1)


def test_near_stage_against_brute_force(llm, sf_dir):
    import corpus_pipeline

    texts = near_texts()
    pairs = jaccard_pairs(texts)
    fps = [fingerprint(t) for t in texts]
    assert sum((fps[i] ^ fps[j]).bit_count() > 3 for i, j in pairs) > len(pairs) // 2  # what 3 bits of 3 words miss
    docs = llm.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"] for r in corpus_pipeline.simhash_stage(llm, docs.repartition(5), sf_dir).collect()}
    whole = set(components(len(texts), pairs))
    assert whole <= kept  # nothing that is not similar is dropped
    assert len(kept - whole) <= 0.02 * (len(texts) - len(whole))


def test_keep_near_of_odd_rows(odd, none):
    kept, rows = simhash.keep_near(odd), odd.collect()
    least = components(len(rows), jaccard_pairs([r["text"] for r in rows]))
    assert kept.columns == odd.columns and kept.count() == len(set(least))
    assert simhash.keep_near(none).count() == 0


@pytest.mark.parametrize("work", [lambda spark, d: simhash.query(spark, d), lambda spark, d: simhash.keep_near(spark.read.parquet(f"{d}/documents.parquet"))])
def test_no_table_is_broadcast(llm, monkeypatch, sf_dir, work):
    """Tables that grow with the documents stay off the driver, also under Spark's own threshold."""
    from mulberry.llm import components as steps

    assert llm.conf.get("spark.sql.autoBroadcastJoinThreshold") == "10485760b"
    plans, write = [], simhash.written

    def spy(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(simhash, "written", spy)
    monkeypatch.setattr(steps, "written", spy)
    spy(work(llm, sf_dir), "test-plans")
    assert any("SortMergeJoin" in x for x in plans) and not any("Broadcast" in x for x in plans)


def test_near_candidates_lie_in_a_grid_of_popcounts(llm):
    """Swapping the two bits of segments changes no popcount, so no cell: such pairs meet however many bits of their group differ."""
    random.seed(8)
    fps = [random.getrandbits(63) for _ in range(300)]
    assert simhash.embeddings(np.array(fps)).tolist() == [r["e"] for r in llm.createDataFrame([(x,) for x in fps], "fp long").select(simhash.embedding(simhash.F.col("fp")).alias("e")).collect()]
    cells = np.array([simhash.embeddings(np.array(fps)) >> 16 * g & 0xFFFF for g in range(4)])
    swapped = np.array([x >> 1 & 0x1555555555555555 | (x & 0x1555555555555555) << 1 for x in fps])
    assert (np.array([simhash.embeddings(swapped) >> 16 * g & 0xFFFF for g in range(3)]) == cells[:3]).all()
    place = {(number, row): set() for number in range(4) for row in range(300)}
    for number, rows, keys in simhash._bundle_keys(np.array(fps)[:, None], 4):
        for row, key in zip(rows.tolist(), keys.tolist(), strict=True):
            place[number, row].add(key)
    for (number, row), keys in place.items():
        own = int(cells[number, row]) >> 12
        popcounts = [(key & 3).bit_count() + (key >> 2).bit_count() for key in keys]
        assert own in keys and all(key & 3 != 2 and key >> 2 != 2 for key in keys) and max(abs(x - own.bit_count()) for x in popcounts) <= 1


def brute_repeats(strings, weights, length):
    counts = Counter()
    for s, w in zip(strings, weights, strict=True):
        for i in range(len(s) - length + 1):
            counts[s[i : i + length]] += w
    return [{i for i in range(len(s) - length + 1) if counts[s[i : i + length]] >= 2} for s in strings]


@pytest.mark.parametrize("letters", [b"a", b"ab", b"abcdefgh", bytes(range(256))])
def test_bwt_merge(letters):
    random.seed(len(letters))
    some = lambda n: bytes(random.choice(letters) for _ in range(n))
    for _ in range(40):
        length = random.choice([10, 20, 40])
        pool = [some(random.randint(length, 3 * length)) for _ in range(4)]
        strings = [some(random.randint(0, length)) + random.choice(pool) + some(random.randint(0, length)) for _ in range(random.randint(1, 12))]
        weights = [random.choice([1, 1, 1, 2]) for _ in strings]
        got = repeated(strings, np.array(weights), length, shards=random.choice([1, 2, 3, 4]))
        assert [{i for a, b in ranges for i in range(a, b)} for ranges in got] == brute_repeats(strings, weights, length)


@pytest.mark.parametrize(("length", "width"), [(200, 25), (40, 20), (25, 25), (24, 8)])
def test_wide_symbols_are_ranked_as_their_bytes(length, width):
    from mulberry.llm.bwt_merge import _symbols

    random.seed(length)
    strings = [bytes(random.choice(b"\0\1\xff") for _ in range(random.randint(length, 3 * length))) for _ in range(6)]
    strings += [strings[0][3:] + strings[1], b"\0" * length, b"\xff" * (length + 5)]
    data, stops = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8), np.cumsum([len(x) + 1 for x in strings])
    starts = stops - [len(x) + 1 for x in strings]
    q, ranks = _symbols(data, stops - 1, starts, length)
    spelled = {int(a) + i: x[i : i + q] for a, x in zip(starts, strings, strict=True) for i in range(len(x) - q + 1)}
    order = {x: i for i, x in enumerate(sorted(set(spelled.values())))}
    assert q == width and np.unique(ranks[[*spelled]], return_inverse=True)[1].tolist() == [order[x] for x in spelled.values()]
    got = repeated(strings, np.ones(len(strings)), length)
    assert [{i for a, b in ranges for i in range(a, b)} for ranges in got] == brute_repeats(strings, [1] * len(strings), length)


@pytest.mark.parametrize("most", [600, 1 << 18])
def test_segments_and_division(most):
    random.seed(9)
    some = lambda n: bytes(random.choice(b"abcdef ") for _ in range(n))
    passages = [some(random.randint(150, 500)) for _ in range(3)]
    texts = [b"".join(some(random.randint(0, 250)) + random.choice(passages)[: random.randint(100, 500)] for _ in range(3)) for _ in range(25)] + [b"ab" * 300, b"ab" * 180, b"a" * 450]
    groups = {}
    for d, text in enumerate(texts):
        if len(text) >= 200:
            for value, first, n, at in zip(*(x.tolist() for x in substrings.segments_of(text, 200)), strict=True):
                groups.setdefault(value, []).append(([((d, first), 0)], text[first : first + n + 199], n, at, 1))
    got = [set() for _ in texts]
    for group in groups.values():
        for part in substrings.divided(group, 200, most):
            for (owners, *_), ranges in zip(part, repeated([x[1] for x in part], np.array([x[4] for x in part]), 200), strict=True):
                for (d, first), cut in owners:
                    for a, b in ranges:
                        got[d].update(range(first + cut + a, first + cut + b))
    assert got == brute_repeats(texts, [1] * len(texts), 200)


def removed(texts, length=200):
    out = []
    for text, starts in zip(texts, brute_repeats(texts, [1] * len(texts), length), strict=True):
        gone = np.zeros(len(text) + 1, bool)
        for i in starts:
            gone[i : i + length] = True
        out.append((bytes(np.frombuffer(text, np.uint8)[~gone[:-1]]), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum())))
    return out


def test_substring_query(llm, sf_dir):
    import hashlib

    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in llm.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    expected = {(i, len(t), n, spans, hashlib.sha256(kept).hexdigest()) for (i, t), (kept, n, spans) in zip(rows, removed([t for _, t in rows]), strict=True)}
    assert {tuple(r) for r in substrings.query(llm, sf_dir).collect()} == expected


@pytest.mark.parametrize("group", [3000, 20_000])
def test_one_passage_in_every_document(llm, monkeypatch, group):
    """Common anchors are salted and divided in Spark, with the same rows as brute force."""
    import hashlib

    random.seed(group)
    monkeypatch.setattr(substrings, "GROUP", group)
    monkeypatch.setattr(substrings, "COMMON", 0.002)
    some = lambda n, letters=b"abcdef ": bytes(random.choice(letters) for _ in range(n))
    passage, line = some(420), some(24) + b" "
    texts = [some(random.randint(0, 260)) + passage + some(random.randint(0, 260)) for _ in range(60)]
    texts += [some(random.randint(0, 120)) + line * random.randint(8, 20) + some(random.randint(0, 120)) for _ in range(25)] + [texts[3], texts[3], texts[7][:300], b""]
    docs = llm.createDataFrame([(i, t.decode()) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    got = {tuple(r) for r in substrings.spans(docs).select("key", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()}
    expected = {(hashlib.md5(t).digest(), len(t), n, spans, hashlib.sha256(kept).hexdigest()) for t, (kept, n, spans) in zip(texts, removed(texts), strict=True)}
    assert {(bytes(k), *rest) for k, *rest in got} == expected


def test_copies_of_a_long_text(monkeypatch):
    monkeypatch.setattr(substrings, "BATCH", 1000)
    random.seed(4)
    some = lambda n: bytes(random.choice(b"abcdef ") for _ in range(n))
    texts = [(some(5000), 2), (some(150), 5), (some(1000), 3), (b"", 2)]
    assert [substrings.covered(x, 200) for x in substrings.copied(texts, 200)] == [[(0, 5000)], [], [(0, 1000)], []]


def test_cleaning_has_a_python_worker_of_its_own(odd):
    cleaned = substrings.remove(odd)
    cleaned.collect()
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    clean, found = [x.start() for x in re.finditer("MapInArrow clean|MapInArrow run", plan)][:2]
    assert "SortMergeJoin" in plan[clean:found] and "Exchange" in plan[clean:found] and "BroadcastHashJoin" not in plan[clean:found]


def test_substrings_of_odd_documents(odd, none):
    cleaned = substrings.remove(odd)
    rows = odd.collect()
    kept = removed([(r["text"] or "").encode() for r in rows])
    assert cleaned.columns == odd.columns
    assert sorted(str((r["doc_id"], r["text"])) for r in cleaned.collect()) == sorted(str((r["doc_id"], None if r["text"] is None else k.decode("utf-8", "ignore"))) for r, (k, _, _) in zip(rows, kept, strict=True))
    assert substrings.remove(none).count() == 0


def vectors(n, seed=1):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n // 3, 16))
    rows = [*base, *(base[: n // 6] + 0.05 * rng.standard_normal((n // 6, 16))), *(base[0] + 0.12 * rng.standard_normal((n // 3, 16))), *base[:5]]
    return [(i, [float(x) for x in v]) for i, v in enumerate(rows)]


@pytest.mark.parametrize("block", [40, 8192])
def test_cover_tree_against_all_pairs(llm, monkeypatch, block):
    monkeypatch.setattr(covertree, "BLOCK", block)
    nan, inf = float("nan"), float("inf")
    rows = vectors(300)
    odd_rows = [(900, None), (901, []), (902, [0.0] * 16), (903, [nan] * 16), (904, [inf] + [1.0] * 15), (905, [None] + [1.0] * 15), (906, [1.0, 0.0]), (907, [2.0, 0.0]), (908, [1e-300] * 16), (909, [1e200] * 16), (None, rows[0][1])]
    every = rows + odd_rows
    unit = covertree.units([v for _, v in every])
    pairs = [(i, j) for i in range(len(every)) for j in range(i) if unit[i] and unit[j] and len(unit[i]) == len(unit[j]) and np.frombuffer(unit[i]) @ np.frombuffer(unit[j]) >= 0.9]
    links = Counter(x for p in pairs for x in p)
    least = components(len(every), pairs)
    ids = {}
    for i, g in enumerate(least):
        if every[i][0] is not None:
            ids.setdefault(g, every[i][0])
    got = covertree.near_duplicates(llm.createDataFrame([(i, v, "x") for i, v in every], "vec_id long, embedding array<double>, cid string"))
    assert sorted(str(tuple(r)) for r in got.collect()) == sorted(str((i, links[k], ids.get(least[k]), i == ids.get(least[k]))) for k, (i, _) in enumerate(every))


def test_cover_tree_of_nothing(llm):
    assert covertree.near_duplicates(llm.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_cover_tree_query(llm, sf_dir):
    rows = sorted((r["vec_id"], r["embedding"]) for r in llm.read.parquet(f"{sf_dir}/embeddings.parquet").collect())
    x = np.array([v for _, v in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = np.triu(x @ x.T >= 0.9, 1)
    least = components(len(rows), zip(*np.nonzero(near), strict=True))
    n = near.sum(0) + near.sum(1)
    assert {tuple(r) for r in covertree.query(llm, sf_dir).collect()} == {(rows[i][0], int(n[i]), rows[least[i]][0], least[i] == i) for i in range(len(rows))}


def test_block_pairs_stay_off_the_driver(llm, monkeypatch):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 8))
    vectors = np.concatenate([base, base + 0.02 * rng.normal(size=base.shape), base + 0.3 * rng.normal(size=base.shape)])
    df = llm.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    want = {tuple(r) for r in covertree.near_duplicates(df).collect()}
    sent, make = [], type(llm).createDataFrame

    def spy(self, data, *args, **more):
        sent.append(len(data))
        return make(self, data, *args, **more)

    monkeypatch.setattr(covertree, "BLOCK", 20)
    monkeypatch.setattr(covertree, "CENTRES", 2)
    monkeypatch.setattr(type(llm), "createDataFrame", spy)
    assert {tuple(r) for r in covertree.near_duplicates(df).collect()} == want
    assert sent and max(sent) <= 2 * 2
