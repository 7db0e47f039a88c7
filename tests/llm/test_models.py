import math
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import lower, words

from mulberry.llm import gru, language, lm, quality


def test_quality_held_out(llm):
    sf = "/root/testdata/sf0.01"
    got = quality.query(llm, sf).join(llm.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in got]) >= 0.9
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)


def test_sum_of_squares_identity():
    m = quality.Machine(0)
    index, value = quality.features(b"Some text, of a FEW words. of a few")
    m.linear[:] = 0.1
    pairs = sum(float(m.factors[i] @ m.factors[j]) * float(x) * float(y) for k, (i, x) in enumerate(zip(index, value, strict=True)) for j, y in list(zip(index, value, strict=True))[:k])
    assert m.logit(index, value) == pytest.approx(m.bias + 0.1 * float(value.sum()) + pairs, rel=1e-4)


def test_quality_of_odd_documents(llm, odd, none):
    labels = llm.createDataFrame([(i, i % 3 and 1) for i in range(60)] + [(None, 1), (5, None), (7, 0)], "doc_id long, quality int")
    machine = quality.train(odd, labels, ("n_chars",))
    scored = quality.score(odd, machine, ("n_chars",))
    assert scored.count() == odd.count() and scored.where("score is null or score < 0 or score > 1").count() == 0
    assert quality.keep_good(odd, labels).columns == odd.columns
    for some in (labels.where("quality = 1"), labels.where("false")):
        assert quality.score(odd, quality.train(odd, some)).where("score between 0 and 1").count() == odd.count()
    assert quality.score(none, machine, ("n_chars",)).count() == 0
    assert quality.score(odd, quality.train(none, labels)).where("score between 0 and 1").count() == odd.count()


def test_quality_query_against_double_sums(llm, sf_dir):
    """Every score by the definition: the sum over all pairs of features, with the fitted parameters."""
    docs, labels = llm.read.parquet(f"{sf_dir}/documents.parquet"), llm.read.parquet(f"{sf_dir}/labels.parquet")
    held = {i for (i,) in docs.select("doc_id").collect() if zlib.crc32(str(i).encode()) % 4 == 2}
    m = quality.train(docs, labels.where(~labels.doc_id.isin(list(held))), ("n_chars",))
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in docs.collect()}
    for r in quality.query(llm, sf_dir).collect():
        index, value = quality.features(None if texts[r["doc_id"]][0] is None else texts[r["doc_id"]][0].encode(), (texts[r["doc_id"]][1],))
        spread = m.factors[index].astype(float) * value[:, None]
        products = spread @ spread.T
        z = m.bias + float(m.linear[index].astype(float) @ value) + float(np.triu(products, 1).sum())
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-4)
        assert r["held_out"] == (r["doc_id"] in held) and r["predicted"] == (r["score"] >= 0.7)


def plain_gram(gram):
    """The bucket of a 1-, 2- or 3-gram by integer arithmetic."""
    a, mask = [ord(c) for c in gram], 2**32 - 1
    h = a[0] * 0x9E3779B1 & mask
    if len(a) > 1:
        h = (h ^ (a[1] * 0x85EBCA77 + 0x165667B1 & mask)) * 0xC2B2AE3D & mask
    if len(a) > 2:
        h = (h ^ (a[2] * 0x27D4EB2F + 0x9E3779B1 & mask)) * 0x85EBCA6B & mask
    return h >> (32 - language.BITS)


def test_language_query_against_plain_version(llm, sf_dir):
    """Every prediction from counts of n-grams, document frequencies and the fitted weights, text by text."""
    rows = llm.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang").collect()
    grams = {r["doc_id"]: Counter(plain_gram(t[i : i + n]) for t in [r["text"].lower()] for n in (1, 2, 3) for i in range(len(t) - n + 1)) for r in rows if r["text"]}
    learnt = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1 and r["text"] is not None and r["lang"] is not None]
    frequency = Counter(g for r in learnt for g in grams.get(r["doc_id"], ()))
    model, _ = language.train(llm.createDataFrame([tuple(r) for r in learnt], "doc_id long, text string, lang string"))
    for r in language.query(llm, sf_dir).collect():
        own = grams.get(r["doc_id"])
        if not own or r["lang_pred"] == "und":
            continue
        value = {g: n * (math.log((1 + len(learnt)) / (1 + frequency[g])) + 1) for g, n in own.items()}
        z = sum(language.SCALE * v / sum(value.values()) * model.weights[g].astype(float) for g, v in value.items()) / model.temperature
        chance = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert r["score"] == pytest.approx(chance.max(), abs=1e-3)
        assert r["lang_pred"] == model.languages[int(chance.argmax())] or chance.max() < 0.51


def test_language_held_out(llm):
    sf = "/root/testdata/sf0.01"
    got = language.query(llm, sf).join(llm.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in got]) >= 0.95


def test_language_of_odd_documents(odd, none):
    trained = language.train(odd)
    assert (trained[0].weights == 0).mean() > 0.3
    got = language.predict(odd.drop("lang", "source", "doc_id"), trained).collect()
    for r in got:
        und = r["text"] is None or not any(map(str.isalpha, r["text"]))
        assert (r["lang_pred"] == "und") == und and 0 <= r["score"] <= 1
    assert language.train(none) is None
    assert language.predict(none, trained).count() == 0
    assert {r["lang_pred"] for r in language.predict(odd, None).collect()} == {"und"}
    one = language.train(odd.where("lang = 'en'"))
    assert {r["lang_pred"] for r in language.predict(odd, one).collect()} == {"und", "en"}


def test_gru_gradients():
    rng = np.random.default_rng(0)
    m = gru.Gru(np.array([5.0, 9, 4, 3, 2, 2, 1, 1]))
    m.p = {k: x.astype(np.float64) for k, x in m.p.items()}
    tokens, target, used = rng.integers(0, 8, (6, 3)), rng.integers(0, 8, (6, 3)), np.ones((6, 3), bool)
    used[5, 2] = False
    trainer, got, start = gru.Trainer(m), {}, rng.standard_normal((3, gru.HIDDEN)) * 0.1
    trainer._adam = lambda g, n: got.update({k: x.copy() for k, x in g.items()})

    def loss():
        h, total = start, 0.0
        for t in range(6):
            h = m.step((m.p["embed"] @ m.p["wx"] + m.p["bx"])[tokens[t]], h * (tokens[t] != 0)[:, None])[0]
            total -= (m.output(h, target[t])[0] * used[t]).sum()
        return total

    trainer.window(tokens, target, used, start)
    for name, x in m.p.items():
        for _ in range(3):
            i = tuple(int(rng.integers(0, s)) for s in x.shape)
            old = x[i]
            x[i] = old + 1e-4
            up = loss()
            x[i] = old - 1e-4
            down = loss()
            x[i] = old
            assert (up - down) / 2e-4 == pytest.approx(got[name][i], abs=1e-4)


def test_gru_probabilities_sum_to_one():
    m = gru.Gru(np.arange(1, 40, dtype=float))
    h = np.random.default_rng(1).standard_normal((1, gru.HIDDEN)).astype(np.float32)
    assert np.exp([m.output(h, np.array([t]))[0][0] for t in range(39)]).sum() == pytest.approx(1, rel=1e-4)


def test_gru_state_is_carried():
    m = gru.Gru(np.arange(1, 40, dtype=float))
    m.p["wo"] *= 30
    documents = [np.random.default_rng(k).integers(1, 39, n).astype(np.int32) for k, n in enumerate([3, 2000, 0, 700])]
    for x, got in zip(documents, m.score(documents), strict=True):
        h, total = np.zeros((1, gru.HIDDEN), np.float32), 0.0
        for a, b in zip([0, *x], [*x, 0], strict=True):
            h = m.step((m.p["embed"][[a]] @ m.p["wx"] + m.p["bx"]), h)[0]
            total += m.output(h, np.array([b]))[0][0]
        assert got == pytest.approx(total, rel=1e-4)


@pytest.mark.parametrize("head", [3, 200_000])
def test_scores_of_odd_documents(odd, none, monkeypatch, head):
    from pyspark.sql import functions as F

    monkeypatch.setattr(lm, "HEAD", head)
    held = F.coalesce(F.col("doc_id") % 5 == 1, F.lit(False))
    docs = odd.select("doc_id", "text", held.alias("held_out"))
    counts = lm.written(lm.word_counts(docs.where("not held_out")), "words")
    lexicon = lm.lexicon(counts)
    found = lm.tokenised(docs, lexicon)
    model = lm.train(found.where("not held_out"), lexicon)
    got = lm.score(found, model, lexicon, counts).collect()
    tokens = [(r["doc_id"], [*words(lower(r["text"])), None]) for r in docs.collect()]
    seen = Counter(w for i, t in tokens if i is None or i % 5 != 1 for w in t)
    n, v = sum(seen.values()), len(seen)
    expected = sorted((str(i), len(t), sum(seen[w] > 0 for w in t), n, round(sum(math.log10((seen[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), 4)) for i, t in tokens)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == expected
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    # scores word by word: the network's tokens, and shares of the words of one token
    known = {k: w.decode() for k, w in enumerate(lexicon.words)}
    token = {w: int(lexicon.token_of[k]) for k, w in known.items()}
    share = {t: sum(seen[w] + 0.5 for w in token if token[w] == t) for t in set(token.values())}
    rare = sum(k for w, k in seen.items() if w is not None and w not in token) + 0.5 * (sum(w is not None and w not in token for w in seen) + 1)
    scores = []
    for i, t in tokens:
        h, before, total = np.zeros((1, gru.HIDDEN), np.float32), 0, 0.0
        for w in t[-400:] if len(t) > 400 else t:
            at = 0 if w is None else token.get(w, 1)
            h = model.step(model.p["embed"][[before]] @ model.p["wx"] + model.p["bx"], h)[0]
            total += model.output(h, np.array([at]))[0][0] / math.log(10)
            if w is not None:
                total += math.log10((seen[w] + 0.5) / (share[at] if at > 1 else rare))
            before = at
        if len(t) <= 400:
            scores.append((str(i), len(t), total))
    assert [(i, n) for i, n, _ in sorted(scores)] == [(i, n) for i, n, _ in sorted((str(r["doc_id"]), r["n_tokens"], r["score"]) for r in got if r["n_tokens"] <= 400)]
    for x, y in zip(sorted(scores), sorted((str(r["doc_id"]), r["n_tokens"], r["score"]) for r in got if r["n_tokens"] <= 400), strict=True):
        assert x[2] == pytest.approx(y[2], rel=1e-3)
    nothing = lm.written(lm.word_counts(none), "words")
    empty = lm.lexicon(nothing)
    unlearnt = lm.tokenised(docs, empty)
    assert lm.score(unlearnt, lm.train(unlearnt.where("false"), empty), empty, nothing).count() == docs.count()
    assert lm.score(lm.tokenised(docs.where("false"), lexicon), model, lexicon, counts).count() == 0


def test_scores_do_not_depend_on_files(llm, sf_dir, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(lm, "SHARD", 5000)
    docs = llm.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", (F.col("doc_id") % 5 == 1).alias("held_out"))
    found = []
    for some in (docs.coalesce(1), docs.repartition(7)):
        counts = lm.written(lm.word_counts(some.where("not held_out")), "words")
        lexicon = lm.lexicon(counts)
        tokens = lm.tokenised(some, lexicon)
        found.append({r["doc_id"]: r["score"] for r in lm.score(tokens, lm.train(tokens.where("not held_out"), lexicon), lexicon, counts).collect()})
    assert found[0].keys() == found[1].keys()
    assert all(found[0][i] == pytest.approx(found[1][i], rel=1e-5) for i in found[0])


def test_model_beats_unigrams(llm):
    sf = "/root/testdata/sf0.01"
    got = [r for r in lm.query(llm, sf).collect() if r["held_out"]]
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1) == r["held_out"] for r in got)
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)
