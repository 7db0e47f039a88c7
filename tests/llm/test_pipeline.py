"""Each stage on what the one before it kept, against plain versions, and the whole."""

import hashlib
from collections import Counter, defaultdict
from pathlib import Path

import corpus_pipeline
import public_tokenizers
from helpers import components, words
from pyspark.sql import functions as F
from test_mixing import targets
from test_near_duplicates import jaccard_pairs, removed

from mulberry.llm import bpe, mixing, quality
from mulberry.llm.common import FILES_EACH, drop_tables, shared_dir, table, written


def test_stages(llm, sf_dir):
    documents = table(llm, sf_dir, "documents")
    docs, kept = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        new = written(stage(llm, docs, sf_dir), "test-stage")
        if name != "bpe":
            assert new.columns == documents.columns
        kept[name], docs = (docs, new), new
    # quality: scores by the definition, with the fitted parameters, cut at the threshold
    before, after = kept["quality"]
    m, scored = quality.train(before, table(llm, sf_dir, "labels"), meta=("n_chars",)), {}
    for r in before.collect():
        index, value = quality.features(None if r["text"] is None else r["text"].encode(), (r["n_chars"],))
        spread = m.factors[index].astype(float) * value[:, None]
        products = spread @ spread.T
        scored[r["doc_id"]] = m.bias + float(m.linear[index].astype(float) @ value) + float(products.sum() - products.trace()) / 2
    limit = 0.8472978603872034  # the logit of 0.7
    assert {r["doc_id"] for r in after.collect()} == {i for i, z in scored.items() if z >= limit}
    labels = {r["doc_id"]: r["quality"] for r in table(llm, sf_dir, "labels").collect()}
    clean = [i for i, q in labels.items() if q == 1]
    assert sum(scored[i] >= limit for i in clean) >= 0.97 * len(clean)
    # near-duplicates: components of all pairs whose five-word sets have a similarity of 0.8 or more
    before, after = kept["simhash"]
    rows = sorted(before.collect(), key=lambda r: r["doc_id"])
    assert {r["doc_id"] for r in after.collect()} == {rows[i]["doc_id"] for i in set(components(len(rows), jaccard_pairs([r["text"] for r in rows])))}
    # repeated passages: every 200 bytes held against all others
    before, after = kept["substrings"]
    rows = before.collect()
    left = {r["doc_id"]: k.decode("utf-8", "ignore") for r, (k, _, _) in zip(rows, removed([(r["text"] or "").encode() for r in rows]), strict=True)}
    assert {r["doc_id"]: r["text"] or "" for r in after.collect()} == left
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect() if r["text"] is not None)
    # mixing: copies by targets that are shared out round by round, and a draw from the MD5 of the id
    before, after = kept["mixing"]
    rows, sizes, expected = before.collect(), defaultdict(int), Counter()
    for r in rows:
        sizes[r["source"]] += len(words(r["text"]))
    share = targets(sizes)
    for r in rows:
        rate = min(3.0, share[r["source"]] / sizes[r["source"]]) if sizes[r["source"]] else 0.0
        draw = int(hashlib.md5(f"{mixing.SEED}:{r['doc_id']}".encode()).hexdigest()[:13], 16) / 2**52
        expected[r["doc_id"]] += int(rate) + (draw < rate - int(rate))
    assert Counter(r["doc_id"] for r in after.collect()) == +expected
    before, after = kept["bpe"]
    assert after.count() == before.count() and after.where("n_tokens * 4 != length(ids)").count() == 0
    from tokenizers import Tokenizer

    library, texts = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), {r["doc_id"]: r["text"] or "" for r in before.collect()}
    assert all(r["n_tokens"] == len(library.encode(texts[r["doc_id"]], add_special_tokens=False).ids) for r in after.collect())
    assert sorted(r["decoded_sha256"] for r in after.collect()) == sorted(hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in before.collect())
    assert bpe.decode(after.select("doc_id", "ids"), corpus_pipeline.public_tokenizers.path("byte_bpe_50k.json")).count() == after.count()


def test_odd_documents_pass_all_stages(llm, odd, sf_dir):
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(llm, docs, sf_dir), "test-odd")
    assert docs.count() > 0


def test_empty_documents_pass_all_stages(llm, none, sf_dir):
    docs = none.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(llm, docs, sf_dir), "test-none")
    assert docs.count() == 0


def test_extra_columns_pass_all_stages_but_the_last(llm, odd, sf_dir):
    docs = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(llm, docs, sf_dir), "test-extra")
        assert docs.columns == odd.columns
    assert corpus_pipeline.STAGES[-1][1](llm, docs, sf_dir).count() == docs.count() > 0


def test_run(llm, sf_dir):
    assert corpus_pipeline.run(llm, sf_dir).count() > 0


def test_few_files_of_many_shuffle_partitions(llm, sf_dir):
    most, made = FILES_EACH * llm.sparkContext.defaultParallelism, Path(shared_dir(llm).removeprefix("file://").removeprefix("file:"), "mulberry")
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before, old = {k: llm.conf.get(k) for k in held}, set(made.glob("*"))
    for k, v in held.items():
        llm.conf.set(k, v)
    try:
        docs = table(llm, sf_dir, "documents")
        twice = docs.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 10**9).withColumn("text", F.concat("text", F.lit(" again"))))
        alone = written(corpus_pipeline.simhash_stage(llm, twice, sf_dir), "alone")
        cut = written(corpus_pipeline.substring_stage(llm, twice, sf_dir), "cleaned")
        assert 0 < alone.count() <= twice.count() == cut.count()
        drop_tables(llm)
    finally:
        for k, v in before.items():
            llm.conf.set(k, v)
    files = {d.name.rsplit("-", 1)[0]: len(list(d.glob("part-*"))) for d in set(made.glob("*")) - old}
    names = ("distinct", "needed", "sets", "left", "spanning", "rooted", "kept", "alone", "occurrences", "kinds", "marks", "cleaned")
    assert {k: files[k] for k in names if files[k] > most} == {}
