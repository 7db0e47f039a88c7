"""Small documents with every odd case, and brute-force versions."""

import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, target string, label int, n int, key string"


def odd_documents(spark, sf_dir):
    """Real documents among nulls in each column, empty, one-word and long texts, ties, repeated rows, and extra columns with clashing names."""
    real = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    long = " ".join(f"word{i % 977} of{i % 13}" for i in range(20_000))
    rows = [
        *real, (None, real[3][1], "en", "src1", 5), (1000, None, "en", "src1", None), (1001, "", None, None, 0), (1002, " \n\t ", "fr", None, 4), (1003, "one", "en", "", 3), (1004, "Two words", None, "é", 9),
        (1005, long, "en", "src2", len(long)), (1005, long, "en", "src2", len(long)), (1006, real[5][1], "de", "src3", 1), (1006, real[6][1], "es", "src3", 1), (1007, "日本語 テキスト  ñandú ß 🙂<|endoftext|> x", "ja", "src4", None),
        (1008, "a " * 700, "en", "src5", 1400), (1009, "1234 !!! ???", "en", "src5", 12), (None, None, None, None, None)]
    return spark.createDataFrame([(*r, 7, "t", 1, 2, "k") for r in rows], SCHEMA)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return WORDS.findall(text or "")


def components(n, pairs):
    """Least member of each of n nodes' component."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
