from collections import defaultdict

import duckdb
import pytest
from helpers import words

from mulberry.llm import mixing


def targets(sizes, weights=(1, 2, 3), most=3):
    """Round by round, as stated: who is above stops, the rest is shared again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in fixed]
        share = (total - sum(fixed.values())) / max(1, sum(weight[s] for s in rest))
        above = [s for s in rest if share * weight[s] > most * sizes[s]]
        if not above:
            return fixed | {s: share * weight[s] for s in rest}
        fixed |= {s: most * sizes[s] for s in above}


def test_against_sql(llm, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    df = mixing.query(llm, sf_dir)
    found = con.execute(mixing.ORACLE)
    names = [x[0] for x in found.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(tuple(r[c] for c in names) for r in df.collect()) == sorted(found.fetchall())


def test_plan_of_odd_rows(odd):
    plan = mixing.mix_plan(odd).collect()
    assert len(plan) == odd.count()
    sizes = defaultdict(int)
    for r in odd.collect():
        sizes[r["source"]] += len(words(r["text"]))
    expected = targets(sizes)
    for r in plan:
        assert r["size"] == len(words(r["text"])) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(expected[r["source"]])
        rate = r["target"] / r["source_size"] if r["source_size"] else 0
        assert int(rate) <= r["copies"] <= int(rate) + 1 and r["copies"] <= 3
    assert sorted(map(str, plan)) == sorted(map(str, mixing.mix_plan(odd).collect()))


def test_mix_repeats_whole_rows(odd):
    plan = {(str(r["doc_id"]), r["text"], r["source"]): r["copies"] for r in mixing.mix_plan(odd).collect()}
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns
    assert mixed.count() == sum(r["copies"] for r in mixing.mix_plan(odd).collect())
    assert all(plan[str(r["doc_id"]), r["text"], r["source"]] > 0 for r in mixed.collect())


def test_taken_is_near_the_target(llm):
    rows = [(i, "w " * (1 + i % 9), f"s{i % 5}") for i in range(20_000)]
    plan = mixing.mix_plan(llm.createDataFrame(rows, "doc_id long, text string, source string"))
    for r in plan.groupBy("source").agg({"target": "max"}).collect():
        taken = plan.where(plan.source == r["source"]).selectExpr("sum(size * copies)").first()[0]
        assert taken == pytest.approx(r[1], rel=0.05)


def test_empty(none):
    assert mixing.mix_plan(none).count() == 0 and mixing.mix(none).columns == none.columns
