import math
import re

import pytest
from llm.frames import clashing, documents, nothing, odd
from pyspark.sql import functions as F

import __spark_entry__ as entry
from brasstally.llm.mixing import draw, hypergeometric, log_factorial, mix, mixed, targets
from sidebyside import compare


def test_same_as_sql(spark, duck, small):
    outcome = compare(entry.queries()["op1_mix_sources"](spark, small), duck, entry.oracle_sql()["op1_mix_sources"])
    assert outcome.startswith("OK"), outcome


def slow_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > most * sizes[s]}
        if not over:
            return target | share
        target |= {s: float(most * sizes[s]) for s in over}
        left -= sum(most * sizes[s] for s in over)
        open_ -= over
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 100, "c": 1000}, {"a": 1, "b": 1, "c": 500, "d": 3, None: 40}, {"a": 0}, {"a": 0, "b": 7}, {"x": 5}])
def test_targets_by_repeated_sharing(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in targets(frame).collect()}
    assert got == {s: pytest.approx(t) for s, t in slow_targets(sizes).items()}


def test_hypergeometric_inverts_its_distribution(spark):
    total, marked, drawn = 50, 20, 15
    probs = [math.comb(marked, k) * math.comb(total - marked, drawn - k) / math.comb(total, drawn) for k in range(drawn + 1)]
    us = [(k + 0.5) / 200 for k in range(200)]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in us], "u double").select(hypergeometric(F.lit(total), F.lit(marked), F.lit(drawn), F.col("u"))).collect()]
    want = []
    for u in us:
        k, below = 0, 0.0
        while below + probs[k] < u:
            below += probs[k]
            k += 1
        want.append(k)
    assert got == want
    logs = spark.range(30).select(log_factorial(F.col("id"))).collect()
    assert all(abs(r[0] - math.lgamma(k + 1)) < 1e-7 for k, r in enumerate(logs))


def test_draws_keep_quotas(spark):
    rows = spark.range(50).select(draw(F.array(*[F.lit(x).cast("long") for x in (5, 0, 12, 3, 1)]), F.lit(9), F.concat_ws("-", "id")).alias("d")).collect()
    for r in rows:
        assert sum(r["d"]) == 9 and all(0 <= x <= q for x, q in zip(r["d"], (5, 0, 12, 3, 1)))
    assert len({tuple(r["d"]) for r in rows}) > 5


def test_words_meet_targets_and_shards_are_disjoint(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pdf = documents(spark, "/root/testdata/sf0.01")
    plan = mix(docs).toPandas()
    sizes = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in zip(pdf.doc_id, pdf.text)}
    assert dict(zip(plan.doc_id, plan["size"])) == sizes
    plan["taken"] = [sum(c["words"] for c in x) for x in plan.copies]
    assert (plan.taken <= 3 * plan["size"]).all()
    for _, own in plan.groupby("source"):
        assert abs(own.taken.sum() - own.target.iloc[0]) <= 1
    blocks = {}
    for doc_id, copies in zip(plan.doc_id, plan.copies):
        assert len({c["copy"] for c in copies}) == len(copies)
        for c in copies:
            blocks[c["shard"]] = blocks.get(c["shard"], 0) + 1
    assert len(blocks) == 16
    again = mix(docs.repartition(3)).toPandas()
    assert {(r.doc_id, str(r.copies)) for r in plan.itertuples()} == {(r.doc_id, str(r.copies)) for r in again.itertuples()}


def test_mixed_rows(spark):
    docs = clashing(spark)
    got = mixed(docs)
    assert got.columns == docs.columns
    plan = mix(odd(spark)).collect()
    assert got.count() == sum(len(r["copies"]) for r in plan)
    assert mixed(nothing(spark)).count() == 0 and mix(nothing(spark)).count() == 0


def test_equal_rows_share_what_falls_to_them(spark):
    """Rows equal in id, source and text, of which one is cut: the same copies whatever the plan."""
    rows = [(1, "a b c d e f g h", "s", k) for k in range(6)] + [(2, "x " * 40, "t", 9), (3, "y " * 300, "u", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, other int")
    expected = sorted(c["words"] for r in mix(docs).collect() for c in r["copies"])
    got = [sorted((r["other"], r["text"]) for r in mixed(f).collect()) for f in (docs, docs.repartition(7), docs.orderBy("other"))]
    assert got[0] == got[1] == got[2]
    assert sorted(len(t.split()) for _, t in got[0]) == expected
