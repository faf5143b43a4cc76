import re

import pytest
from llm.frames import clashing, nothing, odd
from llm.test_dedup import slow_components, slow_fingerprint
from pyspark.sql import Row
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from brasstally.llm.common import written
from brasstally.llm.mixing import mix
from sidebyside import compare


@pytest.mark.parametrize("name", ["op5_exact_dedup"])
def test_same_as_sql(spark, duck, small, name):
    outcome = compare(entry.queries()[name](spark, small), duck, entry.oracle_sql()[name])
    assert outcome.startswith("OK"), outcome


def test_each_stage_by_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    odd_rows = spark.createDataFrame([(10_001, "12 34 !!"), (10_002, None), (10_003, "Same text here once"), (10_004, "Same  text here once")], "doc_id long, text string")
    docs = docs.unionByName(odd_rows, allowMissingColumns=True)
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = written(stage(spark, docs, small), name)
        assert docs.columns == columns
        kept[name] = docs.collect()
    texts = {i: t for i, t in before.items() if re.search(r"[^\W\d_]", t or "")}
    assert {r["doc_id"] for r in kept["language_id"]} == set(texts)
    least = {}
    for i, t in texts.items():
        key = re.sub(r"[\x20\x09-\x0D]+", " ", t)
        least[key] = min(i, least.get(key, i))
    assert sorted(r["doc_id"] for r in kept["exact_dedup"]) == sorted(least.values())
    ids = sorted(least.values())
    roots = slow_components([slow_fingerprint(texts[i]) for i in ids])
    assert sorted(r["doc_id"] for r in kept["simhash"]) == sorted({ids[r] for r in roots})
    plan = mix(spark.createDataFrame([(r["doc_id"], r["text"], r["source"]) for r in kept["simhash"]], "doc_id long, text string, source string"))
    assert len(kept["mixing"]) > 0 and plan.count() == len(kept["simhash"])
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, small).toPandas()
    assert set(pieces.doc_id) == {r["doc_id"] for r in kept["mixing"]}
    assert pieces.groupby("sequence_id").length.sum().max() <= 2048


def test_run(spark, small):
    assert entry.queries()["pipeline"](spark, small).count() > 0


@pytest.mark.parametrize("frame", [odd, clashing, nothing])
def test_stages_bear_odd_rows(spark, small, frame):
    docs = frame(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, small), "odd")
    assert docs.count() >= (frame is not nothing)


def test_nothing_to_learn_keeps_texts_with_letters(spark, small):
    docs = spark.createDataFrame([(1, "plain text", None), (2, "12 34 !!", None), (3, None, None), (4, "ж", None)], "doc_id long, text string, lang string")
    kept = dict(corpus_pipeline.STAGES)["language_id"](spark, docs, small)
    assert kept.columns == docs.columns and {x["doc_id"] for x in kept.collect()} == {1, 4}


def test_near_copies_do_not_stand_for_other_texts(spark, small):
    """Rows that share an id, or have none, but differ in text."""
    one, two, three = ("one two three four five six", "red green blue black white grey", "north south east west up down")
    rows = [(1, one, "a"), (1, two, "b"), (1, one, "a"), (1, one, "A"), (2, two, "c"), (None, three, "d"), (None, one, "e"), (None, "lone text here", "f"), (3, three, "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string")
    for frame in (docs, docs.repartition(5), docs.orderBy(F.desc("row"))):
        kept = sorted(dict(corpus_pipeline.STAGES)["simhash"](spark, frame, small).collect(), key=str)
        assert [tuple(x) for x in kept] == sorted([(1, one, "A"), (1, two, "b"), (3, three, "g"), (None, "lone text here", "f")], key=lambda r: str(Row(doc_id=r[0], text=r[1], row=r[2])))
