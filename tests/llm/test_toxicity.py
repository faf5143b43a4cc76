import random
import zlib

import numpy as np
import pytest
from llm.frames import clashing, nothing, odd

import brasstally.llm.toxicity as toxicity
from brasstally.llm.toxicity import BUCKETS, Model, State, chance, features, fit, labelled, op11_toxicity, scored

DOCS, LABELS = "doc_id long, text string", "doc_id long, toxic int"
MARKS = ["vilx", "grobz", "snerk"]


def is_held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def made(n=1500, seed=4):
    """Texts of common words; toxic ones hold a mark, or two words with one other between them that are harmless alone."""
    r = random.Random(seed)
    words = [f"wort{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300)]
    rows, labels = [], []
    for i in range(n):
        text = [r.choice(words) for _ in range(r.randint(20, 120))]
        toxic, at = r.random() < 0.25, r.randrange(3, len(text) - 5)
        if toxic and i % 3:
            text[at] = r.choice(MARKS)
        elif toxic:
            text[at], text[at + 2] = "left", "right"
        elif r.random() < 0.5:
            text[at], text[at - 3] = "left", "right"
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def learned(spark):
    rows, labels = made()
    docs, marks = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)
    return dict(rows), dict(labels), docs, marks, fit(docs, marks)


def slow_score(model, text):
    """Every feature of a text, pair by pair."""
    met = {int(b) for family in features(text) for b in family}
    weights = dict(zip(model.buckets.tolist(), model.weights.tolist()))
    return chance(model.intercept + sum(weights.get(b, 0.0) for b in met))


def test_held_out_rows_are_told(learned):
    texts, labels, docs, _, model = learned
    got = {x["doc_id"]: x for x in scored(docs, model).collect()}
    held = [i for i in texts if is_held(i)]
    right = [got[i]["predicted"] == labels[i] for i in held]
    assert len(held) > 200 and np.mean(right) > 0.97
    assert 0 < len(model.buckets) < 3_000
    for i in held[:60]:
        assert got[i]["score"] == pytest.approx(slow_score(model, texts[i]), abs=1e-12)
        assert got[i]["predicted"] == int(got[i]["score"] >= 0.5)


def test_held_out_labels_and_other_columns_teach_nothing(spark, learned):
    texts, labels, docs, _, model = learned
    turned = spark.createDataFrame([(i, 1 - t if is_held(i) else t) for i, t in labels.items()], LABELS)
    more = docs.selectExpr("*", "doc_id % 2 as toxic", "'x' as source", "'en' as lang").repartition(7)
    again = fit(more, turned.repartition(3))
    assert np.array_equal(again.buckets, model.buckets) and np.allclose(again.weights, model.weights) and again.intercept == pytest.approx(model.intercept)


def test_one_step_by_hand():
    """FTRL-proximal on three buckets against the formulas, one bucket at a time."""
    state, z, n = State(), {}, {}
    for at, label in (([1, 2], 1), ([2, 3], 0), ([1, 2, 3], 1), ([1], 0)) * 5:
        w = {}
        for k in at:
            zk = z.get(k, 0.0)
            w[k] = 0.0 if abs(zk) <= toxicity.L1 else -(zk - np.sign(zk) * toxicity.L1) / ((toxicity.BETA + np.sqrt(n.get(k, 0.0))) / toxicity.ALPHA + toxicity.L2)
        b = -z.get("b", 0.0) / ((toxicity.BETA + np.sqrt(n.get("b", 0.0))) / toxicity.ALPHA)
        g = chance(b + sum(w.values())) - label
        for k, now in [*w.items(), ("b", b)]:
            step = (np.sqrt(n.get(k, 0.0) + g * g) - np.sqrt(n.get(k, 0.0))) / toxicity.ALPHA
            z[k], n[k] = z.get(k, 0.0) + g - step * now, n.get(k, 0.0) + g * g
        state.learn(np.array(at), label)
    for k in (1, 2, 3):
        assert state.z[k] == pytest.approx(z[k], rel=1e-4, abs=1e-5) and state.n[k] == pytest.approx(n[k], rel=1e-4)
    assert state.z[BUCKETS] == pytest.approx(z["b"], rel=1e-4, abs=1e-5) and np.count_nonzero(state.n) == 4


def test_features_are_words_and_skipped_pairs():
    one, two = features("Ab cd ef gh"), features("ab, CD. ef-gh 12")
    assert [len(x) for x in one] == [4, 3, 2, 1] and all((a == b).all() for a, b in zip(one, two))
    assert [len(x) for x in features(None)] == [0] and [len(x) for x in features("12 !!")] == [0]
    assert features("ab cd")[1][0] != features("cd ab")[1][0]


def test_which_rows_teach(spark):
    docs = [(i, f"text {i}") for i in range(40)] + [(1, "another text"), (None, "no id")]
    labels = [(i, i % 2) for i in range(30)] + [(2, 1), (3, 1), (31, None), (32, 7), (None, 1), (99, 1)]
    frame = spark.createDataFrame(docs, DOCS)
    got = labelled(frame, spark.createDataFrame(labels, LABELS), 1_000, "doc_id", "text", "toxic").collect()
    taught = {i for i in range(30) if not is_held(i) and i != 2}
    assert sorted(r["text"] for r in got) == sorted("another text" if i == 1 else f"text {i}" for i in taught)
    few = labelled(frame, spark.createDataFrame(labels, LABELS), 8, "doc_id", "text", "toxic").count()
    assert 1 <= few < len(taught)


def test_odd_rows_and_nothing_to_learn(spark, learned):
    model = learned[4]
    for frame in (odd, clashing):
        docs = frame(spark).selectExpr("*", "'kept' as score2", "9 as score")
        got = scored(docs, model)
        assert got.columns == [c for c in docs.columns if c != "score"] + ["score", "predicted"]
        scores = {x["doc_id"]: x["score"] for x in got.collect()}
        assert got.count() == docs.count() and scores[3] == scores[4] == scores[6] == pytest.approx(chance(model.intercept))
    assert scored(nothing(spark), model).count() == 0
    empty = fit(odd(spark), spark.createDataFrame([], LABELS))
    assert {x["predicted"] for x in scored(odd(spark), empty).collect()} == {0}
    only = fit(odd(spark), spark.createDataFrame([(1, 0), (2, 0), (7, 0)], LABELS))
    assert {x["predicted"] for x in scored(odd(spark), only).collect()} == {0}
    assert Model(np.array([], dtype=np.int64), np.array([]), -2.0).score("any words", np.zeros(BUCKETS)) == pytest.approx(chance(-2.0))


def test_given_documents(spark):
    """Held-out labels of the given table, learned from 350 toxic rows in four languages; some labels are noise."""
    folder = "/root/testdata/sf0.1"
    got = op11_toxicity(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").collect()
    toxic, clean = ([r["predicted"] for r in got if r["toxic"] == t] for t in (1, 0))
    assert len(toxic) > 60 and np.mean(toxic) > 0.75 and np.mean(clean) < 0.01
