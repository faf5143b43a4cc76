import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm.frames import clashing, nothing, odd

import brasstally.llm.lexical_search as search_module
from brasstally.llm.lexical_search import BITS_SET, LEVELS, OP13_SQL, Items, index, op13_lexical_search, places, search, terms_of
from sidebyside import compare

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(b): chr(b + 32) for b in range(65, 91)})


def slow_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def slow_search(docs, items, top=10):
    """(item id, rank, doc id, score) rows, every pair scored one by one."""
    counted = [(i, Counter(slow_terms(t))) for i, t in docs]
    counted = [(i, c, c.total()) for i, c in counted if c]
    n, length = len(counted), sum(x[2] for x in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, words in counted:
            m = 25 + 75 * words * n // length
            w = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in slow_terms(text)}
            scores.append((sum(w[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in slow_terms(text)), i))
        best = sorted((x for x in scores if x[0] > 0), key=lambda x: (-x[0], x[1] is None, x[1]))[:top]
        out += [(item, k + 1, i, s) for k, (s, i) in enumerate(best)]
    return sorted(out, key=str)


def rows(df):
    return sorted([(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()], key=str)


@pytest.fixture(scope="module")
def made(spark):
    """Documents of all lengths with frequent and rare words, copies, null and repeated ids, and items over them."""
    r = random.Random(5)
    words = [f"w{k}" for k in range(400)] + ["Æther", "naïve", "x²", "İ", "9"]
    text = lambda n: " ".join(words[min(int(r.paretovariate(0.6)) - 1, len(words) - 1)] for _ in range(n))
    docs = [(i, text(r.choice([1, 5, 40, 300]))) for i in range(600)] + [(600, text(60_000)), (601, None), (602, " .,!\n"), (603, "")]
    docs += [(1000 + i, docs[7][1]) for i in range(80)] + [(None, docs[7][1]), (None, text(30)), (3, text(20)), (3, text(20))]
    items = [(i, text(r.choice([1, 3, 12]))) for i in range(20)]
    items += [(50, docs[7][1]), (51, None), (52, "nowhere else"), (None, text(4)), (5, "W7 w7, w7 w9"), (53, "")]
    return docs, items, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def test_terms():
    text = "Ab-c_d É9Ω Ünder\x00x\x7fy {z} 𝒜b c"
    assert [t.decode() for t in terms_of(text)] == slow_terms(text) and terms_of(None) == []


def test_same_as_sql(spark, duck, small):
    outcome = compare(op13_lexical_search(spark, small), duck, OP13_SQL)
    assert outcome.startswith("OK"), outcome


def test_brute_force(made):
    docs, items, frame, asked = made
    assert rows(search(frame, asked)) == slow_search(docs, items)
    assert rows(search(frame, asked, top=3)) == slow_search(docs, items, 3)


def test_blocks_of_items_and_ways_to_join(made, monkeypatch):
    """Several blocks of items, vocabularies in parts, and candidates too many to broadcast give the same rows."""
    docs, items, frame, asked = made
    monkeypatch.setattr(search_module, "ITEMS", 11)
    monkeypatch.setattr(search_module, "BROADCAST", 0)
    monkeypatch.setattr(Items, "CHUNK", 13)
    assert rows(search(frame, asked)) == slow_search(docs, items)


def test_bounds_hold_and_prove_most_documents_worse(made):
    docs, items, frame, _ = made
    counted = [Counter(terms_of(t)) for _, t in items if terms_of(t)]
    block = Items(counted)
    held = [(i, Counter(terms_of(t))) for i, t in docs if terms_of(t)]
    block.weigh(len(held), sum(c.total() for _, c in held), {n: sum(t in c for _, c in held) for t, n in block.vocabulary.items()})
    exact = {}
    for i, t in docs:
        exact.setdefault(i, []).append(block.scores(t, range(len(counted))))
    pairs = tight = 0
    for row in index(frame).collect():
        bounds = block.bounds(row["bits"], row["lengths"], row["slices"])
        for d, i in enumerate(row["ids"]):
            for n in range(len(counted)):
                assert bounds[n, d] >= min(s[n] for s in exact[i])
                pairs += 1
                tight += bounds[n, d] <= 1.5 * max(s[n] for s in exact[i])
    assert sum(len(r["ids"]) for r in index(frame).collect()) == len(held)
    assert tight > 0.8 * pairs


def test_levels_and_places():
    assert LEVELS[:8].tolist() == [1, 2, 3, 4, 6, 8, 12, 16]
    at = places(np.arange(50, dtype=np.uint64), np.ones(50, dtype=np.int64), 256)
    assert at.shape == (50, BITS_SET) and at.min() >= 0 and at.max() < 256


@pytest.mark.parametrize("frame", [odd, clashing])
def test_odd_rows(spark, frame):
    asked = spark.createDataFrame([(1, "word gamma", 7), (2, None, 7), (1, "word gamma", 8)], "item_id long, text string, doc_id long")
    docs = frame(spark)
    expected = slow_search([(r["doc_id"], r["text"]) for r in docs.collect()], [(1, "word gamma"), (2, None), (1, "word gamma")])
    assert rows(search(docs, asked)) == expected and len(expected) == 8


def test_empty_tables(spark):
    asked = spark.createDataFrame([(1, "word")], "item_id long, text string")
    for docs, items in ((nothing(spark), asked), (odd(spark), asked.limit(0)), (odd(spark).where("text is null"), asked)):
        got = search(docs, items)
        assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.count() == 0
