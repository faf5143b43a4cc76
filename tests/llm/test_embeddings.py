import numpy as np
import pytest

import __spark_entry__ as entry
from brasstally.llm.embedding_dedup import embedding_groups
from sidebyside import compare


def brute(rows, threshold=0.9):
    """Links and components over all pairs."""
    good = {}
    for i, v in rows:
        if v is not None and None not in v and np.isfinite(v).all() and np.any(v):
            good.setdefault(i, np.array(v, dtype=float))
    ids = sorted(good)
    near = {i: {j for j in ids if j != i and len(good[i]) == len(good[j]) and good[i] @ good[j] / np.linalg.norm(good[i]) / np.linalg.norm(good[j]) >= threshold} for i in ids}
    seen = {}
    for i in ids:
        stack = [i]
        while stack:
            x = stack.pop()
            if x not in seen:
                seen[x] = i
                stack += near[x]
    return {i: (len(near.get(i, ())), seen.get(i, i)) for i, _ in rows}


def test_same_as_sql(spark, duck, small):
    outcome = compare(entry.queries()["op2_embedding_dedup"](spark, small), duck, entry.oracle_sql()["op2_embedding_dedup"])
    assert outcome.startswith("OK"), outcome


@pytest.mark.parametrize("chunk", [2000, 30])
def test_clusters_and_odd_vectors(spark, chunk):
    r = np.random.default_rng(1)
    rows = []
    for c in range(30):
        centre = r.normal(size=16)
        rows += [(len(rows) + k, (centre + r.normal(size=16) * 0.12).tolist()) for k in range(int(r.integers(1, 12)))]
    same = rows[0][1]
    base = len(rows)
    rows += [(base + k, list(same)) for k in range(40)]
    rows += [(base + 50, None), (base + 51, [0.0] * 16), (base + 52, [float("nan")] * 16), (base + 53, [None] * 16), (base + 54, []), (base + 55, [1.0, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(x["vec_id"], x["embedding"]) for x in frame.collect()]
    got = {x["id"]: (x["n_links"], x["component_id"]) for x in embedding_groups(frame, chunk=chunk).collect()}
    want = brute(rows)
    links, found = sum(n for n, _ in want.values()), sum(got[i][0] for i in want)
    assert 0.9 * links <= found <= links
    assert {i: got[i] for i in range(base + 50, base + 56)} == {i: (0, i) for i in range(base + 50, base + 56) if i != base + 55} | {base + 55: (0, base + 55)}


def test_nothing(spark):
    assert embedding_groups(spark.createDataFrame([], "vec_id long, embedding array<float>, id int, vector int")).count() == 0
    one = spark.createDataFrame([(None, [1.0, 0.0]), (4, [2.0, 0.0])], "vec_id long, embedding array<float>")
    assert {(r["id"], r["n_links"], r["component_id"]) for r in embedding_groups(one).collect()} == {(None, 1, 4), (4, 1, 4)}
