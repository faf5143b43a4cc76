import hashlib
import re

import numpy as np
import pytest
import xxhash
from llm.frames import clashing, documents, nothing, odd

from brasstally.llm import simhash
from brasstally.llm.components import components
from brasstally.llm.exact_dedup import exact_dedup, exact_groups, merge_sizes
from brasstally.llm.simhash import simhash_dedup, simhash_groups


def test_exact_groups_by_brute_force(spark, small):
    pdf = documents(spark, small)
    shas = [hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest() for t in pdf.text]
    least, many = {}, {}
    for i, s in zip(pdf.doc_id, shas):
        least[s] = min(i, least.get(s, i))
        many[s] = many.get(s, 0) + 1
    got = exact_groups(spark.createDataFrame(pdf), runs=5, fan_in=2).toPandas()
    assert {tuple(r) for r in got.itertuples(index=False)} == {(i, s, least[s], many[s]) for i, s in zip(pdf.doc_id, shas)}


def test_rounds():
    assert merge_sizes(1, 16) == [] and merge_sizes(49, 16) == [4, 1] and merge_sizes(8, 2) == [4, 2, 1]


def test_exact_groups_of_odd_rows(spark):
    got = {(r["id"], r["keep"], r["n"]) for r in exact_groups(odd(spark)).collect()}
    assert got == {(1, 1, 3), (2, 1, 3), (3, 3, 2), (None, None, 1), (4, 3, 2), (5, 5, 1), (6, 6, 1), (7, 7, 1)}
    assert exact_groups(nothing(spark)).count() == 0


@pytest.mark.parametrize("frame", [odd, clashing])
def test_exact_dedup_keeps_whole_rows(spark, frame):
    docs = frame(spark)
    got = exact_dedup(docs)
    assert got.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in got.collect()) == [0, 1, 3, 5, 6, 7]


def slow_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    counts = [sum(xxhash.xxh64_intdigest(s.encode(), 42) >> b & 1 for s in shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def slow_components(fps):
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (int(fps[i]) ^ int(fps[j])).bit_count() <= 2:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


def test_simhash_by_brute_force(spark, small):
    pdf = documents(spark, small).sort_values("doc_id")
    fps = [slow_fingerprint(t) for t in pdf.text]
    want = dict(zip(pdf.doc_id, zip(fps, pdf.doc_id.iloc[slow_components(fps)])))
    got = simhash_groups(spark.createDataFrame(pdf)).toPandas()
    assert {i: (f % (1 << 64), c) for i, f, c in got.itertuples(index=False)} == want


def chained(n=400, seed=3):
    r = np.random.default_rng(seed)
    fps = [int(r.integers(0, 1 << 63))]
    for _ in range(n):
        x = fps[int(r.integers(0, len(fps)))]
        for _ in range(int(r.integers(1, 5))):
            x ^= 1 << int(r.integers(0, 64))
        fps.append(x)
    return np.array(sorted(set(fps)), dtype=np.uint64)


@pytest.mark.parametrize("large", [4096, 40])
def test_blocks_lose_no_link(spark, monkeypatch, large):
    """Also where every block is dealt anew by finer bands."""
    monkeypatch.setattr(simhash, "LARGE", large)
    fps = chained()
    frame = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    blocks = simhash.in_blocks(frame).repartition(4, "block", "part").sortWithinPartitions("block", "part", "fp")
    got = components(blocks.mapInPandas(simhash.links, "a long, b long")).toPandas()
    roots = slow_components(fps)
    groups = {}
    for x, r in zip(fps.view(np.int64).tolist(), roots):
        groups.setdefault(r, set()).add(x)
    found = {}
    for node, component in got.itertuples(index=False):
        found.setdefault(component, set()).add(node)
    assert {frozenset(g) for g in groups.values() if len(g) > 1} == {frozenset(g) for g in found.values()}


def test_bit_planes_count_distances():
    fps = chained(200)
    for q, places in simhash.within_radius(fps, simhash.planes(fps), np.arange(len(fps))):
        for a, b in zip(q, places):
            if b < len(fps):
                assert (int(fps[a]) ^ int(fps[b])).bit_count() <= 2
    found = {(int(a), int(b)) for q, p in simhash.within_radius(fps, simhash.planes(fps), np.arange(len(fps))) for a, b in zip(q, p) if b < len(fps)}
    assert found == {(i, j) for i in range(len(fps)) for j in range(len(fps)) if (int(fps[i]) ^ int(fps[j])).bit_count() <= 2}


def test_simhash_of_odd_rows(spark):
    got = {(r["doc_id"], r["component_id"]) for r in simhash_groups(odd(spark)).collect()}
    assert got == {(1, 1), (2, 1), (3, 3), (4, 3), (5, 3), (None, None), (6, 6), (7, 7)}
    assert simhash_groups(nothing(spark)).count() == 0
    kept = simhash_dedup(clashing(spark))
    assert kept.columns == clashing(spark).columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 3, 6, 7]


def test_components_of_a_long_chain(spark):
    edges = spark.range(1, 3000).selectExpr("id as a", "id + 1 as b").repartition(7)
    rows = components(edges).collect()
    assert len(rows) == 3000 and {r["component"] for r in rows} == {1}
    assert components(edges.limit(0)).count() == 0
