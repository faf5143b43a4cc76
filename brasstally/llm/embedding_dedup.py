"""Near duplicates among embeddings, by a pivot-permutation index.

Pivots are a spread-out sample of the vectors. A vector is described by its
``NEAREST`` pivots, and inverted lists hold the vectors of each pivot. Vectors that
share ``SHARED`` pivots or more are candidates and are verified by their cosine in
double precision. Pivots are ranked from rare to common: two vectors that share enough
have their first common pivot among the first of each, so only lists of those are
kept, and a pair counts in the list of its first common pivot alone.

Equal vectors are one class beforehand. A long list is cut into chunks, and each pair
of chunks is compared by a task of its own. Tasks give link counts and a forest of the
links, not the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brasstally.llm.common import table, tasks, written
from brasstally.llm.components import components

THRESHOLD = 0.9
#: The sample that the index is fitted on: about ``PIVOTS_PER_ROOT`` times the root of the vectors, at most ``MOST_PIVOTS``.
PIVOTS_PER_ROOT = 4
MOST_PIVOTS = 4096
#: Pivots closer than this to an earlier one are left out.
APART = 0.6
NEAREST = 12
SHARED = 3
CHUNK = 2000


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # so that no square leaves the range
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(v: Column) -> Column:
    """Not null, some component not zero, all components finite numbers."""
    return v.isNotNull() & F.exists(v, lambda x: x != 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))


def choose_pivots(classes: DataFrame, per_root: float, most: int) -> dict[int, np.ndarray]:
    """For each dimension: pivots from the rows with the smallest digests. Their number is bounded by ``most``."""
    found = {}
    order = F.xxhash64("vector")
    for dim, n in classes.groupBy("dim").count().collect():
        want = min(most, math.ceil(per_root * math.sqrt(n)))
        share = F.pmod(order, F.lit(1 << 40)) < (1 << 40) * min(1.0, 2 * want / n + 40 / n)
        rows = classes.where((F.col("dim") == dim) & share).select("vector", order.alias("o")).orderBy("o").limit(want).collect()
        sample = unit(np.array([r["vector"] for r in rows]))
        kept = np.zeros((0, dim))
        for x in sample:
            if not (kept @ x >= APART).any():
                kept = np.vstack([kept, x])
        found[dim] = kept
    return found


def describe(pivots: dict[int, np.ndarray], nearest: int):
    first, at = {}, 0
    for dim in sorted(pivots):
        first[dim] = at
        at += len(pivots[dim])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for dim, part in pdf.groupby("dim"):
                near = unit(np.stack(part["vector"].to_numpy())) @ pivots[dim].T
                order = np.argsort(-near, axis=1, kind="stable")[:, :nearest] + first[dim]
                yield part.assign(pivots=list(order.astype(np.int32)))

    return run


def list_links(key: tuple, pdf: pd.DataFrame, threshold: float, shared: int) -> pd.DataFrame:
    """Links of one list, or between two of its chunks: rows of (kind, a, b), 0 for counts and 1 for forest edges."""
    pivot, low, high = (int(k) for k in key)
    pdf = pdf.sort_values("cid")
    ids, sizes, side = pdf["cid"].to_numpy(), pdf["n"].to_numpy(), pdf["chunk"].to_numpy()
    x, ranks = unit(np.stack(pdf["vector"].to_numpy())), np.stack(pdf["ranks"].to_numpy())
    known, places = np.unique(ranks, return_inverse=True)
    member = np.zeros((len(ids), len(known)), dtype=np.float32)
    member[np.arange(len(ids))[:, None], places.reshape(ranks.shape)] = 1
    before = np.ascontiguousarray(member[:, known < pivot])
    need = min(shared, ranks.shape[1])
    links, parent = np.zeros(len(ids), dtype=np.int64), list(range(len(ids)))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = k = parent[parent[k]]
        return k

    columns = np.nonzero(side == high)[0]
    rows = np.nonzero(side == low)[0]
    for at in range(0, len(rows), 256):
        some = rows[at : at + 256]
        found = member[some] @ member[columns].T >= need
        found &= before[some] @ before[columns].T == 0
        if low == high:
            found &= some[:, None] < columns[None, :]
        i, j = np.nonzero(found)
        i, j = some[i], columns[j]
        for cut in range(0, len(i), 1 << 16):
            a, b = i[cut : cut + (1 << 16)], j[cut : cut + (1 << 16)]
            near = np.einsum("ij,ij->i", x[a], x[b]) >= threshold
            a, b = a[near], b[near]
            np.add.at(links, a, sizes[b])
            np.add.at(links, b, sizes[a])
            for p, q in zip(a.tolist(), b.tolist(), strict=True):
                p, q = root(p), root(q)
                if p != q:
                    parent[max(p, q)] = min(p, q)
    linked = np.nonzero(links)[0]
    moved = [(k, root(k)) for k in linked.tolist() if root(k) != k]
    return pd.DataFrame(
        {
            "kind": np.r_[np.zeros(len(linked), dtype=np.int32), np.ones(len(moved), dtype=np.int32)],
            "a": np.r_[ids[linked], ids[[k for k, _ in moved]]].astype(np.int64),
            "b": np.r_[links[linked], ids[[r for _, r in moved]]].astype(np.int64),
        }
    )


def inverted_lists(described: DataFrame, nearest: int, shared: int, chunk: int) -> DataFrame:
    """A row for each kept list of a vector, and each pair of chunks that its chunk is in.

    The number of vectors of each pivot is a table of as many rows as there are pivots.
    """
    spark = described.sparkSession
    counts = described.select(F.explode("pivots").alias("p")).groupBy("p").count().collect()
    # Ranks from rare to common; what is looked up below is as long as the pivots are many.
    ranked = sorted(counts, key=lambda r: (r["count"], r["p"]))
    rank = [0] * (1 + max((r["p"] for r in counts), default=0))
    for k, r in enumerate(ranked):
        rank[r["p"]] = k
    chunks = [max(1, -(-r["count"] // chunk)) for r in ranked] or [1]
    held = spark.sparkContext.broadcast((np.array(rank), np.array(chunks)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rank, chunks = held.value
        for pdf in batches:
            if not len(pdf):
                continue
            ids = pdf["cid"].to_numpy()
            for at in range(0, len(pdf), 512):
                part = pdf.iloc[at : at + 512]
                ranks = [np.sort(rank[p]) for p in part["pivots"]]
                rows = []
                for k, r in enumerate(ranks):
                    # Pairs that share fewer than ``shared`` because there are fewer pivots are all candidates.
                    for p in r[: max(1, len(r) - min(shared, len(r)) + 1)].tolist():
                        own = int(ids[at + k]) * 2654435761 % (1 << 32) % int(chunks[p])
                        rows += [(k, p, min(own, c), max(own, c), own) for c in range(int(chunks[p]))]
                k, p, low, high, own = (np.array(c) for c in zip(*rows))
                taken = part.iloc[k]
                yield pd.DataFrame(
                    {
                        "pivot": p, "low": low, "high": high, "chunk": own, "cid": taken["cid"].to_numpy(), "n": taken["n"].to_numpy(),
                        "vector": taken["vector"].to_numpy(), "ranks": [ranks[x].astype(np.int32) for x in k],
                    }
                )

    kind = described.schema["vector"].dataType.simpleString()
    return described.mapInPandas(run, f"pivot int, low int, high int, chunk int, cid long, n long, vector {kind}, ranks array<int>")


def embedding_groups(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
    nearest: int = NEAREST,
    shared: int = SHARED,
    per_root: float = PIVOTS_PER_ROOT,
    most: int = MOST_PIVOTS,
    chunk: int = CHUNK,
) -> DataFrame:
    """``id``, ``n_links`` and ``component_id`` of every row.

    Vectors that are null, zero, or hold null or non-finite components link with
    nothing, and so do vectors of different lengths; such a row is a component of its
    own. Rows with equal vectors are linked; repeated ids are separate rows. A null id
    names a component only if all its ids are null.
    """
    spark = vectors.sparkSession
    rows = vectors.select(vectors[f"`{id_col}`"].alias("id"), vectors[f"`{vector_col}`"].alias("vector"))
    grouped = rows.where(usable(F.col("vector"))).groupBy("vector").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
    classes = written(grouped.withColumns({"cid": F.monotonically_increasing_id(), "dim": F.size("vector")}), "vectors")
    pivots = choose_pivots(classes, per_root, most)
    kind = classes.schema["vector"].dataType.simpleString()
    described = written(
        classes.select("cid", "n", "dim", "vector").mapInPandas(
            describe(pivots, nearest), f"cid long, n long, dim int, vector {kind}, pivots array<int>"
        ),
        "described",
    )
    lists = inverted_lists(described, nearest, shared, chunk).repartition(tasks(spark), "pivot", "low", "high")
    found = written(
        lists.groupBy("pivot", "low", "high").applyInPandas(
            lambda key, pdf: list_links(key, pdf, threshold, shared), "kind int, a long, b long"
        ),
        "links",
    )
    joined = components(found.where("kind = 1").select("a", "b"))
    counts = found.where("kind = 0").groupBy(F.col("a").alias("cid")).agg(F.sum("b").alias("links"))
    named = classes.join(joined.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("component", "cid"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = named.join(least, "root").join(counts, "cid", "left").select(
        F.col("vector").alias("v"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"
    )
    # Unusable vectors have no class; a component of equal ids alone is named by its smallest.
    out = rows.join(by_class, rows["vector"] == by_class["v"], "left")
    return out.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("v").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def op2_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    groups = embedding_groups(table(spark, sf_dir, "embeddings"))
    return groups.select(
        F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


OP2_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), r(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b
)
SELECT e.vec_id, (SELECT count(*) FROM l WHERE l.a = e.vec_id) AS n_links, min(r.b) AS component_id, e.vec_id = min(r.b) AS kept
FROM embeddings e JOIN r ON r.a = e.vec_id GROUP BY e.vec_id
"""
