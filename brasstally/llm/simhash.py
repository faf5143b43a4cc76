"""Near duplicates by SimHash fingerprints, compared bit-sliced.

A fingerprint's bit is the majority of its shingles' hash bits. Documents of equal
fingerprints are one class from then on. Classes within the radius share at least
``KEPT`` of ``BANDS`` bands, so each goes to one block for every choice of bands. In a
block the fingerprints stand as bit planes: plane by plane, one exclusive-or marks
which of them differ from a query in that bit, and carry-save counters add this to
all distances at once. A stretch of a block is left as soon as all its distances have
passed the radius.

A block with more than ``LARGE`` classes is dealt anew by the bits that its members do
not share; after that no block can hold more than a few thousand. A block gives a
forest of its links, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brasstally.llm.common import table, tasks, written
from brasstally.llm.components import components

SHINGLE = 3
SEED = 42
BITS = 64
RADIUS = 2
BANDS = 5
KEPT = BANDS - RADIUS
LARGE = 4096
TOGETHER = 512
SPACES = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")
STRETCH = 64 * 16


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The signed 64-bit SimHash of a text's word shingles; 0 without words."""
    import xxhash

    low = text.encode().lower()  # bytes: only A to Z change
    words = low.translate(SPACES).split(b" ")
    words = [w for w in words if w]
    if not words:
        return 0
    hashed, join = xxhash.xxh64_intdigest, b" ".join
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, 1 << 16):
        part = range(at, min(n, at + (1 << 16)))
        h = np.array([hashed(join(words[i : i + shingle]), SEED) for i in part], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``digest`` (SHA-256 of the text) and ``fp`` of every row; null texts are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps, pa.int64())], names=["doc_id", "digest", "fp"])

    text = F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit(""))
    rows = docs.select(docs[f"`{id_col}`"].alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, digest binary, fp long")


def band_masks(free: int, bands: int = BANDS) -> list[int]:
    """The bits of ``free`` in ``bands`` parts, as even as can be, as masks."""
    places = [b for b in range(BITS) if free >> b & 1]
    cuts = [len(places) * k // bands for k in range(bands + 1)]
    return [sum(1 << b for b in places[a:z]) for a, z in zip(cuts, cuts[1:])]


def signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def keys(free: int) -> list[int]:
    """One mask for every choice of ``KEPT`` bands: what two fingerprints within the radius share."""
    return [sum(c) for c in combinations(band_masks(free), KEPT)]


def in_blocks(classes: DataFrame) -> DataFrame:
    """``fp`` rows to (``block``, ``part``, ``fp``): block tells the masks that are shared, part their bits."""
    every = (1 << BITS) - 1
    first = keys(every)

    def struct(block: int, mask: int, shared: int = 0) -> Column:
        return F.struct(F.lit(block).alias("block"), F.col("fp").bitwiseAND(F.lit(signed(mask | shared))).alias("part"))

    dealt = classes.select("fp", F.explode(F.array(*[struct(k, m) for k, m in enumerate(first)])).alias("k")).select("fp", "k.*")
    sizes = dealt.groupBy("block", "part").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = dealt.join(sizes, ["block", "part"])
    # Within a large block, the bits not shared yet are banded in turn.
    choices = F.lit(None)
    for k, m in enumerate(first):
        finer = F.array(*[struct((k + 1) * 100 + j, x, m) for j, x in enumerate(keys(every & ~m))])
        choices = F.when(F.col("block") == k, finer).otherwise(choices)
    own = F.array(F.struct("block", "part"))
    spread = blocks.select("fp", F.explode(F.when(F.col("n") > LARGE, choices).otherwise(own)).alias("k"))
    return spread.select("k.block", "k.part", "fp")


def planes(fps: np.ndarray) -> np.ndarray:
    """Bit planes: row b holds bit b of all fingerprints, 64 of them in a word."""
    n = -(-len(fps) // 64) * 64
    padded = np.zeros(n, dtype="<u8")
    padded[: len(fps)] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def within_radius(fps: np.ndarray, block: np.ndarray, queries: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each query's place: the places in the planes of fingerprints at most ``RADIUS`` (2) bits away, its own included.

    Two carry-save counters and an overflow hold every distance up to 3 and more. A
    query's own place is not counted, so that a stretch without a neighbour is left as
    soon as all other distances in it have passed the radius.
    """
    full, zero, one = np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0), np.uint64(1)
    for first in range(0, len(queries), 256):
        some = queries[first : first + 256]
        bits = [np.where((fps[some] >> np.uint64(b)) & one, full, zero)[:, None] for b in range(BITS)]
        for at in range(0, block.shape[1], STRETCH // 64):
            part = block[:, at : at + STRETCH // 64]
            ones = np.zeros((len(some), part.shape[1]), dtype=np.uint64)
            twos, passed = ones.copy(), ones.copy()
            own = np.nonzero((some // 64 >= at) & (some // 64 < at + part.shape[1]))[0]
            itself = passed.copy()
            itself[own, some[own] // 64 - at] = one << (some[own] % 64).astype(np.uint64)
            passed |= itself
            for b in range(BITS):
                differ = part[b] ^ bits[b]
                carry = ones & differ
                ones ^= differ
                # Three is beyond the radius: the counters need not go on from there.
                twos |= carry
                passed |= ones & twos
                if b % 8 == 7 and (passed == full).all():
                    break
            near = ~passed | itself
            rows, words = np.nonzero(near)
            if len(rows):
                found = np.unpackbits(near[rows, words].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                hits, places = np.nonzero(found)
                yield some[rows[hits]], (at + words[hits]) * 64 + places


def block_links(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the links among fingerprints: each with the smallest that it reaches here."""
    order = np.argsort(fps.view(np.int64), kind="stable")
    fps = fps[order]
    parent = list(range(len(fps)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for queries, others in within_radius(fps, planes(fps), np.arange(len(fps))):
        for q, o in zip(queries.tolist(), others.tolist(), strict=True):
            if q < o < len(fps):
                a, b = root(q), root(o)
                if a != b:
                    parent[max(a, b)] = min(a, b)
    roots = np.array([root(x) for x in range(len(fps))])
    moved = np.nonzero(roots != np.arange(len(fps)))[0]
    return fps[moved].view(np.int64), fps[roots[moved]].view(np.int64)


def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted (block, part, fp) rows of a task to edges between fingerprints.

    Whole blocks stand side by side in the planes until these hold ``TOGETHER``
    fingerprints, so that small blocks fill their words; what is found across two blocks
    is a link as well. A task holds these and the rows of one block.
    """
    held: list[np.ndarray] = []
    last, together, out_a, out_b, n = None, [], [], [], 0

    def close(all_: bool = False):
        nonlocal n, together
        if held:
            together += held
        if together and (all_ or sum(map(len, together)) >= TOGETHER):
            fps = np.unique(np.concatenate(together)).view(np.uint64)
            together = []
            a, b = block_links(fps)
            out_a.append(a)
            out_b.append(b)
            n += len(a)

    for pdf in batches:
        block, part, fp = (pdf[c].to_numpy() for c in ("block", "part", "fp"))
        cuts = np.nonzero((block[1:] != block[:-1]) | (part[1:] != part[:-1]))[0] + 1
        for a, z in zip([0, *cuts], [*cuts, len(fp)]):
            if a == z:
                continue
            here = (block[a], part[a])
            if here != last:
                close()
                held = []
            last = here
            held.append(fp[a:z])
        if n > 10_000:
            yield pd.DataFrame({"a": np.concatenate(out_a), "b": np.concatenate(out_b)})
            out_a, out_b, n = [], [], 0
    close(all_=True)
    if n:
        yield pd.DataFrame({"a": np.concatenate(out_a), "b": np.concatenate(out_b)})


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` (the smallest id reachable over links) of every row.

    Null texts and texts without words share fingerprint 0 and are linked like others.
    A null id never names a group unless the group has no other. Rows that repeat an id
    each give a row, in the group of their own text; an empty table gives none.
    """
    return groups_by_text(docs, id_col, text_col, shingle).select("doc_id", "fp", "component_id")


def groups_by_text(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``simhash_groups``, with ``digest`` (SHA-256 of the text) and ``root`` (the group's own key: a fingerprint in it)."""
    spark = docs.sparkSession
    rows = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    classes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    blocks = in_blocks(classes.select("fp")).repartition(tasks(spark), "block", "part").sortWithinPartitions("block", "part", "fp")
    joined = components(blocks.mapInPandas(links, "a long, b long"))
    named = classes.join(joined.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("component", "fp"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = named.join(least, "root").select("fp", "root", "component_id")
    return rows.join(by_class, "fp").select("doc_id", "digest", "fp", "component_id", "root")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row of each group, with all columns of ``docs``: the one with the smallest id.

    A null id stays only where its group has no other id; of rows that share the
    smallest id, the smallest text digest stays; of rows equal in id and text, the first
    by their other columns. A text's group follows from the text alone, so that rows
    which share an id or have none, but differ in text, do not stand for each other.
    """
    groups = groups_by_text(docs, id_col, text_col, shingle)
    first = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("first"))
    kept = first.select(key_of(F.col("first.doc_id")).alias("key"), F.col("first.digest").alias("digest"))
    text = F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit(""))
    marked = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
        key_of(docs[f"`{id_col}`"]).alias("key"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )
    stay = marked.join(kept, ["key", "digest"], "left_semi")
    others = F.to_json(F.struct(*[F.col("row").getField(c).alias(f"c{n}") for n, c in enumerate(docs.columns) if c != text_col]))
    return stay.groupBy("key", "digest").agg(F.min_by("row", others).alias("row")).select("row.*")


def key_of(id_: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), id_.cast("string")), F.lit("null"))


def op4_simhash(spark, sf_dir: str) -> DataFrame:
    groups = simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
