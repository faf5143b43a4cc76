"""Ranked lexical search over bit-sliced Bloom signatures, with exact rescoring.

Documents of like size stand together in blocks of up to ``BLOCK`` rows. A block's
signatures are kept as slices: slice *b* is a bitmap over the block's documents that
tells whose Bloom filter has bit *b*. A filter holds a key for every term, and one more
for each level of ``LEVELS`` that the term's count reaches. The slices of a key, joined by
*and*, are a bitmap of documents that may hold it: never too few, sometimes too many.

For a block of items, every term's bitmaps level by level tell the most that it can
add to a document's score; their weighted sum bounds the score from above. The
documents with the highest bounds are scored exactly, and the tenth best of these
scores is a limit that no better document can miss: all documents whose bound
reaches it are then scored from their whole texts, and only those that it proves to be
worse are left out. No document, term or candidate is dropped for its number.

The index knows nothing of the items. Items are taken in blocks of at most ``ITEMS``
items (and ``VOCABULARY`` terms, unless one item alone has more), which bounds what is
broadcast.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brasstally.llm.common import table, written

TOP = 10
SEEDS = 32
BLOCK = 1024
ITEMS = 512
VOCABULARY = 16_384
# Bits of a filter for each key (up to the next power of two), and bits that a key sets.
BITS_PER_KEY = 10
BITS_SET = 4
HELD = 64 << 20
BROADCAST = 1_000_000
LEVELS = np.array(sorted({1, *(1 << k for k in range(1, 40)), *(3 << k for k in range(39))}), dtype=np.int64)
SEPARATED = bytes((b + 32 if 65 <= b <= 90 else b) if chr(b).isalnum() or b >= 128 else 32 for b in range(256))
STEP = np.uint64(0x9E3779B97F4A7C15)


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a whole text: runs of ASCII letters, digits and characters beyond ASCII; A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(SEPARATED).split()


def hashes_of(terms: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, terms), dtype=np.uint64, count=len(terms))


def places(hashes: np.ndarray, levels: np.ndarray, bits: int) -> np.ndarray:
    """The ``BITS_SET`` slices of each key (term at level) in filters of ``bits`` (a power of two) bits."""
    with np.errstate(over="ignore"):
        x = hashes + levels.astype(np.uint64) * STEP
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        step = (x >> np.uint64(32)) | np.uint64(1)
        return ((x[:, None] + step[:, None] * np.arange(BITS_SET, dtype=np.uint64)) & np.uint64(bits - 1)).astype(np.int64)


def signature(terms: list[bytes]) -> tuple[int, np.ndarray]:
    """Size of a document's filter and the bits set in it."""
    counted = Counter(terms)
    reached = np.searchsorted(LEVELS, np.fromiter(counted.values(), dtype=np.int64, count=len(counted)), side="right")
    keys = int(reached.sum())
    bits = 1 << max(6, (BITS_PER_KEY * keys - 1).bit_length())
    level = np.arange(keys) - np.repeat(np.cumsum(reached) - reached, reached)
    return bits, places(np.repeat(hashes_of(list(counted)), reached), LEVELS[level], bits).ravel()


def sliced(bits: int, rows: list[np.ndarray]) -> np.ndarray:
    """Slices of a block: one line of bits over the documents for every bit of the filter."""
    out = np.zeros((bits, -(-len(rows) // 8)), dtype=np.uint8)
    for n, at in enumerate(rows):
        out[at, n >> 3] |= np.uint8(1 << (n & 7))
    return out


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The signature table: ``bits``, ``ids``, ``lengths`` (terms with repeats) and ``slices`` of each block.

    Every document with a term is in one block; null texts and texts without terms are in none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        size, kind = 0, None

        def block(bits: int) -> pa.RecordBatch:
            rows = held.pop(bits)
            made = [bits], [[r[0] for r in rows]], [[r[1] for r in rows]], [sliced(bits, [r[2] for r in rows]).tobytes()]
            types = pa.int64(), pa.list_(kind), pa.list_(pa.int64()), pa.binary()
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(made, types)], names=["bits", "ids", "lengths", "slices"])

        for batch in batches:
            kind = batch.column(0).type
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not (terms := terms_of(text.as_py())):
                    continue
                bits, at = signature(terms)
                held.setdefault(bits, []).append((id_, len(terms), at))
                size += at.nbytes
                if len(held[bits]) == BLOCK:
                    size -= sum(r[2].nbytes for r in held[bits])
                    yield block(bits)
                elif size > HELD:
                    for bits in list(held):
                        yield block(bits)
                    size = 0
        for bits in list(held):
            yield block(bits)

    rows = docs.select(docs[f"`{id_col}`"].alias("id"), docs[f"`{text_col}`"].cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return written(rows.mapInArrow(run, f"bits long, ids array<{kind}>, lengths array<long>, slices binary"), "signatures")


class Items:
    """A block of items as its tasks need it: vocabulary, weights, and each item's terms with repeats."""

    CHUNK = 2048

    def __init__(self, items: list[Counter]):
        self.items = items
        self.vocabulary = {t: n for n, t in enumerate(dict.fromkeys(t for terms in items for t in terms))}
        self.hashes = hashes_of(list(self.vocabulary))
        pairs = [np.array(sorted((self.vocabulary[t], n) for t, n in terms.items()), dtype=np.int64) for terms in items]
        self.terms, self.repeats = [x[:, 0] for x in pairs], [x[:, 1] for x in pairs]
        self.weights = np.zeros(len(self.vocabulary), dtype=np.int64)
        self.documents = self.length = 0
        self.least: list[tuple[int, object]] = []

    def weigh(self, documents: int, length: int, holding: dict[int, int]) -> None:
        """Weights by the numbers of all documents with terms, of all terms, and of documents that hold each term."""
        self.documents, self.length = documents, length
        for n in range(len(self.weights)):
            self.weights[n] = math.floor(1000 * math.log((2 * documents + 2) / (2 * holding.get(n, 0) + 1)))

    def damping(self, n: int) -> int:
        return 25 + 75 * n * self.documents // self.length

    def bounds(self, bits: int, lengths: list[int], slices: bytes) -> np.ndarray:
        """The most that each document of a block can score for each item (lines)."""
        lines = np.frombuffer(slices, dtype=np.uint8).reshape(bits, -1)
        most = np.array(lengths, dtype=np.int64)
        slow = np.array([8 * self.damping(n) for n in lengths], dtype=np.int64)
        out = np.zeros((len(self.items), len(lengths)), dtype=np.int64)
        for first in range(0, len(self.hashes), self.CHUNK):
            reached = self.reached(lines, bits, len(lengths), first)
            shown = np.nonzero(reached.any(axis=1))[0]
            if not len(shown):
                continue
            # What a term with the highest count below the next level adds for a weight of one.
            counts = np.minimum(LEVELS[1 : reached.max() + 1, None] - 1, most)
            adds = np.concatenate([np.zeros_like(most)[None], 1_000_000_000 * counts // (1000 * counts + slow)])
            value = np.zeros((reached.shape[0], len(lengths)), dtype=np.int64)
            value[shown] = np.take_along_axis(adds, reached[shown].astype(np.intp), axis=0) * self.weights[first + shown, None]
            for n, (terms, repeats) in enumerate(zip(self.terms, self.repeats)):
                a, z = np.searchsorted(terms, [first, first + self.CHUNK])
                if a < z:
                    out[n] += (value[terms[a:z] - first] * repeats[a:z, None]).sum(axis=0)
        return out

    def reached(self, lines: np.ndarray, bits: int, documents: int, first: int) -> np.ndarray:
        """For each term from ``first`` on and each document: number of levels that its filter shows."""
        hashes = self.hashes[first : first + self.CHUNK]
        out = np.zeros((len(hashes), documents), dtype=np.uint8)
        alive, before = np.arange(len(hashes)), None
        for level in LEVELS:
            at = places(hashes[alive], np.full(len(alive), level), bits)
            here = reduce(np.bitwise_and, (lines[at[:, k]] for k in range(BITS_SET)))
            if before is not None:
                here &= before
            some = here.any(axis=1)
            alive, before = alive[some], here[some]
            if not len(alive):
                break
            out[alive] += np.unpackbits(before, axis=1, bitorder="little")[:, :documents]
        return out

    def scores(self, text: str | None, wanted: list[int]) -> list[int]:
        """Exact scores of a whole text for some of the items."""
        terms = terms_of(text)
        value = np.zeros(len(self.weights), dtype=np.int64)
        if terms:
            slow = 8 * self.damping(len(terms))
            for term, n in Counter(terms).items():
                if (at := self.vocabulary.get(term)) is not None:
                    value[at] = int(self.weights[at]) * (1_000_000_000 * n // (1000 * n + slow))
        return [int((value[self.terms[n]] * self.repeats[n]).sum()) for n in wanted]


def in_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[tuple[list, Items]]:
    """Items with a term, block by block: their ids and what the tasks need. The driver holds one block."""
    ids, counted, known = [], [], set()
    for row in items.select(items[f"`{id_col}`"].alias("id"), items[f"`{text_col}`"].cast("string").alias("text")).toLocalIterator():
        terms = Counter(terms_of(row["text"]))
        if not terms:
            continue
        if ids and (len(ids) == ITEMS or len(known | terms.keys()) > VOCABULARY):
            yield ids, Items(counted)
            ids, counted, known = [], [], set()
        ids.append(row["id"])
        counted.append(terms)
        known |= terms.keys()
    if ids:
        yield ids, Items(counted)


def statistics(texts: DataFrame, items: Items) -> None:
    """Count documents, terms and holders of each term over all whole texts, and set the items' weights."""
    shared = texts.sparkSession.sparkContext.broadcast(items.vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, holding, documents, length = shared.value, Counter(), 0, 0
        for batch in batches:
            for text in batch.column(0):
                if terms := terms_of(text.as_py()):
                    documents += 1
                    length += len(terms)
                    holding.update(vocabulary[t] for t in vocabulary.keys() & set(terms))
        rows = [(-2, documents), (-1, length), *holding.items()]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], names=["term", "n"])

    found = texts.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = {r["term"]: r["n"] for r in found}
    items.weigh(counts.pop(-2, 0), counts.pop(-1, 0), counts)


def highest(signatures: DataFrame, items: Items, seeds: int) -> DataFrame:
    """(``item``, ``id``): for each item, the documents with the highest bounds, ``seeds`` of each task."""
    shared, kind = signatures.sparkSession.sparkContext.broadcast(items), signatures.schema["ids"].dataType.elementType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, best, type_ = shared.value, {}, None
        for batch in batches:
            type_ = batch.column(1).type.value_type
            for bits, ids, lengths, slices in zip(*(c.to_pylist() for c in batch.columns)):
                for n, line in enumerate(own.bounds(bits, lengths, slices)):
                    for d in np.argpartition(-line, min(seeds, len(line) - 1))[:seeds].tolist():
                        if line[d]:
                            best.setdefault(n, []).append((int(line[d]), ids[d]))
                    if len(best.get(n, ())) > 8 * seeds:
                        best[n] = sorted(best[n], key=lambda x: -x[0])[:seeds]
        rows = [(n, d, b) for n, some in best.items() for b, d in sorted(some, key=lambda x: -x[0])[:seeds]]
        if rows:
            columns = zip(zip(*rows), (pa.int32(), type_, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in columns], names=["item", "id", "bound"])

    found = signatures.mapInArrow(run, f"item int, id {kind.simpleString()}, bound long")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("bound"), F.asc_nulls_last("id")))
    return found.withColumn("rank", rank).where(F.col("rank") <= seeds).select("item", "id")


def possible(signatures: DataFrame, items: Items) -> DataFrame:
    """(``item``, ``id``): all documents that the item's limit doesn't prove to be outside its best."""
    shared, kind = signatures.sparkSession.sparkContext.broadcast(items), signatures.schema["ids"].dataType.elementType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for bits, ids, lengths, slices in zip(*(c.to_pylist() for c in batch.columns)):
                bounds = own.bounds(bits, lengths, slices)
                limit = np.array([x for x, _ in own.least], dtype=np.int64)[:, None]
                hit, at = np.nonzero((bounds >= limit) & (bounds > 0))
                # A document that can only equal the limit must come before the last one there.
                tied = bounds[hit, at] == limit[hit, 0]
                out = [
                    (n, ids[d])
                    for n, d, same in zip(hit.tolist(), at.tolist(), tied.tolist())
                    if not same or not own.least[n][0] or before(ids[d], own.least[n][1])
                ]
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], batch.column(1).type.value_type)],
                        names=["item", "id"],
                    )

    return signatures.mapInArrow(run, f"item int, id {kind.simpleString()}")


def before(id_, last) -> bool:
    """Whether ``id_`` comes no later than ``last``; null ids come last."""
    return last is None or (id_ is not None and id_ <= last)


def best_of(texts: DataFrame, candidates: DataFrame, items: Items, top: int, small: bool) -> DataFrame:
    """(``item``, ``id``, ``score``, ``rank``) of the best candidates, scored exactly from their whole texts.

    The texts themselves are moved only where the candidates are too many to be broadcast.
    """
    shared, kind = texts.sparkSession.sparkContext.broadcast(items), texts.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, best, type_ = shared.value, {}, None
        order = lambda x: (-x[0], x[1] is None, x[1])
        for batch in batches:
            type_ = batch.column(0).type
            for id_, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                for n, score in zip(wanted, own.scores(text.as_py(), wanted)):
                    if score:
                        best.setdefault(n, []).append((score, id_))
                        if len(best[n]) > 8 * top:
                            best[n] = sorted(best[n], key=order)[:top]
        rows = [(n, d, s) for n, some in best.items() for s, d in sorted(some, key=order)[:top]]
        if rows:
            columns = zip(zip(*rows), (pa.int32(), type_, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in columns], names=["item", "id", "score"])

    wanted = candidates.groupBy("id").agg(F.sort_array(F.collect_set("item")).alias("wanted")).withColumnRenamed("id", "known")
    rows = texts.join(F.broadcast(wanted) if small else wanted, F.col("id").eqNullSafe(F.col("known"))).select("id", "text", "wanted")
    scored = rows.mapInArrow(run, f"item int, id {kind}, score long")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id")))
    return scored.withColumn("rank", rank).where(F.col("rank") <= top)


def search(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: each item's ``top`` highest-scoring documents, score above 0.

    Equal scores are ranked by ascending id, null ids last. Null and empty texts hold no
    term: such documents are found by no item and count nowhere, such items find none.
    Every row of ``docs`` is a document and every row of ``items`` an item by itself, so
    that repeated rows are ranked one by one. Other columns do not matter.
    """
    spark = docs.sparkSession
    texts = docs.select(docs[f"`{doc_id}`"].alias("id"), docs[f"`{doc_text}`"].cast("string").alias("text"))
    kinds = items.schema[item_id].dataType.simpleString(), texts.schema["id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score long")
    signatures = None
    for ids, block in in_blocks(items, item_id, item_text):
        statistics(texts, block)
        if not block.documents:
            break
        signatures = index(docs, doc_id, doc_text) if signatures is None else signatures
        seeds = best_of(texts, highest(signatures, block, max(SEEDS, top)), block, top, small=True)
        limits = {r["item"]: (r["score"], r["id"]) for r in seeds.where(F.col("rank") == top).collect()}
        block.least = [limits.get(n, (0, None)) for n in range(len(ids))]
        candidates = written(possible(signatures, block), "candidates")
        best = best_of(texts, candidates, block, top, small=candidates.count() <= BROADCAST)
        names = spark.createDataFrame(list(enumerate(ids)), f"item int, item_id {kinds[0]}")
        named = written(best, "best").join(F.broadcast(names), "item")
        out = out.union(named.select("item_id", F.col("rank").cast("int"), F.col("id").alias("doc_id"), "score"))
    return out


def op13_lexical_search(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
),
asked AS (
  SELECT item_id, term, count(*) AS repeats FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL
),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
totals AS (SELECT count(*) AS documents, sum(n)::BIGINT AS length FROM lengths),
counts AS (SELECT doc_id, term, count(*) AS tf FROM words SEMI JOIN asked USING (term) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * documents + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), totals
),
scored AS (
  SELECT item_id, doc_id,
         sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * documents) // length))))::BIGINT AS score
  FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), totals
  GROUP BY ALL
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
) WHERE rank <= 10
"""
