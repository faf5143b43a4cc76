"""Toxicity by logistic regression over hashed word n-grams and skip-grams, fitted with FTRL-proximal.

A text's features are the words, the pairs of neighbours, and the pairs of words with
one or two others between them, each hashed into one of ``BUCKETS`` and counted as present
or not. FTRL-proximal learns with a rate of its own for every bucket; its L1 term keeps
all weights at zero that the labels do not speak for, so that what is left is small
enough to be sent to every task.

A model is fitted on about ``ROWS`` labelled rows, chosen by a hash of their ids. They are
dealt into ``SHARDS`` that learn at the same time, one row after another, from one state;
after each round a bucket's state moves by the mean over the shards that met it. Only
states pass through the driver: at most ``SHARDS`` x ``BUCKETS`` x 8 bytes. Scoring is one
pass over the whole texts without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brasstally.llm.common import table, written

BUCKET_BITS = 20
BUCKETS = 1 << BUCKET_BITS
ROWS = 32_768
SHARDS = 4
ROUNDS = 4
ALPHA, BETA, L1, L2 = 2.0, 1.0, 3.0, 0.1
FOLDS = 5
WORD = re.compile(r"[^\W\d_]+")
# Distances of the paired words: neighbours, and one or two words skipped.
PAIRS = (1, 2, 3)
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def features(text: str | None) -> list[np.ndarray]:
    """Buckets of a whole text's features, family by family, with repeats."""
    import xxhash

    words = [w.encode("utf-8", "surrogatepass") for w in WORD.findall((text or "").lower())]
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    shift = np.uint64(64 - BUCKET_BITS)
    with np.errstate(over="ignore"):
        out = [(h * SPREAD) >> shift]
        for gap in PAIRS:
            if len(h) > gap:
                pair = h[:-gap] * np.uint64(2 * gap + 1) ^ (h[gap:] * SPREAD + np.uint64(gap))
                out.append(((pair ^ (pair >> np.uint64(29))) * SPREAD) >> shift)
    return [x.astype(np.int64) for x in out]


@dataclass
class State:
    """FTRL's sums for every bucket; the last place is the intercept, which has no L1 term."""

    prior: float = 0.0
    z: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS + 1, dtype=np.float32))
    n: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS + 1, dtype=np.float32))

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at].astype(np.float64), self.n[at].astype(np.float64)
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def intercept(self) -> float:
        return self.prior - float(self.z[-1]) / ((BETA + math.sqrt(float(self.n[-1]))) / ALPHA)

    def learn(self, at: np.ndarray, label: int) -> None:
        """One step on a row's distinct buckets."""
        w, b = self.weights(at), self.intercept()
        g = chance(b + float(w.sum())) - label
        for places, now in ((at, w), (np.array([BUCKETS]), b - self.prior)):
            n = self.n[places].astype(np.float64)
            self.z[places] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * now
            self.n[places] = n + g * g


def chance(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x > -500 else 0.0


@dataclass
class Model:
    """What is sent to the tasks: the buckets whose weights are not zero, their weights, and the intercept."""

    buckets: np.ndarray
    weights: np.ndarray
    intercept: float

    def lookup(self) -> np.ndarray:
        out = np.zeros(BUCKETS)
        out[self.buckets] = self.weights
        return out

    def score(self, text: str | None, lookup: np.ndarray) -> float:
        met = [x[lookup[x] != 0] for x in features(text)]
        return chance(self.intercept + float(lookup[np.unique(np.concatenate(met))].sum()))


def held_out(id_: Column) -> Column:
    """Whether the id's CRC-32 (of its decimal text) is divisible by ``FOLDS``; null ids are not held out."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, rows: int, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """``order``, ``shard``, ``text``, ``label`` of about ``rows`` labelled documents that are not held out.

    Labels other than 0 and 1 and ids that carry both teach nothing; an id teaches once,
    with the first of its texts.
    """
    known = labels.select(labels[f"`{id_col}`"].alias("id"), labels[f"`{label_col}`"].cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
    known = written(known.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other"), "labels")
    order = F.xxhash64(F.col("id").cast("string"), F.lit("toxicity"))
    share = min(1.0, rows / max(1, known.count()))
    place = F.shiftrightunsigned(order, 11) / F.lit(float(1 << 53))
    chosen = known.select("id", "label", order.alias("order"), place.alias("place")).where(F.col("place") < share)
    texts = docs.select(docs[f"`{id_col}`"].alias("id"), docs[f"`{text_col}`"].cast("string").alias("text"))
    # At most about ``rows`` short rows are broadcast.
    met = texts.join(F.broadcast(chosen.drop("place")), "id")
    first = met.groupBy("order", "id", "label").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    return first.select("order", F.pmod("order", F.lit(SHARDS)).cast("int").alias("shard"), "text", "label")


def one_round(sample: DataFrame, state: State) -> State:
    """Every shard learns from ``state`` on; buckets move by the mean over the shards that met them."""
    shared = sample.sparkSession.sparkContext.broadcast(state)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told() -> pa.RecordBatch:
            columns = [[shard], [own.z.tobytes()], [own.n.tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.binary(), pa.binary()))], names=["shard", "z", "n"])

        shard, own = None, None
        for batch in batches:
            for here, text, label in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                if here != shard:
                    if own:
                        yield told()
                    shard, own = here, State(shared.value.prior, shared.value.z.copy(), shared.value.n.copy())
                own.learn(np.unique(np.concatenate(features(text.as_py()))), label)
        if own:
            yield told()

    dealt = sample.repartition(SHARDS, "shard").sortWithinPartitions("shard", "order").select("shard", "text", "label")
    moved, steps = np.zeros(BUCKETS + 1, dtype=np.int32), [np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)]
    for row in sorted(dealt.mapInArrow(run, "shard int, z binary, n binary").collect(), key=lambda r: r["shard"]):
        z, n = (np.frombuffer(row[c], dtype=np.float32) for c in ("z", "n"))
        moved += n != state.n
        steps[0] += z - state.z
        steps[1] += n - state.n
    z, n = ((old + step / np.maximum(moved, 1)).astype(np.float32) for old, step in zip((state.z, state.n), steps))
    return State(state.prior, z, n)


def fit(
    docs: DataFrame, labels: DataFrame, rows: int = ROWS, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> Model:
    """A model of ``label_col`` in ``labels`` by the texts of ``docs``; see ``labelled`` for what teaches it.

    Without a labelled row every text scores 0.25.
    """
    sample = written(labelled(docs, labels, rows, id_col, text_col, label_col), "labelled")
    n, toxic = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    state = State(math.log((toxic + 0.5) / (n - toxic + 1.5)))
    for _ in range(rounds if n else 0):
        state = one_round(sample, state)
    w = state.weights(slice(0, BUCKETS))
    kept = np.nonzero(w)[0]
    return Model(kept, w[kept], state.intercept())


def scored(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) of every whole text, and ``predicted``; null texts are empty.

    Columns of these names are replaced, all others stay as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rest = [c for c in docs.columns if c not in ("score", "predicted")]
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in rest]).alias("row"), docs[f"`{text_col}`"].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = shared.value.lookup()
        for batch in batches:
            scores = pa.array([shared.value.score(t.as_py(), lookup) for t in batch.column(1)], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), scores], names=["row", "score"])

    kinds = ", ".join(f"`{f.name.replace('`', '``')}`: {f.dataType.simpleString()}" for f in rows.schema["row"].dataType.fields)
    out = rows.mapInArrow(run, f"row struct<{kinds}>, score double")
    return out.select("row.*", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = scored(docs, fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
