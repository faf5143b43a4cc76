"""Repeated passages by paragraph MinHash banding.

Paragraphs are the lines of a text that have at least ``LEAST_WORDS`` words, and, as
passages are often set into longer lines, also stretches of ``STRETCH`` words that
begin at anchors: words whose shingle has the smallest hash of ``SPAN`` in a row. Equal
text has equal anchors wherever it stands, so a passage of ``STRETCH + SPAN`` - 1 words
or more that two documents share has a stretch in common.

Lines get MinHash signatures, banded for high recall (``BANDS`` bands of ``ROWS`` rows:
0.995 at the threshold); lines that collide are joined and verified by the exact
Jaccard similarity of their shingle sets. A stretch is a single band of all its words.
Equal paragraphs are one class throughout, verified classes are clustered by
components, and each cluster keeps one paragraph, that of the smallest document id.

Colliding lines are first compared with the most frequent line of their bucket only.
Then, in buckets whose lines are not yet one component, lines of different components
are compared, so that no link which the bands offer is lost to the shortcut. That is
done inside tasks, a tile of a bucket at a time, and gives a forest of the links: no
pairs are written out, however many lines a bucket holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brasstally.llm.common import table, tasks, written
from brasstally.llm.components import components

LEAST_WORDS = 50
SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 10, 4
STRETCH, SPAN = 37, 15
#: Lines of an open bucket that one task compares with as many others.
TILE = 512
#: Names a null id while identifiers are compared.
NO_ID = -(1 << 63)
BASE = np.uint64(0x9E3779B97F4A7C15)
UNITS = "line boolean, doc long, start int, end int, words int, hash long, bands array<long>, shingles array<int>"


def inverse(odd: int) -> int:
    """The inverse of an odd number modulo 2^64."""
    x = odd
    for _ in range(6):
        x = x * (2 - odd * x) % (1 << 64)
    return x


BACK = np.uint64(inverse(int(BASE)))


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def stretch_hashes(sums: np.ndarray, back: np.ndarray, n: int) -> np.ndarray:
    """Hash of each ``n`` words in a row, from the running sums of word hashes by powers."""
    return mixed((sums[n:] - sums[:-n]) * back[: len(sums) - n]) if len(sums) > n else np.zeros(0, dtype=np.uint64)


def anchors(shingles: np.ndarray) -> np.ndarray:
    """Places that hold the smallest hash of some ``SPAN`` places in a row."""
    n = len(shingles)
    if n < SPAN:
        return np.zeros(0, dtype=np.int64)
    least = shingles
    for k in halvings(SPAN):
        least = np.minimum(least[:-k], least[k:])
    # A place is one if a stretch around it has no smaller hash: the largest of those stretches' smallest is its own.
    edge = np.zeros(SPAN - 1, dtype=np.uint64)
    most = np.concatenate([edge, least, edge])
    for k in halvings(SPAN):
        most = np.maximum(most[:-k], most[k:])
    return np.nonzero(most == shingles)[0]


def halvings(n: int) -> list[int]:
    """Steps by which a value over single places grows into one over ``n`` places."""
    steps, width = [], 1
    while width < n:
        steps.append(min(width, n - width))
        width += steps[-1]
    return steps


def permutations() -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(7)
    return r.integers(1, 1 << 63, (BANDS * ROWS, 1), dtype=np.uint64) | np.uint64(1), r.integers(0, 1 << 63, (BANDS * ROWS, 1), dtype=np.uint64)


class Powers:
    """Powers of the base and of its inverse, as many as the longest text so far has needed."""

    def __init__(self):
        self.up = self.back = np.ones(1, dtype=np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = max(1 << 14, 2 * n)
            self.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, BASE, dtype=np.uint64)]), dtype=np.uint64)
            self.back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, BACK, dtype=np.uint64)]), dtype=np.uint64)
        return self.up, self.back


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The keys of a shingle set's bands."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 4096):
        least = np.minimum(least, (shingles[None, at : at + 4096] * a + b).min(axis=1))
    least = least.reshape(BANDS, ROWS)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        keys = mixed(keys * BASE + least[:, k])
    return keys.view(np.int64)


def paragraphs(text: str, a: np.ndarray, b: np.ndarray, powers: Powers) -> tuple[list, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """A text's lines as rows of (start, end, words, hash, bands, shingles), its stretches as arrays of starts, ends and hashes."""
    import xxhash

    none = np.zeros(0, dtype=np.int64)
    signs = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    space = (signs == 32) | (signs - np.uint32(9) < 5)
    edge = np.diff(space.view(np.int8), prepend=np.int8(1), append=np.int8(1))
    starts, ends = np.nonzero(edge == -1)[0], np.nonzero(edge == 1)[0]
    n = len(starts)
    if n < min(LEAST_WORDS, STRETCH):
        return [], (none, none, none)
    words = text.encode("utf-8", "surrogatepass").lower().split()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=n)
    with np.errstate(over="ignore"):
        up, back = powers.of(n + 1)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * up[:n], dtype=np.uint64)])
        shingles = stretch_hashes(sums, back, SHINGLE)
        at = anchors(shingles)
        at = at[at + STRETCH <= n]
        whole = mixed((sums[at + STRETCH] - sums[at]) * back[at])
        lines = []
        breaks = np.nonzero(signs == 10)[0]
        first = np.searchsorted(starts, np.concatenate([[0], breaks + 1]))
        last = np.concatenate([first[1:], [n]])
        long = np.nonzero(last - first >= LEAST_WORDS)[0]
        for i, j in zip(first[long].tolist(), last[long].tolist(), strict=True):
            own = np.unique(shingles[i : j - SHINGLE + 1])
            total = mixed((sums[j : j + 1] - sums[i]) * back[i] + np.uint64(j - i))
            short = (own >> np.uint64(32)).astype(np.uint32).view(np.int32)
            lines.append((int(starts[i]), int(ends[j - 1]), j - i, int(total.view(np.int64)[0]), signature(own, a, b), short))
    return lines, (starts[at], ends[at + STRETCH - 1], whole.view(np.int64))


def units(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Every paragraph of every text."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(UNITS))

    def lines_of(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def stretches_of(found: list) -> pa.RecordBatch:
        docs, starts, ends, hashes = (np.concatenate(c) for c in zip(*found))
        n = len(docs)
        values = [np.zeros(n, dtype=bool), docs, starts.astype(np.int32), ends.astype(np.int32), np.full(n, STRETCH, dtype=np.int32), hashes]
        arrays = [pa.array(v, f.type) for v, f in zip(values, schema)] + [pa.nulls(n, f.type) for f in list(schema)[6:]]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = permutations()
        powers, rows, found, n = Powers(), [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                lines, stretches = paragraphs(text.as_py() or "", a, b, powers)
                rows += [(True, doc, *x) for x in lines]
                if len(stretches[0]):
                    found.append((np.full(len(stretches[0]), doc, dtype=np.int64), *stretches))
                    n += len(stretches[0])
                if len(rows) >= 2_000:
                    yield lines_of(rows)
                    rows = []
                if n >= 100_000:
                    yield stretches_of(found)
                    found, n = [], 0
        if rows:
            yield lines_of(rows)
        if found:
            yield stretches_of(found)

    key = F.coalesce(docs[f"`{id_col}`"].cast("long"), F.lit(NO_ID))
    return docs.select(key.alias("doc"), docs[f"`{text_col}`"].cast("string").alias("text")).mapInArrow(run, UNITS)


def verified(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """Of (a, b) pairs of line classes, those whose shingle sets are similar enough."""
    sets = lines.select("hash", "shingles")
    both = pairs.join(sets.withColumnsRenamed({"hash": "a", "shingles": "x"}), "a").join(sets.withColumnsRenamed({"hash": "b", "shingles": "y"}), "b")
    common = F.size(F.array_intersect("x", "y"))
    return both.where(common >= SIMILAR * (F.size("x") + F.size("y") - common)).select("a", "b")


def tile_links(own: np.ndarray, hashes: np.ndarray, parts: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links between lines of different components whose shingle sets are similar enough; one is enough to join two groups."""
    sizes = np.array([len(x) for x in sets])
    known, places = np.unique(np.concatenate(sets), return_inverse=True)
    rows = np.repeat(np.arange(len(sets)), sizes)
    common = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for at in range(0, len(known), 4096):
        inside = (places >= at) & (places < at + 4096)
        member = np.zeros((len(sets), min(4096, len(known) - at)), dtype=np.float32)
        member[rows[inside], places[inside] - at] = 1
        common += member @ member.T
    near = common >= SIMILAR * (sizes[:, None] + sizes[None, :] - common)
    near &= parts[:, None] != parts[None, :]
    if own.min() != own.max():
        near &= own[:, None] != own[None, :]
    joined, out = {}, []

    def root(x):
        while joined.setdefault(x, x) != x:
            joined[x] = x = joined[joined[x]]
        return x

    for i, j in zip(*(x.tolist() for x in np.nonzero(np.triu(near, 1)))):
        a, b = root(parts[i]), root(parts[j])
        if a != b:
            joined[max(a, b)] = min(a, b)
            out.append((int(hashes[i]), int(hashes[j])))
    return out


def open_links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted tiles of open buckets to links; a task holds one tile at a time."""
    last, held = None, []

    def close() -> list[tuple[int, int]]:
        tile = pd.concat(held)
        if len(tile) < 2:
            return []
        return tile_links(tile["own"].to_numpy(), tile["hash"].to_numpy(), tile["component"].to_numpy(), tile["shingles"].tolist())

    found: list[tuple[int, int]] = []
    for pdf in batches:
        marks = pdf[["key", "low", "high"]].to_numpy()
        cuts = (np.nonzero((marks[1:] != marks[:-1]).any(axis=1))[0] + 1).tolist()
        for a, z in zip([0, *cuts], [*cuts, len(pdf)]):
            if a == z:
                continue
            here = tuple(marks[a].tolist())
            if here != last and held:
                found += close()
                held = []
            last = here
            held.append(pdf.iloc[a:z])
        if found:
            yield pd.DataFrame(found, columns=["a", "b"])
            found = []
    if held and (found := close()):
        yield pd.DataFrame(found, columns=["a", "b"])


def line_components(classes: DataFrame, sets_of: DataFrame | None = None) -> DataFrame:
    """(``node``, ``component``) of the line classes that are linked to another.

    ``sets_of`` has one row of (``hash``, ``shingles``) for each class where ``classes`` has none.
    """
    banded = classes.select("hash", "n", F.explode("bands").alias("key"))
    hubs = banded.groupBy("key").agg(F.count(F.lit(1)).alias("many"), F.max(F.struct("n", "hash")).alias("hub")).where("many > 1")
    shared = written(banded.join(hubs, "key").select("key", "hash", F.col("hub.hash").alias("hub")), "buckets")
    sets = written((classes if sets_of is None else sets_of).join(shared.select("hash").distinct(), "hash", "left_semi").select("hash", "shingles"), "shingles")
    first = shared.where("hash <> hub").select(F.col("hub").alias("a"), F.col("hash").alias("b")).distinct()
    links = written(verified(first, sets), "links")
    joined = components(links)
    # Buckets whose lines lie in several components: lines of different ones are compared, tile by tile.
    named = shared.join(joined.withColumnRenamed("node", "hash"), "hash", "left").withColumn("component", F.coalesce("component", "hash"))
    mixed_keys = named.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("key")
    open_ = written(named.join(mixed_keys, "key", "left_semi").where("hash <> hub"), "open")
    tiles = open_.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
    own = F.pmod(F.xxhash64("hash"), F.col("tiles")).cast("int")
    placed = open_.join(tiles, "key").withColumn("own", own).join(sets, "hash")
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    paired = placed.withColumn("other", other).select(
        "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "hash", "component", "shingles"
    )
    dealt = paired.repartition(tasks(classes.sparkSession), "key", "low", "high").sortWithinPartitions("key", "low", "high")
    more = written(dealt.mapInPandas(open_links, "a long, b long"), "links")
    return components(links.unionByName(more)) if more.head(1) else joined


def repeated_lines(lines: DataFrame) -> DataFrame:
    """Lines that another document has too, alike or nearly so: with the class's and component's smallest document."""
    classes = lines.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("low"), F.max("doc").alias("high"), F.first("bands").alias("bands"), F.first("shingles").alias("shingles"))
    classes = written(classes, "line-classes")
    named = classes.select("hash", "low", "high").join(line_components(classes).withColumnRenamed("node", "hash"), "hash", "left")
    named = named.withColumn("component", F.coalesce("component", "hash"))
    whole = named.groupBy("component").agg(F.min("low").alias("least"), F.max("high").alias("most")).where("least <> most")
    own = named.join(whole, "component").select("hash", "least")
    return lines.select("hash", "doc", "start", "end", "words").join(own, "hash").select("doc", "start", "end", "words", "least")


def repeated_stretches(stretches: DataFrame) -> DataFrame:
    """Stretches that another document has too."""
    rows = stretches.select("hash", "doc", "start", "end")
    shared = rows.groupBy("hash").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least <> most").select("hash", "least")
    return rows.join(shared, "hash").select("doc", "start", "end", F.lit(STRETCH).alias("words"), "least")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per repeated passage of a document: ``doc_id``, ``start``, ``end``, ``component_id``, ``kept``.

    Places are code points of the text, the end exclusive. ``component_id`` is the
    smallest id of a document with that passage; the passage is kept there and may be
    removed elsewhere. Overlapping passages of one component are one row. Passages that
    only one document has give none; null, empty and short texts give none. A null id is
    one document, ahead of all others; so are rows that repeat an id, and places then
    belong to any of their texts. Words count without regard to the case of A to Z.
    """
    found = written(units(docs, id_col, text_col), "paragraphs")
    spans = repeated_lines(found.where("line")).unionByName(repeated_stretches(found.where("not line")))
    order = Window.partitionBy("doc", "least").orderBy("start", "end")
    until = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = spans.withColumn("new", F.when(until >= F.col("start"), 0).otherwise(1))
    numbered = opened.withColumn("passage", F.sum("new").over(order))
    merged = numbered.groupBy("doc", "least", "passage").agg(F.min("start").alias("start"), F.max("end").alias("end"))

    def id_of(c: str):
        return F.when(F.col(c) != NO_ID, F.col(c))

    return merged.select(id_of("doc").alias("doc_id"), "start", "end", id_of("least").alias("component_id"), (F.col("doc") == F.col("least")).alias("kept"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns kept, without the passages that are kept elsewhere.

    Rows whose id (or want of one) stands for several texts are left whole: a place tells
    nothing about which of them it is in.
    """
    rows = docs.select(docs[f"`{id_col}`"].cast("long").alias("of"), F.sha2(F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit("")), 256).alias("sha"))
    several = rows.groupBy("of").agg(F.min("sha").alias("a"), F.max("sha").alias("z")).where("a <> z").select("of")
    cuts = repeated_passages(docs, id_col, text_col).where(~F.col("kept")).groupBy("doc_id")
    cuts = cuts.agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts"))
    cuts = cuts.join(several, F.col("doc_id").eqNullSafe(F.col("of")), "left_anti")
    marked = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs[f"`{id_col}`"].cast("long").alias("doc"))
    joined = marked.join(cuts, marked["doc"].eqNullSafe(cuts["doc_id"]), "left")
    text = F.col(f"row.`{text_col}`")
    state = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def cut(s, c):
        more = F.when(c["start"] > s["at"], F.substring(text, s["at"] + 1, c["start"] - s["at"])).otherwise("")
        return F.struct(F.concat(s["out"], more).alias("out"), F.greatest(s["at"], c["end"]).alias("at"))

    left = F.aggregate("cuts", state, cut, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    new = F.when(F.col("cuts").isNull(), text).otherwise(left)
    return joined.select(*[new.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op9_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))
