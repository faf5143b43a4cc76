"""Prefix trie of conversations: double arrays per prefix shard, shared upper nodes merged globally.

A conversation is the row of its turns (role and text), each known by a digest; every
prefix has a digest chained from them, so texts are read once and never shuffled.
Conversations of equal turns are one class and go through the trie once, with their
number.

Conversations are dealt into shards by a prefix that they share. A prefix is looked at
at depths 1, 2, 4, 8 ...; the first one with at most ``SHARD`` turns below it is the
conversation's shard, so that a first turn which opens very many conversations is split
by their later turns, and no shard is larger than that. A shard's turns get dense ids,
its conversations are packed into BASE and CHECK arrays (the child of slot *s* by turn
*t* is slot ``BASE[s] + t`` if ``CHECK`` there names *s*), and walks over these arrays give
its nodes and their subtree totals. Nodes above the shards are shared by many: their
counts are global aggregates by prefix, and the totals of all that lies below reach them
along the turns of each node's smallest member.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brasstally.llm.common import table, tasks, written

SHARD = 1024
IDS_IN_CHUNK = 256
OUT_ROWS = 10_000
ROOT = bytes(16)
# Of the rebuilt conversations of the query: so many of them share an opening, of fewer turns than this.
FAMILY, OPENINGS = 100, 6

NODE_COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turn_rows(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv``, ``pos`` (from 1, by turn, null first), ``digest`` and ``chars`` of every turn.

    Null roles and texts are empty. Turns of one number are ordered by their digest, and
    repeated rows are turns of their own. Rows without a conversation id belong to none.
    """
    role, text = (F.coalesce(conversations[f"`{c}`"].cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = conversations.select(
        conversations[f"`{conv_col}`"].cast("long").alias("conv"),
        conversations[f"`{turn_col}`"].alias("turn"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.length(text).cast("long").alias("chars"),
    ).where("conv IS NOT NULL")
    by_turn = Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "digest")
    return rows.select("conv", F.row_number().over(by_turn).cast("long").alias("pos"), "digest", "chars")


def with_shared_openings(turns: DataFrame, family: int = FAMILY, openings: int = OPENINGS) -> DataFrame:
    """Turns of rebuilt conversations: ``h`` turns of the family's first, then the own ones after the first ``h``.

    ``h`` follows from the id (CRC-32 modulo ``openings``); the family's first is the id
    rounded to ``family`` toward zero, and gives nothing where it does not exist. A row
    without a digest stands for every conversation, so that those left without a turn remain.
    """
    turns = written(turns, "turns")
    opening = F.crc32(F.col("conv").cast("string").cast("binary")) % openings
    each = turns.where("pos = 1").select("conv", (F.col("conv") - F.col("conv") % family).alias("first"), opening.alias("h"))
    heads = turns.where((F.col("conv") % family == 0) & (F.col("pos") < openings)).withColumnRenamed("conv", "first")
    lent = each.join(heads, "first").where("pos <= h").select("conv", F.lit(1).alias("part"), "pos", "digest", "chars")
    own = turns.where(F.col("pos") > opening).select("conv", F.lit(2).alias("part"), "pos", "digest", "chars")
    there = each.select("conv", F.lit(0).alias("part"), F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("chars"))
    parts = lent.union(own).union(there)
    return parts.select("conv", F.struct("part", "pos").alias("pos"), "digest", "chars")


def prefixes(turns: DataFrame) -> DataFrame:
    """``conv``, ``depth``, ``prefix``, ``parent``, ``turn``, ``chars``, ``last`` of every prefix, the empty one included.

    One pass over each conversation's turns in order; only the row before is held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out = None, []
        for batch in batches:
            for conv, digest, chars in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3))):
                if held is None or held[0] != conv:
                    if held:
                        out.append((*held, True))
                    held = (conv, 0, ROOT, None, None, 0)
                if digest is not None:
                    out.append((*held, False))
                    below = hashlib.blake2b(held[2] + digest, digest_size=16).digest()
                    held = (conv, held[1] + 1, below, held[2], digest, chars)
            if len(out) >= OUT_ROWS:
                yield batch_of(out, PREFIX_TYPES)
                out = []
        if held:
            out.append((*held, True))
        if out:
            yield batch_of(out, PREFIX_TYPES)

    dealt = turns.repartition(tasks(turns.sparkSession), "conv").sortWithinPartitions("conv", "pos")
    return written(dealt.select("conv", "pos", "digest", "chars").mapInArrow(run, schema_of(PREFIX_TYPES)), "prefixes")


PREFIX_TYPES = {"conv": "long", "depth": "long", "prefix": "binary", "parent": "binary", "turn": "binary", "chars": "long", "last": "boolean"}
ARROW = {"long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "string": pa.string()}


def schema_of(types: dict[str, str]) -> str:
    return ", ".join(f"{n} {t}" for n, t in types.items())


def batch_of(rows: list[tuple], types: dict[str, str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, ARROW[t]) for x, t in zip(zip(*rows), types.values())], names=list(types))


def classes_of(rows: DataFrame) -> DataFrame:
    """``conv`` (smallest), ``n``, ``length``, ``sha`` of each class of conversations with equal turns.

    ``sha`` is the SHA-256 of all ids in order. Ids are first joined in chunks, sorted
    over all tasks, so that a class of very many copies sends few rows to the task that
    hashes them, one after another.
    """

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(end, length, ids):
            return end, length, ids[0], len(ids), ",".join(map(str, ids))

        held, ids, out = None, [], []
        for batch in batches:
            for end, length, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if ids and (held != (end, length) or len(ids) == IDS_IN_CHUNK):
                    out.append(told(*held, ids))
                    ids = []
                held = (end, length)
                ids.append(conv)
            if len(out) >= OUT_ROWS:
                yield batch_of(out, chunk_types)
                out = []
        if ids:
            out.append(told(*held, ids))
        if out:
            yield batch_of(out, chunk_types)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sha, out = None, None, []
        for batch in batches:
            for end, length, first, n, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0] == end:
                    sha.update(b",")
                    held[2] += n
                else:
                    if held:
                        out.append((*held[1:], sha.hexdigest()))
                    held, sha = [end, first, n, length], hashlib.sha256()
                sha.update(ids.encode())
            if len(out) >= OUT_ROWS:
                yield batch_of(out, class_types)
                out = []
        if held:
            out.append((*held[1:], sha.hexdigest()))
        if out:
            yield batch_of(out, class_types)

    chunk_types = {"end": "binary", "length": "long", "first": "long", "n": "long", "ids": "string"}
    class_types = {"conv": "long", "n": "long", "length": "long", "sha": "string"}
    n = tasks(rows.sparkSession)
    ends = rows.where("last").select(F.col("prefix").alias("end"), F.col("depth").alias("length"), "conv")
    sorted_ids = ends.repartitionByRange(n, "end", "conv").sortWithinPartitions("end", "conv")
    joined = sorted_ids.mapInArrow(chunks, schema_of(chunk_types)).repartition(n, "end").sortWithinPartitions("end", "first")
    return written(joined.mapInArrow(hashed, schema_of(class_types)), "classes")


class DoubleArray:
    """A trie over sequences of dense ids (from 1), as BASE and CHECK; slot 0 is the root."""

    def __init__(self, sequences: list[list[int]]):
        """``sequences`` are distinct and sorted. ``slots`` has the slots in use, parents before children."""
        self.base, self.check, self.free = [0], [0], 1
        self.slots = [0]
        open_ = [(0, len(sequences), 0, 0)]
        for first, end, depth, slot in open_:
            first += len(sequences[first]) == depth
            children = [(turn, [*run]) for turn, run in groupby(range(first, end), key=lambda n: sequences[n][depth])]
            if not children:
                continue
            base = self.place([turn for turn, _ in children])
            self.base[slot] = base
            for turn, run in children:
                self.check[base + turn] = slot
                self.slots.append(base + turn)
                open_.append((run[0], run[-1] + 1, depth + 1, base + turn))

    def place(self, turns: list[int]) -> int:
        """The first base, from the first free slot on, at which the slots of all turns (ascending) are free."""
        while self.free < len(self.check) and self.check[self.free] != -1:
            self.free += 1
        base = max(0, self.free - turns[0])
        while any(base + t < len(self.check) and self.check[base + t] != -1 for t in turns):
            base += 1
        more = base + turns[-1] + 1 - len(self.check)
        self.base += [0] * more
        self.check += [-1] * more
        return base

    def child(self, slot: int, turn: int) -> int:
        """The slot of a turn after ``slot``, or -1."""
        at = self.base[slot] + turn
        return at if 0 < at < len(self.check) and self.check[at] == slot else -1


NODE_TYPES = {
    "prefix": "binary", "parent": "binary", "conv": "long", "depth": "long", "parent_conv": "long", "n": "long", "children": "long",
    "leaves": "long", "saved": "long", "sha": "string", "shard": "binary", "slot": "long", "base": "long", "check": "long",
}


def shard_nodes(rows: list[tuple]) -> list[tuple]:
    """The nodes of one shard. ``rows`` are (conv, depth, prefix, parent, turn, chars, last, n, sha), by conversation and depth."""
    dense: dict[bytes, int] = {}
    walks = []
    for conv, own in groupby(rows, key=lambda r: r[0]):
        own = list(own)
        walks.append(([dense.setdefault(r[4], len(dense) + 1) for r in own[1:]], conv, own))
    walks.sort(key=lambda w: w[0])
    trie = DoubleArray([w[0] for w in walks])
    size = len(trie.check)
    n, least, depth, chars, sha = [0] * size, [None] * size, [0] * size, [0] * size, [None] * size
    for turns, conv, own in walks:
        slot = 0
        for k, row in enumerate(own):
            slot = trie.child(slot, turns[k - 1]) if k else 0
            n[slot] += row[7]
            least[slot] = conv if least[slot] is None else min(least[slot], conv)
            depth[slot], chars[slot] = row[1], row[5]
        sha[slot] = own[-1][8]
    children, leaves = [0] * size, [0] * size
    saved = [(a - 1) * b for a, b in zip(n, chars)]
    for slot in reversed(trie.slots):
        leaves[slot] = leaves[slot] or 1
        if slot:
            up = trie.check[slot]
            children[up] += 1
            leaves[up] += leaves[slot]
            saved[up] += saved[slot]
    shard, above = rows[0][2], rows[0][3]
    return [
        (
            None if s else shard, None if s else above, least[s], depth[s], least[trie.check[s]] if s else None, n[s], children[s],
            leaves[s], saved[s], sha[s], shard, s, trie.base[s], trie.check[s] if s else None,
        )
        for s in trie.slots
    ]


def in_shards(rows: DataFrame) -> DataFrame:
    """Nodes of all shards; a task holds one shard at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, out = None, [], []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != shard:
                    if held:
                        out += shard_nodes(held)
                    shard, held = row[0], []
                held.append(row[1:])
            if len(out) >= OUT_ROWS:
                yield batch_of(out, NODE_TYPES)
                out = []
        if held:
            out += shard_nodes(held)
        if out:
            yield batch_of(out, NODE_TYPES)

    columns = ["shard", "conv", "depth", "prefix", "parent", "turn", "chars", "last", "n", "sha"]
    dealt = rows.select(*columns).repartition(tasks(rows.sparkSession), "shard").sortWithinPartitions("shard", "conv", "depth")
    return written(dealt.mapInArrow(run, schema_of(NODE_TYPES)), "shard-nodes")


def shards_of(rows: DataFrame, classes: DataFrame, limit: int) -> DataFrame:
    """``conv``, ``cut``, ``shard``: the first looked-at prefix with at most ``limit`` turns at or below it, if any."""
    looked_at = F.col("depth").bitwiseAND(F.col("depth") - 1) == 0
    heads = rows.where((F.col("depth") > 0) & looked_at).select("conv", "depth", "prefix").join(classes, "conv")
    weights = heads.groupBy("prefix").agg(F.sum(F.col("length") - F.col("depth") + 1).alias("below"))
    small = written(weights.where(F.col("below") <= limit).select("prefix"), "shards")
    return written(
        heads.join(small, "prefix").groupBy("conv").agg(F.min(F.struct("depth", "prefix")).alias("at")).select("conv", F.col("at.depth").alias("cut"), F.col("at.prefix").alias("shard")),
        "cuts",
    )


def shared_nodes(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """The nodes above all shards, with totals of all that lies below them."""
    named = [F.max(c).alias(c) for c in ("depth", "parent", "chars")]
    sha = F.max(F.when(F.col("last"), F.col("sha"))).alias("sha")
    nodes = written(rows.groupBy("prefix").agg(F.min("conv").alias("conv"), F.sum("n").alias("n"), *named, sha), "shared")
    children = nodes.select("parent").union(roots.select("parent")).where("parent IS NOT NULL").groupBy("parent").agg(F.count(F.lit(1)).alias("children"))
    counted = nodes.join(children.withColumnRenamed("parent", "prefix"), "prefix", "left").na.fill(0, ["children"])
    counted = written(counted, "shared-counted")
    # What a node adds stands at its smallest member and depth; all prefixes of that member down to there have it below them.
    own = counted.select("conv", "depth", F.lit(None).cast("binary").alias("prefix"), (F.col("children") == 0).cast("long").alias("leaves"), ((F.col("n") - 1) * F.col("chars")).alias("saved"))
    below = roots.select("conv", "depth", F.lit(None).cast("binary").alias("prefix"), "leaves", "saved")
    ways = rows.select("conv", "depth", "prefix", F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"))
    deeper = Window.partitionBy("conv").orderBy(F.desc("depth")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    summed = ways.union(own).union(below).select("prefix", F.sum("leaves").over(deeper).alias("leaves"), F.sum("saved").over(deeper).alias("saved"))
    totals = summed.where("prefix IS NOT NULL").groupBy("prefix").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    return written(counted.join(totals, "prefix"), "shared-nodes")


def trie_nodes(turns: DataFrame, shard: int = SHARD) -> DataFrame:
    """The nodes of the trie of all conversations in ``turns`` (see ``turn_rows``).

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (the parent's; root: null), ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``, and where a node is packed: ``shard``
    (its prefix digest), ``slot``, ``base``, ``check`` (all null for shared upper nodes; ``check`` null for a
    shard's top). No conversation gives no node.
    """
    rows = prefixes(turns)
    classes = classes_of(rows)
    cuts = shards_of(rows, classes, shard)
    members = written(rows.join(classes.select("conv", "n", "sha"), "conv").join(cuts, "conv", "left"), "members")
    inside = in_shards(members.where("depth >= cut"))
    roots = inside.where("prefix IS NOT NULL")
    shared = shared_nodes(members.where("cut IS NULL OR depth < cut"), roots)
    above = shared.select(F.col("prefix").alias("parent"), F.col("conv").alias("up"))
    empty = F.sha2(F.lit("").cast("binary"), 256)

    def shown(nodes: DataFrame, parent: Column, packed: bool) -> DataFrame:
        where = [F.col(c) if packed else F.lit(None).cast(NODE_TYPES[c]).alias(c) for c in ("shard", "slot", "base", "check")]
        values = [F.col("conv"), F.col("depth"), parent, F.col("n"), F.col("children"), F.col("leaves"), F.col("saved"), F.coalesce("sha", empty)]
        return nodes.select(*[v.alias(c) for v, c in zip(values, NODE_COLUMNS)], *where)

    return (
        shown(shared.join(above, "parent", "left"), F.col("up"), False)
        .union(shown(roots.join(above, "parent"), F.col("up"), True))
        .union(shown(inside.where("prefix IS NULL"), F.col("parent_conv"), True))
    )


def op12_conversation_trie(spark, sf_dir: str) -> DataFrame:
    turns = with_shared_openings(turn_rows(table(spark, sf_dir, "conversations")))
    return trie_nodes(turns).select(*NODE_COLUMNS)


OP12_SQL = r"""
WITH RECURSIVE bits(i, k, v) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8
),
crc AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8),
turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS pos, digest, chars FROM (
    SELECT conv_id, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
           length(coalesce(text, '')) AS chars
    FROM conversations WHERE conv_id IS NOT NULL)
),
each_one AS (
  SELECT conv_id, conv_id - conv_id % 100 AS first_id,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
                         lambda a, c: xor(a >> 8, t[(xor(a, c) & 255) + 1])), 4294967295::BIGINT) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM turns), crc
),
parts AS (
  SELECT e.conv_id, 1 AS part, pos, digest, chars FROM each_one e JOIN turns t ON t.conv_id = first_id AND pos <= h
  UNION ALL SELECT conv_id, 2, pos, digest, chars FROM turns JOIN each_one USING (conv_id) WHERE pos > h
),
whole AS (
  SELECT conv_id, coalesce(digests, []) AS digests, coalesce(sizes, []) AS sizes FROM each_one
  LEFT JOIN (SELECT conv_id, list(digest ORDER BY part, pos) AS digests, list(chars ORDER BY part, pos) AS sizes
             FROM parts GROUP BY conv_id) USING (conv_id)
),
ways AS (
  SELECT conv_id, d, digests[1:d] AS p, CASE WHEN d > 0 THEN digests[1:d - 1] END AS up, coalesce(sizes[d], 0) AS chars, len(digests) = d AS ends
  FROM (SELECT *, unnest(range(len(digests) + 1)) AS d FROM whole)
),
nodes AS (
  SELECT p, any_value(up) AS up, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM ways GROUP BY p
),
counted AS (
  SELECT n.*, coalesce(c.children, 0) AS n_children FROM nodes n
  LEFT JOIN (SELECT up, count(*) AS children FROM nodes WHERE up IS NOT NULL GROUP BY up) c ON c.up = n.p
),
totals AS (
  SELECT w.p, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * c.chars)::BIGINT AS saved_tokens
  FROM counted c JOIN ways w ON w.conv_id = c.conv_id AND w.d <= c.depth GROUP BY w.p
)
SELECT c.conv_id, c.depth, u.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves, saved_tokens, c.ends_sha256
FROM counted c JOIN totals t ON t.p = c.p LEFT JOIN nodes u ON u.p = c.up
"""
