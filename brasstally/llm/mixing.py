"""Mixing sources to target weights, by a multivariate-hypergeometric splitting tree.

Each source's documents fall into blocks by a digest of their ids. A source owes a
number of blocks: all of them once for each whole time that its target covers its
size, and for the rest as many permuted blocks as fit, the last of them in part. A
binary tree over the output shards splits these quotas: at each node the left half
takes, source by source, a hypergeometric draw of what is left, so that each shard's
blocks are a draw without replacement from all blocks owed and every block goes to
one shard. Shards then take disjoint stretches of each source's permuted blocks and
are shuffled within themselves.

Everything is DataFrame work. Quotas are rows of sources, blocks and shards; only
documents and blocks are joined, by block, so that a source that holds a third of all
rows is as spread as the others.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brasstally.llm.common import SPACE, table, tasks, words_in, written

WEIGHTS = (5, 2, 1)
MOST = 3
BLOCKS = 1024
SHARDS = 16


def place(*parts: Column | str) -> Column:
    """A number below 2^48 from a digest of the parts: the same in every run."""
    text = F.concat_ws(":", *[F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("-")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, blocks: int) -> DataFrame:
    """``doc_id``, ``source``, ``size`` and the document's ``block`` and ``rank`` in it."""
    rows = docs.select(
        docs[f"`{id_col}`"].alias("doc_id"), docs[f"`{source_col}`"].cast("string").alias("source"), words_in(docs[f"`{text_col}`"]).alias("size")
    )
    return rows.withColumn("rank", place(F.lit("doc"), "doc_id")).withColumn("block", F.pmod("rank", F.lit(blocks)).cast("int"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """``source``, ``source_size``, ``target`` from one row per source.

    Sources in the order of their code points, null last, take the weights in turn.
    A source whose share would pass ``most`` times its size stops there; the sources
    that stop first are those with the least room for their weight.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))).cast("int") + 1
    rows = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)).cast("array<double>"), turn))
    rows = rows.withColumn("room", F.col("source_size") * F.lit(most))
    fill = Window.orderBy(F.col("room") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier, later = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    rows = rows.withColumns(
        {
            "left": F.sum("source_size").over(everything) - F.coalesce(F.sum("room").over(earlier), F.lit(0)),
            "weights": F.sum("weight").over(later),
        }
    )
    # A share of what the stopped ones leave; the first source that it does not fill sets it for the rest.
    rows = rows.withColumn("share", F.col("left") / F.col("weights"))
    open_ = F.min(F.when(F.col("share") * F.col("weight") <= F.col("room"), F.struct(F.col("room") / F.col("weight"), "share"))).over(everything)
    level = F.coalesce(open_["share"], F.lit(0.0))
    return rows.select("source", "source_size", F.least(F.col("room").cast("double"), level * F.col("weight")).alias("target"))


def log_factorial(n: Column) -> Column:
    """Stirling's series for log n!, from n + 1 on to be exact for small n as well."""
    x = n.cast("double") + 1
    y = x + 6
    low = F.log(x) + F.log(x + 1) + F.log(x + 2) + F.log(x + 3) + F.log(x + 4) + F.log(x + 5)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y * y * y) - low


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many marked ones are among ``drawn`` of ``total``, for ``u`` uniform in [0, 1).

    The distribution function is inverted over eight standard deviations around the
    mean, within the values that are possible.
    """
    lowest, highest = F.greatest(F.lit(0), drawn + marked - total), F.least(drawn, marked)
    mean = drawn.cast("double") * marked / F.greatest(total, F.lit(1))
    reach = 8 * F.sqrt(mean * (1 - drawn / F.greatest(total, F.lit(1))) + 1)
    low = F.greatest(lowest, F.floor(mean - reach).cast("long"))
    high = F.greatest(low, F.least(highest, F.ceil(mean + reach).cast("long")))

    def weight(k: Column) -> Column:
        return F.exp(
            log_factorial(marked) - log_factorial(k) - log_factorial(marked - k)
            + log_factorial(total - marked) - log_factorial(drawn - k) - log_factorial(total - marked - drawn + k)
            - log_factorial(total) + log_factorial(drawn) + log_factorial(total - drawn)
        )

    start = F.struct(F.lit(0.0).alias("sum"), low.cast("long").alias("at"))
    walked = F.aggregate(
        F.sequence(low, high),
        start,
        lambda s, k: F.struct(
            (s["sum"] + weight(k)).alias("sum"), F.when(s["sum"] <= u, k).otherwise(s["at"]).cast("long").alias("at")
        ),
    )
    return F.least(F.greatest(walked["at"], lowest), highest)


def draw(quotas: Column, room: Column, seed: Column) -> Column:
    """A multivariate hypergeometric draw of ``room`` blocks from an array of quotas: the array of what is drawn."""
    state = F.struct(
        F.aggregate(quotas, F.lit(0).cast("long"), lambda a, x: a + x).alias("total"),
        room.cast("long").alias("room"),
        F.array().cast("array<long>").alias("out"),
    )

    def step(s: Column, q: Column) -> Column:
        u = place(seed, F.size(s["out"])) / F.lit(float(1 << 48))
        k = hypergeometric(s["total"], q, s["room"], u).cast("long")
        return F.struct((s["total"] - q).alias("total"), (s["room"] - k).alias("room"), F.concat(s["out"], F.array(k)).alias("out"))

    return F.aggregate(quotas, state, step, lambda s: s["out"])


def split_quotas(quotas: DataFrame, shards: int) -> DataFrame:
    """``source``, ``shard``, ``first`` and ``quota``: which of a source's permuted blocks each shard takes.

    ``quotas`` has (source, owed) rows. One row holds the quotas of all sources at a
    node of the tree, so its size is the number of sources.
    """
    listed = F.sort_array(F.collect_list(F.struct(F.coalesce("source", F.lit("")).alias("name"), F.col("source").isNull().alias("none"), "source", "owed")))
    nodes = quotas.agg(listed.alias("all")).select(
        F.lit(0).alias("low"), F.lit(shards).alias("high"), F.transform("all", lambda x: x["owed"]).alias("quota"), F.col("all.source").alias("sources")
    )
    for _ in range(max(0, math.ceil(math.log2(shards)))):
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        total = F.aggregate("quota", F.lit(0).cast("long"), lambda a, x: a + x)
        room = F.floor(total * (middle - F.col("low")) / (F.col("high") - F.col("low"))).cast("long")
        nodes = nodes.withColumns({"middle": middle, "left": F.when(F.col("high") - F.col("low") > 1, draw(F.col("quota"), room, F.concat_ws("-", "low", "high")))})
        rest = F.zip_with("quota", "left", lambda q, k: q - k)
        halves = F.when(
            F.col("left").isNotNull(),
            F.array(
                F.struct("low", F.col("middle").alias("high"), F.col("left").alias("quota")),
                F.struct(F.col("middle").alias("low"), "high", rest.alias("quota")),
            ),
        ).otherwise(F.array(F.struct("low", "high", "quota")))
        nodes = nodes.select(F.explode(halves).alias("half"), "sources").select("half.*", "sources")
    rows = nodes.select(F.col("low").alias("shard"), F.explode(F.arrays_zip("sources", "quota")).alias("x")).select("shard", "x.sources", "x.quota")
    before = Window.partitionBy("sources").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return rows.select(
        F.col("sources").alias("source"), "shard", F.coalesce(F.sum("quota").over(before), F.lit(0)).alias("first"), "quota"
    ).where(F.col("quota") > 0)


def name_of(source: str) -> Column:
    """A key that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("null"))


def block_plan(parts: DataFrame, goal: DataFrame, shards: int) -> DataFrame:
    """``name``, ``block`` and the ``takes`` of each block: (copy, shard, limit), the limit null for a whole copy."""
    permuted = Window.partitionBy("name").orderBy("order", "block")
    ranked = (
        parts.join(goal.select("name", "passes", "rest"), "name")
        .withColumn("order", place(F.lit("block"), "source", "block"))
        .withColumn("limit", F.col("rest") - F.sum("words").over(permuted) + F.col("words"))
    )
    owed = ranked.select(
        "source", "name", "block", F.explode(F.sequence(F.lit(0), F.col("passes"))).alias("copy"), "passes", "limit", "words"
    ).where((F.col("copy") < F.col("passes")) | (F.col("limit") > 0))
    deal = Window.partitionBy("name").orderBy("copy", place(F.lit("deal"), "source", "block", "copy"), "block")
    numbered = written(owed.withColumn("number", F.row_number().over(deal) - 1), "owed")
    shares = split_quotas(numbered.groupBy("source").agg(F.count(F.lit(1)).alias("owed")), shards)
    shares = shares.select(name_of("source").alias("name"), "shard", "first", "quota")
    dealt = numbered.join(shares, "name").where((F.col("number") >= F.col("first")) & (F.col("number") < F.col("first") + F.col("quota")))
    part = F.when((F.col("copy") == F.col("passes")) & (F.col("limit") < F.col("words")), F.col("limit"))
    return dealt.groupBy("name", "block").agg(F.sort_array(F.collect_list(F.struct("copy", "shard", part.alias("limit")))).alias("takes"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    most: int = MOST,
    blocks: int = BLOCKS,
    shards: int = SHARDS,
) -> DataFrame:
    """One row per document: ``doc_id``, ``source``, ``size``, ``source_size``, ``target`` and its ``copies``.

    ``copies`` is an array of (copy, shard, turn, words), empty for a document that the
    mix leaves out: which copy, the output shard, its place in the shard's shuffle and
    how many words are taken. One document of each source is cut to meet the target; all
    others are taken whole, at most ``most`` times. A null source is a source of its own, a null text has size
    0; documents of size 0 go with their blocks. Rows that repeat an id each count and
    fall into one block. An empty table gives no rows. Reruns agree.
    """
    spark = docs.sparkSession
    rows = written(sized(docs, id_col, text_col, source_col, blocks), "sizes").withColumn("name", name_of("source"))
    parts = written(rows.groupBy("source", "name", "block").agg(F.sum("size").alias("words")), "blocks")
    goal = targets(parts.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most).withColumn("name", name_of("source"))
    # Whole passes over a source, then permuted blocks while they fit, then documents of the next block.
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    goal = goal.withColumn("passes", passes)
    goal = written(goal.withColumn("rest", F.floor(F.col("target") - F.col("passes") * F.col("source_size")).cast("long")), "targets")
    plan = block_plan(parts, goal, shards)
    within = Window.partitionBy("name", "block").orderBy("rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    chosen = rows.repartition(tasks(spark), "name", "block").withColumn("before", F.sum("size").over(within) - F.col("size"))
    joined = chosen.join(plan, ["name", "block"], "left").join(goal.select("name", "source_size", "target"), "name")

    def take(t: Column) -> Column:
        words = F.least(F.col("size"), F.greatest(F.lit(0).cast("long"), F.coalesce(t["limit"] - F.col("before"), F.col("size"))))
        turn = place(F.lit("turn"), "doc_id", t["copy"])
        kept = t["limit"].isNull() | (t["limit"] > F.col("before"))
        return F.when(kept, F.struct(t["copy"].alias("copy"), t["shard"].alias("shard"), turn.alias("turn"), words.alias("words")))

    copies = F.array_compact(F.transform(F.coalesce("takes", F.array().cast(plan.schema["takes"].dataType)), take))
    return joined.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: all columns of ``docs``, a row for each copy that is taken.

    Within a task, rows are in the order of shard and turn. A document that is cut keeps
    its first words, joined by one space. Rows that repeat an id are told apart by text
    and source (by SHA-256); rows equal in all three are numbered in the order of their
    other columns, and the copies that fall to them are dealt out in that order.
    """
    parts = [docs[f"`{c}`"].cast("string") for c in (id_col, source_col, text_col)]
    told = F.concat(*[F.coalesce(F.concat(F.length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in parts])
    key = F.sha2(told, 256)
    marked = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
        docs[f"`{text_col}`"].alias("text"),
        docs[f"`{source_col}`"].alias("source"),
        key.alias("doc_id"),
    )
    plan = mix(marked, "doc_id", "text", "source", **options).where(F.size("copies") > 0).select("doc_id", "size", "copies")
    alike = plan.groupBy("doc_id", "size", "copies").agg(F.count(F.lit(1)).alias("n"))
    once = alike.groupBy("doc_id").agg(F.first("size").alias("size"), F.sort_array(F.collect_list(F.struct("copies", "n")), False).alias("owed"))
    rest = F.to_json(F.struct(*[F.col("row").getField(c).alias(f"c{k}") for k, c in enumerate(docs.columns) if c != text_col]))
    twins = Window.partitionBy("doc_id").orderBy(rest)
    joined = marked.select("doc_id", "row").join(once, "doc_id").withColumn("twin", F.row_number().over(twins))
    none = F.struct(F.col("twin").cast("long").alias("left"), F.lit(None).cast(plan.schema["copies"].dataType).alias("copies"))

    def owed(a: Column, v: Column) -> Column:
        mine = (a["left"] > 0) & (a["left"] <= v["n"])
        return F.struct((a["left"] - v["n"]).alias("left"), F.when(mine, v["copies"]).otherwise(a["copies"]).alias("copies"))

    taken = joined.select("row", "size", F.explode(F.aggregate("owed", none, owed)["copies"]).alias("c"))
    text = F.col(f"row.`{text_col}`")
    words = F.slice(F.split(F.trim(F.regexp_replace(text, SPACE, " ")), " "), F.lit(1), F.col("c.words").cast("int"))
    cut = F.when(F.col("c.words") < F.col("size"), F.array_join(words, " ")).otherwise(text)
    columns = [cut.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return taken.repartition("c.shard", "c.turn").sortWithinPartitions("c.shard", "c.turn").select(*columns)


def op1_mix_sources(spark, sf_dir: str) -> DataFrame:
    plan = mix(table(spark, sf_dir, "documents"))
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda a, c: a + c["words"])
    return plan.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+'))::BIGINT AS size,
         ('0x' || substr(md5('doc:' || coalesce(doc_id::VARCHAR, '-')), 1, 12))::BIGINT AS rank
  FROM documents
), e AS (SELECT *, rank % BLOCKS AS block FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM e GROUP BY source),
w AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight FROM s),
f AS (
  SELECT *, source_size * 3 AS room,
         sum(source_size) OVER ()
           - coalesce(sum(source_size * 3) OVER (ORDER BY source_size * 3 / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
         sum(weight) OVER (ORDER BY source_size * 3 / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM w
), g AS (
  SELECT *, min(CASE WHEN remaining / weights * weight <= room THEN {'a': room / weight, 'b': remaining / weights} END) OVER () AS open FROM f
), t AS (SELECT source, source_size, least(room::DOUBLE, coalesce(open.b, 0) * weight) AS target FROM g),
r AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS passes FROM t
), b AS (
  SELECT source, block, sum(size)::BIGINT AS words,
         ('0x' || substr(md5('block:' || coalesce(source, '-') || ':' || block), 1, 12))::BIGINT AS ord
  FROM e GROUP BY source, block
), p AS (
  SELECT b.source, b.block, floor(r.target - r.passes * r.source_size)::BIGINT + b.words
           - sum(b.words) OVER (PARTITION BY b.source ORDER BY b.ord, b.block) AS room
  FROM b JOIN r ON b.source IS NOT DISTINCT FROM r.source
), c AS (
  SELECT *, sum(size) OVER (PARTITION BY source, block ORDER BY rank, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before FROM e
)
SELECT c.doc_id, c.size, r.source_size, r.target,
       (r.passes * c.size + least(c.size, greatest(0, p.room - c.before)))::BIGINT AS taken
FROM c JOIN r ON c.source IS NOT DISTINCT FROM r.source
JOIN p ON p.source IS NOT DISTINCT FROM c.source AND p.block = c.block
""".replace("BLOCKS", str(BLOCKS))
