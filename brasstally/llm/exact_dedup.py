"""Exact deduplication by a tree merge of sorted digest runs.

Every document becomes one digest row. Rows are dealt into runs, each run is sorted
by digest and cut to one row per distinct text with its smallest identifier. Runs
then merge in rounds, ``FAN_IN`` into one (several binomial rounds at once), each
round again keeping the smallest identifier. The way back down the same tree gives
every document its group: no step needs more rows of one text than a run holds, or
a merge joins, however many copies a text has.

Identifiers are verified at each level: rows merge only when the short digest that
sorts the run, the SHA-256 of the whole text and its length all agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brasstally.llm.common import SPACE, table, tasks, written

FAN_IN = 16
KEY = ["digest", "sha", "chars"]


def normalised(text: Column) -> Column:
    """The text with every stretch of white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def digest_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    plain = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("plain"))
    return plain.select(
        "id",
        F.sha2("plain", 256).alias("sha"),
        F.length("plain").alias("chars"),
    ).withColumn("digest", F.xxhash64("sha"))


def merge_sizes(runs: int, fan_in: int) -> list[int]:
    """Runs left after each round, down to one."""
    sizes = []
    while runs > 1:
        runs = -(-runs // fan_in)
        sizes.append(runs)
    return sizes


def smallest(rows: DataFrame, by: list[str], id_: Column, n: Column) -> DataFrame:
    return rows.groupBy(*by).agg(F.min(id_).alias("keep"), F.sum(n).alias("n"))


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", runs: int | None = None, fan_in: int = FAN_IN
) -> DataFrame:
    """One row per document: ``id``, ``sha`` (of the normalised text), ``keep``, ``n`` (its group's size).

    ``runs`` defaults to the session's number of shuffle partitions. Null texts are
    empty texts. A null id counts in its group and is kept only if all ids of the
    group are null. Rows that repeat an id each give a row.
    """
    runs = runs or tasks(docs.sparkSession)
    at = ["run", *KEY]
    # A row's run follows from its id and its text: the same on every attempt.
    # The digests are written, so that the texts are read once for all levels.
    leaf = (
        written(digest_rows(docs, id_col, text_col), "digests")
        .withColumn("run", F.pmod(F.xxhash64("id", "chars"), F.lit(runs)).cast("int"))
        .repartition(tasks(docs.sparkSession), *at)
        .sortWithinPartitions(*at)
    )
    levels = [smallest(leaf, at, F.col("id"), F.lit(1))]
    for _ in merge_sizes(runs, fan_in):
        up = levels[-1].withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
        levels.append(smallest(up, at, F.col("keep"), F.col("n")))
    down = levels[-1]
    for level in levels[-2::-1]:
        parent = down.withColumnRenamed("run", "up")
        child = level.select("run", F.floor(F.col("run") / fan_in).cast("int").alias("up"), *KEY)
        down = child.join(parent, ["up", *KEY]).select(*at, "keep", "n")
    return leaf.join(down, at).select("id", "sha", "keep", "n")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns: of equal texts the smallest id.

    Rows that repeat an id and its text stay once. White space decides nothing. An
    empty table gives an empty table. Extra columns of any name pass through.
    """
    # A null id is a key of its own, apart from every id's text.
    key = F.coalesce(F.concat(F.lit("="), F.col("id").cast("string")), F.lit("null"))
    marked = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"),
        docs[id_col].alias("id"),
        F.sha2(normalised(docs[text_col]), 256).alias("sha"),
    ).select("row", key.alias("key"), "sha")
    groups = exact_groups(docs, id_col, text_col)
    keepers = groups.where(F.col("id").eqNullSafe(F.col("keep"))).select(key.alias("key"), "sha")
    kept = marked.join(keepers, ["key", "sha"], "left_semi")
    return kept.groupBy("key", "sha").agg(F.first("row").alias("row")).select("row.*")


def op5_exact_dedup(spark, sf_dir: str) -> DataFrame:
    groups = exact_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"),
        F.col("keep").alias("keep_id"),
        F.col("n").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
