"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from brasstally.sources.staging import staged, to_stage_by


def latest_version(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    *,
    deleted: str | None = "is_deleted",
) -> DataFrame:
    """First row per key in ``order``, which should be total. Deleted rows never compete.

    The rank filter lets Spark keep one row per key in every map task before the
    shuffle, so a key with very many versions sends few of them.
    """
    live = df if deleted is None else df.filter(~F.col(deleted))
    newest = Window.partitionBy(*keys).orderBy(*order)
    return live.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") == 1).drop("_rank")


def latest_staged(
    df: DataFrame, key: str, order: Sequence[Column], name: str, *, deleted: str | None = "is_deleted"
) -> DataFrame:
    """``latest_version`` by one key, of wide rows: these are staged by their key and ranked where they lie.

    All versions are written, in columns, instead of being moved as rows: for keys with few versions.
    """
    live = df if deleted is None else df.filter(~F.col(deleted))
    return latest_version(staged(to_stage_by(live, key), name), [key], order, deleted=None)


def first_match(df: DataFrame, key: str, order: Sequence[str], take: Sequence[str]) -> DataFrame:
    """Columns ``take`` of the lowest row per key by ``order``: an aggregate, combined map-side."""
    rank = F.struct(*order)
    if set(take) <= set(order):  # the lowest rank holds them
        return df.groupBy(key).agg(F.min(rank).alias("_first")).select(key, *[F.col(f"_first.{c}").alias(c) for c in take])
    return df.groupBy(key).agg(F.min_by(F.struct(*take), rank).alias("_first")).select(key, "_first.*")


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    """All columns renamed ``prefix_<name>``, to join tables that share names."""
    return df.select(*[F.col(c).alias(f"{prefix}_{c}") for c in df.columns])
