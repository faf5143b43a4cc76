"""Joins to tables given by the user: partner names, items, codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from brasstally.operators.skew import _all


def lookup_join(df: DataFrame, lookup: DataFrame, on: Sequence[tuple[str, str]], *, how: str = "left") -> DataFrame:
    """Join a lookup table and drop its key columns.

    Spark broadcasts the table where its size in bytes allows; otherwise adaptive
    execution splits the keys that many rows share.
    """
    match = _all([F.col(l) == F.col(r) for l, r in on])
    return df.join(lookup, match, how).drop(*[r for _, r in on])


def brought(df: DataFrame, found: DataFrame, group: str, key: str) -> DataFrame:
    """``df`` left-joined by ``group`` and ``key`` to ``found``, without moving its rows where they are staged by ``group``.

    ``found`` has what is known of the (group, key) pairs that occur in ``df``; it is far narrower and has
    fewer rows than ``df``. Each group gets its part of it as a list, in which a row looks its key up:
    groups with very many keys should be dealt into smaller ones first.
    """
    facts = [c for c in found.columns if c not in (group, key)]
    listed = found.groupBy(F.col(group).alias("_group")).agg(
        F.collect_list(F.struct(F.col(key).alias("_key"), *facts)).alias("_found")
    )
    own = F.filter("_found", lambda f: f["_key"] == F.col(key))
    joined = df.join(listed, F.col(group) == F.col("_group"), "left").select(*df.columns, F.explode_outer(own).alias("_own"))
    return joined.select(*df.columns, *[F.col(f"_own.{c}").alias(c) for c in facts])
