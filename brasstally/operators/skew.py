"""Joins, group totals and numbering that survive a key holding a large share of all rows.

There is one form of each, whatever the size. Totals are combined map-side and joined
back, numbers are given within 256 parts of a group, and joins are Spark's own, whose
hot keys adaptive execution splits. Where adaptive execution is off, a caller who
knows the hot keys of a join from table statistics may name them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, functions as F


@dataclass(frozen=True)
class HotKeys:
    """Values of one column that hold many rows, and how many ways to split them."""

    values: tuple = ()
    nulls: bool = False
    splits: int = 1

    def __bool__(self) -> bool:
        return bool(self.values) or self.nulls

    def mapped(self, change: Callable[[str], str]) -> HotKeys:
        """The same keys as they look after ``change``, for a join on a derived column."""
        return replace(self, values=tuple(dict.fromkeys(change(v) for v in self.values)))

    def holds(self, column: Column) -> Column:
        listed = F.coalesce(column.isin(*self.values), F.lit(False)) if self.values else F.lit(False)
        return (listed | column.isNull()) if self.nulls else listed


NONE_HOT = HotKeys()


def enrich(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    *,
    how: str = "left",
    hot: HotKeys | None = None,
    spread: Sequence[str] = (),
) -> DataFrame:
    """Equi-join. Right columns must be named apart from left ones.

    With ``hot``, rows of these keys of the left side's first column are dealt
    over ``hot.splits`` slots by a hash of ``spread`` (columns that tell the rows
    apart); the right rows of those few keys are repeated once per slot. Null
    keys match nothing, so they are dealt out and nothing is repeated for them.
    """
    match = [F.col(l) == F.col(r) for l, r in on]
    if not hot:
        return left.join(right, _all(match), how)
    first_left, first_right = on[0]
    slots = hot.splits
    dealt = F.pmod(F.xxhash64(*spread), F.lit(slots)).cast("int")
    slotted = left.withColumn("_slot", F.when(hot.holds(F.col(first_left)), dealt).otherwise(0))
    listed = F.col(first_right).isin(*hot.values) if hot.values else F.lit(False)
    copies = F.when(listed, F.sequence(F.lit(0), F.lit(slots - 1))).otherwise(F.array(F.lit(0)))
    repeated = right.withColumn("_copy", F.explode(copies))
    joined = slotted.join(repeated, _all([*match, F.col("_slot") == F.col("_copy")]), how)
    return joined.drop("_slot", "_copy")


def _all(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def group_totals(
    df: DataFrame,
    keys: Sequence[str],
    totals: Mapping[str, Column],
    *,
    hot: HotKeys | None = None,
    spread: Sequence[str] = (),
) -> DataFrame:
    """Every row with aggregates of its whole group. Keys must not be null; ``totals`` are bare aggregates.

    The aggregates are combined map-side and joined back, so that no group need fit
    in one task.
    """
    renamed = [f"_key_{k}" for k in keys]
    summed = df.groupBy(*[F.col(k).alias(r) for k, r in zip(keys, renamed)]).agg(
        *[agg.alias(name) for name, agg in totals.items()]
    )
    return enrich(df, summed, list(zip(keys, renamed)), hot=hot, spread=spread).drop(*renamed)


def number_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], *, into: str = "line_number"
) -> DataFrame:
    """1..n within each group, the same on every run. Keys must not be null.

    Rows are ordered by the first two hex digits of a digest of ``order``, then by
    ``order`` itself, which must tell the rows of a group apart. The digest cuts a
    group of any size into 256 near-equal parts that are numbered separately;
    only the 256 counts of a group ever meet in one task.
    """
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in order]
    parted = df.withColumn("_part", F.substring(F.md5(F.concat_ws("|", *text)), 1, 2))
    ordered = [F.asc_nulls_first(c) for c in order]
    within = Window.partitionBy(*keys, "_part").orderBy(*ordered)
    before = Window.partitionBy(*[f"_key_{k}" for k in keys]).orderBy("_part_key")
    offsets = (
        parted.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys], F.col("_part").alias("_part_key"))
        .agg(F.count("*").alias("_rows"))
        .withColumn("_offset", F.sum("_rows").over(before) - F.col("_rows"))
        .drop("_rows")
    )
    match = [F.col(k) == F.col(f"_key_{k}") for k in keys] + [F.col("_part") == F.col("_part_key")]
    return (
        parted.withColumn("_place", F.row_number().over(within))
        .join(offsets, _all(match), "inner")
        .withColumn(into, F.col("_place") + F.col("_offset"))
        .drop("_part", "_place", "_offset", "_part_key", *[f"_key_{k}" for k in keys])
    )
