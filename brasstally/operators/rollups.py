"""Aggregates that list and count distinct values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Values that are joined to one text at a time.
CHUNK_BITS = 12


def distinct_values(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(keys, ``list``, ``value``): the distinct values of each column per key, as text, in order over all tasks.

    A key of any number of values is as spread as any: rows are dealt by ranges of
    (key, column, value). Where some row of a key has no value in a column, one row tells
    it by a null value. Repeats are removed map-side.
    """
    values = F.array(*[F.struct(F.lit(c).alias("list"), F.col(c).cast("string").alias("value")) for c in columns])
    rows = df.select(*keys, F.explode(values).alias("_v")).select(*keys, "_v.*").distinct()
    by = [*keys, "list", "value"]
    return rows.repartitionByRange(*by).sortWithinPartitions(*by)


def distinct_rollup(
    df: DataFrame,
    keys: Sequence[str],
    lists: Mapping[str, str],
    counts: Mapping[str, str],
    *,
    separator: str = ", ",
) -> DataFrame:
    """Per key: distinct value lists and counts, by output name and column.

    The lists hold every value, in the order of their text; none is null. They are joined
    from texts of at most 4,096 neighbouring values, so that no aggregate ever holds a
    key's values one by one; ``distinct_values`` has them as rows.
    """
    wanted = list(dict.fromkeys([*lists.values(), *counts.values()]))
    # A row's number within its sorted partition tells its chunk; partitions are in order.
    chunk = F.shiftright(F.monotonically_increasing_id(), CHUNK_BITS)
    rows = distinct_values(df, keys, wanted).withColumn("_chunk", chunk)
    texts = rows.groupBy(*keys, "list", "_chunk").agg(
        F.count("value").alias("_n"), F.array_join(F.array_sort(F.collect_list("value")), separator).alias("_text")
    )
    here = F.struct("_chunk", "_text")

    def joined(column: str) -> Column:
        parts = F.collect_list(F.when((F.col("list") == column) & (F.col("_n") > 0), here))
        return F.when(F.size(parts) > 0, F.array_join(F.transform(F.array_sort(parts), lambda p: p["_text"]), separator))

    return texts.groupBy(*keys).agg(
        *[F.sum(F.when(F.col("list") == c, F.col("_n")).otherwise(0)).alias(name) for name, c in counts.items()],
        *[joined(c).alias(name) for name, c in lists.items()],
    )


def counted_stages(df: DataFrame, counts: Mapping[str, Column]) -> DataFrame:
    """One row per stage and its count, all from one aggregate."""
    return df.agg(*[c.alias(n) for n, c in counts.items()]).unpivot([], list(counts), "stage", "records")
