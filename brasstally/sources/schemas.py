"""Typed tables: the user's schema, with comments, as an empty table or as the form of a frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def described(columns: Sequence[tuple[str, str, str]]) -> T.StructType:
    """A schema from (name, type, comment) triples; the comments become field metadata."""
    return T.StructType([T.StructField(c, T.DataType.fromDDL(t), True, {"comment": note}) for c, t, note in columns])


def create_table(spark: SparkSession, table: str, schema: T.StructType, *, format: str = "parquet") -> None:
    """Make an empty catalog table of this schema; its columns carry their comments."""

    def column(f: T.StructField) -> str:
        note = f.metadata.get("comment", "").replace("\\", "\\\\").replace("'", "\\'")
        return f"`{f.name}` {f.dataType.simpleString()}" + (f" COMMENT '{note}'" if note else "")

    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(map(column, schema.fields))}) USING {format}")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in order and type: missing ones null, others dropped, bad casts an error."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name, metadata=f.metadata)
            for f in schema.fields
        ]
    )
