"""Frames written once, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# A column noted so is the key that staged rows are kept by, in so many buckets at most.
STAGED_BY, STAGED_PARTS = "staged_by", 256


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Only a session on one machine may go without: it gets a temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="brasstally-"))
    return spark.sparkContext.getCheckpointDir()


def staged_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; what lies there may be cleared when the application has ended."""
    return f"{shared_folder(spark)}/brasstally/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def to_stage_by(df: DataFrame, key: str) -> DataFrame:
    """The same rows, with a note on the column that ``staged`` is to keep them by."""
    return df.withMetadata(key, {**df.schema[key].metadata, STAGED_BY: True})


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read again: steps that use it several times evaluate what is behind it once.

    Runs one job. Its lineage ends here, so that a lost executor costs none of it.

    With a column noted by ``to_stage_by`` the rows are written in buckets of it, straight from the
    tasks that made them: aggregates and joins by that column then move no row. Columns in files take
    a third of the bytes that a shuffle of the same rows takes. A bucket is read by one task: deal
    values that very many rows may share first.
    """
    spark, path = df.sparkSession, staged_path(df.sparkSession, name)
    key = next((f.name for f in df.schema if STAGED_BY in f.metadata), None)
    if key is None:
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    # Spark writes and knows buckets as a table only, which is forgotten once it is resolved.
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), STAGED_PARTS)
    table = f"staged_{uuid.uuid4().hex}"
    plain = {k: v for k, v in df.schema[key].metadata.items() if k != STAGED_BY}
    rows = df.withMetadata(key, plain).write.format("parquet").option("path", path).option("compression", "zstd")
    try:
        rows.bucketBy(parts, key).saveAsTable(table)
        return spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
