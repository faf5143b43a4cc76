"""Small helpers shared by the operators: table paths, written intermediate tables, slots."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brasstally.sources.staging import shared_folder

# The white space of the contracts.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends here, and a lost executor loses none of it.

    The files stay until the folder is cleared; they lie under the application's id.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/brasstally/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words_in(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; 0 for null."""
    plain = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " "))
    return F.when(plain == "", F.lit(0)).otherwise(
        F.length(plain) - F.length(F.replace(plain, F.lit(" "), F.lit(""))) + 1
    ).cast("long")
