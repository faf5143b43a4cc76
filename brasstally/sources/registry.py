"""Named tables behind one lookup."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Sources:
    """Table names mapped to catalog tables, files or a function that builds the frame.

    ``locations`` values: (rows, schema) for a short list of plain rows, a catalog name ('billing.accounts'), a path ('s3://…/x.parquet',
    '/data/x.parquet') or a callable taking the session. Anything not listed is looked
    up as ``{root}/{name}.{format}`` when ``root`` is set, else in the catalog.
    """

    spark: SparkSession
    root: str | None = None
    format: str = "parquet"
    locations: Mapping[str, str | tuple[list, str] | Callable[[SparkSession], DataFrame]] = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        where = self.locations.get(name)
        if callable(where):
            return where(self.spark)
        if isinstance(where, tuple):
            return self.spark.createDataFrame(*where)
        if where is None and self.root is not None:
            where = f"{self.root}/{name}.{self.format}"
        if where is None:
            return self.spark.read.table(name)
        if "/" in where:
            return self.spark.read.format(self.format).load(where)
        return self.spark.read.table(where)

    __getitem__ = table
