"""File manifests and stored documents."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

# The reader of heads travels to the executors by value: these need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STORES = {"s3a": "s3", "s3n": "s3"}
MANIFEST_SCHEMA = "batch_id string, success boolean, status string, files array<map<string,string>>"


def read_manifests(spark: SparkSession, path: str, *, multi_line: bool = False) -> DataFrame:
    """JSON manifests with their file lists typed; every entry is also kept whole as a map.

    JSON lines by default, which Spark splits. With ``multi_line`` a file is one
    document, read whole by one task: for small pretty-printed manifests only.
    """
    raw = spark.read.schema(MANIFEST_SCHEMA).json(path, multiLine=multi_line)
    files = F.transform(
        "files",
        lambda e: F.struct(
            e["id"].alias("id"),
            e["name"].alias("name"),
            e["fullUrl"].alias("url"),
            e["billingAccountId"].alias("billing_account_id"),
            e.alias("entry"),
        ),
    )
    return raw.select(F.coalesce("batch_id", F.input_file_name()).alias("batch_id"), "success", "status", files.alias("files"))


def read_documents(spark: SparkSession, path: str, *, glob: str = "*") -> DataFrame:
    """Stored files as the document check takes them; the type is not recorded in storage."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    return found.load(path).select(
        F.col("path").alias("content_url"), F.lit(None).cast("string").alias("content_type"), "content"
    )


def list_documents(spark: SparkSession, path: str, *, glob: str = "*") -> DataFrame:
    """Stored files by path and size, as the document check lists them; no file is opened."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    return found.load(path).select(F.col("path").alias("content_url"), F.lit(None).cast("string").alias("content_type"), "length")


def first_bytes(path: str, n: int) -> bytes:
    """The first ``n`` bytes of a stored file, by one read of that range."""
    from urllib.parse import quote

    from pyarrow import fs

    # Hadoop writes file:/a b where others want file:///a%20b, and has names of its own for one store.
    scheme, found, rest = path.partition(":")
    scheme, rest = (STORES.get(scheme, scheme), rest) if found else ("file", path)
    store, inside = fs.FileSystem.from_uri(f"{scheme}:{'' if rest.startswith('//') else '//'}{quote(rest, safe='/:@')}")
    with store.open_input_file(inside) as f:
        return f.read_at(min(n, f.size()), 0)


def read_heads(urls: DataFrame, n: int, *, read: Callable[[str, int], bytes] = first_bytes) -> DataFrame:
    """``content_url`` and ``head``: the first ``n`` bytes of each file, whatever its size.

    ``read`` is given a path and a number of bytes; the default knows the schemes that
    Arrow knows (file, s3, gs, hdfs). A file that can't be opened fails the job.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = [read(path, n) for path in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(heads, pa.binary())], names=["content_url", "head"])

    return urls.select("content_url").mapInArrow(run, "content_url string, head binary")
