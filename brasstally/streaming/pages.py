"""Run a page hook on every micro-batch of a stream.

A page is what arrives between two triggers (bounded by the source's options,
such as ``maxFilesPerTrigger``). Hooks that judge rows one by one fit here;
rules over whole orders or tables belong in a batch run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from brasstally.result import Result
from brasstally.sources.sinks import write_result

Hook = Callable[[DataFrame], Result]


def checkpoint_root(df: DataFrame, fallback: str | None = None) -> str:
    """The shared folder the cluster names; ``fallback`` only where it names none."""
    root = df.sparkSession.conf.get("spark.checkpoint.dir", fallback)
    if root is None:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return root


def run_pages(
    rows: DataFrame, hook: Hook, path: str, *, name: str, checkpoint: str | None = None
) -> StreamingQuery:
    """Judge each page and write its accepted and refused rows under ``path/page=<n>``.

    A page that is run again after a failure overwrites itself. An exception in the
    hook stops the stream, and the page stays unprocessed.
    """

    def judge(page: DataFrame, number: int) -> None:
        write_result(hook(page), f"{path}/page={number}")

    root = checkpoint_root(rows, checkpoint)
    return (
        rows.writeStream.foreachBatch(judge)
        .queryName(name)
        .option("checkpointLocation", f"{root}/{name}")
        .trigger(availableNow=True)
        .start()
    )
