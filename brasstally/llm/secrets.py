"""Secret scans with an incremental blob ledger.

Every version of every path is addressed by the SHA-256 of its text. A ledger holds
the findings of each (blob, rule version) already scanned; a scan reads only blobs
whose pair is not there, each once however many paths and versions share it. Findings
then go back to all paths by the blob's address.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brasstally.llm.common import table, written
from brasstally.llm.spans import SPAN_TYPE, Span

# The kinds and patterns of the base rules.
KINDS = ["assign", "access", "hex"]
RULES_VERSION = "base-1"
NAMES = ["password", "passwd", "secret", "token", "apikey", "api_key"]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_LENGTH = 12
# A greedy run of 18 or 16 characters and more: shorter runs are failing matches and hold no other.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
LEDGER = f"blob string, rules string, spans {SPAN_TYPE}"


def base_rules(text: str) -> list[Span]:
    """Base spans by start, then kind. Only texts with one of the names or letters are searched for them."""
    found = [("hex", *m.span()) for m in HEX.finditer(text)]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    low = text.lower()
    if any(name in low for name in NAMES):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def scan_blobs(blobs: DataFrame, rules=base_rules, version: str = RULES_VERSION) -> DataFrame:
    """(blob, text) rows to ledger rows; a blob without findings has an empty list."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(LEDGER))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[dict(zip(("kind", "start", "end"), s)) for s in rules(t.as_py())] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([version] * len(spans)), pa.array(spans, arrow.field(2).type)], schema=arrow
            )

    return blobs.mapInArrow(run, LEDGER)


def scan_history(
    history: DataFrame, text_col: str = "text", ledger: DataFrame | None = None, rules=base_rules, version: str = RULES_VERSION
) -> tuple[DataFrame, DataFrame]:
    """``history`` without its text but with ``blob`` and ``spans``; and the ledger rows that this scan adds.

    A null text is the empty blob. Every row of ``history`` comes back, repeated ones
    too; columns named ``blob`` or ``spans`` are replaced. Append the second frame to
    the ledger; a scan with the same rule version then finds nothing to do.
    """
    text = F.coalesce(history[f"`{text_col}`"].cast("string"), F.lit(""))
    kept = [c for c in history.columns if c not in (text_col, "blob", "spans")]
    addressed = history.select(*[history[f"`{c}`"] for c in kept], F.sha2(text, 256).alias("blob"))
    # One text of each blob leaves a map task, so that a blob of very many paths stays small.
    blobs = history.select(F.sha2(text, 256).alias("blob"), text.alias("text")).groupBy("blob").agg(F.first("text").alias("text"))
    if ledger is not None:
        done = ledger.where(F.col("rules") == version).select("blob", "rules", "spans")
        blobs = blobs.join(done.select("blob"), "blob", "left_anti")
    fresh = written(scan_blobs(blobs, rules, version), "ledger")
    known = fresh if ledger is None else fresh.unionByName(done)
    return addressed.join(known.select("blob", "spans"), "blob", "left").select(*kept, "blob", "spans"), fresh


def report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts by kind, the digest of the base spans, and all spans as text."""
    text = F.coalesce(F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","), F.lit(""))
    counts = [
        F.coalesce(F.size(F.array_remove(F.transform("spans", lambda s: s["kind"] == F.lit(k)), F.lit(False))), F.lit(0)).cast("long").alias(f"n_{k}")  # noqa: B023
        for k in KINDS
    ]
    return found.select(F.col(id_col).alias("doc_id"), *counts, F.sha2(text, 256).alias("base_sha256"), text.alias("spans"))


def op10_secret_scan(spark, sf_dir: str) -> DataFrame:
    found, _ = scan_history(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return report(found)
