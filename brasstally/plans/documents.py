"""Invoice files: manifest, document check, batch outcome, dispatch audit, retention, redaction."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from brasstally.functions.dates import day
from brasstally.functions.text import file_name, is_empty, safe_folder, short_url
from brasstally.operators.gates import any_of
from brasstally.operators.latest import latest_version
from brasstally.operators.rules import open_judgement, refuse
from brasstally.operators.skew import HotKeys, enrich
from brasstally.result import Result

# What a PDF is known by.
PDF_CONTENT_TYPE, PDF_SUFFIX, PDF_MAGIC = "application/pdf", ".pdf", b"%PDF-"

# A dispatch is tried three times; a client error is not tried again.
MAX_ATTEMPTS = 3
OK_STATUS = 200

# A field whose name has one of these words is masked.
SENSITIVE_WORDS = ("authorization", "token", "password", "secret", "key", "auth")
MASK = "[REDACTED]"


def explode_manifests(manifests: DataFrame) -> DataFrame:
    """One row per listed file; a batch that failed upstream, or lists nothing, is one refused row."""
    lists = F.coalesce(F.size("files"), F.lit(0)) > 0
    ok = F.coalesce(F.col("success"), F.lit(False))
    rest = [c for c in manifests.columns if c not in ("files", "success")]
    # Files of a failed batch are not looked at, so its list is cut before the explode.
    opened = manifests.withColumn("files", F.when(ok, F.col("files")))
    rows = opened.select(*rest, ok.alias("_ok"), lists.alias("_lists"), F.explode_outer("files").alias("_file"))
    judged = refuse(
        open_judgement(rows.select(*rest, "_ok", "_lists", "_file.*")),
        ~F.col("_ok"),
        "upstream_failed",
        F.lit("the batch was not made"),
    )
    return refuse(judged, ~F.col("_lists"), "no_files", F.lit("the batch lists no file")).drop("_ok", "_lists")


def safe_url(url: Column | str, allowed: Sequence[str]) -> Column:
    """Scheme and authority of the URL, port and user part included, are among the allowed ones."""
    url = F.col(url) if isinstance(url, str) else url
    origin = F.concat(F.try_parse_url(url, F.lit("PROTOCOL")), F.lit("://"), F.try_parse_url(url, F.lit("AUTHORITY")))
    return F.coalesce(origin.isin(*allowed), F.lit(False))


def told_by_name(content_type: Column, url: Column) -> Column:
    """Known as a document without a look at its bytes: by its type or the end of its URL."""
    return F.coalesce(F.contains(F.lower(content_type), F.lit(PDF_CONTENT_TYPE)), F.lit(False)) | F.coalesce(
        F.endswith(F.lower(url), F.lit(PDF_SUFFIX)), F.lit(False)
    )


def is_document(content_type: Column, url: Column, content: Column, magic: bytes = PDF_MAGIC) -> Column:
    """Known by its type, the end of its URL or its first bytes: any one is enough."""
    first = F.coalesce(F.substring(content, 1, len(magic)) == F.lit(magic), F.lit(False))
    return told_by_name(content_type, url) | first


def undecided(entries: DataFrame, stored: DataFrame) -> DataFrame:
    """``content_url`` of the stored files that some entry names and that neither type nor URL tells, once each."""
    asked = entries.filter(F.col("reject_code").isNull()).select(F.col("url").alias("content_url"))
    unsure = stored.filter(~told_by_name(F.col("content_type"), F.col("content_url")))
    return unsure.select("content_url").distinct().join(asked, "content_url", "left_semi")


def document_manifest(
    manifests: DataFrame,
    contents: DataFrame,
    *,
    heads: Callable[[DataFrame, int], DataFrame] | None = None,
    allowed_origins: Sequence[str] | None = None,
    magic: bytes = PDF_MAGIC,
    hot: HotKeys | None = None,
) -> Result:
    """Where each listed file goes and with which metadata, or why it does not.

    ``contents`` (content_url, content_type) lists the files already in storage, such as
    ``manifests.list_documents``. Only files that neither type nor URL decides are opened:
    ``heads`` (such as ``manifests.read_heads``) takes their ``content_url`` and a number of
    bytes and gives ``content_url`` and ``head``. Where ``contents`` has the bytes itself, as
    ``content``, its first ones are taken.
    """
    files = explode_manifests(manifests)
    # A manifest read from JSON keeps each entry whole; otherwise the known fields make the metadata.
    listed = [c for c in ("id", "name", "url", "billing_account_id") if c in files.columns]
    named = files.withColumns(
        {
            "file_name": file_name("name", "id"),
            "folder": safe_folder("billing_account_id"),
            "metadata": F.map_filter(
                F.col("entry")
                if "entry" in files.columns
                else F.create_map(*[x for c in listed for x in (F.lit(c), F.col(c).cast("string"))]),
                lambda _, v: v.isNotNull(),
            ),
        }
    )
    checked = refuse(named, is_empty("url"), "missing_url", F.lit("entry without url"))
    if allowed_origins is not None:
        checked = refuse(
            checked, ~safe_url("url", allowed_origins), "url_not_allowed", F.lit("origin not on the list")
        )
    if "content" in contents.columns:
        stored = contents.select("content_url", "content_type", F.substring("content", 1, len(magic)).alias("head"))
    else:
        stored = contents.select("content_url", "content_type")
        opened = heads(undecided(checked, stored), len(magic)) if heads else None
        none = F.lit(None).cast("binary")
        stored = stored.join(opened, "content_url", "left") if opened else stored.withColumn("head", none)
    # Many entries may name one file, or none.
    found = enrich(checked, stored, [("url", "content_url")], hot=hot, spread=["batch_id", "id"])
    found = refuse(found, F.col("content_url").isNull(), "not_found", F.lit("not among the stored files"))
    found = refuse(
        found,
        ~is_document(F.col("content_type"), F.col("url"), F.col("head"), magic),
        "not_a_document",
        F.lit("neither type, name nor first bytes tell a document"),
    )
    path = F.when(F.col("reject_code").isNull(), F.concat("folder", F.lit("/"), "file_name"))
    return Result(found.withColumn("file_path", path).drop("content_url", "head"))


def with_parent_metadata(df: DataFrame, parent: str = "_PARENT", metadata: str = "metadata") -> DataFrame:
    """Adds the entries of a parent map to the metadata, keys prefixed by the parent's name."""
    entries = F.transform_keys(
        F.coalesce(F.col(parent), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))),
        lambda k, _: F.concat(F.lit(f"{parent}_"), k),
    )
    return df.withColumn(metadata, F.map_concat(metadata, entries))


def batch_outcome(judged: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Per batch: files, successes, failures, success rate, level and answer code."""
    failed = F.count_if(F.col("reject_code").isNotNull())
    counts = judged.groupBy(batch).agg(F.count("*").alias("total_files"), failed.alias("failed"))
    good = F.col("total_files") - F.col("failed")
    level = F.when(F.col("failed") == 0, "info").when(good > 0, "warning").otherwise("error")
    share = F.round(good.cast("decimal(20,0)") * 100 / F.col("total_files").cast("decimal(20,0)"), 2)
    return counts.select(
        batch,
        "total_files",
        good.alias("successful"),
        "failed",
        share.cast("decimal(18,2)").alias("success_rate"),
        level.alias("level"),
        F.when(level == "error", 400).otherwise(207).alias("answer_code"),
    )


def error_counts(judged: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Failures per batch and error."""
    return (
        judged.filter(F.col("reject_code").isNotNull())
        .groupBy(batch, F.col("reject_message").alias("error"))
        .agg(F.count("*").alias("occurrences"))
    )


def dispatch_outcomes(attempts: DataFrame, *, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """What became of each file, from the log of all its attempts.

    The attempts end at the first success, the first client error or the last try
    allowed, whichever is earliest; later ones never counted. Per file only the
    attempts up to ``max_attempts`` are kept, cut map-side.
    """
    tries = Window.partitionBy("batch_id", "file_id").orderBy("attempted_at", "attempt_id")
    counted = attempts.withColumn("attempt", F.row_number().over(tries)).filter(F.col("attempt") <= max_attempts)
    ends = (F.col("status_code") == OK_STATUS) | F.col("status_code").between(400, 499)
    # The deciding attempt is the first that ends the file, else the last one made.
    rank = F.when(ends, F.col("attempt")).otherwise(F.lit(2 * max_attempts) - F.col("attempt"))
    last = F.min_by(F.struct("file_name", "status_code", "error", "attempt", "attempted_at"), rank)
    return (
        counted.groupBy("batch_id", "file_id")
        .agg(last.alias("last"))
        .select(
            "batch_id",
            "file_id",
            "last.file_name",
            "last.status_code",
            "last.error",
            F.col("last.attempt").alias("attempts"),
            F.col("last.attempted_at").alias("finished_at"),
            (F.col("last.status_code") == OK_STATUS).alias("success"),
            F.coalesce(F.col("last.status_code").between(400, 499), F.lit(False)).alias("no_retry"),
        )
    )


def dispatch_summary(outcomes: DataFrame) -> DataFrame:
    """Per batch: files, successes, failures and the success rate."""
    good = F.count_if("success")
    return outcomes.groupBy("batch_id").agg(
        F.count("*").alias("total_files"),
        good.alias("successful"),
        F.count_if(~F.col("success")).alias("failed"),
        F.sum("attempts").alias("attempts"),
        F.round(good.cast("decimal(20,0)") * 100 / F.count("*").cast("decimal(20,0)"), 2)
        .cast("decimal(18,2)")
        .alias("success_rate"),
    )


def retention_candidates(files: DataFrame, folder: object, start: date, end: date) -> DataFrame:
    """Files of one folder created from one day to another, both included. Selects, deletes nothing."""
    created = F.col("created").cast("date")
    return files.filter((F.col("folder_id") == F.lit(folder)) & (created >= day(start)) & (created <= day(end)))


def retention_summary(candidates: DataFrame) -> DataFrame:
    """How many files were handled and how many failed, per folder."""
    return candidates.groupBy("folder_id").agg(
        F.count("*").alias("processed"),
        F.count_if(F.coalesce(F.col("failed"), F.lit(False))).alias("errors"),
        F.min("created").alias("first_created"),
        F.max("created").alias("last_created"),
    )


def redact(
    df: DataFrame, sensitive: Sequence[str] = SENSITIVE_WORDS, urls: Sequence[str] = ("url", "fullUrl")
) -> DataFrame:
    """Fields with a sensitive word in their name masked, long URLs shortened, inside structs, arrays and maps too.

    A map's entries are judged by their keys, row by row. What a map holds under a sensitive
    key becomes the mask where it is text, and null where it can't hold the mask.
    """

    def by_key(entries: Column, kind: T.MapType) -> Column | None:
        inner = safe(F.lit(None), kind.valueType, "")
        if not isinstance(kind.keyType, T.StringType):
            return None if inner is None else F.transform_values(entries, lambda _, v: safe(v, kind.valueType, ""))
        text = isinstance(kind.valueType, T.StringType)

        def entry(key: Column, value: Column) -> Column:
            low = F.lower(key)
            masked = F.when(value.isNotNull(), F.lit(MASK)) if text else F.lit(None).cast(kind.valueType)
            out = F.when(any_of([F.contains(low, F.lit(word)) for word in sensitive]), masked)
            if text and urls:
                out = out.when(key.isin(*urls), short_url(value))
            return out.otherwise(value if inner is None else safe(value, kind.valueType, ""))

        return F.transform_values(entries, entry)

    def safe(value: Column, kind: T.DataType, name: str) -> Column | None:
        """What stands for a value; None where it may stay as it is."""
        if any(word in name.lower() for word in sensitive):
            return F.lit(MASK)
        if name in urls and isinstance(kind, T.StringType):
            return short_url(value)
        if isinstance(kind, T.ArrayType):
            if safe(F.lit(None), kind.elementType, "") is None:
                return None
            return F.transform(value, lambda x: safe(x, kind.elementType, ""))
        if isinstance(kind, T.MapType):
            return by_key(value, kind)
        if isinstance(kind, T.StructType):
            inner = {f.name: safe(value[f.name], f.dataType, f.name) for f in kind.fields}
            if all(x is None for x in inner.values()):
                return None
            fields = [(value[f] if x is None else x).alias(f) for f, x in inner.items()]
            return F.when(value.isNotNull(), F.struct(*fields))
        return None

    out = {f.name: safe(F.col(f"`{f.name}`"), f.dataType, f.name) for f in df.schema.fields}
    out = {name: x for name, x in out.items() if x is not None}
    return df.withColumns(out) if out else df
