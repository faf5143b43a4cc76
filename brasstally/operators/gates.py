"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from brasstally.functions.dates import cutoff, stamp
from brasstally.operators.skew import _all

# Payer kinds for whom a third party pays.
THIRD_PARTY_TYPES = ("RESELLER", "MARKETPLACE", "RESELLER_MARKETPLACE")

# An incremental run looks back 28 hours.
SYNC_WINDOW = timedelta(hours=28)


# A stored table may be kept by day of sync, and versions by a part of their key (see ``sinks``).
SYNC_DAY, KEY_PART, KEY_PARTS = "sync_day", "key_part", 256


def part_of(key: str | Column, parts: int) -> Column:
    """The part of its key that a version is kept in: the bucket of a table bucketed by that key."""
    return F.pmod(F.hash(key), F.lit(parts)).cast("int")


def synced_since(rows: DataFrame, floor: Column, synced: str = "synced_at") -> DataFrame:
    """Rows synced at or after a moment; of a table kept by day of sync, only days that can hold one are read."""
    found = rows.filter(F.col(synced) >= floor)
    return found.filter(F.col(SYNC_DAY) >= floor.cast("date")) if SYNC_DAY in rows.columns else found


def any_of(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


all_of = _all


def paid_by_third_party(payer_type: str = "payer_type", kinds: Sequence[str] = THIRD_PARTY_TYPES) -> Column:
    return F.coalesce(F.col(payer_type).isin(*kinds), F.lit(False))


def resolve_payer(df: DataFrame, kinds: Sequence[str] = THIRD_PARTY_TYPES) -> DataFrame:
    """Adds ``payer_account_id``: the third party where one pays and is known, else the account."""
    third = F.when(paid_by_third_party(kinds=kinds), F.col("third_party_payer_id"))
    return df.withColumn("payer_account_id", F.coalesce(third, "billing_account_id"))


def recency_gate(
    df: DataFrame, columns: Sequence[str], as_of: datetime, window: timedelta = SYNC_WINDOW
) -> DataFrame:
    """Rows with any of the timestamps inside the window; a missing one is outside."""
    floor = cutoff(as_of, window)
    return df.filter(any_of([F.coalesce(F.col(c) >= floor, F.lit(False)) for c in columns]))


def with_changes(
    versions: DataFrame,
    key: str,
    related: Sequence[tuple[str, DataFrame, str]],
    as_of: datetime,
    window: timedelta = SYNC_WINDOW,
    *,
    synced: str = "synced_at",
    parts: int = KEY_PARTS,
    telling: Column | None = None,
) -> DataFrame:
    """All versions of the keys of which any version, or any row related to one, was synced inside the window.

    ``related`` has (column of versions, frame, its key). What a run ranks and joins
    then follows what changed, not all history. A superset of what a recency gate
    behind the joins would keep: the gate still decides. Where only versions that meet a
    condition can come out of what follows, ``telling`` is that condition: others make no
    key changed, but stay in the history of those that are.

    Of related tables kept by day of sync only the days of the window are read. Of
    versions kept in ``parts`` of their key, only the parts of changed keys are read for
    their history (dynamic partition pruning; the parts, at most ``parts`` rows, are broadcast).
    Read as a table bucketed by that key (``sinks.keep_by_key``), their rows are not moved
    to find it.
    """
    floor = cutoff(as_of, window)
    changed = versions if telling is None else versions.filter(telling)
    changed = changed.withColumn("_changed", F.coalesce(F.col(synced) >= floor, F.lit(False)))
    for i, (column, rows, rows_key) in enumerate(related):
        recent = synced_since(rows, floor, synced).select(F.col(rows_key).alias(f"_near{i}")).distinct()
        changed = changed.join(recent, F.col(column) == F.col(f"_near{i}"), "left")
        changed = changed.withColumn("_changed", F.col("_changed") | F.col(f"_near{i}").isNotNull())
    keys = changed.filter("_changed").select(F.col(key).alias("_key"))
    if KEY_PART not in versions.columns:
        return versions.join(keys.distinct(), F.col(key).eqNullSafe(F.col("_key")), "left_semi")
    # A plain equality, to rows that lie in no order by key yet, lets the buckets stay as they are,
    # however many partitions a shuffle has; versions without a key follow one row.
    part = part_of("_key", parts)
    # Both uses ask the same of a key, so that Spark finds the changed ones once.
    known = keys.filter(F.col("_key").isNotNull() & part.isNotNull())
    touched = F.broadcast(known.select(part.alias("_part")).distinct())
    near = versions.join(touched, F.col(KEY_PART) == F.col("_part"), "left_semi")
    keyed = near.join(known, F.col(key) == F.col("_key"), "left_semi")
    no_key = part_of(F.lit(None).cast(versions.schema[key].dataType), parts)
    unkeyed = versions.filter(F.col(key).isNull() & (F.col(KEY_PART) == no_key)).join(
        F.broadcast(keys.filter(F.col("_key").isNull()).limit(1)), F.lit(True), "left_semi"
    )
    return keyed.union(unkeyed).drop(KEY_PART)


def synced_between(df: DataFrame, columns: Sequence[str], start: datetime, end: datetime) -> DataFrame:
    """Rows with any of the timestamps in [start, end)."""
    inside = [(F.col(c) >= stamp(start)) & (F.col(c) < stamp(end)) for c in columns]
    return df.filter(any_of([F.coalesce(i, F.lit(False)) for i in inside]))


def created_in(df: DataFrame, start: datetime, end: datetime, column: str = "created_at") -> DataFrame:
    return df.filter((F.col(column) >= stamp(start)) & (F.col(column) < stamp(end)))


def run_mode(
    df: DataFrame,
    mode: str,
    *,
    start: datetime | None = None,
    end: datetime | None = None,
    accounts: Sequence[str] = (),
    floor: datetime | None = None,
) -> DataFrame:
    """'DATE' keeps rows created in [start, end); 'ACCOUNT' keeps listed accounts from ``floor`` on."""
    if mode == "DATE":
        return created_in(df, start, end)
    if mode == "ACCOUNT":
        listed = df.filter(F.col("billing_account_id").isin(*accounts))
        return listed if floor is None else listed.filter(F.col("created_at") >= stamp(floor))
    raise ValueError(f"unknown run mode {mode!r}")


def unexpired(as_of: datetime, column: str = "contract_end_date") -> Column:
    """Ends today or later, or never."""
    return F.col(column).isNull() | (F.col(column).cast("date") >= stamp(as_of).cast("date"))


def not_in(column: str, values: Sequence[str]) -> Column:
    """SQL NOT IN: a missing value does not pass. With no values to refuse, everything passes."""
    return ~F.col(column).isin(*values) if values else F.lit(True)


def null_or_not_in(column: str, values: Sequence[str]) -> Column:
    return F.col(column).isNull() | not_in(column, values)


def not_prefixed(column: str, prefix: str) -> Column:
    """Missing counts as empty, so it passes."""
    return ~F.startswith(F.coalesce(F.col(column), F.lit("")), F.lit(prefix))
