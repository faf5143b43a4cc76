"""Account feeds and account reports."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from brasstally.functions.dates import cutoff
from brasstally.operators.gates import (
    any_of,
    null_or_not_in,
    not_in,
    recency_gate,
    resolve_payer,
    synced_between,
    unexpired,
    with_changes,
)
from brasstally.operators.latest import latest_version, prefixed
from brasstally.operators.lookups import lookup_join
from brasstally.operators.rollups import counted_stages
from brasstally.operators.rules import blank_flags
from brasstally.operators.skew import enrich
from brasstally.plans.policy import Hot, Policy, skewed


def exempt_type(policy: Policy) -> Column:
    """The line's type is billed whatever the state of its account."""
    return F.col("type").isin(*policy.status_exempt_types) if policy.status_exempt_types else F.lit(False)


def billable_account(policy: Policy, *, exempt: bool | Column = False) -> Column:
    """Joined account is in a billed state, on no free tier, not an expired trial."""
    status = F.col("account_status").isin(*policy.account_statuses)
    if exempt is not False:
        status = status | (exempt_type(policy) if exempt is True else exempt)
    thawed = F.col("account_freeze_reason").isNull() | (
        F.col("account_freeze_reason") != policy.expired_freeze_reason
    )
    return status & null_or_not_in("account_platform_tier", policy.free_tiers) & thawed


def account_sync(
    subs: DataFrame,
    accounts: DataFrame,
    info: DataFrame,
    as_of: datetime,
    policy: Policy = Policy(),
    *,
    hot: Hot = None,
) -> DataFrame:
    """Newest unexpired subscriptions with their account and billing details, recently synced.

    Expiry is judged before the newest version is picked, so an older open version
    may stand for a line. Deleted billing details are not left out.
    """
    hot = skewed(hot, "billing_account_id")["billing_account_id"]
    near = [("billing_account_id", accounts, "id"), ("billing_account_id", info, "account_id")]
    live = with_changes(subs, "crm_line_id", near, as_of, policy.window).filter(unexpired(as_of))
    newest = resolve_payer(
        latest_version(live, ["crm_line_id"], policy.newest_first()), policy.third_party_types
    )
    wanted = newest.filter(
        F.col("billing_account_id").isNotNull()
        & F.col("order_number").isNotNull()
        & not_in("type", policy.free_types)
    )
    on_account = enrich(
        wanted,
        prefixed(accounts, "account"),
        [("billing_account_id", "account_id")],
        how="inner",
        hot=hot,
        spread=["crm_line_id"],
    ).filter(billable_account(policy, exempt=True))
    full = enrich(
        on_account,
        prefixed(info, "info"),
        [("billing_account_id", "info_account_id")],
        hot=hot,
        spread=["crm_line_id"],
    )
    return recency_gate(full, ["synced_at", "account_synced_at", "info_synced_at"], as_of, policy.window)


def account_stage_counts(
    subs: DataFrame, accounts: DataFrame, info: DataFrame, as_of: datetime, policy: Policy = Policy()
) -> DataFrame:
    """Lines left after each stage of the account feed, in order: where a row went that is looked for.

    The recency of a line counts over the line, its account and its billing details.
    """
    floor = cutoff(as_of, policy.window)
    live = ~F.col("is_deleted")
    open_ = live & unexpired(as_of)
    # One pass over the versions: a line's counts and its newest open version come from one aggregate,
    # and go through the joins to one row per account together. What its order, type and sync say is
    # told by flags: the rows of this aggregate are sorted, so the narrower they are, the less a task holds.
    ordered = F.col("order_number").isNotNull() & not_in("type", policy.free_types)
    newest = F.struct(
        "billing_account_id",
        F.coalesce(ordered, F.lit(False)).alias("ordered"),
        F.coalesce(exempt_type(policy), F.lit(False)).alias("exempt"),
        F.coalesce(F.col("synced_at") >= floor, F.lit(False)).alias("recent"),
    )
    lines = subs.groupBy("crm_line_id").agg(
        F.count("*").alias("raw"),
        F.count_if(live).alias("live"),
        F.count_if(open_).alias("open"),
        F.max_by(newest, F.when(open_, F.struct(*policy.newest_by()))).alias("newest"),
    ).select("raw", "live", "open", "newest.*", F.col("newest").isNotNull().alias("found"))
    states = latest_version(accounts, ["id"], [F.desc_nulls_last("synced_at"), F.asc_nulls_last("status")], deleted=None)
    details = info.groupBy("account_id").agg(F.max("synced_at").alias("synced_at"))
    joined = lines.join(prefixed(states, "account"), F.col("billing_account_id") == F.col("account_id"), "left").join(
        prefixed(details, "info"), F.col("billing_account_id") == F.col("info_account_id"), "left"
    )
    ordered = F.col("found") & F.col("ordered")
    on_account = ordered & F.col("account_id").isNotNull()
    billed = on_account & billable_account(policy, exempt=F.col("exempt"))
    recent = any_of([F.col("recent"), *[F.coalesce(F.col(c) >= floor, F.lit(False)) for c in ("account_synced_at", "info_synced_at")]])
    return counted_stages(
        joined,
        {
            "1_raw": F.coalesce(F.sum("raw"), F.lit(0)),
            "2_live": F.coalesce(F.sum("live"), F.lit(0)),
            "3_unexpired": F.coalesce(F.sum("open"), F.lit(0)),
            "4_newest": F.count_if("found"),
            "5_ordered": F.count_if(ordered),
            "6_on_account": F.count_if(on_account),
            "7_billed": F.count_if(billed),
            "8_recent": F.count_if(billed & recent),
        },
    )


def missing_account_fields(
    subs: DataFrame,
    accounts: DataFrame,
    info: DataFrame,
    start: datetime,
    end: datetime,
    policy: Policy = Policy(),
    *,
    hot: Hot = None,
) -> DataFrame:
    """Billed accounts of which all of billing address, shipping address and legal name are blank."""
    hot = skewed(hot, "billing_account_id")["billing_account_id"]
    newest = latest_version(subs, ["crm_line_id"], policy.newest_first()).filter(not_in("type", policy.free_types))
    on_account = enrich(
        newest,
        prefixed(accounts, "account"),
        [("billing_account_id", "account_id")],
        how="inner",
        hot=hot,
        spread=["crm_line_id"],
    ).filter(billable_account(policy))
    full = enrich(
        on_account, prefixed(info, "info"), [("billing_account_id", "info_account_id")], hot=hot, spread=["crm_line_id"]
    )
    recent = synced_between(full, ["synced_at", "account_synced_at", "info_synced_at"], start, end)
    flags = blank_flags(
        [
            ("is_billing_missing", "info_billing_address"),
            ("is_shipping_missing", "info_shipping_address"),
            ("is_legal_missing", "info_legal_name"),
        ],
        "all",
    )
    return (
        recent.withColumns(flags)
        .filter("is_missing")
        .select(
            "billing_account_id",
            "third_party_payer_id",
            "crm_account_id",
            F.col("synced_at").alias("subscription_synced_at"),
            "account_synced_at",
            F.col("info_synced_at").alias("billing_synced_at"),
            F.col("info_billing_address").alias("billing_address"),
            F.col("info_shipping_address").alias("shipping_address"),
            F.col("info_legal_name").alias("legal_name"),
            "payer_type",
            *flags,
        )
        .distinct()
    )


# Verdicts on an account, in the order they are tried.
FAIL_STATUS = "FAIL: status not allowed"
FAIL_TIER = "FAIL: free tier"
FAIL_TRIAL = "FAIL: trial expired"
WARN_STALE = "WARN: stale acct sync"


def _gates(policy: Policy) -> list[tuple[str, str, Column]]:
    return [
        ("status", FAIL_STATUS, not_in("status", policy.account_statuses)),
        (
            "platform_tier",
            FAIL_TIER,
            F.col("platform_tier").isin(*policy.free_tiers) if policy.free_tiers else F.lit(False),
        ),
        ("freeze_reason", FAIL_TRIAL, F.col("freeze_reason") == policy.expired_freeze_reason),
    ]


def drop_reason(accounts: DataFrame, as_of: datetime, policy: Policy = Policy()) -> DataFrame:
    """First gate each account fails, as ``diagnosis``; a stale sync only warns."""
    verdict = F.when(F.lit(False), "")
    for _, label, failed in _gates(policy):
        verdict = verdict.when(failed, label)
    verdict = verdict.when(F.col("synced_at") < cutoff(as_of, policy.window), WARN_STALE).otherwise("OK")
    return accounts.select(
        "id", "status", "platform_tier", "freeze_reason", "synced_at", verdict.alias("diagnosis")
    )


def recently_dropped(accounts: DataFrame, as_of: datetime, policy: Policy = Policy()) -> DataFrame:
    """Accounts synced inside the window that fail a gate, with its name.

    A missing status fails no gate by name and is reported as 'unknown' only if
    another part fails, as SQL's three-valued NOT does.
    """
    tier_ok = null_or_not_in("platform_tier", policy.free_tiers)
    thawed = F.col("freeze_reason").isNull() | (F.col("freeze_reason") != policy.expired_freeze_reason)
    passes = F.col("status").isin(*policy.account_statuses) & tier_ok & thawed
    reason = F.when(F.lit(False), "")
    for name, _, failed in _gates(policy):
        reason = reason.when(failed, name)
    recent = recency_gate(accounts, ["synced_at"], as_of, policy.window)
    return recent.filter(~passes).select(
        "id", "status", "platform_tier", "freeze_reason", "synced_at", reason.otherwise("unknown").alias("drop_reason")
    )


def product_account_sync(
    subs: DataFrame,
    orgs: DataFrame,
    info: DataFrame,
    as_of: datetime,
    product_type: str,
    policy: Policy = Policy(),
    *,
    hot: Hot = None,
) -> DataFrame:
    """Open subscriptions of one product line with payment details: newest per organisation,
    then one row per billing account, a known payment profile first."""
    hot = skewed(hot, "billing_account_id")["billing_account_id"]
    open_subs = subs.filter(
        ~F.col("is_deleted")
        & F.col("termination_date_utc").isNull()
        & unexpired(as_of)
        & (F.col("type") == product_type)
    )
    members = orgs.filter(~F.col("is_deleted")).select("org_id", "billing_info_id").distinct()
    in_line = lookup_join(
        open_subs,
        members,
        [("billing_account_id", "billing_info_id")],
        how="inner",
    )
    newest = latest_version(in_line, ["org_id"], policy.newest_first(), deleted=None)
    paying = prefixed(
        info.filter(~F.col("is_deleted") & F.col("payment_profile_id").isNotNull()), "info"
    )
    full = newest.join(paying, F.col("billing_account_id") == F.col("info_id"), "inner")
    recent = recency_gate(full, ["synced_at", "info_synced_at"], as_of, policy.window)
    best = [F.desc_nulls_last("info_payment_profile_id"), *policy.newest_first(), F.asc("org_id")]
    return latest_version(recent, ["billing_account_id"], best, deleted=None)


def owner_change_sync(
    history: DataFrame,
    crm_accounts: DataFrame,
    account_map: DataFrame,
    users: DataFrame,
    accounts: DataFrame,
    as_of: datetime,
    self_service_email: str,
    policy: Policy = Policy(),
    *,
    statuses: Sequence[str] = ("Customer", "Frozen"),
    billing_accounts: Sequence[str] | None = None,
) -> DataFrame:
    """Newest owner change per CRM account in the window, with both owners' e-mails.

    Changes to the self-service owner and accounts in other states are left out.
    ``billing_accounts`` narrows the output to a list.
    """
    changes = history.filter(
        ~F.col("is_deleted") & (F.col("field") == "Owner") & (F.col("data_type") == "EntityId")
    )
    changes = recency_gate(changes, ["created_date"], as_of, policy.window)
    live = crm_accounts.filter(~F.col("is_deleted")).select(F.col("id").alias("crm_account_id")).distinct()
    # The newest change is picked first: deleted accounts go as whole groups, and one row
    # per account is left to join.
    newest = latest_version(
        changes, ["crm_account_id"], [F.desc("created_date"), F.desc("history_id")], deleted=None
    ).join(live, "crm_account_id", "left_semi")
    mapped = account_map.filter(F.col("billing_account_id").isNotNull() & F.col("crm_account_id").isNotNull())
    owners = users.select(F.col("id").alias("user_id"), "email")
    newer = owners.filter(
        F.col("email").isNotNull() & (F.lower("email") != self_service_email.lower())
    ).toDF("new_user", "new_owner_email")
    older = owners.toDF("old_user", "old_owner_email")
    billed = accounts.filter(F.col("status").isin(*statuses)).select(
        F.col("id").alias("billed_id"), F.col("status")
    )
    # One owner may hold many accounts, so owners are joined as a lookup.
    owned = lookup_join(newest, newer, [("new_value", "new_user")], how="inner")
    owned = lookup_join(owned, older, [("old_value", "old_user")])
    out = (
        owned.join(mapped.select("crm_account_id", "billing_account_id"), "crm_account_id", "inner")
        .join(billed, F.col("billing_account_id") == F.col("billed_id"), "inner")
        .select(
            "billing_account_id",
            "crm_account_id",
            "new_owner_email",
            "old_owner_email",
            F.col("created_date").alias("owner_changed_at"),
            "status",
        )
    )
    return out if billing_accounts is None else out.filter(F.col("billing_account_id").isin(*billing_accounts))
