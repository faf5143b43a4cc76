"""Subscription feed, subscription reports and order backfills."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from brasstally.functions.dates import cutoff, stamp, us_date
from brasstally.operators.gates import (
    created_in,
    not_in,
    not_prefixed,
    paid_by_third_party,
    recency_gate,
    resolve_payer,
    synced_between,
    with_changes,
)
from brasstally.operators.latest import latest_version, prefixed
from brasstally.operators.lookups import lookup_join
from brasstally.operators.rollups import counted_stages, distinct_rollup
from brasstally.operators.rules import blank_flags
from brasstally.operators.skew import HotKeys, enrich, group_totals
from brasstally.plans.policy import Hot, Policy, skewed

# Payer kinds that the missing-field report reads the payer's details for.
REPORT_PAYER_TYPES = ("RESELLER", "MARKETPLACE")
# Fixed value: how far back the order backfill looks.
BACKFILL_WINDOW = timedelta(days=1095)


def with_both_roles(
    subs: DataFrame, info: DataFrame, hot: dict[str, HotKeys], *, live_only: bool = True
) -> DataFrame:
    """Billing details twice: ``payer_…`` for the third party, ``customer_…`` for the account."""
    details = info.filter(~F.col("is_deleted")) if live_only else info
    details = details.select("account_id", "billing_address", "shipping_address", "legal_name", "tax_id", "synced_at")
    paid = enrich(
        subs,
        prefixed(details, "payer_info"),
        [("third_party_payer_id", "payer_info_account_id")],
        hot=hot["third_party_payer_id"],
        spread=["crm_line_id"],
    )
    return enrich(
        paid,
        prefixed(details, "customer_info"),
        [("billing_account_id", "customer_info_account_id")],
        hot=hot["billing_account_id"],
        spread=["crm_line_id"],
    )


def newest_details(info: DataFrame) -> DataFrame:
    """The newest live billing details of each account: one row, so that no line is doubled."""
    newest = [F.desc_nulls_last(c) for c in ("updated_at", "synced_at", "id", "legal_name", "billing_address")]
    return latest_version(info, ["account_id"], newest)


def by_role(column: str, kinds) -> Column:
    """The payer's value where a third party pays, the customer's otherwise."""
    return F.when(paid_by_third_party(kinds=kinds), F.col(f"payer_info_{column}")).otherwise(
        F.col(f"customer_info_{column}")
    )


def orderable(policy: Policy) -> Column:
    """Paid type with an order number, not a product kept out of the feed."""
    return (
        not_in("type", [*policy.free_types, *policy.legacy_types])
        & F.col("order_number").isNotNull()
        & not_in_or_missing("product_code", policy.excluded_products)
    )


def not_in_or_missing(column: str, values) -> Column:
    return ~F.coalesce(F.col(column), F.lit("")).isin(*values) if values else F.lit(True)


def dated(created_from: datetime) -> Column:
    return ~F.col("is_evergreen") & (F.col("created_at") >= stamp(created_from))


def dated_lines(subs: DataFrame, created_from: datetime, policy: Policy) -> DataFrame:
    """Newest version of every fixed-term line created since a date."""
    fixed = subs.filter(dated(created_from))
    return resolve_payer(
        latest_version(fixed, ["crm_line_id"], policy.newest_first()), policy.third_party_types
    )


def subscription_sync(
    subs: DataFrame,
    info: DataFrame,
    as_of: datetime,
    created_from: datetime,
    policy: Policy = Policy(),
    *,
    legal_name_from: str = "customer",
    hot: Hot = None,
) -> DataFrame:
    """Order lines with the billing details of whoever pays, synced in the window.

    ``legal_name_from='payer'`` takes the legal name by role as the addresses are.
    """
    hot = skewed(hot, "third_party_payer_id", "billing_account_id")
    live = info.filter(~F.col("is_deleted"))
    near = [("billing_account_id", live, "account_id"), ("third_party_payer_id", live, "account_id")]
    # The gate sees the newest version that competes, if it can be ordered, and live details only.
    telling = ~F.col("is_deleted") & dated(created_from) & orderable(policy)
    changed = with_changes(subs, "crm_line_id", near, as_of, policy.window, telling=telling)
    lines = dated_lines(changed, created_from, policy).filter(orderable(policy))
    joined = with_both_roles(lines, info, hot)
    recent = recency_gate(
        joined, ["synced_at", "customer_info_synced_at", "payer_info_synced_at"], as_of, policy.window
    )
    kinds = policy.third_party_types
    legal = by_role("legal_name", kinds) if legal_name_from == "payer" else F.col("customer_info_legal_name")
    return recent.select(
        *lines.columns,
        by_role("billing_address", kinds).alias("billing_address"),
        F.col("customer_info_shipping_address").alias("shipping_address"),
        legal.alias("legal_name"),
        by_role("tax_id", kinds).alias("tax_id"),
    )


def missing_subscription_fields(
    subs: DataFrame, info: DataFrame, start: datetime, end: datetime, policy: Policy = Policy(), *, hot: Hot = None
) -> DataFrame:
    """Orders of which any of billing address, shipping address and legal name is blank.

    Here the sync range is applied before the newest version is picked, and
    deleted billing details count.
    """
    hot = skewed(hot, "third_party_payer_id", "billing_account_id")
    recent = synced_between(subs.filter(~F.col("is_evergreen")), ["synced_at"], start, end)
    newest = latest_version(recent, ["crm_line_id"], policy.newest_first())
    lines = newest.filter(not_in("type", policy.free_types) & F.col("order_number").isNotNull())
    joined = with_both_roles(lines, info, hot, live_only=False)
    addressed = joined.select(
        "billing_account_id",
        "third_party_payer_id",
        "crm_account_id",
        "order_number",
        F.col("synced_at").alias("subscription_synced_at"),
        "payer_type",
        by_role("billing_address", REPORT_PAYER_TYPES).alias("billing_address"),
        F.col("customer_info_shipping_address").alias("shipping_address"),
        by_role("legal_name", REPORT_PAYER_TYPES).alias("legal_name"),
    )
    flags = blank_flags(
        [
            ("is_billing_missing", "billing_address"),
            ("is_shipping_missing", "shipping_address"),
            ("is_legal_missing", "legal_name"),
        ],
        "any",
    )
    return addressed.withColumns(flags).filter("is_missing").distinct()


def id_map(subs: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Billing accounts of each CRM account that has a product which is not free."""
    newest = latest_version(subs, ["crm_line_id"], policy.newest_first())
    paid = newest.filter(not_prefixed("product_code", policy.free_product_prefix))
    return distinct_rollup(
        paid,
        ["crm_account_id"],
        {"billing_account_ids": "billing_account_id"},
        {"count_billing_accounts": "billing_account_id"},
    )


def reseller_rollup(
    subs: DataFrame, info: DataFrame, policy: Policy = Policy(), *, hot: Hot = None
) -> DataFrame:
    """Per CRM account sold by resellers: how many, which, and the names on both sides."""
    hot = skewed(hot, "third_party_payer_id", "billing_account_id")
    sold = subs.filter(
        ~F.col("is_evergreen")
        & F.col("crm_line_id").isNotNull()
        & F.col("order_number").isNotNull()
        & not_prefixed("product_code", policy.free_product_prefix)
        & (F.col("payer_type") == "RESELLER")
    )
    newest = latest_version(sold, ["crm_line_id"], policy.newest_first())
    # Only distinct values are reported, so equal combinations go before the joins.
    pairs = newest.select("crm_account_id", "billing_account_id", "third_party_payer_id").distinct()
    names = info.select("account_id", "legal_name").distinct()
    resellers = names.toDF("reseller_id", "reseller_name")
    customers = names.toDF("customer_id", "customer_name")
    named = enrich(
        pairs,
        resellers,
        [("third_party_payer_id", "reseller_id")],
        hot=hot["third_party_payer_id"],
        spread=["crm_account_id", "billing_account_id"],
    )
    named = enrich(
        named,
        customers,
        [("billing_account_id", "customer_id")],
        hot=hot["billing_account_id"],
        spread=["crm_account_id", "third_party_payer_id"],
    )
    return distinct_rollup(
        named,
        ["crm_account_id"],
        {
            "billing_account_ids": "billing_account_id",
            "partner_ids": "third_party_payer_id",
            "reseller_names": "reseller_name",
            "customer_names": "customer_name",
        },
        {"reseller_count": "third_party_payer_id"},
    )


def with_erp_item(lines: DataFrame, item_map: DataFrame) -> DataFrame:
    items = item_map.select(F.col("product_code").alias("item_product"), "erp_item_id")
    return lookup_join(lines, items, [("product_code", "item_product")])


def order_backfill_rollup(
    subs: DataFrame,
    item_map: DataFrame,
    as_of: datetime,
    policy: Policy = Policy(),
    *,
    window: timedelta = BACKFILL_WINDOW,
    least: int = 1,
) -> DataFrame:
    """Per order: its subscriptions, accounts, products and ERP items as lists."""
    dated = subs.filter(
        ~F.col("is_evergreen")
        & (F.col("created_at") >= cutoff(as_of, window))
        & F.col("crm_line_id").isNotNull()
        & F.col("order_number").isNotNull()
    )
    newest = latest_version(dated, ["crm_line_id"], policy.newest_first())
    paid = newest.filter(not_prefixed("product_code", policy.free_product_prefix))
    mapped = with_erp_item(paid, item_map).withColumn("id_text", F.col("id").cast("string"))
    return distinct_rollup(
        mapped,
        ["order_number"],
        {
            "subscription_ids": "id_text",
            "billing_account_ids": "billing_account_id",
            "item_codes": "product_code",
            "erp_item_ids": "erp_item_id",
        },
        {"subscription_count": "id"},
    ).filter(F.col("subscription_count") >= least)


def order_backfill_detail(
    subs: DataFrame, item_map: DataFrame, created_from: datetime, created_to: datetime, policy: Policy = Policy()
) -> DataFrame:
    """Newest version of the lines created in a range, with item ids and US dates."""
    dated = created_in(subs, created_from, created_to).filter(
        ~F.col("is_evergreen") & F.col("crm_line_id").isNotNull() & F.col("order_number").isNotNull()
    )
    newest = latest_version(dated, ["crm_line_id"], policy.newest_first())
    paid = newest.filter(not_prefixed("product_code", policy.free_product_prefix))
    return with_erp_item(paid, item_map).select(
        "order_number",
        "id",
        "billing_account_id",
        "product_code",
        "erp_item_id",
        us_date("start_date_utc").alias("service_start_date"),
        us_date("end_date_utc").alias("service_end_date"),
        "amount",
        "crm_line_id",
        "contract_start_date",
        "contract_end_date",
    )


def join_coverage(
    subs: DataFrame,
    info: DataFrame,
    as_of: datetime,
    created_from: datetime,
    policy: Policy = Policy(),
    *,
    all_lines: bool = False,
    hot: Hot = None,
) -> DataFrame:
    """Which billing details each line finds in either role, and its newest sync against the cutoff.

    ``all_lines`` also shows lines that the feed leaves out for their type, order or product.
    """
    hot = skewed(hot, "third_party_payer_id", "billing_account_id")
    lines = dated_lines(subs, created_from, policy)
    joined = with_both_roles(lines if all_lines else lines.filter(orderable(policy)), info, hot)
    epoch = stamp("1970-01-01 00:00:00")
    newest = F.greatest(
        F.col("synced_at"),
        F.coalesce("customer_info_synced_at", epoch),
        F.coalesce("payer_info_synced_at", epoch),
    )
    return joined.select(
        "id",
        "billing_account_id",
        "payer_type",
        "third_party_payer_id",
        F.col("synced_at").alias("sub_synced_at"),
        F.col("payer_info_account_id").alias("payer_join_hit"),
        F.col("payer_info_synced_at").alias("payer_synced_at"),
        F.col("customer_info_account_id").alias("customer_join_hit"),
        F.col("customer_info_synced_at").alias("customer_synced_at"),
        newest.alias("latest_any_sync"),
        cutoff(as_of, policy.window).alias("sync_cutoff"),
        (newest >= cutoff(as_of, policy.window)).alias("inside_window"),
    )


def zero_total_orders(
    subs: DataFrame, created_from: datetime, policy: Policy = Policy(), *, hot: Hot = None
) -> DataFrame:
    """Orders whose amounts cancel out, with their lines and types in id order.

    Only lines of the few orders found are listed.
    """
    hot = skewed(hot, "order_number")
    lines = dated_lines(subs, created_from, policy).filter(orderable(policy))
    lines = lines.select("order_number", "billing_account_id", "id", "type", "amount", "crm_line_id")
    # A missing account is a group of its own.
    keyed = lines.withColumn("_account", F.coalesce(F.concat(F.lit("="), "billing_account_id"), F.lit("")))
    totalled = group_totals(
        keyed,
        ["order_number", "_account"],
        {"total": F.sum("amount"), "line_count": F.count("*")},
        hot=hot["order_number"],
        spread=["crm_line_id"],
    )
    return (
        totalled.filter(F.col("total") == 0)
        .groupBy("order_number", "_account")
        .agg(
            F.first("billing_account_id").alias("billing_account_id"),
            F.first("line_count").alias("line_count"),
            F.first("total").cast("decimal(18,4)").alias("total_amount"),
            F.expr("listagg(CAST(id AS STRING), ',') WITHIN GROUP (ORDER BY id)").alias("subscription_ids"),
            F.expr("listagg(type, ',') WITHIN GROUP (ORDER BY id)").alias("types"),
        )
        .drop("_account")
    )


def stage_counts(
    subs: DataFrame, as_of: datetime, created_from: datetime, policy: Policy = Policy()
) -> DataFrame:
    """Rows left after each stage of the subscription feed's own table, in order.

    One pass: the versions of a line are counted and its newest one found in the same aggregate.
    """
    dated = ~F.col("is_deleted") & ~F.col("is_evergreen") & (F.col("created_at") >= stamp(created_from))
    recent = F.coalesce(F.col("synced_at") >= cutoff(as_of, policy.window), F.lit(False))
    state = F.struct(F.coalesce(orderable(policy), F.lit(False)).alias("keep"), recent.alias("recent"))
    lines = subs.groupBy("crm_line_id").agg(
        F.count("*").alias("raw"),
        F.count_if(~F.col("is_deleted")).alias("live"),
        F.count_if(dated).alias("dated"),
        F.max_by(state, F.when(dated, F.struct(*policy.newest_by()))).alias("newest"),
    )
    keep = F.col("newest.keep")
    return counted_stages(
        lines,
        {
            "1_raw": F.coalesce(F.sum("raw"), F.lit(0)),
            "2_live": F.coalesce(F.sum("live"), F.lit(0)),
            "3_fixed_term_since": F.coalesce(F.sum("dated"), F.lit(0)),
            "4_newest": F.count("newest"),
            "5_orderable": F.count_if(keep),
            "6_recent": F.count_if(keep & F.col("newest.recent")),
        },
    )

