"""Revenue records to invoice and credit-memo lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from brasstally.functions.dates import month_start
from brasstally.functions.numbers import MONEY, classify_transaction, external_id, rate
from brasstally.functions.text import is_empty, merge_emails
from brasstally.operators.latest import latest_version
from brasstally.operators.lookups import lookup_join
from brasstally.operators.rules import open_judgement, refuse, required_fields
from brasstally.operators.skew import number_rows
from brasstally.result import Result
from brasstally.sources.staging import staged

# Usage kinds are told by words in the revenue type.
OVERAGE_WORD, SELF_WORD = "OVERAGE", "SELF"
SELF_SERVICE_TYPE = "SELF_SERVICE"

# Payment terms.
AUTOPAY, NET_30 = "Autopay", "Net 30"

# Fields an invoice line cannot be sent without.
INVOICE_FIELDS = (
    "external_id",
    "erp_customer_id",
    "item_id",
    "to_be_emailed",
    "transaction_type",
    "erp_amount",
    "erp_quantity",
)


def month_rollup(revenue: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Credits and amounts per key and month: summed map-side, so a heavy account costs nothing extra."""
    return (
        revenue.withColumn("revenue_month_start", month_start("revenue_date_utc"))
        .groupBy(*keys, "revenue_month_start")
        .agg(
            F.sum("credits_used").cast(MONEY).alias("credits_used"),
            F.sum(F.col("amount").cast("decimal(28,9)")).cast("decimal(28,9)").alias("revenue_amount"),
        )
        .withColumn("revenue_month_end", F.last_day("revenue_month_start"))
    )


def priced(df: DataFrame) -> DataFrame:
    """Quantity (credits, or the amount without any), rounded amount, unsigned forms, rate and kind."""
    amount = F.round("revenue_amount", 2).cast(MONEY)
    return (
        df.withColumns({"amount": amount, "quantity": F.coalesce(F.col("credits_used"), amount).cast(MONEY)})
        .withColumns(
            {
                "erp_quantity": F.abs("quantity"),
                "erp_amount": F.abs("amount"),
                "rate": rate("amount", "quantity"),
                "transaction_type": classify_transaction("amount"),
            }
        )
        .drop("revenue_amount", "credits_used")
    )


def numbered(df: DataFrame, invoice_prefix: str, memo_prefix: str, order: Sequence[str]) -> Result:
    """Adds the external id and the line number; rows without an ERP customer are refused and have no number.

    The lines are written once (``staged``), so that numbering and its counts evaluate what is behind them once.
    """
    named = df.withColumn(
        "external_id",
        external_id("transaction_type", "erp_customer_id", "revenue_month_end", invoice_prefix, memo_prefix),
    )
    # Rows of no invoice are a group of their own, and a kind is never null in a key.
    keyed = staged(named, "invoice-lines").withColumns(
        {"_invoice": F.coalesce(F.concat(F.lit("="), "external_id"), F.lit("")), "_kind": F.coalesce("transaction_type", F.lit(""))}
    )
    lines = number_rows(keyed, ["_invoice", "_kind"], order).drop("_invoice", "_kind")
    unknown = F.col("external_id").isNull()
    judged = refuse(
        open_judgement(lines.withColumn("line_number", F.when(~unknown, F.col("line_number")))),
        unknown,
        "missing_erp_customer",
        F.concat(F.lit("account without customer: "), F.coalesce("billing_account_id", F.lit(""))),
    )
    return Result(judged)


def usage_invoices(
    revenue: DataFrame,
    accounts: DataFrame,
    customers: DataFrame,
    partners: DataFrame,
    items: DataFrame,
    *,
    invoice_prefix: str,
    memo_prefix: str,
    overage_usage: int,
    self_usage: int,
    account_key: str = "id",
) -> Result:
    """Overage and self-service revenue per account and month as invoice lines.

    The item is found by tier and usage kind, as the item table numbers the two; a
    partner counts only for self-service. The revenue type is compared in upper case throughout.
    """
    kind = F.upper("type")
    wanted = revenue.filter(kind.contains(OVERAGE_WORD) | kind.contains(SELF_WORD))
    monthly = month_rollup(
        wanted.withColumn("revenue_type", F.col("type")),
        ["billing_account_id", "crm_account_id", "account_tier", "revenue_type", "status"],
    )
    # One row per key of every table joined below: none drops or doubles revenue.
    profile = [F.asc_nulls_last("payment_profile_id")]
    billed = latest_version(accounts, [account_key], profile, deleted=None).select(
        F.col(account_key).alias("account_key"), "payment_profile_id"
    )
    buyers = latest_version(customers, ["billing_account_id"], [F.asc("id")]).select(
        F.col("billing_account_id").alias("buyer_account"),
        F.col("id").cast("string").alias("erp_customer_id"),
        F.col("name").alias("erp_customer_name"),
        F.col("partner_id").alias("buyer_partner"),
        merge_emails("email", "alt_email").alias("to_be_emailed"),
    )
    sellers = latest_version(partners, ["id"], [F.asc_nulls_last("third_party_payer")]).select(
        F.col("id").alias("seller_key"), F.col("id").alias("seller_id"), "third_party_payer"
    )
    tiers = latest_version(items, ["account_tier", "usage_type"], [F.asc("id")], deleted=None).select(
        F.col("account_tier").alias("item_tier"), F.col("usage_type").alias("item_usage"), F.col("id").alias("item_id")
    )
    overage = F.upper("revenue_type").contains(OVERAGE_WORD)
    bought = (
        monthly.join(billed, F.col("billing_account_id") == F.col("account_key"), "inner")
        .join(buyers, F.col("billing_account_id") == F.col("buyer_account"), "left")
        .withColumn("usage", F.when(overage, overage_usage).otherwise(self_usage).cast("long"))
    )
    sold = lookup_join(bought, sellers, [("buyer_partner", "seller_key")])
    joined = lookup_join(sold, tiers, [("account_tier", "item_tier"), ("usage", "item_usage")])
    third_party = F.col("seller_id").isNotNull() & ~overage
    lines = priced(
        joined.withColumns(
            {
                "is_third_party_payer": third_party,
                "tax_override": third_party,
                "partner_id": F.when(~overage, F.col("seller_id")),
                "payment_term": F.when(
                    (F.upper("revenue_type") == SELF_SERVICE_TYPE) & ~third_party, AUTOPAY
                ).otherwise(NET_30),
            }
        ).drop("account_key", "buyer_account", "buyer_partner", "seller_id", "usage")
    )
    order = ["billing_account_id", "crm_account_id", "account_tier", "revenue_type", "status", "item_id"]
    return numbered(lines, invoice_prefix, memo_prefix, order)


def active_customers(customers: DataFrame, entity_status: int) -> DataFrame:
    """Live companies in customer state, one per billing account: the lowest id."""
    active = customers.filter(
        ~F.col("is_deleted")
        & (F.col("inactive") == "F")
        & (F.col("entity_status") == entity_status)
        & (F.col("is_person") == "F")
    )
    return latest_version(active, ["billing_account_id"], [F.asc("id")], deleted=None)


def product_invoices(
    revenue: DataFrame,
    info: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    *,
    product_type: str,
    item_code: str,
    invoice_prefix: str,
    memo_prefix: str,
    billing_sync: str,
    entity_status: int,
    strict_one_row: bool = False,
) -> Result:
    """Revenue of one product line per account and month as autopay invoice lines of one item.

    Customers and billing details are cut to one row per account before they are
    joined, so no revenue is dropped or doubled. ``strict_one_row`` keeps a single
    row per account and month instead, whatever types and states it has.
    """
    wanted = revenue.filter(~F.col("is_deleted") & (F.col("product_type") == product_type))
    monthly = month_rollup(
        wanted.withColumn("revenue_type", F.col("type")),
        ["billing_account_id", "revenue_type", "product_type", "status"],
    )
    details = latest_version(
        info, ["id"], [F.desc_nulls_last("updated_at"), F.desc_nulls_last("payment_profile_id")]
    ).select(F.col("id").alias("info_id"), "payment_profile_id")
    buyers = active_customers(customers, entity_status).select(
        F.col("billing_account_id").alias("buyer_account"),
        F.col("id").cast("string").alias("erp_customer_id"),
        F.col("name").alias("erp_customer_name"),
        merge_emails("email", "alt_email").alias("to_be_emailed"),
    )
    item = items.filter((F.col("item_code") == item_code) & ~F.col("is_deleted")).agg(F.min("id").alias("item_id"))
    joined = monthly.join(details, F.col("billing_account_id") == F.col("info_id"), "left").join(
        buyers, F.col("billing_account_id") == F.col("buyer_account"), "left"
    )
    lines = priced(joined.drop("info_id", "buyer_account").withColumn("item_id", item.scalar()))
    lines = lines.withColumns({"payment_term": F.lit(AUTOPAY), "billing_sync": F.lit(billing_sync)})
    order = ["billing_account_id", "revenue_type", "status"]
    if strict_one_row:
        first = [F.asc_nulls_first("revenue_type"), F.asc_nulls_first("status")]
        lines = latest_version(lines, ["billing_account_id", "revenue_month_start"], first, deleted=None)
    return numbered(lines, invoice_prefix, memo_prefix, order)


def totals_by_type(lines: DataFrame) -> DataFrame:
    """Lines and amounts per month and transaction kind."""
    return lines.groupBy("revenue_month_start", "transaction_type").agg(
        F.count("*").alias("line_count"),
        F.sum("erp_amount").cast(MONEY).alias("erp_amount"),
        F.sum("amount").cast(MONEY).alias("amount"),
    )


def check_invoice_lines(lines: DataFrame, fields: Sequence[str] = INVOICE_FIELDS) -> Result:
    """Refuse lines lacking a field the ERP needs; blanks of spaces count as values."""
    missing: list[tuple[str, Column]] = [(f, is_empty(F.col(f).cast("string"))) for f in fields]

    def message(names: Column) -> Column:
        account = F.coalesce("billing_account_id", F.lit(""))
        return F.concat(F.lit("line lacks ["), names, F.lit("] for account "), account)

    return Result(required_fields(open_judgement(lines), missing, message))
