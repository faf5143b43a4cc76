"""Account rows to customer rows ready for the ERP."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from brasstally.functions.address import flatten_address, parse_json_map
from brasstally.functions.text import is_empty, strip
from brasstally.operators.rules import missing_fields, open_judgement, refuse, required_fields
from brasstally.plans.orders import missing_order_fields
from brasstally.plans.validation import with_partner
from brasstally.result import Result

# Contract kinds.
SALES_ASSISTED, PREPAID, SELF_SERVICE = "sales_assisted", "Prepaid", "Self-Service"

# Payer spellings these rules look for; they are compared with case.
EMAIL_PAYERS = ("Customer", "Reseller")
PARTNER_PAYERS = ("MARKETPLACE", "RESELLER_MARKETPLACE")


# The refusal that ends a run.
FATAL = "fatal_missing_fields"


class MissingBillingFields(ValueError):
    """A readable address lacks a field without which no customer may be written."""


def prepare_accounts(
    accounts: DataFrame,
    partner_names: DataFrame,
    *,
    countries: Mapping[str, str] | None = None,
    states: Mapping[str, str] | None = None,
) -> Result:
    """Customer rows with flat addresses, contract kind and partner; refused without the
    required fields, a mapped reseller or the e-mails their payer kind needs."""
    account = F.when(
        ~is_empty("billing_account_id"),
        F.concat(F.lit(" (account "), "billing_account_id", F.lit(")")),
    ).otherwise("")
    kind = F.when(~is_empty("type"), F.concat(F.lit(" (type "), "type", F.lit(")"))).otherwise("")

    def message(names: Column) -> Column:
        return F.concat(F.lit("lacks "), names, account, kind)

    checked = required_fields(open_judgement(accounts), missing_order_fields(), message)
    flat = flatten_address(checked, "billing_address", "billing", countries=countries, states=states)
    flat = flatten_address(flat, "shipping_address", "shipping", countries=countries, states=states)
    flat = flat.drop("billing_address", "shipping_address").withColumnRenamed(
        "billing_attention", "billaddress_attention"
    )
    contract = F.when(F.lower("contract_type") == SALES_ASSISTED, PREPAID).otherwise(SELF_SERVICE)
    named = with_partner(flat, partner_names).withColumns(
        {
            "sales_rep": F.lit(""),
            "contract_type": F.when(is_empty("contract_type"), F.col("contract_type")).otherwise(contract),
        }
    )
    gated = refuse(
        named,
        (F.col("payer_type") == "RESELLER") & F.col("partner_name").isNull(),
        "invalid_reseller_mapping",
        F.concat(
            F.lit("no partner is known for payer '"),
            F.coalesce(strip("third_party_payer_id"), F.lit("")),
            F.lit("'."),
        ),
    )
    lacking = F.concat_ws(
        "; ",
        F.when(is_empty("billing_email"), F.lit("billing_email")),
        F.when(is_empty("shipping_email"), F.lit("shipping_email")),
    )
    mailed = refuse(
        gated,
        F.col("payer_type").isin(*EMAIL_PAYERS) & (lacking != ""),
        "missing_email",
        F.concat(F.lit("this payer needs mail: "), lacking),
    )
    partner = F.when(F.col("third_party_payer_id") == strip("third_party_payer_id"), F.col("partner_name"))
    flag = partner.isNotNull() & F.coalesce(F.col("payer_type").isin(*PARTNER_PAYERS), F.lit(False))
    return Result(
        mailed.withColumns(
            {"partner": partner, "is_partner": F.when(flag, "true").otherwise("false")}
        ).drop("partner_name")
    )


def prepare_product_accounts(accounts: DataFrame) -> Result:
    """Customer rows of the product line: e-mail, country and zip from the billing address.

    No address, an unreadable one or one that lacks one of the three refuses the row.
    Refusals of the last kind end a run: ``result.stop_on(FATAL)`` ends the job that writes
    the rows, before its commit; ``stop_on_missing`` looks at rows that are written already.
    """
    parsed = parse_json_map("billing_address")
    taken = {"billing_email": "email", "billing_country": "country", "billing_zip": "postalCode"}
    read = open_judgement(accounts).withColumn("_address", parsed)
    read = read.withColumns({c: F.nullif(F.col("_address")[k], F.lit("")) for c, k in taken.items()})
    account = F.when(
        ~is_empty("billing_account_id"),
        F.concat(F.lit(" (account "), "billing_account_id", F.lit(")")),
    ).otherwise("")
    checked = refuse(
        read,
        is_empty("billing_address"),
        "missing_fields",
        F.concat(F.lit("lacks billing_address"), account),
    )
    checked = refuse(
        checked,
        F.col("_address").isNull(),
        "invalid_billing_address",
        F.concat(F.lit("billing_address is no JSON object"), account),
    )
    names = missing_fields([(c, F.col(c).isNull()) for c in taken])
    fatal = F.concat(F.lit("billing_address holds none of ["), names, F.lit("]"), account)
    judged = refuse(checked, names != "", FATAL, fatal)
    legal = F.when(is_empty("legal_name"), F.col("billing_email")).otherwise(F.col("legal_name"))
    return Result(judged.withColumn("legal_name", legal).drop("_address"))


def stop_on_missing(judged: DataFrame) -> None:
    """Raise if written product accounts hold a readable address without the fields it must have."""
    bad = judged.filter(F.col("reject_code") == FATAL).select("reject_message").head(1)
    if bad:
        raise MissingBillingFields(bad[0]["reject_message"])
