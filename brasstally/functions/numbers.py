"""Amounts, rates and invoice identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from brasstally.functions.text import _col, is_blank, strip

MONEY = "decimal(18,2)"
RATE = "decimal(18,4)"
AMOUNT = "decimal(38,9)"

# Transaction kinds; amounts from zero up to one are billed to nobody.
INVOICE, CREDIT_MEMO, NO_TRANSACTION = "Invoice", "Credit Memo", "None"

# Invoice kinds read from the item text.
PREPAID, SELF_SERVICE, OVERAGE = "Prepaid", "Self Service", "Overage"


def safe_number(c: Column | str) -> Column:
    """Decimal from text with thousands commas: blank is 0, text that is no number is null."""
    bare = strip(F.replace(_col(c).cast("string"), F.lit(","), F.lit("")))
    return F.when(bare == "", F.lit(0).cast(AMOUNT)).otherwise(bare.try_cast(AMOUNT))


def number_in(df: DataFrame, column: str) -> Column:
    """``safe_number`` of a column of ``df``; one that holds exact numbers already is not written out and parsed."""
    exact = isinstance(df.schema[column].dataType, (T.DecimalType, T.IntegralType))
    return F.col(column).try_cast(AMOUNT) if exact else safe_number(column)


def rate(amount: Column | str, quantity: Column | str) -> Column:
    """Unit price at four places; null for no quantity, quantity zero or amounts beyond the type."""
    ratio = F.try_divide(_col(amount).try_cast("decimal(18,4)"), _col(quantity).try_cast("decimal(18,4)"))
    return ratio.try_cast(RATE)


def classify_transaction(amount: Column | str) -> Column:
    amount = _col(amount)
    return F.when(amount >= 1, INVOICE).when(amount < 0, CREDIT_MEMO).otherwise(NO_TRANSACTION)


def external_id(
    kind: Column | str, customer: Column | str, month_end: Column | str, invoice_prefix: str, memo_prefix: str
) -> Column:
    """Prefix, customer and yyyyMM: the same row gets the same id on every run."""
    prefix = F.when(_col(kind) == CREDIT_MEMO, memo_prefix).otherwise(invoice_prefix)
    return F.concat(prefix, _col(customer).cast("string"), F.date_format(_col(month_end), "yyyyMM"))


def clean_amount(c: Column | str) -> Column:
    """'0.00' for a missing amount or a bare '.00', the text as it stands otherwise."""
    return F.when(is_blank(c) | (strip(c) == ".00"), "0.00").otherwise(_col(c))


def invoice_type(item: Column | str) -> Column:
    text = F.lower(F.coalesce(_col(item), F.lit("")))
    return (
        F.when(text.contains("prepaid") | text.contains("services"), PREPAID)
        .when(text.contains("evergreen"), SELF_SERVICE)
        .otherwise(OVERAGE)
    )
