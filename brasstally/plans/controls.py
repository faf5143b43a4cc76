"""Control totals and row cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from brasstally.functions.numbers import clean_amount, invoice_type, number_in, safe_number
from brasstally.functions.text import hash_total, inactive_flag, is_blank, strip
from brasstally.operators.rules import open_judgement, refuse

# The amounts of a financial line that are cleaned.
FINANCIAL_AMOUNTS = (
    "amount",
    "amount_remaining",
    "amount_paid",
    "applied_paid",
    "applied_remaining",
    "applied_amount",
    "linked_amount",
)


def control_aggregates(amount: str = "amount", key: str = "billing_account_id") -> dict[str, Column]:
    """The control sums as bare aggregates, for a job that observes them while it writes the rows."""
    valid, number = ~is_blank(key), safe_number(amount).try_cast("decimal(24,4)")
    return {
        "record_count": F.count(F.lit(1)),
        "valid_records": F.count_if(valid),
        "invalid_records": F.count_if(~valid),
        "bad_amounts": F.count_if(valid & number.isNull() & F.col(amount).isNotNull()),
        "total": F.coalesce(F.sum(F.when(valid, number)), F.lit(0)).cast("decimal(28,4)"),
        "hash_total": F.coalesce(F.sum(F.when(valid, hash_total(strip(key)))), F.lit(0)).cast("long"),
    }


def control_totals(df: DataFrame, amount: str = "amount", key: str = "billing_account_id") -> DataFrame:
    """One row: records, valid and invalid ones, total, id hash total, average of the valid.

    An amount that is no number, or too large for one, counts as 0 and is counted in ``bad_amounts``.
    Rows are summed per id first (map-side), so that each id is hashed once, not once a row.
    """
    number = number_in(df, amount).try_cast("decimal(24,4)")
    per_id = df.groupBy(strip(key).alias("id")).agg(
        F.count("*").alias("n"),
        F.count_if(number.isNull() & F.col(amount).isNotNull()).alias("bad"),
        F.sum(number).cast("decimal(28,4)").alias("total"),
    )
    valid = ~is_blank("id")
    sums = per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("record_count"),
        F.coalesce(F.sum(F.when(valid, F.col("n"))), F.lit(0)).alias("valid_records"),
        F.coalesce(F.sum(F.when(~valid, F.col("n"))), F.lit(0)).alias("invalid_records"),
        F.coalesce(F.sum(F.when(valid, F.col("bad"))), F.lit(0)).alias("bad_amounts"),
        F.coalesce(F.sum(F.when(valid, F.col("total"))), F.lit(0)).cast("decimal(28,4)").alias("total"),
        F.coalesce(F.sum(F.when(valid, F.col("n") * hash_total("id"))), F.lit(0)).cast("long").alias("hash_total"),
    )
    average = F.coalesce(F.try_divide("total", F.col("valid_records").cast("decimal(20,0)")), F.lit(0))
    return sums.select(
        "record_count",
        "valid_records",
        "invalid_records",
        "bad_amounts",
        F.round("total", 2).cast("decimal(28,2)").alias("total_amount"),
        "hash_total",
        F.round(average, 2).cast("decimal(28,2)").alias("average_amount"),
    )


def stamp_control_totals(df: DataFrame, amount: str = "amount", key: str = "billing_account_id") -> DataFrame:
    """Every row; valid ones carry the totals, the others an ``invalid_record`` refusal.

    The totals are one row and reach the rows as a scalar subquery.
    """
    totals = control_totals(df, amount, key)
    fields = {
        "control_record_count": "record_count",
        "control_valid_records": "valid_records",
        "control_total_amount": "total_amount",
        "control_hash_total": "hash_total",
        "control_average_amount": "average_amount",
    }
    one = totals.select(F.struct(*[F.col(c).alias(n) for n, c in fields.items()]).alias("totals")).scalar()
    valid = ~is_blank(key)
    stamped = df.withColumn("_totals", one).withColumns(
        {name: F.when(valid, F.col("_totals")[name]) for name in fields}
    )
    message = F.concat(
        F.lit("blank key ("), F.nvl(F.nullif(strip(key), F.lit("")), F.lit("none")), F.lit(")")
    )
    return refuse(open_judgement(stamped.drop("_totals")), ~valid, "invalid_record", message)


def clean_financial_lines(df: DataFrame, amounts: Sequence[str] = FINANCIAL_AMOUNTS) -> DataFrame:
    """Missing amounts as '0.00', and an invoice type on invoices."""
    kind = F.when(F.lower("record_type") == "invoice", invoice_type("item"))
    cleaned = {c: clean_amount(c) for c in amounts if c in df.columns}
    return df.withColumns({**cleaned, "invoice_type": kind})


def with_inactive_flag(df: DataFrame, active: str = "active_status") -> DataFrame:
    return df.withColumn("inactive", inactive_flag(active))
