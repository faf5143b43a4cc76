"""Contacts and reminder recipients of sales reps, as a set of changes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from brasstally.functions.dates import stamp
from brasstally.functions.text import norm_email

# Actions of the plan.
CREATE, FLAG = "create_contact", "flag_contact"
CREATE_RECIPIENT, UPDATE_RECIPIENT, DEACTIVATE_RECIPIENT = (
    "create_recipient",
    "update_recipient",
    "deactivate_recipient",
)
NO_RECIPIENT = "none"


def contact_upsert_plan(
    customers: DataFrame,
    contacts: DataFrame,
    recipients: DataFrame,
    *,
    level: int,
    self_service_email: str,
    as_of: datetime | None = None,
) -> DataFrame:
    """For each active customer with a rep e-mail: what to do with the rep's contact and recipient.

    Contacts and recipients are cut to one per key by aggregation before the joins.
    An existing recipient of a self-service rep is deactivated. Every customer in the
    plan is stamped: with ``as_of`` as its update time, and its last error cleared.
    """
    active = customers.filter((F.col("inactive") == "F") & (norm_email("rep_email") != "")).select(
        "customer_id", norm_email("rep_email").alias("rep_email")
    )
    known = contacts.groupBy(
        F.col("customer_id").alias("contact_customer"), norm_email("email").alias("contact_email")
    ).agg(F.max("contact_id").alias("contact_id"))
    listed = (
        recipients.filter(F.col("level") == level)
        .groupBy(F.col("customer_id").alias("recipient_customer"))
        .agg(F.min("recipient_id").alias("recipient_id"))
    )
    joined = active.join(
        known,
        (F.col("customer_id") == F.col("contact_customer")) & (F.col("rep_email") == F.col("contact_email")),
        "left",
    ).join(listed, F.col("customer_id") == F.col("recipient_customer"), "left")
    usable = F.col("rep_email") != self_service_email.strip().lower()
    exists = F.col("recipient_id").isNotNull()
    return joined.select(
        "customer_id",
        "rep_email",
        "contact_id",
        F.when(F.col("contact_id").isNull(), CREATE).otherwise(FLAG).alias("contact_action"),
        "recipient_id",
        F.when(usable & exists, UPDATE_RECIPIENT)
        .when(usable, CREATE_RECIPIENT)
        .when(exists, DEACTIVATE_RECIPIENT)
        .otherwise(NO_RECIPIENT)
        .alias("recipient_action"),
        F.when(usable, F.lit(level)).alias("recipient_level"),
        *([stamp(as_of).alias("customer_updated_at"), F.lit("").alias("customer_error")] if as_of else []),
    )
