"""Payment profiles that lack their ERP customer, and checks of how ids line up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from brasstally.functions.address import json_text
from brasstally.operators.latest import latest_version


def payment_id_backfill(
    profiles: DataFrame,
    accounts: DataFrame,
    info: DataFrame,
    orgs: DataFrame,
    customers: DataFrame,
    *,
    main_line: str,
    product_line: str,
    link_base: str,
    id_key: str = "erp_customer_id",
) -> DataFrame:
    """Profiles whose metadata has no ERP customer id although the ERP has one for the account.

    Accounts reach profiles by two ways, the main line's and the product line's.
    A profile reached more than once keeps a way that is found in the ERP.
    """
    main = accounts.filter(~F.col("is_deleted")).select(
        F.col("id").alias("billing_account_id"), "payment_profile_id", F.lit(main_line).alias("product_source")
    )
    members = orgs.filter(~F.col("is_deleted")).select(F.col("billing_info_id").alias("id")).distinct()
    product = latest_version(
        info.join(members, "id", "left_semi"), ["id"], [F.desc_nulls_last("payment_profile_id")]
    ).select(
        F.col("id").alias("billing_account_id"), "payment_profile_id", F.lit(product_line).alias("product_source")
    )
    # A way without a profile can never be reported, and all such ways share one null key.
    ways = main.unionByName(product).filter(F.col("payment_profile_id").isNotNull())
    known = customers.filter(~F.col("is_deleted")).select(
        F.col("billing_account_id").alias("erp_account"), F.col("id").cast("string").alias("erp_customer_id")
    )
    found = ways.join(known, F.col("billing_account_id") == F.col("erp_account"), "left")
    one = latest_version(
        found,
        ["payment_profile_id"],
        [F.asc_nulls_last("erp_customer_id"), F.asc("product_source"), F.asc("billing_account_id")],
        deleted=None,
    )
    unlinked = profiles.filter(~F.col("is_deleted") & json_text("metadata", id_key).isNull())
    return (
        unlinked.select(F.col("id").alias("profile_id"))
        .join(one.filter(F.col("erp_customer_id").isNotNull()), F.col("profile_id") == F.col("payment_profile_id"))
        .select(
            F.col("profile_id").alias("id"),
            "erp_customer_id",
            F.concat(F.lit(link_base), "erp_customer_id").alias("erp_customer_link"),
            "product_source",
            "billing_account_id",
        )
    )


def id_match_debug(accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """Accounts whose id is known to the ERP, with the customer found."""
    known = customers.filter(~F.col("is_deleted")).select(
        F.col("billing_account_id").alias("erp_account"),
        F.col("id").cast("string").alias("erp_customer_id"),
        F.col("name").alias("erp_customer_name"),
    )
    live = accounts.filter(~F.col("is_deleted")).select(F.col("id").alias("billing_account_id"), "payment_profile_id")
    return live.join(known, F.col("billing_account_id") == F.col("erp_account")).drop("erp_account")


def key_profile(
    facts: DataFrame, fact_key: str, members: DataFrame, member_key: str, *, date: str | None = None
) -> DataFrame:
    """Both sides of a join key: rows, distinct keys, smallest and largest, type, and how many meet.

    Facts are counted per key before the two sides are joined.
    """
    per_key = facts.groupBy(F.col(fact_key).alias("fact_key")).agg(F.count("*").alias("fact_rows"))
    keys = members.filter(F.col(member_key).isNotNull()).groupBy(F.col(member_key).alias("member_key")).agg(
        F.count("*").alias("member_rows")
    )

    def side(name: str, df: DataFrame, key: str, rows: str) -> DataFrame:
        return df.agg(
            F.lit(name).alias("side"),
            F.coalesce(F.sum(rows), F.lit(0)).alias("records"),
            F.count(key).alias("distinct_keys"),
            F.min(F.col(key).cast("string")).alias("smallest_key"),
            F.max(F.col(key).cast("string")).alias("largest_key"),
            F.lit(df.schema[key].dataType.simpleString()).alias("key_type"),
        )

    both = per_key.join(keys, F.col("fact_key") == F.col("member_key")).withColumn(
        "joined_rows", F.col("fact_rows") * F.col("member_rows")
    )
    return (
        side("facts", per_key, "fact_key", "fact_rows")
        .unionByName(side("members", keys, "member_key", "member_rows"))
        .unionByName(side("overlap", both, "fact_key", "joined_rows"))
    )


def date_range(facts: DataFrame, column: str, condition: Column) -> DataFrame:
    """How many rows meet a condition and from when to when they run."""
    return facts.filter(condition).agg(
        F.count("*").alias("records"), F.min(column).alias("first_at"), F.max(column).alias("last_at")
    )


def key_sample(facts: DataFrame, fact_key: str, members: DataFrame, member_key: str, *, rows: int = 10) -> DataFrame:
    """The first distinct keys of each side with their types, to compare formats by eye."""

    def first(name: str, df: DataFrame, key: str) -> DataFrame:
        keys = df.select(F.col(key).cast("string").alias("key")).filter("key IS NOT NULL").distinct()
        return keys.orderBy("key").limit(rows).select(
            F.lit(name).alias("side"), "key", F.lit(df.schema[key].dataType.simpleString()).alias("key_type")
        )

    return first("facts", facts, fact_key).unionByName(first("members", members, member_key))
