"""Stand-in billing tables over the given tables.

Each keeps every row of what it reads. Blanks, strays and broken values are made
by rules on the columns, so that each branch of an operator is taken.
``workload/sql_views.py`` states the same tables in SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brasstally.sources.registry import Sources

AS_OF = datetime(2001, 8, 1)
CREATED_FROM = datetime(1996, 1, 1)
DEALT = {"lineitem": "l_orderkey", "events": "event_id"}
EVENTS_AS_OF = datetime(2024, 1, 30)


def text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def null_when(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def ntz(value: str) -> Column:
    return F.to_timestamp_ntz(F.lit(value))


def plus_days(moment: Column, days: Column) -> Column:
    return moment + F.make_dt_interval(days.cast("int"))


def once(method: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
    """Build a table's frame only once for each folder object."""

    @wraps(method)
    def made(self: Views) -> DataFrame:
        if method.__name__ not in self._made:
            self._made[method.__name__] = method(self)
        return self._made[method.__name__]

    return made


class Views:
    """The stand-in tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.sources = Sources(spark, root=folder)
        self._made: dict[str, DataFrame] = {}

    def given(self, name: str) -> DataFrame:
        """A given table. A small one that would be read by fewer tasks than there are cores is dealt over
        them by a key. A larger one has splits enough: dealt over the cores, its parts would grow with it."""
        if name not in self._made:
            table, cores = self.sources.table(name), self.spark.sparkContext.defaultParallelism
            if name in DEALT and table.rdd.getNumPartitions() < cores:
                table = table.repartition(cores, DEALT[name])
            self._made[name] = table
        return self._made[name]

    @once
    def sub_versions(self) -> DataFrame:
        # Parts first: where neither table is small, the rows are moved by part while they are narrow,
        # and with what is asked of a line's tax, discount and flag instead of these.
        lines = self.given("lineitem").select(
            *["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"],
            (F.col("l_tax") == 0).alias("is_evergreen"),
            (F.col("l_discount") == 0).alias("is_deleted"),
            (F.col("l_returnflag") == "R").alias("returned"),
        )
        rows = (
            lines
            .join(self.given("part"), F.col("l_partkey") == F.col("p_partkey"))
            .join(self.given("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        )
        line = F.col("l_orderkey") * 10 + F.col("l_linenumber")
        supplier = F.col("l_suppkey")
        sign = F.when(F.col("l_orderkey") % 50 == 0, 0).when(F.col("returned"), -1).otherwise(1)
        kind = supplier % 4
        return rows.select(
            line.alias("id"),
            text(line).alias("crm_line_id"),
            F.concat(F.lit("CRM"), text(F.floor(F.col("o_custkey") / 3))).alias("crm_account_id"),
            null_when(F.col("o_orderkey") % 97 == 0, text("o_orderkey")).alias("order_number"),
            null_when(F.col("o_custkey") % 101 == 0, text("o_custkey")).alias("billing_account_id"),
            F.datediff(F.col("l_shipdate"), F.lit("1970-01-01").cast("date")).cast("long").alias("version"),
            F.col("l_partkey").alias("tie_part"),
            supplier.alias("tie_supplier"),
            F.when(F.col("o_orderstatus") == "F", "FREE")
            .when(F.col("o_orderstatus") == "P", "CROSS_SELL")
            .otherwise("STANDARD")
            .alias("type"),
            F.when(F.col("p_type") == "PROMO", "Free_PROMO").otherwise(F.col("p_type")).alias("product_code"),
            F.when(supplier % 8 == 5, "reseller")
            .when(kind == 0, "CUSTOMER")
            .when(kind == 1, "RESELLER")
            .when(kind == 2, "MARKETPLACE")
            .otherwise("RESELLER_MARKETPLACE")
            .alias("payer_type"),
            null_when((kind == 0) | (supplier % 10 == 3), text(supplier)).alias("third_party_payer_id"),
            (F.col("l_extendedprice").cast("decimal(18,2)") * sign).cast("decimal(18,2)").alias("amount"),
            F.col("l_quantity").cast("decimal(18,2)").alias("product_quantity"),
            F.element_at(
                F.array(*[F.lit(x) for x in ("ANNUAL_UPFRONT", "SEMI_ANNUAL", "quarterly", "Monthly", "CUSTOM")]),
                (F.col("p_size") % 5 + 1).cast("int"),
            ).alias("billing_frequency"),
            F.col("l_shipdate").alias("start_date_utc"),
            plus_days(F.col("l_shipdate"), F.col("l_quantity") * 30).alias("end_date_utc"),
            F.col("o_orderdate").alias("contract_start_date"),
            null_when(
                F.col("l_linenumber") == 7, plus_days(F.col("o_orderdate"), F.col("l_linenumber") * 200)
            ).alias("contract_end_date"),
            F.when(F.col("l_linenumber") == 5, F.col("l_shipdate")).alias("termination_date_utc"),
            F.col("o_orderdate").alias("created_at"),
            F.col("l_shipdate").alias("synced_at"),
            "is_evergreen",
            "is_deleted",
        )

    @once
    def accounts(self) -> DataFrame:
        key = F.col("c_custkey")
        segment = F.col("c_mktsegment")
        return self.given("customer").select(
            text(key).alias("id"),
            F.when(segment == "BUILDING", "Customer")
            .when(segment == "MACHINERY", "Frozen")
            .when(segment == "FURNITURE", "Partner")
            .otherwise("Lead")
            .alias("status"),
            F.when(key % 7 == 0, F.lit(None)).when(key % 7 == 1, "Free").otherwise("Paid").alias("platform_tier"),
            F.when(F.col("c_acctbal") < 0, "TRIAL_EXPIRED").alias("freeze_reason"),
            null_when(key % 5 == 0, F.concat(F.lit("P"), text(key))).alias("payment_profile_id"),
            (ntz("2001-07-31 00:00:00") - F.make_dt_interval((key % 900).cast("int"))).alias("synced_at"),
            (key % 31 == 0).alias("is_deleted"),
        )

    @once
    def billing_info(self) -> DataFrame:
        """A current row per account, for some an older one, for some a newer deleted one."""
        key = F.col("c_custkey")

        def address(email: Column, zip_missing: Column) -> Column:
            nation = F.col("c_nationkey")
            country = F.when(nation < 5, "UK").when(nation < 10, "USA").otherwise(text(nation))
            return F.concat(
                F.lit('{"firstName":"'),
                F.when(key % 3 == 0, "").otherwise(F.concat(F.lit("Fn"), text(key))),
                F.lit('","lastName":"'),
                F.when(key % 9 == 0, "").otherwise(F.concat(F.lit("Ln"), text(key))),
                F.lit('","email":"'),
                email,
                F.lit('","country":"'),
                country,
                F.lit('","state":"'),
                F.when(nation == 3, "Old State").otherwise("S"),
                F.lit('","postalCode":"'),
                F.when(zip_missing, "").otherwise(F.concat(F.lit("Z"), text(nation))),
                F.lit('"}'),
            )

        mail = F.concat(F.lit("u"), text(key), F.lit("@example.com"))
        kinds = (
            F.when(key % 6 == 0, F.array(F.lit("current"), F.lit("older")))
            .when(key % 6 == 1, F.array(F.lit("current"), F.lit("deleted")))
            .otherwise(F.array(F.lit("current")))
        )
        kind = F.col("kind")
        current = kind == "current"
        moment = ntz("2001-07-30 00:00:00") - F.make_dt_interval((key % 700).cast("int"))
        moment = (
            F.when(current, moment)
            .when(kind == "older", ntz("1999-01-01 00:00:00"))
            .otherwise(ntz("2001-07-31 00:00:00"))
        )
        billing = (
            F.when(key % 19 == 0, F.lit(None))
            .when(key % 17 == 0, "{bad")
            .otherwise(address(F.when(key % 4 == 0, "").otherwise(mail), key % 29 == 0))
        )
        shipping = null_when(key % 23 == 0, address(F.when(key % 37 == 0, "").otherwise(mail), F.lit(False)))
        return self.given("customer").withColumn("kind", F.explode(kinds)).select(
            text(key).alias("id"),
            text(key).alias("account_id"),
            F.when(key % 13 == 0, F.lit(None)).when(key % 11 == 0, " ").otherwise(F.col("c_name")).alias("legal_name"),
            F.concat(F.lit("T"), text(key)).alias("tax_id"),
            F.when(current, billing).alias("billing_address"),
            F.when(current, shipping).alias("shipping_address"),
            F.when(current & (key % 5 != 0), F.concat(F.lit("P"), text(key)))
            .when(kind == "older", F.concat(F.lit("Q"), text(key)))
            .when(kind == "deleted", F.concat(F.lit("D"), text(key)))
            .alias("payment_profile_id"),
            moment.alias("updated_at"),
            moment.alias("synced_at"),
            (kind == "deleted").alias("is_deleted"),
        )

    @once
    def product_orgs(self) -> DataFrame:
        """Organisations of the second product line; several may share billing details."""
        key = F.col("s_suppkey")
        return self.given("supplier").select(
            F.concat(F.lit("ORG"), text(F.floor(key / 2))).alias("org_id"),
            text(key).alias("billing_info_id"),
            (key % 8 == 7).alias("is_deleted"),
        )

    @once
    def partner_names(self) -> DataFrame:
        """Third-party payer id to partner name; a null name is a payer without one."""
        return self.given("supplier").select(
            text("s_suppkey").alias("payer_id"),
            F.when(F.col("s_acctbal") >= 2000, F.col("s_name")).alias("partner_name"),
        )

    @once
    def item_map(self) -> DataFrame:
        return (
            self.given("part")
            .select("p_type")
            .distinct()
            .select(F.col("p_type").alias("product_code"), F.concat(F.lit("I"), "p_type").alias("erp_item_id"))
        )

    @once
    def band_items(self) -> DataFrame:
        """Item per banded product and term band; one pair is left out of the books."""
        banded = self.item_map().filter(F.col("product_code").isin("ECONOMY", "LARGE"))
        return banded.select(
            "product_code",
            F.explode(F.array(F.lit("Y1"), F.lit("Y2"), F.lit("Y3"))).alias("term_band"),
            "erp_item_id",
        ).select(
            "product_code",
            "term_band",
            F.when(
                ~((F.col("product_code") == "LARGE") & (F.col("term_band") == "Y3")),
                F.concat("erp_item_id", F.lit("_"), "term_band"),
            ).alias("band_item_id"),
        )

    @once
    def revenue_records(self) -> DataFrame:
        event = F.col("event_type")
        credits = F.get_json_object("props", "$.k").cast("decimal(18,2)")
        value = F.col("value").cast("decimal(18,2)")
        return self.given("events").select(
            text("user_id").alias("billing_account_id"),
            F.concat(F.lit("CRM"), text(F.floor(F.col("user_id") / 3))).alias("crm_account_id"),
            plus_days(F.col("ts"), F.col("event_id") % 3 * 31).alias("revenue_date_utc"),
            F.concat(F.lit("Tier"), text(F.col("user_id") % 6)).alias("account_tier"),
            F.when(event.isin("purchase", "view"), "SELF_SERVICE")
            .when(event == "click", "OVERAGE")
            .when(event == "error", "Overage_Adjustment")
            .otherwise("PREPAID")
            .alias("type"),
            F.when(event.isin("purchase", "click"), "LINE_A").otherwise("LINE_B").alias("product_type"),
            F.when(F.col("event_id") % 2 == 0, "BILLED").otherwise("PENDING").alias("status"),
            F.when(event != "view", credits).alias("credits_used"),
            F.when(F.col("user_id") % 25 == 7, F.lit("0.01").cast("decimal(18,2)"))
            .when(event == "error", (-value).cast("decimal(18,2)"))
            .otherwise(value)
            .alias("amount"),
            (F.col("event_id") % 50 == 0).alias("is_deleted"),
        )

    @once
    def erp_customers(self) -> DataFrame:
        key = F.col("c_custkey")
        mail = F.concat(F.lit("u"), text(key), F.lit("@example.com"))
        return self.given("customer").select(
            (key + 100000).alias("id"),
            text(key).alias("billing_account_id"),
            F.col("c_name").alias("name"),
            null_when(key % 3 == 1, mail).alias("email"),
            F.when(key % 3 == 0, mail)
            .when(key % 6 == 5, F.lit(None))
            .otherwise(F.concat(F.lit("alt"), text(key), F.lit("@example.com")))
            .alias("alt_email"),
            F.when(key % 4 == 0, F.col("c_nationkey").cast("long")).alias("partner_id"),
            F.when(F.col("c_acctbal") < 0, "T").otherwise("F").alias("inactive"),
            F.when(key % 10 == 9, 6).otherwise(13).cast("long").alias("entity_status"),
            F.when(key % 17 == 0, "T").otherwise("F").alias("is_person"),
            (key % 43 == 0).alias("is_deleted"),
        )

    @once
    def partners(self) -> DataFrame:
        return self.given("nation").select(
            F.col("n_nationkey").cast("long").alias("id"),
            F.concat(F.lit("payer_"), F.lower("n_name")).alias("third_party_payer"),
            (F.col("n_nationkey") % 9 == 0).alias("is_deleted"),
        )

    @once
    def erp_items(self) -> DataFrame:
        key = F.col("n_nationkey").cast("long")
        return self.given("nation").select(
            (key + 500).alias("id"),
            F.concat(F.lit("ITEM"), text(key)).alias("item_code"),
            F.concat(F.lit("Tier"), text(F.floor(key / 5))).alias("account_tier"),
            (key % 5).alias("usage_type"),
            F.lit(False).alias("is_deleted"),
        )

    @once
    def payment_profiles(self) -> DataFrame:
        key = F.col("c_custkey")
        known = F.concat(F.lit('{"erp_customer_id":"'), text(key + 100000), F.lit('"}'))
        return self.given("customer").select(
            F.concat(F.lit("P"), text(key)).alias("id"),
            F.when(key % 4 == 0, known)
            .when(key % 4 == 1, F.concat(F.lit('{"account":"'), text(key), F.lit('"}')))
            .when(key % 4 == 2, "{bad")
            .alias("metadata"),
            (key % 53 == 0).alias("is_deleted"),
        )

    @once
    def crm_orders(self) -> DataFrame:
        key = F.col("o_orderkey")
        stray = F.when(key % 10 == 0, "-c").otherwise("")
        return self.given("orders").select(
            F.concat(F.lit("  Ord"), text(key), stray).alias("order_number"),
            F.concat(F.lit("SO"), text(key)).alias("id"),
            text("o_custkey").alias("account_id"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("type"),
            F.col("o_orderdate").alias("effective_date"),
            text(F.col("o_totalprice").cast("decimal(18,2)")).alias("total_amount"),
            F.when(key % 9 == 0, "true").otherwise("false").alias("skip_export"),
            F.when(key % 14 == 0, "true").otherwise("false").alias("test_mode"),
            F.when(key % 8 == 0, "false").when(key % 8 == 1, F.lit(None)).otherwise("true").alias("synced_flag"),
            null_when((key % 8 == 0) | (key % 5 == 0), F.concat(F.lit("E"), text(key))).alias("erp_id"),
            F.when(key % 12 == 0, F.concat(F.lit("L"), text(key))).alias("legacy_erp_id"),
            (key % 41 == 0).alias("is_deleted"),
        )

    @once
    def erp_transactions(self) -> DataFrame:
        key = F.col("o_orderkey")
        stray = F.when(key % 7 == 0, "-e").otherwise("")
        amount = F.col("o_totalprice").cast("decimal(18,2)") + F.when(key % 6 == 0, 1).otherwise(0)
        return self.given("orders").select(
            F.concat(F.lit("ord"), text(key), stray).alias("memo"),
            F.concat(F.lit("D"), text(key)).alias("document_number"),
            key.alias("transaction_id"),
            F.col("o_orderdate").alias("transaction_date"),
            F.col("o_orderstatus").alias("transaction_status"),
            F.when(key % 11 == 0, "Invoice").otherwise("SalesOrd").alias("transaction_type"),
            F.when(key % 13 == 0, "Secondary").otherwise("Primary").alias("book_name"),
            text(amount.cast("decimal(18,2)")).alias("amount"),
            text("o_custkey").alias("billing_account_id"),
        )

    @once
    def erp_sales_orders(self) -> DataFrame:
        """Sales orders whose memo is the bare order number, several per order."""
        key = F.col("l_orderkey")
        return self.given("lineitem").select(
            F.concat(F.lit(" "), text(key)).alias("memo"),
            F.concat(F.lit("SO"), text(key), F.lit("-"), text("l_linenumber"), F.lit("-"), text("l_partkey")).alias(
                "document_number"
            ),
            F.col("l_shipdate").alias("transaction_date"),
            F.when(F.col("l_returnflag") == "N", "Invoice").otherwise("Sales Order").alias("transaction_type"),
        )

    @once
    def owner_history(self) -> DataFrame:
        event = F.col("event_id")
        return self.given("events").select(
            event.alias("history_id"),
            F.concat(F.lit("CRM"), text(F.floor(F.col("user_id") / 3))).alias("crm_account_id"),
            F.when(F.col("event_type").isin("signup", "view"), "Owner").otherwise("Phone").alias("field"),
            F.when(event % 6 == 0, "Text").otherwise("EntityId").alias("data_type"),
            text(event % 31).alias("old_value"),
            text(event % 37).alias("new_value"),
            F.col("ts").alias("created_date"),
            (event % 20 == 0).alias("is_deleted"),
        )

    @once
    def crm_accounts(self) -> DataFrame:
        return (
            self.given("customer")
            .select(F.floor(F.col("c_custkey") / 3).alias("k"))
            .distinct()
            .select(F.concat(F.lit("CRM"), text("k")).alias("id"), (F.col("k") % 13 == 0).alias("is_deleted"))
        )

    @once
    def crm_account_map(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.given("customer").select(
            F.concat(F.lit("CRM"), text(F.floor(key / 3))).alias("crm_account_id"),
            null_when(key % 59 == 0, text(key)).alias("billing_account_id"),
        )

    @once
    def crm_users(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.given("customer").select(
            text(key).alias("id"),
            F.when(key == 5, "Self.Service@example.com")
            .when(key % 10 != 7, F.concat(F.lit("Owner"), text(key), F.lit("@example.com")))
            .alias("email"),
        )

    @once
    def dispatch_attempts(self) -> DataFrame:
        event = F.col("event_type")
        return self.given("events").select(
            F.concat(F.lit("b"), text("user_id")).alias("batch_id"),
            (F.col("event_id") % 40).alias("file_id"),
            F.concat(F.lit("file"), text(F.col("event_id") % 40)).alias("file_name"),
            F.when(event.isin("purchase", "view"), 200)
            .when(event == "click", 500)
            .when(event == "signup", 503)
            .otherwise(404)
            .alias("status_code"),
            F.when(~event.isin("purchase", "view"), F.concat(F.lit("HTTP "), event)).alias("error"),
            F.col("ts").alias("attempted_at"),
            F.col("event_id").alias("attempt_id"),
        )

    @once
    def file_manifests(self) -> DataFrame:
        """One request per page with a list of two files; the second has no URL."""
        page = F.col("page_id")
        account = F.element_at(
            F.array(*[F.lit(x) for x in ("", "../ab/c", "two_words", "a_b_c_d_e", "one")]), (page % 5 + 1).cast("int")
        )
        name = (
            F.when(page % 9 == 0, F.lit(None))
            .when(page % 2 == 0, F.concat(F.lit("doc"), text(page), F.lit(".PDF")))
            .otherwise(F.concat(F.lit("doc"), text(page)))
        )

        def entry(file_id: Column, url: Column) -> Column:
            return F.struct(
                file_id.alias("id"), name.alias("name"), url.alias("url"), account.alias("billing_account_id")
            )

        return self.given("pages").select(
            F.concat(F.lit("b"), text(page % 20)).alias("batch_id"),
            (page % 20 != 19).alias("success"),
            F.array(
                entry(page * 2, F.col("url")), entry(page * 2 + 1, F.lit(None).cast("string"))
            ).alias("files"),
        )

    @once
    def file_contents(self) -> DataFrame:
        return self.given("pages").select(
            F.col("url").alias("content_url"),
            F.when(F.col("page_id") % 3 == 0, "application/pdf").otherwise("text/html").alias("content_type"),
            F.encode("html", "UTF-8").alias("content"),
        )

    @once
    def stored_files(self) -> DataFrame:
        page = F.col("page_id")
        return self.given("pages").select(
            page.alias("file_id"),
            F.concat(F.lit("doc"), text(page), F.lit(".pdf")).alias("name"),
            (page % 4).alias("folder_id"),
            plus_days(ntz("2024-01-01 08:00:00"), page % 60).alias("created"),
            (page % 16 == 0).alias("failed"),
        )

    @once
    def financial_lines(self) -> DataFrame:
        price = F.col("l_extendedprice").cast("decimal(18,2)")
        line = F.col("l_linenumber")

        def amount(blank_at: int, zero_at: int) -> Column:
            return (
                F.when(line == blank_at, F.lit(None)).when(line == zero_at, " .00").otherwise(text(price))
            )

        item = F.element_at(
            F.array(*[F.lit(x) for x in ("Prepaid credits", "Support SERVICES", "Evergreen plan", "Usage", None)]),
            (F.col("l_partkey") % 5 + 1).cast("int"),
        )
        return self.given("lineitem").select(
            F.col("l_orderkey").alias("id"),
            line.alias("line_id"),
            F.when(F.col("l_linestatus") == "O", "INVOICE").otherwise("CreditMemo").alias("record_type"),
            item.alias("item"),
            amount(1, 2).alias("amount"),
            amount(2, 3).alias("amount_remaining"),
            amount(3, 4).alias("amount_paid"),
            amount(4, 5).alias("applied_amount"),
            amount(5, 6).alias("applied_paid"),
            amount(6, 7).alias("applied_remaining"),
            F.when(line == 7, "").otherwise(text(price)).alias("linked_amount"),
        )

    @once
    def reps(self) -> DataFrame:
        """Customers of the ERP with the e-mail of their sales rep."""
        key = F.col("c_custkey")
        return self.given("customer").select(
            key.alias("customer_id"),
            F.when(F.col("c_acctbal") < 0, "T").otherwise("F").alias("inactive"),
            F.when(key % 12 == 0, F.lit(None))
            .when(key % 12 == 1, " Self.Service@Example.com")
            .otherwise(F.concat(F.lit(" Rep"), text(key % 40), F.lit("@Example.com")))
            .alias("rep_email"),
        )

    @once
    def contacts(self) -> DataFrame:
        """One contact per order of a customer; some carry the rep's e-mail."""
        order = F.col("o_orderkey")
        return self.given("orders").select(
            F.col("o_custkey").alias("customer_id"),
            order.alias("contact_id"),
            F.when(order % 3 == 0, F.concat(F.lit("rep"), text(F.col("o_custkey") % 40), F.lit("@example.com")))
            .otherwise(F.concat(F.lit("c"), text(order), F.lit("@example.com")))
            .alias("email"),
        )

    @once
    def recipients(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.given("customer").select(
            key.alias("customer_id"),
            (key + 900000).alias("recipient_id"),
            (F.lit(1) + key % 4).alias("level"),
        )


