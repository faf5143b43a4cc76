"""Billing plans on hand-written edges and against plain Python."""

import random
from collections import defaultdict
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from brasstally.operators.gates import not_in, recency_gate, resolve_payer, run_mode, unexpired
from brasstally.operators.latest import first_match, latest_version
from brasstally.plans import account_prep, accounts, contacts, controls, documents, invoices, orders, payments, quality
from brasstally.plans import reconcile, subscriptions, validation
from brasstally.plans.policy import Policy

DAY = datetime(2024, 6, 1)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


# --- newest version and gates ----------------------------------------------------------------


def test_latest_version_drops_deleted_first_and_breaks_ties(spark):
    df = spark.createDataFrame(
        [("a", 3, "x", True), ("a", 2, "p", False), ("a", 2, "q", False), ("b", None, "r", False), (None, 1, "s", False), (None, 9, "t", False)],
        "k string, version int, id string, is_deleted boolean",
    )
    got = latest_version(df, ["k"], Policy().newest_first())
    assert rows(got, "k", "id") == [("a", "q"), ("b", "r"), (None, "t")]


def test_latest_version_survives_repartition(spark):
    random.seed(1)
    data = [(random.randrange(5), random.randrange(20), i) for i in range(300)]
    df = spark.createDataFrame(data, "k int, version int, id int")
    expected = sorted(max(((v, i) for k2, v, i in data if k2 == k)) + (k,) for k in range(5))
    for parts in (1, 7):
        got = latest_version(df.repartition(parts), ["k"], Policy().newest_first(), deleted=None)
        assert sorted((r["version"], r["id"], r["k"]) for r in got.collect()) == expected


def test_latest_version_is_cut_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("version"), "id")
    plan = latest_version(df, ["k"], Policy().newest_first(), deleted=None)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_resolve_payer(spark):
    df = spark.createDataFrame(
        [("RESELLER", "t", "b"), ("RESELLER", None, "b"), ("CUSTOMER", "t", "b"), (None, "t", "b"), ("reseller", "t", "b")],
        "payer_type string, third_party_payer_id string, billing_account_id string",
    )
    assert [r["payer_account_id"] for r in resolve_payer(df).collect()] == ["t", "b", "b", "b", "b"]


def test_recency_counts_nulls_as_outside(spark):
    df = spark.createDataFrame(
        [(1, DAY - timedelta(hours=28), None), (2, None, None), (3, DAY - timedelta(hours=29), DAY), (4, DAY - timedelta(days=3), None)],
        "id int, a timestamp_ntz, b timestamp_ntz",
    )
    assert rows(recency_gate(df, ["a", "b"], DAY), "id") == [(1,), (3,)]


def test_not_in_drops_null_and_open_lists_pass(spark):
    df = spark.createDataFrame([("A",), ("B",), (None,)], "type string")
    assert rows(df.filter(not_in("type", ["A"])), "type") == [("B",)]
    assert df.filter(not_in("type", [])).count() == 3


def test_unexpired_includes_today_and_open_ended(spark):
    df = spark.createDataFrame([(1, DAY), (2, DAY - timedelta(seconds=1)), (3, None)], "id int, contract_end_date timestamp_ntz")
    assert rows(df.filter(unexpired(DAY + timedelta(hours=5))), "id") == [(1,), (3,)]


def test_run_mode_bounds(spark):
    df = spark.createDataFrame([(1, "a", DAY), (2, "b", DAY + timedelta(days=1)), (3, "a", DAY - timedelta(days=9))], "id int, billing_account_id string, created_at timestamp_ntz")
    assert rows(run_mode(df, "DATE", start=DAY, end=DAY + timedelta(days=1)), "id") == [(1,)]
    assert rows(run_mode(df, "ACCOUNT", accounts=["a"], floor=DAY), "id") == [(1,)]
    assert rows(run_mode(df, "ACCOUNT", accounts=["a"]), "id") == [(1,), (3,)]
    with pytest.raises(ValueError):
        run_mode(df, "OTHER")


def test_first_match_breaks_ties(spark):
    df = spark.createDataFrame([("m", date(2024, 1, 2), "b"), ("m", date(2024, 1, 1), "z"), ("m", date(2024, 1, 1), "c")], "k string, d date, doc string")
    assert rows(first_match(df, "k", ["d", "doc"], ["doc", "d"]), "k", "doc") == [("m", "c")]


# --- feeds -----------------------------------------------------------------------------------

SUB = (
    "id long, crm_line_id string, crm_account_id string, order_number string, billing_account_id string, version long,"
    " type string, product_code string, payer_type string, third_party_payer_id string, amount decimal(18,2),"
    " product_quantity decimal(18,2), billing_frequency string, start_date_utc timestamp_ntz, end_date_utc timestamp_ntz,"
    " contract_start_date timestamp_ntz, contract_end_date timestamp_ntz, termination_date_utc timestamp_ntz,"
    " created_at timestamp_ntz, synced_at timestamp_ntz, is_evergreen boolean, is_deleted boolean"
)


def sub(**changes):
    base = dict(
        id=1, crm_line_id="L1", crm_account_id="C1", order_number="O1", billing_account_id="A1", version=1, type="STANDARD",
        product_code="P", payer_type="CUSTOMER", third_party_payer_id=None, amount=Decimal("10.00"),
        product_quantity=Decimal("2.00"), billing_frequency="MONTHLY", start_date_utc=DAY, end_date_utc=DAY + timedelta(days=30),
        contract_start_date=DAY, contract_end_date=None, termination_date_utc=None, created_at=DAY, synced_at=DAY,
        is_evergreen=False, is_deleted=False,
    )
    return tuple({**base, **changes}.values())


def subs(spark, *lines):
    return spark.createDataFrame([sub(**x) for x in lines], SUB)


def account_table(spark, *lines):
    return spark.createDataFrame(lines, "id string, status string, platform_tier string, freeze_reason string, payment_profile_id string, synced_at timestamp_ntz, is_deleted boolean")


def info_table(spark, *lines):
    return spark.createDataFrame(
        lines,
        "id string, account_id string, legal_name string, tax_id string, billing_address string, shipping_address string,"
        " payment_profile_id string, updated_at timestamp_ntz, synced_at timestamp_ntz, is_deleted boolean",
    )


def test_account_sync_older_open_version_may_win(spark):
    old = DAY - timedelta(days=90)
    lines = subs(
        spark,
        dict(id=1, version=1),
        dict(id=2, version=2, contract_end_date=DAY - timedelta(days=1)),
        dict(id=3, crm_line_id="L2", type="FREE"),
        dict(id=4, crm_line_id="L3", order_number=None),
        dict(id=5, crm_line_id="L4", billing_account_id="A2", type="X", synced_at=old),
        dict(id=6, crm_line_id="L5", billing_account_id="A2", synced_at=old),
    )
    table = account_table(
        spark,
        ("A1", "Customer", None, None, "P1", old, False),
        ("A2", "Lead", "Paid", None, "P2", old, False),
    )
    info = info_table(spark, ("A2", "A2", "n", "t", None, None, "P2", DAY, DAY, True))
    got = accounts.account_sync(lines, table, info, DAY, Policy(free_types=("FREE",), status_exempt_types=("X",), free_tiers=("Free",)))
    # Line 5 is exempt from the status gate and recent only by its (deleted) billing details.
    assert rows(got, "id", "account_id", "info_legal_name") == [(1, "A1", None), (5, "A2", "n")]


def test_subscription_sync_roles_and_duplicates(spark):
    lines = subs(
        spark,
        dict(id=1, payer_type="RESELLER", third_party_payer_id="R1"),
        dict(id=2, crm_line_id="L2"),
        dict(id=3, crm_line_id="L3", product_code=None),
        dict(id=4, crm_line_id="L4", product_code="OUT"),
        dict(id=5, crm_line_id="L5", is_evergreen=True),
    )
    info = info_table(
        spark,
        ("R1", "R1", "Reseller", "TR", "RB", "RS", None, DAY, DAY, False),
        ("A1", "A1", "Cust", "TC", "CB", "CS", None, DAY, DAY, False),
        ("A1", "A1", "Gone", "TX", "XB", "XS", None, DAY, DAY, True),
    )
    policy = Policy(excluded_products=("OUT",))
    got = subscriptions.subscription_sync(lines, info, DAY, DAY, policy)
    assert rows(got, "id", "billing_address", "shipping_address", "legal_name", "tax_id") == [
        (1, "RB", "CS", "Cust", "TR"), (2, "CB", "CS", "Cust", "TC"), (3, "CB", "CS", "Cust", "TC"),
    ]
    by_payer = subscriptions.subscription_sync(lines, info, DAY, DAY, policy, legal_name_from="payer")
    assert rows(by_payer, "id", "legal_name")[0] == (1, "Reseller")


def test_zero_total_orders_only_exact_zero(spark):
    lines = subs(
        spark,
        dict(id=2, crm_line_id="L2", amount=Decimal("5.10"), type="B"),
        dict(id=1, crm_line_id="L1", amount=Decimal("-5.10"), type="A"),
        dict(id=3, crm_line_id="L3", order_number="O2", amount=Decimal("0.01")),
        dict(id=4, crm_line_id="L4", order_number="O3", amount=Decimal("0.00"), billing_account_id=None),
    )
    got = subscriptions.zero_total_orders(lines, DAY)
    assert rows(got, "order_number", "line_count", "subscription_ids", "types") == [("O1", 2, "1,2", "A,B"), ("O3", 1, "4", "STANDARD")]


def test_id_map_lists_every_distinct_value(spark):
    lines = subs(spark, *[dict(id=i, crm_line_id=f"L{i}", billing_account_id=f"A{i % 40:02}") for i in range(200)], dict(id=999, crm_line_id="F", product_code="Free_x", billing_account_id="Z"))
    row = subscriptions.id_map(lines).first()
    assert row["billing_account_ids"] == ", ".join(f"A{i:02}" for i in range(40)) and row["count_billing_accounts"] == 40


# --- invoices --------------------------------------------------------------------------------


def revenue(spark, *lines):
    return spark.createDataFrame(
        lines,
        "billing_account_id string, crm_account_id string, revenue_date_utc timestamp_ntz, account_tier string, type string,"
        " product_type string, status string, credits_used decimal(18,2), amount decimal(18,2), is_deleted boolean",
    )


def customer_table(spark, *lines):
    return spark.createDataFrame(
        lines,
        "id long, billing_account_id string, name string, email string, alt_email string, partner_id long, inactive string,"
        " entity_status long, is_person string, is_deleted boolean",
    )


ITEMS = "id long, item_code string, account_tier string, usage_type long, is_deleted boolean"
PARTNERS = "id long, third_party_payer string, is_deleted boolean"


def usage(spark, lines, customers=None):
    return invoices.usage_invoices(
        revenue(spark, *lines),
        account_table(spark, *[(f"A{i}", "Customer", None, None, f"P{i}", DAY, False) for i in range(4)]),
        customers or customer_table(spark, (7, "A1", "n", "a@x", "b@x", 3, "F", 13, "F", False), (8, "A2", "m", "a@x", "a@x", None, "F", 13, "F", False)),
        spark.createDataFrame([(3, "seller", False)], PARTNERS),
        spark.createDataFrame([(50, "i2", "T", 2, False), (51, "i3", "T", 3, False)], ITEMS),
        invoice_prefix="INV",
        memo_prefix="CM",
        overage_usage=2,
        self_usage=3,
    )


def test_usage_invoices(spark):
    may, june = datetime(2024, 5, 3), datetime(2024, 6, 30)
    result = usage(
        spark,
        [
            ("A1", "C", may, "T", "SELF_SERVICE", "L", "s", Decimal(4), Decimal(10), False),
            ("A1", "C", datetime(2024, 5, 31, 23), "T", "SELF_SERVICE", "L", "s", Decimal(1), Decimal(5), False),
            ("A1", "C", june, "T", "Overage_x", "L", "s", None, Decimal(-3), False),
            ("A2", "C", june, "T", "SELF_SERVICE", "L", "s", None, Decimal("0.50"), False),
            ("A3", "C", june, "T", "SELF_SERVICE", "L", "s", None, Decimal(9), False),
            ("A1", "C", june, "T", "PREPAID", "L", "s", None, Decimal(9), False),
            ("A9", "C", june, "T", "SELF_SERVICE", "L", "s", None, Decimal(9), False),
        ],
    )
    got = rows(
        result.valid, "external_id", "line_number", "item_id", "quantity", "amount", "erp_amount", "rate", "payment_term",
        "transaction_type", "partner_id", "to_be_emailed",
    )
    assert got == sorted(
        [
            ("INV7202405", 1, 51, Decimal("5.00"), Decimal("15.00"), Decimal("15.00"), Decimal("3.0000"), "Net 30", "Invoice", 3, "a@x,b@x"),
            ("CM7202406", 1, 50, Decimal("-3.00"), Decimal("-3.00"), Decimal("3.00"), Decimal("1.0000"), "Net 30", "Credit Memo", None, "a@x,b@x"),
            ("INV8202406", 1, 51, Decimal("0.50"), Decimal("0.50"), Decimal("0.50"), Decimal("1.0000"), "Autopay", "None", None, "a@x"),
        ],
        key=str,
    )
    assert rows(result.rejects, "billing_account_id", "reject_code") == [("A3", "missing_erp_customer")]
    assert {r["metric"]: r["records"] for r in result.metrics.collect()}["total_input"] == 4


def test_line_numbers_are_unique_and_stable(spark):
    lines = [("A1", "C", DAY, "T", "SELF_SERVICE", "L", f"s{i}", None, Decimal(9), False) for i in range(40)]
    whole = rows(usage(spark, lines).valid, "external_id", "transaction_type", "line_number", "status")
    assert whole == rows(usage(spark, lines).valid, "external_id", "transaction_type", "line_number", "status")
    assert sorted(w[2] for w in whole) == list(range(1, 41))


def test_product_invoices_keep_all_revenue(spark):
    lines = [
        ("A1", "C", DAY, "T", "a", "LINE", "s", Decimal(1), Decimal(2), False),
        ("A1", "C", DAY, "T", "b", "LINE", "s", Decimal(1), Decimal(3), False),
        ("A1", "C", DAY, "T", "a", "OTHER", "s", Decimal(1), Decimal(50), False),
        ("A1", "C", DAY, "T", "a", "LINE", "s", Decimal(1), Decimal(70), True),
    ]
    info = info_table(
        spark,
        ("A1", "A1", None, None, None, None, "OLD", DAY - timedelta(days=9), DAY, False),
        ("A1", "A1", None, None, None, None, "NEW", DAY, DAY, False),
        ("A1", "A1", None, None, None, None, "DEL", DAY + timedelta(days=1), DAY, True),
    )
    people = customer_table(
        spark,
        (9, "A1", "n", "a", None, None, "F", 13, "F", False), (5, "A1", "n", "a", None, None, "F", 13, "F", False),
        (1, "A1", "n", "a", None, None, "T", 13, "F", False), (2, "A1", "n", "a", None, None, "F", 6, "F", False), (3, "A1", "n", "a", None, None, "F", 13, "T", False),
    )
    items = spark.createDataFrame([(60, "ITEM", "T", 1, True), (61, "ITEM", "T", 1, False)], ITEMS)
    options = dict(product_type="LINE", item_code="ITEM", invoice_prefix="P", memo_prefix="M", billing_sync="tag", entity_status=13)
    got = invoices.product_invoices(revenue(spark, *lines), info, people, items, **options).valid
    assert rows(got, "external_id", "revenue_type", "amount", "item_id", "payment_profile_id", "billing_sync") == [
        ("P5202406", "a", Decimal("2.00"), 61, "NEW", "tag"), ("P5202406", "b", Decimal("3.00"), 61, "NEW", "tag"),
    ]
    assert invoices.product_invoices(revenue(spark, *lines), info, people, items, strict_one_row=True, **options).valid.count() == 1


def test_check_invoice_lines(spark):
    df = spark.createDataFrame([("x", "1", "2", "", "Invoice", "1", "1", "A"), ("x", "1", "2", " ", "Invoice", "1", "0", "A")], "external_id string, erp_customer_id string, item_id string, to_be_emailed string, transaction_type string, erp_amount string, erp_quantity string, billing_account_id string")
    result = invoices.check_invoice_lines(df)
    assert result.valid.count() == 1
    assert rows(result.rejects, "reject_message") == [("line lacks [to_be_emailed] for account A",)]


# --- orders ----------------------------------------------------------------------------------

ADDRESS = '{"firstName":"F","lastName":"L","email":"e@x","country":"UK","postalCode":"Z"}'


def order_lines(spark, *lines):
    extra = [("billing_address", ADDRESS), ("shipping_address", ADDRESS), ("legal_name", "N")]
    data = [sub(**{k: v for k, v in x.items() if k not in dict(extra)}) + tuple(x.get(k, d) for k, d in extra) for x in lines]
    return spark.createDataFrame(data, SUB + ", billing_address string, shipping_address string, legal_name string")


def lookups(spark):
    return validation.Lookups(
        spark.createDataFrame([("R1", "Partner"), ("R2", None)], "payer_id string, partner_name string"),
        spark.createDataFrame([("BAND", "Y1", "i1"), ("BAND", "Y2", None)], "product_code string, term_band string, band_item_id string"),
        spark.createDataFrame([("OLD", "legacy")], "product_code string, legacy_item_id string"),
    )


def prepare(spark, *lines, **options):
    chosen = orders.OrderOptions(banded_products=("BAND",), grouped_products=("G",), countries={"UK": "GB"}, **options)
    return orders.prepare_subscription_orders(order_lines(spark, *lines), lookups(spark), chosen)


def test_orders_rejects_by_line(spark):
    result = prepare(
        spark,
        dict(id=1, order_number="a"),
        dict(id=2, order_number="b", billing_address=""),
        dict(id=3, order_number="c", legal_name=" ", billing_account_id=None),
        dict(id=4, order_number="d", payer_type="reseller", third_party_payer_id=" R1 "),
        dict(id=5, order_number="e", payer_type="RESELLER", third_party_payer_id="R2"),
        dict(id=6, order_number="f", payer_type="RESELLER", third_party_payer_id=None),
        dict(id=7, order_number="g", billing_address="{bad"),
    )
    assert rows(result.rejects, "id", "reject_code") == [(2, "missing_fields"), (3, "missing_fields"), (5, "invalid_reseller_mapping"), (6, "invalid_reseller_mapping")]
    messages = {r["id"]: r["reject_message"] for r in result.rejects.collect()}
    assert "legal_name, billing_account_id (" in messages[3] and messages[6].endswith("'(empty)'.")
    kept = {r["id"]: r for r in result.valid.collect()}
    assert kept[4]["payer_type"] == "Reseller" and kept[4]["third_party_payer_id"] == "R1" and kept[4]["partner"] is None
    assert kept[4]["third_party_payer_name"] == "Partner" and kept[1]["billing_country"] == "GB" and kept[7]["billing_country"] is None
    assert kept[1]["billing_attention"] == "F L" and kept[1]["rate"] == Decimal("5.0000")


def test_orders_banding_and_warnings(spark):
    end = DAY + timedelta(days=600)
    result = prepare(
        spark,
        dict(id=1, order_number="a", product_code=" BAND ", contract_end_date=DAY + timedelta(days=10)),
        dict(id=2, order_number="b", product_code="BAND", contract_end_date=end),
        dict(id=3, order_number="c", product_code="BAND", contract_end_date=None, end_date_utc=None),
        dict(id=4, order_number="d", product_code="OLD"),
        dict(id=5, order_number="e", product_code=None),
    )
    got = rows(result.valid, "id", "term_months", "term_band", "product_code_branding", "alloc_strategy", "source_product_code")
    assert got == [
        (1, 1, "Y1", "i1", "banded", "BAND"),
        (2, 20, "Y2", None, "band_missing", None),
        (3, None, None, None, "band_term_error", None),
        (4, None, None, "legacy", "legacy_item", "OLD"),
        (5, None, None, None, "default_no_banding", None),
    ]
    assert rows(result.warnings, "id", "warning_code") == [(2, "lookup_item_missing"), (3, "term_calc_failed")]
    by_code = prepare(spark, dict(id=2, product_code="BAND", contract_end_date=end), branding="code").valid.first()
    assert by_code["product_code_branding"] == "BAND" and by_code["alloc_strategy"] == "banded"


def test_orders_group_dates_skip_refused_lines(spark):
    result = prepare(
        spark,
        dict(id=1, order_number="a", product_code="G", start_date_utc=DAY, end_date_utc=DAY + timedelta(days=5)),
        dict(id=2, order_number="a", product_code="G", start_date_utc=DAY + timedelta(days=3), end_date_utc=DAY + timedelta(days=9)),
        dict(id=3, order_number="a", product_code="G", start_date_utc=DAY - timedelta(days=50), legal_name=None),
    )
    span = (DAY.date(), (DAY + timedelta(days=9)).date())
    assert rows(result.valid, "id", "rr_start_date", "rr_end_date") == [(1, *span), (2, *span)]


def test_order_totals_ignore_refused_lines_and_take_whole_orders(spark):
    lines = (
        dict(id=1, order_number="a", amount=Decimal(10)),
        dict(id=2, order_number="a", amount=Decimal(-10)),
        dict(id=3, order_number="a", amount=Decimal(99), legal_name=None),
        dict(id=4, order_number="b", amount=Decimal(-1)),
        dict(id=5, order_number=None, amount=Decimal(3)),
        dict(id=6, order_number=None, amount=Decimal(-4)),
    )
    result = prepare(spark, *lines)
    assert rows(result.valid, "id") == []
    codes = dict(rows(result.rejects, "id", "reject_code"))
    assert codes == {1: "zero_or_negative_total", 2: "zero_or_negative_total", 3: "missing_fields", 4: "zero_or_negative_total", 5: "zero_or_negative_total", 6: "zero_or_negative_total"}
    only_zero = prepare(spark, *lines, total_policy="==0")
    assert rows(only_zero.valid, "id") == [(4,), (5,), (6,)]
    refused = orders.refused_orders(result.judged)
    assert rows(refused, "order_number", "record_count") == [("a", 2), ("b", 1), (None, 2)]


def test_order_metrics_add_up(spark):
    result = prepare(spark, dict(id=1), dict(id=2, legal_name=None), dict(id=3, order_number="z", amount=Decimal(0)))
    got = {r["metric"]: r["records"] for r in result.metrics.collect()}
    assert got == {
        "total_input": 3, "total_ingested": 1, "total_errored": 2, "difference_ingested_vs_errored": -1,
        "rejected_missing_fields": 1, "rejected_zero_or_negative_total": 1,
    }


def test_amount_text_in_orders(spark):
    lines = order_lines(spark, dict(id=1, order_number="a"), dict(id=2, order_number="a"), dict(id=3, order_number="b")).withColumn(
        "amount", F.element_at(F.array(F.lit("1,234.50"), F.lit("abc"), F.lit("")), F.col("id").cast("int"))
    )
    result = orders.prepare_subscription_orders(lines, lookups(spark))
    assert rows(result.valid, "id", "order_total", "rate") == [(1, Decimal("1234.5000"), Decimal("617.2500")), (2, Decimal("1234.5000"), None)]
    assert rows(result.rejects, "id", "order_total") == [(3, Decimal("0.0000"))]


# --- validation ------------------------------------------------------------------------------


def test_order_validation_messages(spark):
    lines = subs(
        spark,
        dict(id=1, billing_account_id="A1"),
        dict(id=2, crm_line_id="L2", order_number="O2", billing_account_id="A2", amount=Decimal(0), termination_date_utc=DAY),
        dict(id=3, crm_line_id="L3", order_number="O3", billing_account_id="A1", product_code="BAND", start_date_utc=None, contract_start_date=None),
        dict(id=4, crm_line_id="L4", order_number=" o4", billing_account_id="A1", payer_type="RESELLER", third_party_payer_id="R9"),
    )
    table = account_table(spark, ("A1", "Customer", "Paid", None, None, DAY, False), ("A2", "Lead", "Free", "TRIAL_EXPIRED", None, DAY, False))
    info = info_table(spark, ("A1", "A1", "N", "T", ADDRESS, ADDRESS, None, DAY, DAY, False), ("R9", "R9", "RN", "T", ADDRESS, None, None, DAY, DAY, False))
    erp = spark.createDataFrame([("O4 ", "D2", DAY + timedelta(days=1), "Sales Order"), ("o4", "D1", DAY, "Sales Order"), ("o4", "D0", DAY - timedelta(days=1), "Invoice")], "memo string, document_number string, transaction_date timestamp_ntz, transaction_type string")
    got = validation.order_validation(
        lines, table, info, erp, lookups(spark), DAY, Policy(free_tiers=("Free",)), start=DAY, end=DAY + timedelta(days=1), banded_products=("BAND",)
    )
    by_id = {r["id"]: r for r in got.collect()}
    assert by_id[1]["validation_status"] == "VALID" and by_id[1]["rejection_category"] is None
    assert by_id[2]["validation_error_message"] == (
        "no_billing_address; no_shipping_address; no_legal_name; order_total_zero; terminated; "
        "account_status:Lead; trial_over; account_tier:Free"
    )
    assert by_id[2]["rejection_category"] == "addresses_and_names"
    # No start date: no term, so no band and no item, instead of the longest band.
    assert by_id[3]["term_band"] is None and by_id[3]["validation_error_message"] == "no_band_item:BAND"
    assert by_id[4]["validation_error_message"] == "reseller_unmapped" and by_id[4]["erp_order_number"] == "D1"


def test_reconcile_null_and_blank_keys(spark):
    crm = spark.createDataFrame(
        [(" Ord1", "1", "10.00", "false", False), (None, "2", "1", "false", False), ("Ord3", "3", "x", "true", False), ("Ord4", "4", "1", "false", True)],
        "order_number string, id string, total_amount string, skip_export string, is_deleted boolean",
    ).withColumns({c: F.lit(None).cast("string") for c in ("account_id", "status", "type", "effective_date", "test_mode", "synced_flag", "erp_id", "legacy_erp_id")})
    erp = spark.createDataFrame(
        [("ORD1 ", "D1", 1, "10.00005"), (None, "D2", 2, "5"), ("ord1", "D1", 1, "10.00005")],
        "memo string, document_number string, transaction_id long, amount string",
    ).withColumns({"transaction_type": F.lit("SalesOrd"), "book_name": F.lit("Primary"), "transaction_date": F.lit(None), "transaction_status": F.lit(None), "billing_account_id": F.lit(None)})
    got = reconcile.reconcile_orders(crm, erp)
    assert rows(got, "crm_order_id", "erp_transaction_id", "record_status", "amount_variance", "likely_reason") == sorted(
        [
            ("1", 1, "both", Decimal("0.0001"), None),
            ("2", None, None, None, "unknown"),
            ("3", None, "crm_only", None, "skip_flag"),
            (None, 2, None, None, "unknown"),
        ],
        key=str,
    )


# --- accounts --------------------------------------------------------------------------------


def account_rows(spark, *lines):
    return spark.createDataFrame(lines, "billing_account_id string, billing_address string, shipping_address string, legal_name string, payer_type string, third_party_payer_id string, contract_type string, type string")


def test_prepare_accounts(spark):
    no_mail = '{"firstName":"F"}'
    names = spark.createDataFrame([("R1", "Partner")], "payer_id string, partner_name string")
    result = account_prep.prepare_accounts(
        account_rows(
            spark,
            ("1", ADDRESS, ADDRESS, "N", "MARKETPLACE", "R1", "SALES_ASSISTED", None),
            ("2", ADDRESS, no_mail, "N", "Customer", None, "x", None),
            ("3", no_mail, no_mail, "N", "CUSTOMER", None, None, None),
            ("4", ADDRESS, ADDRESS, "N", "RESELLER", "R2", None, None),
            ("5", ADDRESS, None, "N", "RESELLER", "R1", None, "T"),
            ("6", ADDRESS, ADDRESS, "N", "RESELLER", " R1", None, None),
        ),
        names,
    )
    assert rows(result.valid, "billing_account_id", "contract_type", "partner", "is_partner") == [
        ("1", "Prepaid", "Partner", "true"), ("3", None, None, "false"), ("6", None, None, "false"),
    ]
    assert rows(result.rejects, "billing_account_id", "reject_code", "reject_message") == [
        ("2", "missing_email", "this payer needs mail: shipping_email"),
        ("4", "invalid_reseller_mapping", "no partner is known for payer 'R2'."),
        ("5", "missing_fields", "lacks shipping_address (account 5) (type T)"),
    ]


def test_prepare_product_accounts_stops_on_fatal_rows(spark):
    good = spark.createDataFrame([("1", ADDRESS, None), ("2", "{bad", "N"), ("3", None, "N")], "billing_account_id string, billing_address string, legal_name string")
    result = account_prep.prepare_product_accounts(good)
    assert rows(result.valid, "billing_account_id", "legal_name", "billing_zip") == [("1", "e@x", "Z")]
    assert rows(result.rejects, "billing_account_id", "reject_code") == [("2", "invalid_billing_address"), ("3", "missing_fields")]
    bad = good.unionByName(spark.createDataFrame([("9", '{"email":"","country":"US"}', "N")], good.schema))
    judged = account_prep.prepare_product_accounts(bad).judged
    assert rows(judged.filter("billing_account_id = '9'"), "reject_code") == [("fatal_missing_fields",)]
    with pytest.raises(account_prep.MissingBillingFields, match="billing_email, billing_zip"):
        account_prep.stop_on_missing(judged)
    account_prep.stop_on_missing(result.judged)


def test_addresses_are_one_whole_object(spark):
    texts = ['{"a":"1"} x', '{"a":"1"}{"a":"2"}', '{"a":"1"', '[]', '"a"', '', None, '{"a":"1"},"end":1', '{"a":"1"},"x":{}', '{"a":"1","a":"2"}', ' {"a": 1} ']
    from brasstally.functions.address import json_text, parse_json_map

    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [(r[0], r[1]) for r in frame.select(parse_json_map("t")["a"], json_text("t", "a")).collect()]
    assert got == [(None, None)] * 9 + [("2", "2"), ("1", "1")]


def test_oversized_amounts_count_as_bad(spark):
    frame = spark.createDataFrame([("A", "9" * 22), ("A", "1.5"), ("B", "x"), ("B", None)], "billing_account_id string, amount string")
    total = controls.control_totals(frame).first()
    assert (total["bad_amounts"], total["total_amount"]) == (2, Decimal("1.50"))


def test_partner_names_of_any_number(spark):
    names = spark.range(300_000).selectExpr("cast(id as string) as payer_id", "concat('P', id) as partner_name")
    frame = spark.createDataFrame(
        [("1", ADDRESS, ADDRESS, "L", None, None, "Customer", None), ("2", ADDRESS, ADDRESS, "L", None, None, "RESELLER", "299999")],
        "billing_account_id string, billing_address string, shipping_address string, legal_name string, type string, contract_type string, payer_type string, third_party_payer_id string",
    )
    got = account_prep.prepare_accounts(frame, names).judged
    assert rows(got, "billing_account_id", "reject_code", "partner") == [("1", None, None), ("2", None, "P299999")]


def test_recently_dropped_null_status(spark):
    table = account_table(spark, ("1", None, "Free", None, None, DAY, False), ("2", None, "Paid", None, None, DAY, False), ("3", "Lead", None, None, None, DAY, False))
    policy = Policy(free_tiers=("Free",))
    assert rows(accounts.recently_dropped(table, DAY, policy), "id", "drop_reason") == [("1", "platform_tier"), ("3", "status")]


# --- controls, files, contacts, checks -------------------------------------------------------


def test_control_totals(spark):
    df = spark.createDataFrame([(" ab ", "10.005"), ("c", "x"), ("", "7"), (None, "8"), ("d", None)], "billing_account_id string, amount string")
    row = controls.control_totals(df).first()
    assert (row["record_count"], row["valid_records"], row["invalid_records"], row["bad_amounts"]) == (5, 3, 2, 1)
    assert row["hash_total"] == ord("a") + ord("b") + ord("c") + ord("d")
    assert row["total_amount"] == Decimal("10.01") and row["average_amount"] == Decimal("3.34")
    stamped = controls.stamp_control_totals(df)
    assert stamped.count() == 5 and stamped.filter("reject_code IS NULL").select("control_hash_total").distinct().count() == 1
    assert rows(stamped.filter("reject_code IS NOT NULL"), "control_record_count", "reject_code") == [(None, "invalid_record"), (None, "invalid_record")]


def test_control_totals_of_nothing(spark):
    row = controls.control_totals(spark.createDataFrame([], "billing_account_id string, amount string")).first()
    assert (row["record_count"], row["total_amount"], row["hash_total"], row["average_amount"]) == (0, 0, 0, 0)


def replay(codes):
    """Send attempts one after the other as a client would."""
    for n, code in enumerate(codes[:3], 1):
        if code == 200 or 400 <= code < 500:
            return code, n
    return codes[:3][-1], len(codes[:3])


def test_dispatch_outcomes_equal_replay(spark):
    random.seed(3)
    log = [(f"b{random.randrange(3)}", random.randrange(12), random.choice([200, 404, 500, 503]), i) for i in range(150)]
    df = spark.createDataFrame(log, "batch_id string, file_id int, status_code int, attempt_id int").withColumns(
        {"file_name": F.lit("f"), "error": F.lit(None).cast("string"), "attempted_at": F.col("attempt_id")}
    )
    by_file = defaultdict(list)
    for b, f, code, _ in log:
        by_file[b, f].append(code)
    expected = sorted((b, f, *replay(c)) for (b, f), c in by_file.items())
    assert rows(documents.dispatch_outcomes(df), "batch_id", "file_id", "status_code", "attempts") == sorted(expected, key=str)


def test_document_manifest(spark):
    entry = "struct<id:long,name:string,url:string,billing_account_id:string>"
    manifests = spark.createDataFrame(
        [
            ("b1", True, [(1, "a", "http://h/x.pdf", "w"), (2, None, "http://h/y", "../w"), (3, "c", "http://h/z", ""), (4, "d", None, "w"), (5, "e", "http://other/q", "w"), (6, "f", "http://h/none", "w")]),
            ("b2", False, [(7, "x", "http://h/x.pdf", "w")]),
            ("b3", True, []),
        ],
        f"batch_id string, success boolean, files array<{entry}>",
    )
    contents = spark.createDataFrame(
        [("http://h/x.pdf", None, b"zz"), ("http://h/y", None, b"%PDF-1"), ("http://h/z", "text/html", b"<html"), ("http://other/q", "application/pdf", b"")],
        "content_url string, content_type string, content binary",
    )
    result = documents.document_manifest(manifests, contents, allowed_origins=["http://h"])
    assert rows(result.valid, "id", "file_path") == [(1, "w/a.pdf"), (2, "w/file_2.pdf")]
    assert rows(result.rejects, "batch_id", "id", "reject_code") == [
        ("b1", 3, "not_a_document"), ("b1", 4, "missing_url"), ("b1", 5, "url_not_allowed"), ("b1", 6, "not_found"),
        ("b2", None, "upstream_failed"), ("b3", None, "no_files"),
    ]
    outcome = {r["batch_id"]: (r["level"], r["answer_code"], float(r["success_rate"])) for r in documents.batch_outcome(result.judged).collect()}
    assert outcome == {"b1": ("warning", 207, 33.33), "b2": ("error", 400, 0.0), "b3": ("error", 400, 0.0)}


def test_parent_metadata(spark):
    df = spark.sql("SELECT map('a', '1') AS metadata, map('k', 'v') AS _PARENT UNION ALL SELECT map('a', '2'), NULL")
    got = [r[0] for r in documents.with_parent_metadata(df).select("metadata").collect()]
    assert got == [{"a": "1", "_PARENT_k": "v"}, {"a": "2"}]


def test_retention_range_is_inclusive(spark):
    df = spark.createDataFrame([(1, 5, datetime(2024, 1, 1, 0)), (2, 5, datetime(2024, 1, 2, 23, 59)), (3, 5, datetime(2024, 1, 3)), (4, 6, datetime(2024, 1, 1))], "file_id int, folder_id int, created timestamp_ntz")
    assert rows(documents.retention_candidates(df, 5, date(2024, 1, 1), date(2024, 1, 2)), "file_id") == [(1,), (2,)]


def test_redact(spark):
    df = spark.createDataFrame([("s", "k", "u" * 120, 1)], "Auth_header string, api_key string, url string, n int")
    row = documents.redact(df).first()
    assert row[0] == row[1] == "[REDACTED]" and row[2] == "u" * 50 + "..." + "u" * 30 and row[3] == 1


def test_redact_inside_arrays_of_structs(spark):
    files = [("u" * 120, "k1", [1, 2]), (None, None, None)]
    schema = "id int, files array<struct<fullUrl:string,api_key:string,n:array<int>>>, one struct<token:string,x:int>"
    df = spark.createDataFrame([(1, files, ("t", 5)), (2, None, None)], schema)
    first, second = documents.redact(df).orderBy("id").collect()
    assert [tuple(f) for f in first["files"]] == [("u" * 50 + "..." + "u" * 30, "[REDACTED]", [1, 2]), (None, "[REDACTED]", None)]
    assert tuple(first["one"]) == ("[REDACTED]", 5) and second["files"] is None and second["one"] is None


def test_contact_plan_stamps_customers(spark):
    people = spark.createDataFrame([(1, "F", "a@x")], "customer_id int, inactive string, rep_email string")
    none = spark.createDataFrame([], "customer_id int, contact_id int, email string, recipient_id int, level int")
    row = contacts.contact_upsert_plan(people, none, none, level=3, self_service_email="s@x", as_of=DAY).first()
    assert row["customer_updated_at"] == DAY and row["customer_error"] == ""


def test_contact_plan(spark):
    people = spark.createDataFrame([(1, "F", " A@x "), (2, "F", "self@x"), (3, "T", "a@x"), (4, "F", None), (5, "F", "b@x"), (6, "F", "Self@X")], "customer_id int, inactive string, rep_email string")
    known = spark.createDataFrame([(1, 10, "a@X"), (1, 11, "A@x"), (5, 12, "z@x")], "customer_id int, contact_id int, email string")
    told = spark.createDataFrame([(1, 90, 3), (2, 91, 3), (5, 92, 1)], "customer_id int, recipient_id int, level int")
    got = contacts.contact_upsert_plan(people, known, told, level=3, self_service_email="Self@x")
    assert rows(got, "customer_id", "contact_action", "contact_id", "recipient_action") == [
        (1, "flag_contact", 11, "update_recipient"), (2, "create_contact", None, "deactivate_recipient"),
        (5, "create_contact", None, "create_recipient"), (6, "create_contact", None, "none"),
    ]


def test_payment_backfill_prefers_the_way_found_in_the_erp(spark):
    profiles = spark.createDataFrame([("P1", None, False), ("P2", '{"erp_customer_id":"9"}', False), ("P3", "{bad", False), ("P4", None, True)], "id string, metadata string, is_deleted boolean")
    table = account_table(spark, ("A1", "C", None, None, "P1", DAY, False), ("A2", "C", None, None, "P2", DAY, False), ("A3", "C", None, None, None, DAY, False))
    info = info_table(spark, ("B1", "B1", None, None, None, None, "P1", DAY, DAY, False), ("B3", "B3", None, None, None, None, "P3", DAY, DAY, False))
    orgs = spark.createDataFrame([("O", "B1", False), ("O2", "B3", False), ("O3", "B3", False)], "org_id string, billing_info_id string, is_deleted boolean")
    people = customer_table(spark, (5, "B1", "n", None, None, None, "F", 13, "F", False), (6, "B3", "n", None, None, None, "F", 13, "F", False), (4, "A2", "n", None, None, None, "F", 13, "F", False))
    got = payments.payment_id_backfill(profiles, table, info, orgs, people, main_line="M", product_line="L", link_base="u=")
    assert rows(got, "id", "erp_customer_id", "product_source", "erp_customer_link") == [("P1", "5", "L", "u=5"), ("P3", "6", "L", "u=6")]


def test_quality_checks_fail_on_bad_rows(spark):
    lines = spark.createDataFrame([("X1", 1, "A", "Autopay"), ("X1", 1, "B", "Net 30"), ("Y1", 1, None, None)], "external_id string, line_number int, acct string, term string")
    members = spark.createDataFrame([("A",)], "k string")
    got = quality.quality_checks(
        [
            quality.isolation("iso", lines, "acct", members, "k"),
            quality.allowlist("allow", lines, "acct", members, "k"),
            quality.uniqueness("uniq", lines, ["external_id", "line_number"]),
            quality.row_checks(lines, {"term": quality.not_constant("term", "Autopay"), "prefix": quality.prefixed("external_id", ["Y"])}),
            quality.row_count("rows", lines, 3),
            quality.distinct_values("values", lines, "acct", ["A"]),
        ]
    )
    assert rows(got, "check_name", "failures", "passed") == sorted(
        [("iso", 1, False), ("allow", 2, False), ("uniq", 1, False), ("term", 2, False), ("prefix", 1, False), ("rows", 0, True), ("values", 2, False)], key=str
    )


def test_orders_move_and_write_only_what_is_used(spark, small, monkeypatch):
    """The lines written between are as wide as the caller needs, and every row is judged as without ``columns``."""
    from workload.queries import _lookups, _options, order_input
    from workload.views import Views

    kept = []
    monkeypatch.setattr(orders, "staged", lambda df, name: kept.append(df) or df)
    v = Views(spark, small)
    lines = order_input(v, flat=True)
    whole = orders.prepare_subscription_orders(lines, _lookups(v), _options()).judged
    for shown in ([], ["id", "order_total"], ["id", "product_code_branding", "rr_end_date", "billing_schedule_suggested", "warnings"]):
        judged = orders.prepare_subscription_orders(lines, _lookups(v), _options(), columns=shown).judged
        names = [*shown, "reject_code", "reject_message"]
        assert judged.columns == names
        assert sorted(map(str, judged.collect())) == sorted(map(str, whole.select(*names).collect()))
        assert "billing_email" in kept[0].columns and "billing_email" not in kept[-1].columns
        assert len(kept[-1].columns) < len(kept[0].columns) / 2


def test_lines_of_an_order_are_moved_by_their_order_alone(spark):
    """One row of figures per order, with dates of each listed product: lines are joined to it by one key."""
    from brasstally.operators.rules import open_judgement

    day = date
    rows = [("o1", "A", 5, 1, 9), ("o1", "A ", 6, 0, 3), ("o1", "B", -20, 4, 5), ("o2", "B", 1, 2, 3), (None, "A", 4, 7, 8), ("", "A", 1, 1, 2), ("o2", None, None, 6, 6)]
    rows = [(o, p, a, day(2020, 1, s + 1), day(2020, 2, e + 1)) for o, p, a, s, e in rows]
    df = spark.createDataFrame(rows, "order_number string, product_code string, amount int, start_date_utc date, end_date_utc date")
    df = df.withColumns({c: F.lit(None).cast("date") for c in ("contract_start_date", "contract_end_date")})
    made = orders._order_figures(orders.by_order(open_judgement(df)), ["A"], orders.NONE_HOT)
    got = {(r["order_number"], r["product_code"]): (int(r["order_total"]), r["_first"] and r["_first"].day, r["_last"] and r["_last"].day) for r in made.collect()}
    assert got == {
        ("o1", "A"): (-9, 1, 10), ("o1", "A "): (-9, 1, 10), ("o1", "B"): (-9, None, None), ("o2", "B"): (1, None, None),
        ("o2", None): (1, None, None), (None, "A"): (4, 8, 9), ("", "A"): (1, 2, 3),
    }
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    joins = [x for x in plan.splitlines() if "Join " in x]
    assert len(joins) == 1 and "_key__order" in joins[0] and "product" not in joins[0]
