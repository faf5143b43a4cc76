"""The spread-out forms give what the plain forms give."""

from datetime import date

import pytest
from pyspark.sql import Window, functions as F

from brasstally.operators.lookups import lookup_join
from brasstally.operators.skew import HotKeys, enrich, group_totals, number_rows
from brasstally.plans import orders, reconcile, subscriptions, validation
from workload.queries import BANDED, GROUPED, POLICY, _lookups, _options, order_input
from workload.views import AS_OF, CREATED_FROM, CREATED_FROM as SINCE, Views


def rows(df):
    return sorted([tuple(str(x) for x in r) for r in df.select(*sorted(df.columns)).collect()])


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, a third on null, the rest spread; some match nothing."""
    n = F.col("id")
    return spark.range(900).select(
        n.alias("row"),
        F.when(n % 3 == 0, "hot").when(n % 3 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), (n % 40).cast("string"))).alias("k"),
        (n % 7 - 3).cast("decimal(10,2)").alias("v"),
    )


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame([("hot", 1), ("hot", 2), ("k2", 3), ("k5", 4), ("zzz", 5)], "dk string, d int")


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
def test_enrich_same_as_join(skewed, dim, how):
    hot = HotKeys(("hot",), True, 7)
    plain = enrich(skewed, dim, [("k", "dk")], how=how)
    spread = enrich(skewed, dim, [("k", "dk")], how=how, hot=hot, spread=["row"])
    assert rows(plain) == rows(spread)
    assert "_slot" not in spread.columns and "_copy" not in spread.columns


def test_hot_rows_are_dealt_over_many_slots(skewed, dim):
    hot = HotKeys(("hot",), False, 8)
    plan = enrich(skewed, dim, [("k", "dk")], hot=hot, spread=["row"])
    assert plan.count() == enrich(skewed, dim, [("k", "dk")]).count()
    dealt = skewed.filter("k = 'hot'").groupBy(F.pmod(F.xxhash64("row"), F.lit(8)).alias("s")).count()
    assert dealt.count() == 8


def test_group_totals_same_as_window(skewed):
    df = skewed.withColumn("k", F.coalesce("k", F.lit("")))
    totals = {"t": F.sum("v"), "lo": F.min("row"), "n": F.count("*")}
    plain = group_totals(df, ["k"], totals)
    spread = group_totals(df, ["k"], totals, hot=HotKeys(("hot", ""), False, 5), spread=["row"])
    assert rows(plain) == rows(spread)


def test_lookup_is_a_left_join_without_its_keys(skewed, dim):
    joined = lookup_join(skewed, dim, [("k", "dk")])
    assert joined.columns == ["row", "k", "v", "d"]
    assert rows(joined) == rows(enrich(skewed, dim, [("k", "dk")]).drop("dk"))


def test_no_group_need_fit_in_one_task(spark):
    """A key with one row in 200 is cut into parts, and totals use no window."""
    df = spark.range(40_000).select(F.col("id").alias("row"), F.when(F.col("id") % 200 == 0, "k").otherwise(F.col("id").cast("string")).alias("k"))
    parts = number_rows(df, ["k"], ["row"])
    assert parts.filter("k = 'k'").agg(F.count("*"), F.max("line_number")).first() == (200, 200)
    window = [x for x in number_rows(df, ["k"], ["row"])._jdf.queryExecution().analyzed().toString().splitlines() if "Window" in x]
    assert any("_part" in x for x in window)
    assert "Window" not in group_totals(df, ["k"], {"n": F.count("*")})._jdf.queryExecution().analyzed().toString()


def test_number_rows_is_dense_unique_and_stable(skewed):
    df = skewed.withColumn("k", F.coalesce("k", F.lit("")))
    first = number_rows(df, ["k"], ["row"])
    again = number_rows(df.repartition(5, "row"), ["k"], ["row"])
    assert rows(first) == rows(again)
    part = F.substring(F.md5(F.col("row").cast("string")), 1, 2)
    whole = df.withColumn("line_number", F.row_number().over(Window.partitionBy("k").orderBy(part, "row")))
    assert rows(first) == rows(whole)
    check = first.groupBy("k").agg(
        F.count("*").alias("n"), F.count_distinct("line_number").alias("d"), F.max("line_number").alias("m"), F.min("line_number").alias("lo")
    )
    assert check.filter("n <> d OR n <> m OR lo <> 1").count() == 0


def test_outer_match_is_a_full_outer_join(spark, small):
    v = Views(spark, small)
    left, right = v.crm_orders().select(F.col("order_number").alias("a")), v.erp_transactions().select(F.lower("memo").alias("b"))
    left = left.withColumn("a", F.lower(F.trim("a")))
    want = left.join(right, left["a"] == right["b"], "full_outer")
    assert rows(reconcile.outer_match(left, right, "a", "b")) == rows(want)


def test_feeds_same_with_hot_keys(spark, small):
    v = Views(spark, small)
    subs, info = v.sub_versions(), v.billing_info()
    hot = {
        "third_party_payer_id": HotKeys(("1", "2", "5"), True, 6),
        "billing_account_id": HotKeys(("6", "12", "13"), True, 6),
    }
    cold = {k: HotKeys() for k in hot}
    args = (subs, info, AS_OF, CREATED_FROM, POLICY)
    assert rows(subscriptions.subscription_sync(*args, hot=cold)) == rows(subscriptions.subscription_sync(*args, hot=hot))


def test_orders_same_with_hot_keys(spark, small):
    v = Views(spark, small)
    lines = order_input(v).cache()
    hot = {
        "third_party_payer_id": HotKeys(("1", "2", "5"), True, 6),
        "order_number": HotKeys(("10", "11", "12"), True, 3),
    }
    cold = {k: HotKeys() for k in hot}
    drop = ["billing_other", "shipping_other", "warnings"]
    plain = orders.prepare_subscription_orders(lines, _lookups(v), _options(), hot=cold).judged.drop(*drop)
    spread = orders.prepare_subscription_orders(lines, _lookups(v), _options(), hot=hot).judged.drop(*drop)
    assert rows(plain) == rows(spread)
    lines.unpersist()


def test_validation_same_with_hot_keys(spark, small):
    v = Views(spark, small)
    hot = {
        "third_party_payer_id": HotKeys(("1", "2"), True, 4),
        "billing_account_id": HotKeys(("6", "12"), True, 4),
        "order_number": HotKeys(("10", "11"), False, 4),
    }

    def run(h):
        return validation.order_validation(
            v.sub_versions(), v.accounts(), v.billing_info(), v.erp_sales_orders(), _lookups(v), AS_OF, POLICY,
            start=SINCE, end=AS_OF, banded_products=BANDED, contract_first_products=GROUPED, hot=h,
        )

    assert rows(run({k: HotKeys() for k in hot})) == rows(run(hot))


def test_group_span_over_dates(spark):
    df = spark.createDataFrame(
        [("o1", "A", date(2024, 1, 5), date(2024, 2, 1)), ("o1", "A", date(2024, 1, 1), date(2024, 1, 9)), ("o1", "B", date(2023, 1, 1), date(2025, 1, 1))],
        "order_number string, product_code string, service_start_date date, service_end_date date",
    ).withColumns({"rr_start_date": F.col("service_start_date"), "rr_end_date": F.col("service_end_date"), "crm_line_id": F.lit("x")})
    plain = orders.group_date_span(df, ["A"])
    hot = orders.group_date_span(df, ["A"], hot=HotKeys(("o1",), False, 3), spread=["service_start_date"])
    assert rows(plain) == rows(hot)
    a = plain.filter("product_code = 'A'").select("rr_start_date", "rr_end_date").distinct().collect()
    assert [tuple(r) for r in a] == [(date(2024, 1, 1), date(2024, 2, 1))]


def test_lines_without_third_party_are_dealt_out(spark):
    """A join by the third party does not send all lines that have none to one task."""
    from brasstally.plans.policy import skewed

    n = F.col("id").cast("string")
    subs = spark.range(4000).select(n.alias("crm_line_id"), F.when(F.col("id") % 4 == 0, n).alias("third_party_payer_id"), n.alias("billing_account_id"))
    info = spark.range(100).select(
        n.alias("account_id"), F.lit(False).alias("is_deleted"), *[F.lit("x").alias(c) for c in ("billing_address", "shipping_address", "legal_name", "tax_id", "synced_at")]
    )
    plain = {c: HotKeys() for c in ("third_party_payer_id", "billing_account_id")}
    given = skewed(None, *plain)
    assert given["third_party_payer_id"].nulls and given["third_party_payer_id"].splits > 100
    assert rows(subscriptions.with_both_roles(subs, info, given)) == rows(subscriptions.with_both_roles(subs, info, plain))
