"""Rows staged by a key stay where they lie: what follows by that key moves none of them."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from brasstally.operators.latest import first_match, latest_staged, latest_version
from brasstally.operators.lookups import brought
from brasstally.operators.rules import open_judgement, refuse
from brasstally.plans import orders
from brasstally.result import known_codes
from brasstally.sources.staging import staged, to_stage_by
from workload.queries import POLICY, QUERIES, _lookups, _options, order_details, order_lines
from workload.views import Views


def rows(df):
    return sorted([tuple(str(x) for x in r) for r in df.select(*sorted(df.columns)).collect()])


def moved(df, column):
    """The exchanges that rows read with ``column`` from a staged table go through, by the plan."""
    found, above = [], []
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        above = [(d, x) for d, x in above if d < depth] + [(depth, line.strip(" :+-"))]
        if "FileScan parquet" in line and ".staged_" in line and f"{column}#" in line.split("] Batched")[0].split("Bucketed")[0]:
            found.append([x for _, x in above if x.startswith("Exchange")])
    assert found, "no staged table with this column is read"
    return [x for y in found for x in y]


@pytest.fixture
def few_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "50KB")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def lines(spark):
    n = F.col("id")
    return spark.range(400).select(
        F.when(n % 9 > 0, (n % 40).cast("string")).alias("g"), F.when(n % 7 > 0, (n % 5).cast("string")).alias("k"), n.alias("wide")
    )


def test_aggregates_and_joins_by_the_key_move_no_row(spark, lines, few_broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    kept = staged(to_stage_by(lines, "g"), "lines")
    assert rows(kept) == rows(lines)
    sums = kept.groupBy(F.col("g").alias("_g")).agg(F.sum("wide").alias("total"))
    both = kept.join(sums, F.col("g") == F.col("_g"), "left")
    assert moved(both, "wide") == []
    plain = lines.join(lines.groupBy(F.col("g").alias("_g")).agg(F.sum("wide").alias("total")), F.col("g") == F.col("_g"), "left")
    assert rows(both) == rows(plain)
    assert not spark.catalog.listTables(pattern="staged_*"), "the table's name is forgotten"


def test_the_note_goes_and_others_stay(lines):
    judged = refuse(open_judgement(lines), F.col("wide") > 9, "large", F.lit("x"))
    kept = staged(to_stage_by(judged, "g"), "judged")
    assert known_codes(kept) == ["large"]
    again = staged(to_stage_by(kept, "k"), "judged")
    assert all("staged_by" not in f.metadata for f in again.schema) and rows(again) == rows(judged)


def test_brought_is_a_left_join(spark, lines, few_broadcast):
    """Missing groups and keys match nothing; what is known twice of a pair doubles its rows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    known = spark.createDataFrame([("1", "a", None), ("1", "b", 2), ("3", None, 3), ("8", "z", 4)], "fk string, name string, n int")
    kept = staged(to_stage_by(lines, "g"), "lines")
    pairs = kept.select("g", "k").filter("k IS NOT NULL").distinct()
    got = brought(kept, pairs.join(known, F.col("k") == F.col("fk")).drop("fk"), "g", "k")
    numbered = lines.filter("g IS NOT NULL").join(known, F.col("k") == F.col("fk"), "left").drop("fk")
    none = lines.filter("g IS NULL").select("*", F.lit(None).cast("string").alias("name"), F.lit(None).cast("int").alias("n"))
    assert got.columns == ["g", "k", "wide", "name", "n"]
    assert rows(got) == rows(numbered.union(none))
    assert moved(got, "wide") == []


def test_latest_staged_is_the_latest_version(spark, small):
    subs = Views(spark, small).sub_versions()
    odd = subs.withColumns({"crm_line_id": F.when(F.col("id") % 11 > 0, F.col("crm_line_id")), "is_deleted": F.when(F.col("id") % 13 > 0, F.col("is_deleted"))})
    order = [*POLICY.newest_first(), F.desc("id"), F.desc("end_date_utc"), F.desc("contract_end_date")]
    want = latest_version(odd, ["crm_line_id"], order)
    got = latest_staged(odd, "crm_line_id", order, "versions")
    assert got.columns == want.columns and rows(got) == rows(want)


def test_first_match_with_taken_columns_in_its_order(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", None, "q"), ("b", 5, "p"), (None, 3, None)], "k string, n int, t string")
    got = first_match(df, "k", ["n", "t"], ["t", "n"])
    assert got.columns == ["k", "t", "n"]
    assert rows(got) == rows(first_match(df.withColumn("u", F.col("t")), "k", ["n", "t"], ["u", "n"]).withColumnRenamed("u", "t"))


def test_orders_with_details_apart(spark, small):
    """Lines that get their details by order: the same rows, for unnumbered orders and repeated details too."""
    v = Views(spark, small)
    details = order_details(v)
    twice = details.union(details.filter("info_account % 5 = 0").withColumn("legal_name", F.lit(" ")))
    lines = order_lines(v).withColumn("order_number", F.when(F.col("id") % 3 > 0, F.col("order_number")).when(F.col("id") % 2 > 0, "")).cache()
    drop = ["billing_other", "shipping_other", "warnings"]
    for known in (details, twice):
        whole = lines.join(known, F.col("billing_account_id") == F.col("info_account"), "left").drop("info_account")
        want = orders.prepare_subscription_orders(whole, _lookups(v), _options()).judged.drop(*drop)
        got = orders.prepare_subscription_orders(lines, _lookups(v), _options(), details=known).judged.drop(*drop)
        assert rows(got) == rows(want)
    lines.unpersist()


def test_unnumbered_lines_are_one_order_dealt_out(spark):
    n = F.col("id")
    lines = spark.range(300).select(
        n, n.cast("string").alias("crm_line_id"), F.when(n % 3 == 0, "o").when(n % 3 == 1, "").alias("order_number"),
        F.lit("A").alias("product_code"), (n % 5).cast("decimal(18,2)").alias("amount"), F.date_add(F.lit(date(2024, 1, 1)), n.cast("int")).alias("start_date_utc"),
    )
    lines = open_judgement(lines.withColumns({c: F.col("start_date_utc") for c in ("end_date_utc", "contract_start_date", "contract_end_date")}))
    dealt = staged(orders._dealt_by_order(lines), "lines")
    assert dealt.filter("order_number IS NULL").select("_order").distinct().count() > 90
    got = orders._order_figures(dealt, ["A"], orders.NONE_HOT, unnumbered_dealt=True).drop("_order")
    want = orders._order_figures(orders.by_order(lines), ["A"], orders.NONE_HOT).drop("_order")
    assert rows(got) == rows(want) and want.filter("order_number IS NULL").select("order_total", "_first", "_last").distinct().count() == 1


@pytest.mark.parametrize("name", ["order_validation_invalid", "orders_valid"])
def test_lines_are_not_moved_once_they_are_staged_by_order(spark, small, few_broadcast, name):
    assert moved(QUERIES[name](spark, small), "termination_date_utc") == []


def test_lines_written_with_their_metrics_are_not_moved_and_lie_in_small_files(spark, small, few_broadcast, tmp_path):
    from brasstally.sources.sinks import write_with_metrics
    from workload.queries import _orders

    result = _orders(Views(spark, small))
    assert moved(result.judged, "termination_date_utc") == []
    metrics, _ = write_with_metrics(result, f"{tmp_path}/orders")
    assert rows(metrics) == rows(result.metrics)
    written = [f.name for f in tmp_path.glob("orders/outcome=*/part-*")]
    assert written and all(".zstd." in f for f in written)
