"""Incremental reads of tables kept by day of sync and by part of their key."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from brasstally.operators.gates import with_changes
from brasstally.plans import subscriptions
from brasstally.plans.policy import Policy
from brasstally.sources import sinks

AS_OF, DAYS = datetime(2024, 3, 1), 30


def scans(plan):
    """The file scans of a plan that has run, below adaptive stages too."""
    name = plan.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        return scans(plan.executedPlan())
    if "QueryStage" in name:
        return scans(plan.plan())
    children = [plan.children().apply(i) for i in range(plan.children().size())]
    return [plan] * name.startswith("Scan ") + [s for c in children for s in scans(c)]


def files_read(df):
    rows = df.collect()
    read = {}
    for s in scans(df._jdf.queryExecution().executedPlan()):
        columns = s.output().mkString(",")
        read.setdefault("info" if "account" in columns and "line" not in columns else "versions", []).append(s.metrics().apply("numFiles").value())
    return rows, read


def test_incremental_reads_touch_few_files(spark, tmp_path):
    moment = F.lit(AS_OF) - F.make_dt_interval((F.col("id") % 400).cast("int") + 1)
    versions = spark.range(4_000).select(
        (F.col("id") % 1_000).cast("string").alias("line"),
        F.col("id").alias("version"),
        (F.col("id") % 50).cast("string").alias("account"),
        F.when(F.col("id") == 7, F.lit(AS_OF) - F.make_dt_interval(F.lit(1))).otherwise(F.lit(AS_OF) - F.make_dt_interval(F.lit(300))).alias("synced_at"),
    )
    info = spark.range(DAYS * 400).select((F.col("id") + 1_000).cast("string").alias("account_id"), moment.alias("synced_at"))
    info = info.union(spark.createDataFrame([("3", AS_OF - timedelta(hours=3))], info.schema))
    near = lambda i: [("account", i, "account_id")]
    plain = {tuple(r) for r in with_changes(versions, "line", near(info), AS_OF).collect()}
    assert 0 < len(plain) < 4_000 and any(r[0] == "7" for r in plain)

    by_key, by_day = str(tmp_path / "versions"), str(tmp_path / "info")
    sinks.keep_by_key(versions, by_key, "line")
    sinks.keep_by_day(info, by_day)
    stored, details = spark.read.parquet(by_key), spark.read.parquet(by_day)
    rows, read = files_read(with_changes(stored, "line", near(details), AS_OF))
    assert {(r["line"], r["version"], r["account"], r["synced_at"]) for r in rows} == plain
    assert "key_part" not in rows[0].asDict()
    every = len(stored.inputFiles())
    assert sorted(read["versions"])[0] <= every / 2, "the history is read of the parts of changed keys alone"
    assert sum(read["info"]) <= 4 < len(details.inputFiles()), "of billing details, the days of the window"


def moved(plan):
    """The columns that each shuffle of a plan moves."""
    name = plan.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        return moved(plan.initialPlan())
    children = [plan.children().apply(i) for i in range(plan.children().size())]
    own = [plan.output().mkString(",")] if name == "Exchange" else []
    return own + [m for c in children for m in moved(c)]


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_history_in_buckets_is_not_moved(spark, tmp_path, no_broadcast):
    old, new = AS_OF - timedelta(days=300), AS_OF - timedelta(hours=1)
    rows = [(str(i % 100), i, str(i % 9), f"note {i}", new if i in (7, 230) else old) for i in range(400)]
    rows += [(None, 1, "1", "no key", new), (None, 2, None, "no key", old), ("7", 7, "7", "note 7", new)]
    versions = spark.createDataFrame(rows, "line string, version long, account string, note string, synced_at timestamp")
    info = spark.createDataFrame([("3", new), ("x", new), ("4", old), (None, new)], "account_id string, synced_at timestamp")
    near = [("account", info, "account_id")]
    plain = sorted(map(str, with_changes(versions, "line", near, AS_OF).collect()))
    assert any("no key" in r for r in plain) and len(plain) < len(rows)

    path = str(tmp_path / "it's kept")
    for _ in range(2):  # a table defined before is defined anew
        sinks.keep_by_key(versions, path, "line", parts=4, table="kept_versions")
    try:
        kept = with_changes(spark.table("kept_versions"), "line", near, AS_OF, parts=4)
        assert sorted(map(str, kept.collect())) == plain
        shuffles = moved(kept._jdf.queryExecution().executedPlan())
        assert shuffles and not [s for s in shuffles if "note" in s], "full rows stay where they lie"
        by_path = with_changes(spark.read.parquet(path), "line", near, AS_OF, parts=4)
        assert sorted(map(str, by_path.collect())) == plain

        lone = versions.filter("line IS NOT NULL OR version = 2")
        sinks.keep_by_key(lone, path, "line", parts=4, table="kept_versions")
        kept = with_changes(spark.table("kept_versions"), "line", near, AS_OF, parts=4).collect()
        assert sorted(map(str, kept)) == sorted(map(str, with_changes(lone, "line", near, AS_OF).collect()))
        assert not any(r["line"] is None for r in kept), "versions without a key follow their own changes"
    finally:
        spark.sql("DROP TABLE IF EXISTS kept_versions")


def test_only_telling_versions_make_a_key_changed(spark):
    old, new = AS_OF - timedelta(days=300), AS_OF - timedelta(hours=1)
    rows = [("a", 1, True, new), ("a", 2, False, old), ("b", 1, True, old), ("b", 2, False, new), ("c", 1, None, new)]
    versions = spark.createDataFrame(rows, "line string, version long, sold boolean, synced_at timestamp")
    got = with_changes(versions, "line", [], AS_OF, telling=F.col("sold"))
    assert {(r["line"], r["version"]) for r in got.collect()} == {("a", 1), ("a", 2)}


def test_feed_ranks_only_lines_that_can_pass_its_gate(spark, monkeypatch):
    """A deleted row of billing details, or a version that cannot be ordered, brings no line's history along."""
    old, new = AS_OF - timedelta(days=300), AS_OF - timedelta(hours=1)
    flat = ("product_code string, payer_type string, third_party_payer_id string, amount decimal(18,2),"
            " created_at timestamp, synced_at timestamp, is_evergreen boolean, is_deleted boolean")
    line = lambda key, version, kind, account, synced, deleted=False: (
        key, "o", account, version, kind, "p", "CUSTOMER", None, Decimal(1), old, synced, False, deleted)
    versions = spark.createDataFrame(
        [
            line("own", 1, "PAID", "1", old), line("own", 2, "PAID", "1", new),
            line("free", 1, "PAID", "1", old), line("free", 2, "FREE", "1", new),
            line("gone", 1, "PAID", "1", old), line("gone", 2, "PAID", "1", new, True),
            line("near", 1, "FREE", "2", old), line("near", 2, "PAID", "2", old),
            line("dead", 1, "PAID", "3", old),
        ],
        "crm_line_id string, order_number string, billing_account_id string, version long, type string, " + flat,
    )
    versions = versions.withColumn("id", F.col("version"))
    info = spark.createDataFrame(
        [("1", old, False), ("2", new, False), ("3", new, True)], "account_id string, synced_at timestamp, is_deleted boolean"
    )
    for c in ("billing_address", "shipping_address", "legal_name", "tax_id"):
        info = info.withColumn(c, F.lit(c))
    ranked = []
    found = lambda *a, **k: ranked.append(with_changes(*a, **k)) or ranked[-1]
    monkeypatch.setattr(subscriptions, "with_changes", found)
    policy = Policy(free_types=("FREE",))
    got = subscriptions.subscription_sync(versions, info, AS_OF, old, policy)
    assert sorted(r["crm_line_id"] for r in got.collect()) == ["near", "own"]
    assert {r["crm_line_id"] for r in ranked[0].collect()} == {"near", "own"}
