"""Writes that count, stop, replace and can be run again."""

import os

import pytest
from pyspark.sql import functions as F

from brasstally.functions.text import is_blank
from brasstally.operators.rules import open_judgement, refuse
from brasstally.plans import account_prep, controls
from brasstally.result import Result, known_codes
from brasstally.sources import sinks

ROWS = [(1, "a"), (2, " "), (3, None), (4, "bad"), (5, "c"), (6, "bad"), (7, "worse")]


def judged(spark, rows=ROWS):
    df = open_judgement(spark.createDataFrame(rows, "id long, name string").repartition(3))
    df = refuse(df, is_blank("name"), "no_name", F.lit("nothing there"))
    df = refuse(df, F.col("name") == "bad", "bad_name", F.concat(F.lit("id "), F.col("id").cast("string")))
    return Result(refuse(df, F.col("name") == "worse", "fatal_name", F.col("name")))


def told(df):
    return {r["metric"]: r["records"] for r in df.collect()}


def ids(spark, path):
    return sorted(r["id"] for r in spark.read.parquet(path).collect())


def files(path):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.startswith("part-"))


def test_codes_are_noted_on_the_column(spark):
    assert known_codes(judged(spark).judged) == ["no_name", "bad_name", "fatal_name"]


def test_metrics_come_with_the_write(spark, tmp_path):
    result = judged(spark)
    metrics, also = sinks.write_with_metrics(result, str(tmp_path / "out"), most=F.max("id"))
    assert told(metrics) == told(result.metrics) and told(metrics)["rejected_bad_name"] == 2 and also == {"most": 7}
    assert ids(spark, str(tmp_path / "out")) == [1, 2, 3, 4, 5, 6, 7]


def test_rows_are_evaluated_once(spark, tmp_path):
    """Each row is counted by an accumulator as it is evaluated: rows and metrics are one job's."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.createDataFrame(ROWS, "id long, name string").repartition(3).mapInArrow(count, "id long, name string")
    result = Result(refuse(open_judgement(rows), is_blank("name"), "no_name", F.lit("")))
    metrics, _ = sinks.write_with_metrics(result, str(tmp_path / "out"))
    assert told(metrics)["total_input"] == seen.value == len(ROWS)


def test_metrics_of_no_rows(spark, tmp_path):
    result = judged(spark, [])
    metrics, _ = sinks.write_with_metrics(result, str(tmp_path / "out"))
    assert told(metrics) == told(result.metrics) and set(told(metrics).values()) == {0}


def test_unnoted_codes_are_an_error(spark, tmp_path):
    df = spark.createDataFrame([(1, "odd", "m")], "id long, reject_code string, reject_message string")
    with pytest.raises(ValueError, match="no step has noted"):
        sinks.write_with_metrics(Result(df), str(tmp_path / "out"))


def test_control_sums_observed_or_aggregated(spark, tmp_path):
    rows = [("1", "1,000.5"), ("2", "x"), (" ", "7"), (None, "8"), ("1", ""), ("𝒜", None), ("2", "9" * 30)]
    df = spark.createDataFrame(rows, "billing_account_id string, amount string")
    marked = Result(refuse(open_judgement(df), is_blank("billing_account_id"), "invalid_record", F.lit("")))
    _, seen = sinks.write_with_metrics(marked, str(tmp_path / "out"), **controls.control_aggregates())
    row = controls.control_totals(df).first()
    for name in ("record_count", "valid_records", "invalid_records", "bad_amounts", "hash_total"):
        assert seen[name] == row[name], name
    assert float(seen["total"]) == float(row["total_amount"]) == 1000.5 and row["record_count"] == 7


def test_a_fatal_row_ends_the_job_before_its_commit(spark, tmp_path):
    out, result = str(tmp_path / "out"), judged(spark).stop_on("fatal_name")
    for view in (result.valid, result.rejects, result.checked, result.warnings):
        with pytest.raises(Exception, match="fatal_name: worse"):
            view.collect()
    for write in (sinks.write_result, sinks.write_with_metrics):
        with pytest.raises(Exception, match="fatal_name: worse"):
            write(result, out)
        assert files(out) == []
    sinks.write_result(judged(spark, ROWS[:3]), out)
    before = files(out)
    with pytest.raises(Exception, match="fatal_name"):
        sinks.write_result(result, out)
    assert files(out) == before and ids(spark, out) == [1, 2, 3]
    assert told(result.metrics)["rejected_fatal_name"] == 1
    assert judged(spark, ROWS[:6]).stop_on("fatal_name").valid.count() == 2


def test_product_accounts_can_stop_their_run(spark, tmp_path):
    schema = "billing_account_id string, billing_address string, legal_name string"
    good = spark.createDataFrame([("1", '{"email":"a@x.example","country":"US","postalCode":"1"}', None), ("2", None, None)], schema)
    bad = good.union(spark.createDataFrame([("9", '{"email":"","country":"US"}', "N")], schema))
    out = str(tmp_path / "out")
    sinks.write_result(account_prep.prepare_product_accounts(good).stop_on(account_prep.FATAL), out)
    assert spark.read.parquet(out).count() == 2
    with pytest.raises(Exception, match="holds none of"):
        sinks.write_result(account_prep.prepare_product_accounts(bad).stop_on(account_prep.FATAL), out)
    assert spark.read.parquet(out).count() == 2


def test_samples_are_the_first_of_each_code(spark):
    rows = [(k, "bad" if k % 3 else " ") for k in range(500)]
    result = judged(spark, rows)
    got = {(r["reject_code"], r["sample_number"]): r["id"] for r in result.samples(["id"], 3).collect()}
    assert got == {("no_name", 1): 0, ("no_name", 2): 3, ("no_name", 3): 6, ("bad_name", 1): 1, ("bad_name", 2): 2, ("bad_name", 3): 4}
    plan = result.samples(["id"], 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2, "cut in every map task, then for good"


def test_files_are_replaced_when_all_are_written(spark, tmp_path):
    out = str(tmp_path / "out")
    sinks.write_result(judged(spark, ROWS[:3]), out)
    sinks.write_result(judged(spark, ROWS[:3]), out)
    assert ids(spark, out) == [1, 2, 3]
    sinks.write_result(judged(spark, ROWS[:1]), out)
    assert ids(spark, out) == [1] and not os.path.exists(f"{out}/outcome=rejected"), "no row of the run before is left"
    os.makedirs(f"{out}/_coming-broken")
    broken = spark.range(8).select(F.when(F.col("id") == 5, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        sinks.replace_files(broken, out)
    assert ids(spark, out) == [1]
    sinks.replace_files(spark.range(3), out)
    assert ids(spark, out) == [0, 1, 2] and sorted(n for n in os.listdir(out) if n[0] == "_") == ["_SUCCESS"]


def test_months_are_replaced_alone(spark, tmp_path):
    out = str(tmp_path / "out")
    month = lambda rows: spark.createDataFrame(rows, "id long, amount int, month string")
    everything = lambda: sorted(tuple(r) for r in spark.read.parquet(out).select("id", "amount", F.col("month").cast("string")).collect())
    sinks.replace_months(month([(1, 10, "2024-01-01"), (2, 20, "2024-02-01"), (3, 30, "2024-02-01")]), out, month="month")
    for _ in range(2):
        sinks.replace_months(month([(2, 21, "2024-02-01"), (4, 40, "2024-03-01")]), out, month="month")
        assert everything() == [(1, 10, "2024-01-01"), (2, 21, "2024-02-01"), (4, 40, "2024-03-01")]
    failing = month([(5, 50, "2024-01-01")]).withColumn("amount", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        sinks.replace_months(failing, out, month="month")
    with pytest.raises(ValueError, match="other columns"):
        sinks.replace_months(month([(5, 50, "2024-01-01")]).withColumn("amount", F.col("amount").cast("decimal(9,2)")), out, month="month")
    assert everything() == [(1, 10, "2024-01-01"), (2, 21, "2024-02-01"), (4, 40, "2024-03-01")]


def test_table_points_to_whole_versions(spark, tmp_path):
    root, name = str(tmp_path / "versions"), "replaced_versions"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    sinks.replace_table(spark.range(2), name, root)
    for n in (3, 4, 5):
        sinks.replace_table(spark.range(n), name, root)
        assert spark.table(name).count() == n
    assert len(os.listdir(root)) == 2, "the version before stays, older ones go"
    broken = spark.range(8).select(F.when(F.col("id") == 5, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        sinks.replace_table(broken, name, root)
    assert spark.table(name).count() == 5
    sinks.replace_table(spark.range(2).withColumn("more", F.lit("x")), name, root)
    assert spark.table(name).columns == ["id", "more"] and spark.table(name).count() == 2
    spark.sql(f"DROP TABLE {name}")
