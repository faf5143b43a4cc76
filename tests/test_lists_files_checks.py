"""Lists of any size, files by their heads, checks in one pass, entries of maps."""

import os
import random

from pyspark.sql import functions as F

import brasstally.operators.rollups as rollups
from brasstally.plans import documents, quality
from brasstally.sources import manifests
from workload.queries import QUERIES
from workload.views import Views


def test_lists_from_chunks_equal_plain_ones(spark, monkeypatch):
    monkeypatch.setattr(rollups, "CHUNK_BITS", 2)
    r = random.Random(1)
    rows = [(r.choice(["a", "b", None]), r.choice([None, *map(str, range(60))]), r.choice(["x", "y"])) for _ in range(900)]
    rows += [("only null", None, None), ("one", "v", "x")]
    frame = spark.createDataFrame(rows, "k string, v string, w string").repartition(5)
    got = {x["k"]: tuple(x)[1:] for x in rollups.distinct_rollup(frame, ["k"], {"vs": "v", "ws": "w"}, {"n": "v"}).collect()}
    expected = {}
    for k in {x[0] for x in rows}:
        vs, ws = (sorted({x[i] for x in rows if x[0] == k and x[i] is not None}) for i in (1, 2))
        expected[k] = (len(vs), ", ".join(vs) or None, ", ".join(ws) or None)
    assert got == expected


def test_values_as_rows_in_order(spark):
    frame = spark.range(30_000).selectExpr("CAST(id % 2 AS STRING) AS k", "CAST(id % 9000 AS STRING) AS v")
    got = rollups.distinct_values(frame, ["k"], ["v"]).collect()
    assert len(got) == 9000
    parts = rollups.distinct_values(frame, ["k"], ["v"]).withColumn("p", F.spark_partition_id()).groupBy("p").agg(
        F.min(F.struct("k", "list", "value")).alias("a"), F.max(F.struct("k", "list", "value")).alias("z")
    ).orderBy("p").collect()
    assert all(tuple(x["z"]) < tuple(y["a"]) for x, y in zip(parts, parts[1:])), "ranges do not overlap"


def test_no_aggregate_holds_a_keys_values_one_by_one(spark):
    """A key of 200,000 values: texts are joined from chunks of at most 4,096."""
    frame = spark.range(200_000).selectExpr("'hot' AS k", "CAST(id AS STRING) AS v")
    row = rollups.distinct_rollup(frame, ["k"], {"vs": "v"}, {"n": "v"}).first()
    assert row["n"] == 200_000 and row["vs"] == ", ".join(sorted(map(str, range(200_000))))


def test_files_are_listed_without_their_bytes(spark, tmp_path):
    stored = tmp_path / "stored files"
    stored.mkdir()
    (stored / "a b").write_bytes(b"%PDF-1.7 body")
    (stored / "c.pdf").write_bytes(b"no matter")
    (stored / "d").write_bytes(b"hi")
    with open(stored / "huge", "wb") as f:
        f.write(b"%PDF-")
        f.truncate(3 << 30)
    log = tmp_path / "reads"
    log.mkdir()

    def counted(path, n):
        head = manifests.first_bytes(path, n)
        with open(log / path.rsplit("/", 1)[-1], "a") as f:
            f.write(f"{len(head)}\n")
        return head

    listing = manifests.list_documents(spark, str(stored))
    assert {r["length"] for r in listing.collect()} == {13, 9, 2, 3 << 30}
    urls = {os.path.basename(r["content_url"]): r["content_url"] for r in listing.collect()}
    entries = [("b", True, [(str(k), n, urls.get(n, "file:/none"), "acct") for k, n in enumerate(["a b", "c.pdf", "d", "huge", "gone"])])]
    given = spark.createDataFrame(entries, "batch_id string, success boolean, files array<struct<id:string,name:string,url:string,billing_account_id:string>>")
    result = documents.document_manifest(given, listing, heads=lambda u, n: manifests.read_heads(u, n, read=counted))
    codes = {r["name"]: r["reject_code"] for r in result.judged.collect()}
    assert codes == {"a b": None, "c.pdf": None, "d": "not_a_document", "huge": None, "gone": "not_found"}
    assert {f: set((log / f).read_text().split()) for f in os.listdir(log)} == {"a b": {"5"}, "d": {"2"}, "huge": {"5"}}, "no byte of c.pdf"


def test_checks_on_a_frame_are_one_pass(spark, small):
    plan = QUERIES["quality_checks"](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    staged = [x for x in plan.splitlines() if "Relation" in x and "external_id" in x]
    assert len(staged) <= 2 * 3, "each output is read for its rows and for the counts of its numbering"
    lines = spark.createDataFrame([("X1", 1, "A"), ("X1", 1, "B"), ("Y1", 1, None)], "external_id string, line_number int, acct string")
    members = spark.createDataFrame([("A",), ("A",)], "k string")
    checks = [
        quality.isolation("iso", lines, "acct", members, "k"),
        quality.allowlist("allow", lines, "acct", members, "k"),
        quality.uniqueness("uniq", lines, ["external_id", "line_number"]),
        quality.row_checks(lines, {"never": F.col("line_number") > 9}),
        quality.row_count("rows", lines, 5),
        quality.distinct_values("values", lines, "acct", ["A"]),
    ]
    got = quality.quality_checks(checks)
    assert {(r["check_name"], r["failures"], r["detail"]) for r in got.collect()} == {
        ("iso", 1, None), ("allow", 2, None), ("uniq", 1, None), ("never", 0, None), ("rows", 2, "3"), ("values", 2, "B"),
    }
    none = lines.limit(0)
    got = quality.quality_checks([quality.row_count("rows", none, 5), quality.uniqueness("uniq", none, ["acct"]), quality.distinct_values("v", none, "acct", ["A"])])
    assert {(r["check_name"], r["failures"]) for r in got.collect()} == {("rows", 5), ("uniq", 0), ("v", 0)}


def test_entries_of_maps_are_masked_by_key(spark):
    schema = "id int, m map<string,string>, inner map<string,map<string,string>>, list array<map<string,string>>, numbers map<string,int>, by_number map<int,string>, deep map<int,struct<password:string,n:int>>"
    entry = {"authToken": "abc", "Host": "h", "fullUrl": "u" * 150, "API_KEY": None}
    rows = [(1, entry, {"a": entry, "secrets": entry}, [entry, None], {"key": 1, "n": 2}, {1: "x"}, {7: ("p", 3)}), (2, None, None, None, None, None, None)]
    one, none = sorted(documents.redact(spark.createDataFrame(rows, schema)).collect(), key=lambda r: r["id"])
    safe = {"authToken": "[REDACTED]", "Host": "h", "fullUrl": "u" * 50 + "..." + "u" * 30, "API_KEY": None}
    assert one["m"] == safe and one["inner"] == {"a": safe, "secrets": None} and one["list"] == [safe, None]
    assert one["numbers"] == {"key": None, "n": 2} and one["by_number"] == {1: "x"} and one["deep"][7]["password"] == "[REDACTED]"
    assert all(v is None for k, v in none.asDict().items() if k != "id")


def test_stand_in_tables_keep_every_row(spark, small):
    v = Views(spark, small)
    assert v.given("lineitem").count() == spark.read.parquet(f"{small}/lineitem.parquet").count()
