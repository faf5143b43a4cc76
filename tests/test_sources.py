"""Reading, writing and page-wise runs."""

import json
import uuid


from brasstally.plans import controls, documents
from brasstally.operators.rules import open_judgement, required_fields
from brasstally.functions.text import is_blank
from brasstally.result import Result
from brasstally.sources import manifests, schemas, sinks
from brasstally.sources.registry import Sources
from brasstally.streaming.pages import checkpoint_root, run_pages


def named(df):
    return Result(required_fields(open_judgement(df), [("name", is_blank("name"))]))


def test_registry_by_path_view_and_function(spark, small, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t.parquet"))
    spark.range(4).createOrReplaceTempView("registry_view")
    sources = Sources(spark, root=str(tmp_path), locations={"v": "registry_view", "f": lambda s: s.range(5)})
    assert [sources[n].count() for n in ("t", "v", "f")] == [3, 4, 5]


def parcel():
    return schemas.described([("parcel", "string", "Number on the label"), ("weight", "decimal(38,9)", "Weight's figure"), ("sent", "date", "")])


def test_schemas_have_comments_and_conform(spark):
    df = schemas.conform(spark.createDataFrame([("1", "2.5", "x")], "parcel string, weight string, extra string"), parcel())
    assert df.columns == ["parcel", "weight", "sent"]
    assert df.schema["weight"].dataType.simpleString() == "decimal(38,9)"
    assert df.schema["weight"].metadata["comment"] == "Weight's figure"
    assert df.first()["sent"] is None


def test_create_and_replace_table(spark):
    name = "typed_parcels"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    schemas.create_table(spark, name, parcel())
    assert {c.name: c.description for c in spark.catalog.listColumns(name)}["weight"] == "Weight's figure"
    sinks.replace_table(spark.range(2), "replaced")
    sinks.replace_table(spark.range(3), "replaced")
    assert spark.table("replaced").count() == 3
    sinks.publish_view(spark.range(1), "published")
    assert spark.table("published").count() == 1 and sinks.dry_run(spark.range(9)).count() == 0
    spark.sql(f"DROP TABLE {name}")
    spark.sql("DROP TABLE replaced")


def test_inline_rows_and_sorted_files(spark, tmp_path):
    sources = Sources(spark, locations={"ids": ([("10",), ("9",), ("x",), ("100",), (None,)], "id string")})
    sinks.write_sorted(sources["ids"], str(tmp_path / "sorted"), [sinks.text_id("id")])
    files = sorted((tmp_path / "sorted").glob("part-*"))
    found = [r["id"] for f in files for r in spark.read.parquet(str(f)).collect()]
    assert found == ["9", "10", "100", None, "x"]


def test_result_is_written_in_one_pass(spark, tmp_path):
    df = spark.createDataFrame([("a",), (" ",), (None,)], "name string")
    sinks.write_result(named(df), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {r["outcome"]: r["count"] for r in back.groupBy("outcome").count().collect()} == {"valid": 1, "rejected": 2}


def test_manifests_and_documents_from_files(spark, tmp_path):
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "a").write_bytes(b"%PDF-1.7 body")
    (tmp_path / "docs" / "b").write_bytes(b"plain")
    urls = {n: f"file:{tmp_path}/docs/{n}" for n in "ab"}
    batch = {"success": True, "files": [
        {"id": 1, "name": "x", "fullUrl": urls["a"], "billingAccountId": "acc", "custom": 7, "none": None},
        {"id": 2, "fullUrl": urls["b"], "billingAccountId": ""},
    ]}
    (tmp_path / "m.json").write_text(json.dumps(batch, indent=1))
    read = manifests.read_manifests(spark, str(tmp_path / "m.json"), multi_line=True)
    result = documents.document_manifest(read, manifests.read_documents(spark, str(tmp_path / "docs")))
    row = result.valid.first()
    assert row["file_path"] == "acc/x.pdf" and row["metadata"]["custom"] == "7" and "none" not in row["metadata"]
    assert [r["reject_code"] for r in result.rejects.collect()] == ["not_a_document"]
    sinks.write_manifest(result.judged.drop("entry"), str(tmp_path / "laid_out"))
    assert (tmp_path / "laid_out" / "folder=acc").is_dir()


def test_dispatch_audit_files(spark, tmp_path):
    log = spark.createDataFrame([("b", 1, "f1", 200, None, 1, 1), ("b", 2, "f2", 404, "no", 1, 2)], "batch_id string, file_id int, file_name string, status_code int, error string, attempted_at int, attempt_id int")
    sinks.write_dispatch_audit(documents.dispatch_outcomes(log), str(tmp_path))
    assert spark.read.json(str(tmp_path / "success")).count() == 1
    assert spark.read.json(str(tmp_path / "errors")).first()["error"] == "no"
    assert spark.read.json(str(tmp_path / "summary")).first()["successful"] == 1


def test_pages_of_a_stream_are_judged(spark, tmp_path):
    source = tmp_path / "in"
    spark.createDataFrame([("a",), (None,), ("b",), (" ",)], "name string").repartition(2).write.json(str(source))
    pages = spark.readStream.schema("name string").option("maxFilesPerTrigger", 1).json(str(source))
    root = checkpoint_root(pages, str(tmp_path / "ck"))
    query = run_pages(pages, named, str(tmp_path / "out"), name=f"pages_{uuid.uuid4().hex}", checkpoint=str(tmp_path / "ck"))
    query.awaitTermination(120)
    assert root
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.filter("outcome = 'valid'").count() == 2 and back.filter("outcome = 'rejected'").count() == 2
    assert back.select("page").distinct().count() >= 1


def test_inactive_flag_and_cleaning_keep_rows(spark):
    df = spark.createDataFrame([("Yes",), ("No",), (None,)], "active_status string")
    assert [r["inactive"] for r in controls.with_inactive_flag(df).collect()] == ["No", "Yes", "Yes"]
    lines = spark.createDataFrame([("Invoice", None, ".00"), ("Credit", "prepaid", "5")], "record_type string, item string, amount string")
    got = controls.clean_financial_lines(lines).collect()
    assert [(r["amount"], r["invoice_type"]) for r in got] == [("0.00", "Overage"), ("5", None)]
