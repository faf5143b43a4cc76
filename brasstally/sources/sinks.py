"""Writing results."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brasstally.operators.gates import KEY_PART, KEY_PARTS, SYNC_DAY, part_of
from brasstally.plans.documents import dispatch_summary
from brasstally.result import Result, observed_metrics


def _storage(spark: SparkSession, path: str):
    """The path as the cluster's file system sees it, and that file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _shown(fs, folder) -> list:
    """What readers see in a folder: names that begin with neither ``_`` nor a dot, and the success mark."""
    if not fs.exists(folder):
        return []
    found = [s.getPath() for s in fs.listStatus(folder)]
    return [p for p in found if p.getName()[0] not in "_." or p.getName() == "_SUCCESS"]


# Fixed value: tables kept for later reads are written once and read often.
KEPT_AS = {"compression": "zstd"}


def _write_buckets(df: DataFrame, path: str, partition_by: Sequence[str], parts: int, key: str) -> None:
    """Rows in buckets of a key and by it within them; Spark writes these as a table only, which is forgotten."""
    table = f"coming_{uuid.uuid4().hex}"
    rows = df.write.format("parquet").options(**KEPT_AS).option("path", path).partitionBy(*partition_by)
    try:
        rows.bucketBy(parts, key).sortBy(key).saveAsTable(table)
    finally:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")


def replace_files(
    df: DataFrame, path: str, *, partition_by: Sequence[str] = (), buckets: tuple[int, str] | None = None
) -> None:
    """Put the rows in place of all that readers see at ``path``, once they are written.

    They are written beside it first, in a folder that readers skip, so that a job that
    fails leaves the old rows; a repeated run leaves the same ones. The exchange moves
    whole files or partition folders. What a broken run left behind goes with the next one.
    """
    spark = df.sparkSession
    folder, fs = _storage(spark, path)
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    coming, going = (jpath(folder, f"_{n}-{uuid.uuid4().hex}") for n in ("coming", "going"))
    try:
        if buckets is None:
            df.write.options(**KEPT_AS).partitionBy(*partition_by).parquet(coming.toString())
        else:
            _write_buckets(df, coming.toString(), partition_by, *buckets)
    except BaseException:
        fs.delete(coming, True)
        raise
    fs.mkdirs(going)
    for old in _shown(fs, folder):
        fs.rename(old, jpath(going, old.getName()))
    for new in _shown(fs, coming):
        fs.rename(new, jpath(folder, new.getName()))
    for left in fs.listStatus(folder):
        if left.getPath().getName().startswith(("_coming-", "_going-")):
            fs.delete(left.getPath(), True)


def replace_months(df: DataFrame, path: str, *, month: str = "revenue_month_start") -> None:
    """Put the rows in place of those of the same months; other months stay.

    Spark's dynamic partition overwrite: the months change when the job commits, so that
    a failed run leaves the old rows and a repeated one the same. A month without a row
    in ``df`` is another month. Columns of another type than those that stay are an error.
    """
    spark = df.sparkSession
    folder, fs = _storage(spark, path)
    if _shown(fs, folder):
        told = {f.name: f.dataType for f in spark.read.parquet(path).schema if f.name != month}
        if told != {f.name: f.dataType for f in df.schema if f.name != month}:
            raise ValueError(f"the rows at {path} have other columns: {told}")
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(month).parquet(path)


def keep_by_day(df: DataFrame, path: str, *, synced: str = "synced_at") -> None:
    """Rows kept by day of sync, for reads of a window; the days in ``df`` replace those that are there.

    Rows without a time of sync are kept apart, under no day.
    """
    by_day = df.withColumn(SYNC_DAY, F.col(synced).cast("date")).hint("rebalance", SYNC_DAY)
    kept = by_day.write.options(**KEPT_AS, partitionOverwriteMode="dynamic")
    kept.mode("overwrite").partitionBy(SYNC_DAY).parquet(path)


def keep_by_key(df: DataFrame, path: str, key: str, *, parts: int = KEY_PARTS, table: str | None = None) -> None:
    """All versions kept in parts of their key, for reads of the history of few keys; replaces what is there.

    A part is a bucket of the key, too. With ``table`` the files are defined as that catalog
    table: joins and windows by the key then read each part in one task and move no row
    of it, where a read of ``path`` moves them all.
    """
    by_part = df.withColumn(KEY_PART, part_of(key, parts)).hint("rebalance", KEY_PART)
    replace_files(by_part, path, partition_by=[KEY_PART], buckets=(parts, key))
    if table is not None:
        spark = df.sparkSession
        folder, fs = _storage(spark, path)
        where = fs.makeQualified(folder).toString().replace("'", "\\'")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in by_part.schema)
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({KEY_PART})"
            f" CLUSTERED BY (`{key}`) INTO {parts} BUCKETS LOCATION '{where}'"
        )
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")


def replace_table(df: DataFrame, table: str, root: str | None = None, *, format: str = "parquet") -> str:
    """Create or replace a catalog table from a frame; gives the folder of its new rows.

    Every version has a folder of its own under ``root`` (by default one in the warehouse). The table is pointed to it once
    it is whole, so that readers see the old rows or the new ones, and a failed run
    leaves the old. The version before stays for readers that have begun; older ones go.
    With other columns or another format, the table is defined anew instead.
    """
    spark = df.sparkSession
    root = root or f"{spark.conf.get('spark.sql.warehouse.dir')}/_versions/{table}"
    version = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    df.write.format(format).save(version)
    before = None
    if spark.catalog.tableExists(table):
        told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
        before = told.get("Location")
        same = [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in df.schema]
        if same and told.get("Provider", "").lower() == format.lower():
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{version}'")
        else:
            spark.sql(f"DROP TABLE {table}")
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path=version, source=format, schema=df.schema)
    spark.catalog.refreshTable(table)
    folder, fs = _storage(spark, root)
    keep = {version.rsplit("/", 1)[-1], (before or "").rstrip("/").rsplit("/", 1)[-1]}
    for old in fs.listStatus(folder):
        if old.getPath().getName() not in keep:
            fs.delete(old.getPath(), True)
    return version


def publish_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def dry_run(df: DataFrame) -> DataFrame:
    """Same columns, no rows."""
    return df.limit(0)


def _by_outcome(judged: DataFrame) -> DataFrame:
    return judged.withColumn("outcome", F.when(F.col("reject_code").isNull(), "valid").otherwise("rejected"))


def write_result(result: Result, path: str) -> None:
    """Accepted and refused rows in one pass, as ``outcome=valid`` and ``outcome=rejected`` folders.

    They take the place of what was at ``path`` when all are written; a fatal row ends
    the job and leaves it as it was.
    """
    replace_files(_by_outcome(result.checked), path, partition_by=["outcome"])


def write_with_metrics(result: Result, path: str, **also: Column) -> tuple[DataFrame, dict]:
    """``write_result``, and what it wrote counted in the same job.

    Gives the rows of ``Result.metrics``, without a second evaluation, and the values of
    the aggregates ``also`` (such as ``controls.control_aggregates()``).
    """
    rows, seen = result.observed(**also)
    replace_files(_by_outcome(rows), path, partition_by=["outcome"])
    values = seen.get
    metrics = result.judged.sparkSession.createDataFrame(observed_metrics(values), "metric string, records long")
    return metrics, {name: values.get(name) for name in also}


def write_manifest(df: DataFrame, path: str, *, folder: str = "folder") -> None:
    """Manifest rows laid out by folder; adaptive execution cuts a large folder into as many tasks as it needs."""
    df.hint("rebalance", folder).write.mode("overwrite").partitionBy(folder).parquet(path)


def write_sorted(df: DataFrame, path: str, order: Sequence[Column | str], *, mode: str = "overwrite") -> None:
    """Rows in a total order over all files, dealt by ranges; ``text_id`` makes a key of a number kept as text."""
    df.sort(*order).write.mode(mode).parquet(path)


def text_id(column: str) -> Column:
    """Order of ids kept as text: numbers by value, then the others by text."""
    number = F.col(column).try_cast("decimal(38,0)")
    return F.struct(number.isNull().alias("text"), number.alias("number"), F.col(column).alias("id"))


def write_dispatch_audit(outcomes: DataFrame, path: str) -> None:
    """Successes, errors and a summary as JSON; the outcomes are computed once and written first."""
    outcomes.write.mode("overwrite").parquet(f"{path}/outcomes")
    stored = outcomes.sparkSession.read.parquet(f"{path}/outcomes")
    stored.filter("success").write.mode("overwrite").json(f"{path}/success")
    stored.filter("NOT success").write.mode("overwrite").json(f"{path}/errors")
    dispatch_summary(stored).write.mode("overwrite").json(f"{path}/summary")
