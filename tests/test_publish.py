"""Publishing, recovery of a stopped run, footers, schemas per partition and plans."""

import hashlib
import os
import shutil

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from partledger.functions.digests import etag_matches, object_tag
from partledger.operators import catchup, fingerprint
from partledger.sinks import control, publish
from partledger.sources import documents, records
from partledger.spec import DATASETS, KEY

ROWS = [(f"{k:03d}", k % 5, ("AC", "SP")[k % 2], 2024, k % 3 + 1) for k in range(60)]
DDL = "PA_CMP string, PA_CODUNI int, uf string, ano int, mes int"


def data(spark, rows=ROWS):
    return spark.createDataFrame(rows, DDL)


def tree(root):
    return sorted(
        os.path.relpath(os.path.join(d, f), root)
        for d, _, names in os.walk(root)
        for f in names
        if f.endswith(".parquet") and "/_" not in d
    )


def plan(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_published_names_and_hashes(spark, tmp_path):
    root = str(tmp_path / "sia-pa")
    files = publish.publish(data(spark), root, "1")
    assert tree(root) == sorted(f"ano=2024/uf={uf}/mes={m:02d}/part.parquet" for uf in ("AC", "SP") for m in (1, 2, 3))
    for row in files.collect():
        with open(f"{root}/{row['name']}", "rb") as file:
            content = file.read()
        assert hashlib.sha256(content).hexdigest() == row["sha256"]
        assert (len(content), hashlib.md5(content).hexdigest()) == (row["bytes"], row["etag"])
    assert publish.unfinished_runs(spark, root) == []
    again = publish.outputs(publish.hashed_files(spark, root))
    assert sorted(again.collect()) == sorted(publish.outputs(files).collect())


def test_stopped_commit_is_finished(spark, tmp_path):
    root = str(tmp_path / "sia-pa")
    publish.publish(data(spark, ROWS[:10]), root, "1")
    staged = publish.stage(data(spark), root, "2").collect()
    # The first two files had been moved when the run stopped.
    for row in staged[:2]:
        target = f"{root}/{row['name']}"
        os.makedirs(os.path.dirname(target), exist_ok=True)
        source = row["path"].removeprefix("file:")
        shutil.move(source, target)
        # The local file system keeps a checksum beside each file.
        crc = [os.path.join(os.path.dirname(p), f".{os.path.basename(p)}.crc") for p in (source, target)]
        shutil.move(*crc)
    assert publish.unfinished_runs(spark, root) == ["2"]
    publish.commit(spark, root, "2")
    assert publish.unfinished_runs(spark, root) == []
    assert records.scan_dataset(spark, root).count() == 60
    assert {r["run"] for r in publish.published_files(spark, root).collect()} == {"2"}


def test_pieces_of_a_large_partition(spark, tmp_path):
    root = str(tmp_path / "sia-pa")
    one = data(spark).filter("uf = 'SP' AND mes = 1")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "4")
    try:
        files = publish.publish(one, root, "1")
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert tree(root) == [f"ano=2024/uf=SP/mes=01/part.{p}parquet" for p in ("00001.", "00002.", "")]
    total = publish.outputs(files).first()
    hashes = [r["sha256"] for r in files.orderBy("piece").collect()]
    assert (total["files"], total["sha256"]) == (3, hashlib.sha256("".join(hashes).encode()).hexdigest())
    assert publish.outputs(publish.hashed_files(spark, root)).first() == total
    # A smaller version leaves no piece of the larger one behind.
    publish.publish(one.limit(2), root, "2")
    assert tree(root) == ["ano=2024/uf=SP/mes=01/part.parquet"]


def test_empty_run_publishes_nothing(spark, tmp_path):
    root = str(tmp_path / "sia-pa")
    publish.publish(data(spark), root, "1")
    before = tree(root)
    publish.stage(data(spark), root, "2")
    publish.stage(data(spark).limit(0), root, "2")
    publish.commit(spark, root, "2")
    assert tree(root) == before
    assert {r["run"] for r in publish.published_files(spark, root).collect()} == {"1"}


def test_other_partition_columns(spark, tmp_path):
    spec = DATASETS["sinan"]
    rows = spark.createDataFrame([("1", "AC", "DENG", 2024), ("2", "SP", "ZIKA", 2023)], "SEM_NOT string, SG_UF_NOT string, agravo string, ano int")
    files = publish.publish(rows, str(tmp_path / "sinan"), "1", spec)
    assert tree(str(tmp_path / "sinan")) == ["agravo=DENG/ano=2024/part.parquet", "agravo=ZIKA/ano=2023/part.parquet"]
    schema = publish.describe_published(files, spec).first()["schema"]
    assert [(s["name"], s["type"]) for s in schema] == [
        ("SEM_NOT", "VARCHAR"), ("SG_UF_NOT", "VARCHAR"), ("agravo", "VARCHAR"), ("ano", "BIGINT")
    ]
    counts = records.footer_row_counts(spark, str(tmp_path / "sinan"), ["agravo", "ano"])
    assert sorted(tuple(r) for r in counts.collect()) == [("DENG", 2024, 1), ("ZIKA", 2023, 1)]


def test_counts_are_pushed_into_the_scan(spark, tmp_path):
    root = str(tmp_path / "sia-pa")
    publish.publish(data(spark), root, "1")
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    counts = records.footer_row_counts(spark, root)
    assert "PushedAggregation: [COUNT(*)]" in plan(counts)
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    assert sum(r["rows"] for r in counts.collect()) == 60


def test_pruning_does_not_hang_on_sizes(spark, tmp_path):
    root = str(tmp_path / "sia-pa")
    publish.publish(data(spark), root, "1")
    tree_ = records.scan_dataset(spark, root, data(spark).drop(*KEY).schema)
    keys = spark.createDataFrame([("SP", 2024, 2)], "uf string, ano int, mes int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pruned = records.scan_from_manifest(tree_, keys)
        outcomes = keys.withColumn("outcome", F.lit("changed"))
        changed = fingerprint.changed_partitions(tree_, outcomes, KEY)
        for df in (pruned, changed):
            filters = [line for line in plan(df).splitlines() if line.startswith("PartitionFilters")]
            assert any("(uf#" in f and "= SP)" in f and "2024" in f for f in filters)
            assert df.count() == sum(1 for r in ROWS if r[2:] == ("SP", 2024, 2))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_difference_moves_digests_only(spark):
    old = spark.createDataFrame([(1, "a", 0.0), (1, "a", 0.0), (2, None, 1.5), (None, "x", None)], "k int, s string, d double")
    new = spark.createDataFrame([(1, "a", -0.0), (2, None, 1.5), (2, None, 1.5), (None, None, None), (3, "x", float("nan"))], "k int, s string, d double")
    diff = fingerprint.revision_diff(old, new)
    got = sorted(((r["k"], r["s"], r["change"], r["copies"]) for r in diff.collect()), key=repr)
    assert got == sorted(
        [(1, "a", "removed", 1), (2, None, "added", 1), (None, "x", "removed", 1), (None, None, "added", 1), (3, "x", "added", 1)], key=repr
    )


def test_content_does_not_move(spark):
    content = bytes(range(256)) * 300
    local = spark.createDataFrame([("a", len(content), bytearray(content)), ("b", 3, bytearray(b"abc"))], "key string, size long, content binary")
    tags = {r["key"]: r["t"] for r in local.select("key", object_tag(F.col("content"), 65536).alias("t")).collect()}
    parts = b"".join(hashlib.md5(content[k : k + 65536]).digest() for k in range(0, len(content), 65536))
    assert tags == {"a": f"{hashlib.md5(parts).hexdigest()}-2", "b": hashlib.md5(b"abc").hexdigest()}
    assert local.select(etag_matches(F.lit(tags["a"]), F.col("content"), 65536).alias("m")).first()["m"]
    objects = spark.createDataFrame([("a", len(content), hashlib.md5(content).hexdigest()), ("b", 3, "0" * 32)], "key string, size long, etag string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        same = catchup.reusable_local_objects(objects, local)
        assert [r["key"] for r in same.collect()] == ["a"]
        moved = [p for p in plan(same).split("\n\n") if "Exchange" in p.partition("\n")[0]]
        assert moved and not any("content" in p for p in moved)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_documents_are_dropped_by_checked_keys(spark, tmp_path):
    keys = spark.createDataFrame([("AC", 2024, 1), ("SP", 2024, 2)], "uf string, ano int, mes int")
    control.write_documents(keys.withColumn("text", F.lit("{}\n")), str(tmp_path), "sia-pa")
    assert publish.drop_documents(keys.filter("uf = 'SP'"), str(tmp_path), "sia-pa") == 1
    assert publish.drop_documents(keys.filter("uf = 'SP'"), str(tmp_path), "sia-pa") == 0
    assert [r["uf"] for r in documents.scan_provenance(spark, str(tmp_path), "sia-pa").collect()] == ["AC"]
    with pytest.raises(PySparkException):
        publish.drop_documents(spark.createDataFrame([("../AC", 2024, 1)], "uf string, ano int, mes int"), str(tmp_path), "sia-pa")


def test_document_keys_are_checked_once_a_document(spark):
    keys = data(spark).select(*KEY).distinct().withColumn("text", F.lit("{}\n"))
    checked = control.checked_documents(keys, "sia-pa")
    optimized = checked._jdf.queryExecution().optimizedPlan().toString().splitlines()
    below = optimized[next(i for i, line in enumerate(optimized) if "Aggregate" in line) + 1 :]
    assert not any("upload refused" in line for line in below)
    assert checked.count() == keys.count()
    with pytest.raises(PySparkException, match="upload refused"):
        control.checked_documents(keys.withColumn("uf", F.lit("x/")), "sia-pa").collect()
