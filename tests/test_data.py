"""Fingerprints, archived data, readers, writers, jobs and streaming on small trees."""

import json
import os
import random

import duckdb
import pytest
from helpers import SOURCE_DIR, listing, rows, ts
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from partledger.operators import catalog, delta, fingerprint, lineage, verification
from partledger.operators import listing as ls
from partledger.plans import jobs
from partledger.sinks import archive as sink
from partledger.sinks import control
from partledger.sources import documents, listings, records
from partledger.spec import SIA_PA
from partledger.streaming import incremental

TABLES = "/root/testdata/sf0.001"


def micro(spark, n=300, seed=1):
    """Ambulatory records of a few partitions; SP 2024-01 holds a third of them."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        uf, ano, mes = ("SP", 2024, 1) if i % 3 == 0 else (rng.choice(["AC", "MG"]), rng.choice([2023, 2024]), rng.choice([1, 2]))
        code = None if i % 17 == 0 else f"{rng.randrange(50):07d}"
        data.append((f"{ano}{mes:02d}", code, i % 7, uf, ano, mes))
    return spark.createDataFrame(data, "PA_CMP string, PA_CODUNI string, PA_QTDPRO bigint, uf string, ano int, mes int")


# --- fingerprints -----------------------------------------------------------


def oracle_fingerprint(path, where="true"):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    return con.execute(
        "SELECT 'v1:' || count(*) || ':' || coalesce(to_hex(sum(md5_number_lower(to_json(t)::VARCHAR)::HUGEINT)::HUGEINT), '') "
        f"|| ':' || coalesce(to_hex(bit_xor(md5_number_upper(to_json(t)::VARCHAR))), '') FROM read_parquet('{path}') t WHERE {where}"
    ).fetchall()[0][0]


@pytest.mark.parametrize("table", ["lineitem", "orders", "events", "documents", "pages", "customer"])
def test_fingerprint_equals_duckdb(spark, table):
    path = f"{TABLES}/{table}.parquet"
    got = fingerprint.content_fingerprint(spark.read.parquet(path), []).first()
    assert got.fingerprint == oracle_fingerprint(path)


def test_fingerprint_of_every_type_equals_duckdb(spark, tmp_path):
    from datetime import date
    from decimal import Decimal

    data = [
        (1, 2, 3.5, 1.25, Decimal("1.50"), True, "x\u0001\u2028\\/\"é", date(2024, 1, 2), ts("2024-01-02 03:04:05.120000"), ts("2024-01-02 03:04:05.5")),
        (None, None, 1e10, 0.1, Decimal("17.00"), None, "", date(1969, 12, 31), ts("2024-01-02 00:00:00"), None),
        (-5, 7, 2.5e-5, 1e8, Decimal("-0.01"), False, None, None, None, None),
        (0, 0, -0.0, None, None, None, "\t", None, ts("1999-12-31 23:59:59.000001"), ts("2000-01-01 00:00:00")),
    ]
    ddl = "a int, b bigint, c double, d float, e decimal(10,2), f boolean, g string, h date, i timestamp_ntz, j timestamp"
    path = str(tmp_path / "types")
    spark.createDataFrame(data, ddl).coalesce(1).write.parquet(path)
    got = fingerprint.content_fingerprint(spark.read.parquet(path), []).first()
    assert got.fingerprint == oracle_fingerprint(f"{path}/*.parquet")


def test_fingerprint_of_nothing(spark):
    got = fingerprint.content_fingerprint(micro(spark).filter("false"), []).first()
    assert (got.rows, got.fingerprint) == (0, "v1:0::")


def test_format_fingerprint(spark):
    got = spark.range(1).select(
        fingerprint.format_fingerprint(F.lit(173845), F.lit("15454e690ece470aa0aee"), F.lit("8e22f8f5ec55e60e"))
    )
    assert got.first()[0] == "v1:173845:15454E690ECE470AA0AEE:8E22F8F5EC55E60E"


def test_fingerprint_ignores_order_and_counts_copies(spark):
    by = ["uf", "ano", "mes"]
    base = micro(spark)
    plain = rows(fingerprint.content_fingerprint(base, by))
    shuffled = base.orderBy(F.rand(3)).repartition(7)
    assert rows(fingerprint.content_fingerprint(shuffled, by)) == plain
    twice = base.unionByName(base.filter("uf = 'SP'").limit(1))
    changed = fingerprint.compare_fingerprints(
        fingerprint.content_fingerprint(twice, by), fingerprint.content_fingerprint(base, by), by
    )
    assert {(r.uf, r.outcome) for r in changed.collect() if r.outcome != "unchanged"} == {("SP", "changed")}
    # Two copies of one row xor to zero but the sum keeps them apart from none.
    pair = base.limit(1).unionByName(base.limit(1))
    assert fingerprint.content_fingerprint(pair, []).first().fingerprint != "v1:0::"


def test_fingerprint_rows_are_not_shuffled(spark):
    plan = fingerprint.content_fingerprint(micro(spark), ["uf"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_sum") > plan.index("Exchange hashpartitioning(uf")


def test_archived_payload_matches_path_read(spark, tmp_path):
    root = str(tmp_path / "sia-pa")
    sink.write_partitions(micro(spark), root)
    data = records.scan_dataset(spark, root)
    got = fingerprint.content_fingerprint(data, ["uf", "ano", "mes"], fingerprint.archived_payload(data))
    for r in got.collect():
        # The other engine reads the path with its own partition columns.
        path = f"{root}/ano={r.ano}/uf={r.uf}/mes={r.mes:02d}/*.parquet"
        con = duckdb.connect()
        expected = con.execute(
            "SELECT 'v1:' || count(*) || ':' || to_hex(sum(md5_number_lower(to_json(t)::VARCHAR)::HUGEINT)::HUGEINT)"
            f" || ':' || to_hex(bit_xor(md5_number_upper(to_json(t)::VARCHAR))) FROM read_parquet('{path}') t"
        ).fetchall()[0][0]
        assert r.fingerprint == expected


def test_revision_diff(spark):
    old = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), ("c", 3)], "k string, v int")
    new = spark.createDataFrame([("a", 1), ("b", None), ("d", 4), ("d", 4)], "k string, v int")
    diff = fingerprint.revision_diff(old, new)
    assert rows(diff) == [("a", 1, "removed", 1), ("c", 3, "removed", 1), ("d", 4, "added", 2)]
    summary = fingerprint.revision_summary(diff, ["k"])
    assert rows(summary) == [("a", 0, 1, False), ("c", 0, 1, False), ("d", 2, 0, True)]
    assert rows(fingerprint.new_entities(old, new, ["k"])) == [("d",)]


def test_revision_diff_moves_rows_of_differing_groups_only(spark):
    ddl = "k string, v double, g int"
    # Group 1 is equal but for its order, 2 has other copies, 3 swaps pairs that an xor would lose, a row moves from 4 to 5.
    same = [("a", 1.0, 1), ("a", 1.0, 1), ("b", None, 1), (None, 0.0, 1)]
    old = [*same, ("c", 1.0, 2), ("d", 1.0, 3), ("d", 1.0, 3), ("m", 2.0, 4), ("n", 1.0, None)]
    new = [*same[::-1], ("c", 1.0, 2), ("c", 1.0, 2), ("e", 1.0, 3), ("e", 1.0, 3), ("m", 2.0, 5), ("o", 1.0, None)]
    old, new = spark.createDataFrame(old, ddl), spark.createDataFrame(new, ddl)
    assert rows(fingerprint.differing_groups(old, new, ["k", "v"], ["g"])) == [(2,), (3,), (4,), (5,), (None,)]
    diff = fingerprint.revision_diff(old, new, ["k", "v"], ["g"])
    assert rows(diff) == rows(fingerprint.revision_diff(old, new, ["k", "v"]))
    assert rows(diff) == [("c", 1.0, "added", 1), ("d", 1.0, "removed", 2), ("e", 1.0, "added", 2), ("n", 1.0, "removed", 1), ("o", 1.0, "added", 1)]


# --- writers and readers ----------------------------------------------------


def test_write_and_scan(spark, tmp_path):
    root = str(tmp_path / "sia-pa")
    data = micro(spark)
    sink.write_partitions(data, root)
    # Documents kept beside and below the data must not disturb the scan.
    os.makedirs(f"{root}/provenance/ano=2024/uf=SP/mes=01")
    (tmp_path / "sia-pa/provenance/ano=2024/uf=SP/mes=01/part.provenance.json").write_text("{}")
    (tmp_path / "sia-pa/ano=2024/uf=SP/mes=01/part.sources.json").write_text("{}")
    back = records.scan_dataset(spark, root)
    cols = data.columns
    assert rows(back, *cols) == rows(data, *cols)
    assert dict(back.dtypes)["ano"] == "int" and dict(back.dtypes)["mes"] == "int"
    one = records.scan_partition(spark, root, 2024, "SP", 1, ["PA_CMP", "PA_CODUNI"])
    assert one.count() == 100 and one.columns == ["PA_CMP", "PA_CODUNI"]
    codes = [r.PA_CODUNI for r in one.coalesce(1).collect()]
    assert codes == sorted(codes, key=lambda c: (c is None, c))
    counts = verification.partition_row_counts(back)
    assert sum(r.rows for r in counts.collect()) == 300
    assert "ReadSchema: struct<>" in counts._jdf.queryExecution().executedPlan().toString()
    tree = listings.scan_local_tree(spark, str(tmp_path))
    assert {r.dataset for r in tree.collect()} == {"sia-pa"} and tree.count() == counts.count()
    pruned = back.filter("ano = 2024 and uf = 'SP'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in pruned


def test_overwrite_replaces_only_given_partitions(spark, tmp_path):
    root = str(tmp_path / "d")
    data = micro(spark)
    sink.write_partitions(data, root)
    sink.write_partitions(data.filter("uf = 'SP'").limit(5), root)
    back = records.scan_dataset(spark, root)
    assert back.filter("uf = 'SP'").count() == 5 and back.filter("uf <> 'SP'").count() == 200


def test_hot_partition_is_split(spark, tmp_path):
    """One partition with most rows, all copies of one row, is written by several tasks."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    try:
        hot = spark.range(0, 200000, 1, 8).select(
            F.lit("202401").alias("PA_CMP"), F.lit("0000001").alias("PA_CODUNI"), F.lit("SP").alias("uf"),
            F.lit(2024).alias("ano"), F.lit(1).alias("mes"),
        )
        root = str(tmp_path / "hot")
        sink.write_partitions(hot, root)
        files = [f for f in os.listdir(f"{root}/ano=2024/uf=SP/mes=01") if f.endswith(".parquet")]
        assert len(files) > 1
        assert records.scan_dataset(spark, root).count() == 200000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_partitions_that_fit_are_not_cut_for_their_neighbours(spark, tmp_path):
    """Forty partitions of 60 to 70 kB, of which any two are beyond the advisory size together."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    try:
        even = spark.range(0, 160000, 1, 8).select(
            F.lit("202401").alias("PA_CMP"), F.md5(F.col("id").cast("string")).substr(1, 8).alias("PA_CODUNI"),
            F.when(F.col("id") % 40 < 39, F.lit("SP")).alias("uf"), (2000 + F.col("id") % 40).cast("int").alias("ano"), F.lit(1).alias("mes"),
        )
        root = str(tmp_path / "even")
        sink.write_partitions(even, root)
        found = spark.read.parquet(root).select("ano", F.col("_metadata.file_path").alias("file"))
        counts = found.groupBy("ano").agg(F.count_distinct("file").alias("files"), F.count(F.lit(1)).alias("n")).collect()
        assert {(r["files"], r["n"]) for r in counts} == {(1, 4000)} and len(counts) == 40
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_row_groups(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    root = str(tmp_path / "rg")
    data = spark.range(0, 250000, 1, 1).select(
        F.lit("202401").alias("PA_CMP"), F.format_string("%07d", F.col("id")).alias("PA_CODUNI"),
        F.lit("SP").alias("uf"), F.lit(2024).alias("ano"), F.lit(1).alias("mes"),
    )
    sink.write_partitions(data, root)
    (path,) = glob.glob(f"{root}/ano=2024/uf=SP/mes=01/*.parquet")
    meta = pq.ParquetFile(path).metadata
    assert [meta.row_group(i).num_rows for i in range(meta.num_row_groups)] == [100000, 100000, 50000]
    assert meta.row_group(0).column(0).compression == "ZSTD"


def test_vintages_with_drift(spark, tmp_path):
    root = str(tmp_path / "drift")
    a = spark.createDataFrame([("202301", 5, "SP", 2023, 1)], "PA_CMP string, PA_X int, uf string, ano int, mes int")
    b = spark.createDataFrame([("202401", "007", "n", "SP", 2024, 1)], "PA_CMP string, PA_X string, PA_RACACOR string, uf string, ano int, mes int")
    for df in (a, b):
        df.withColumn("mes", F.lpad("mes", 2, "0")).write.mode("append").partitionBy("ano", "uf", "mes").parquet(root)
    with pytest.raises(Exception, match="(?i)merge"):
        records.scan_dataset(spark, root).collect()
    assert records.yearly_vintages(spark, root) == ["ano=2023", "ano=2024"]
    got = records.scan_union_by_name(spark, root)
    assert rows(got, "PA_CMP", "PA_X", "PA_RACACOR", "ano") == [("202301", "5", None, 2023), ("202401", "007", "n", 2024)]
    assert records.drifting_columns([a.schema, b.schema]) == {"PA_X": ["int", "string"]}


def test_scan_records(spark, tmp_path):
    lines = [{"PA_CMP": "202401", "PA_CODUNI": "0000012", "PA_QTDPRO": 3}, {"PA_CMP": "202401", "PA_CODUNI": "0000013"}]
    (tmp_path / "r.ndjson").write_text("\n".join(json.dumps(x) for x in lines))
    schema = SIA_PA.record_schema(["PA_CMP", "PA_CODUNI", "PA_QTDPRO"])
    got = records.scan_records(spark, str(tmp_path), schema)
    assert rows(got) == [("202401", "0000012", 3), ("202401", "0000013", None)]
    (tmp_path / "bad.ndjson").write_text("{broken")
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        records.scan_records(spark, str(tmp_path), schema).collect()
    parts = [got.limit(0), spark.createDataFrame([("x",)], "EXTRA string")]
    assert records.concat_variants(parts).columns == ["PA_CMP", "PA_CODUNI", "PA_QTDPRO", "EXTRA"]


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_object_listing(spark):
    page = json.dumps({"Contents": [{"ETag": '"abc"', "Key": "k", "LastModified": "2026-10-01T16:25:36+00:00", "Size": 169830}]})
    got = listings.parse_object_listing(texts(spark, page, "", "  ", "{}"))
    assert rows(got) == [("k", 169830, "abc", ts("2026-10-01 16:25:36"))]
    good = {"ETag": "e", "Key": "k", "LastModified": "2026-10-01T16:25:36Z", "Size": 1}
    bad = ["{", json.dumps({"Contents": {}})]
    bad += [json.dumps({"Contents": [good, {**good, **c}]}) for c in ({"Size": "1"}, {"Size": 1.5}, {"LastModified": "ontem"}, {"Key": None})]
    for text in bad:
        with pytest.raises(PySparkException, match="invalid object listing"):
            listings.parse_object_listing(texts(spark, text)).count()


def test_object_lines(spark):
    got = listings.parse_object_lines(
        texts(
            spark,
            "2026-01-01 10:00:00    123 sia-pa/ano=2024/uf=SP/mes=01/part.parquet",
            "  2026-01-01 10:00:00 5 sia pa/ano=2024/uf=AC/mes=02/part.parquet  ",
            "2026-01-01 10:00:00 x sia-pa/ano=2024/uf=SP/mes=02/part.parquet",
            "2026-01-01 10:00:00 9",
            "2026-01-01 10:00:00 9 sia-pa/provenance/ano=2024/uf=SP/mes=01/part.provenance.json",
            "",
        )
    )
    assert rows(got) == [("sia pa", "AC", 2024, 2, 5), ("sia-pa", "SP", 2024, 1, 123)]


def test_listing_documents(spark):
    ok = json.dumps([{"mtime": None, "name": "PAAC0802.dbc", "size": 10}, {"mtime": "2026-09-17T17:27:00.000Z", "name": "x", "size": 0}])
    got = listings.parse_listing_documents(texts(spark, ok))
    assert rows(got) == [("PAAC0802.dbc", 10, None), ("x", 0, ts("2026-09-17 17:27"))]
    item = {"mtime": None, "name": "n", "size": 1}
    bad = ["{", "{}"] + [json.dumps([item, x]) for x in ({**item, "size": -1}, {**item, "mtime": "ontem"}, None, {"name": "n", "size": 1})]
    for text in bad:
        with pytest.raises(PySparkException, match="invalid source listing"):
            listings.parse_listing_documents(texts(spark, text)).count()
    with pytest.raises(PySparkException, match="item 1 malformed"):
        listings.parse_listing_documents(texts(spark, bad[2])).count()


def test_pending_documents(spark):
    entry = {"dataset": "sia-pa", "uf": "SP", "year": 2026, "month": 3}
    many = [{**entry, "month": m} for m in range(3, 7)] + [{**entry, "dataset": "sih-rd"}]
    got = documents.parse_pending(texts(spark, json.dumps({"pending": many}), "{}"), "sia-pa")
    assert rows(got) == [("SP", 2026, m) for m in range(3, 7)]
    bad = [{"uf": None}, {"uf": ""}, {"year": "2026"}, {"month": 13}, {"month": 0}, {"dataset": None}]
    for change in bad:
        text = json.dumps({"pending": [{**entry, **change}]})
        with pytest.raises(PySparkException, match="entry 0 malformed"):
            documents.parse_pending(texts(spark, text), "sia-pa").count()
    # Malformed entries of another dataset fail as well.
    with pytest.raises(PySparkException, match="entry 1 malformed"):
        documents.parse_pending(texts(spark, json.dumps({"pending": [entry, {"dataset": "other"}]})), "sia-pa").count()
    for text in ("{", "null", json.dumps({"pending": {}})):
        with pytest.raises(PySparkException, match="invalid pending list"):
            documents.parse_pending(texts(spark, text), "sia-pa").count()


def test_state_documents(spark):
    doc = {"lastRun": "x", "schemaVersion": 1, "processed": {"AC": {"2024-06": {"sourceMtime": "1970-01-01T00:00:00.000Z", "sourceSize": 10}, "2025-07": {"sourceMtime": "2026-01-01T10:00:00.000Z", "sourceSize": 20}}, "SP": {}}}
    state = documents.parse_state(texts(spark, json.dumps(doc)))
    assert rows(state) == [("AC", "2024-06", 10, None), ("AC", "2025-07", 20, ts("2026-01-01 10:00"))]
    back = documents.state_document(state, F.lit("x"))
    assert rows(documents.parse_state(back)) == rows(state)
    assert json.loads(back.first().value)["processed"]["AC"] == doc["processed"]["AC"]


def test_verified_documents(spark):
    doc = {"generatedAt": "g", "rejected": [{"uf": "SP", "year": 2026, "month": 6}], "verified": [{"uf": "AC", "year": 2026, "month": 7}, {"uf": "RJ", "year": 2025, "month": 12}]}
    got = documents.parse_verified(texts(spark, json.dumps(doc)))
    assert rows(got, "key") == [("AC|2026-07",), ("RJ|2025-12",)]
    for text in ("{", "{}", json.dumps({"verified": "x"})):
        with pytest.raises(PySparkException, match="invalid verification"):
            documents.parse_verified(texts(spark, text)).count()


def test_source_files(spark, tmp_path):
    import hashlib

    data = b"\x03\x1a\x0b\x1e" + (26508).to_bytes(4, "little") + b"xyz" * 100
    (tmp_path / "PAAC2401.dbc").write_bytes(data)
    (tmp_path / "note.txt").write_text("x")
    (got,) = listings.scan_source_files(spark, str(tmp_path)).collect()
    assert (got.name, got.bytes, got.sha256) == ("PAAC2401.dbc", len(data), hashlib.sha256(data).hexdigest())


def test_provenance_documents_round_trip(spark, tmp_path):
    docs = spark.createDataFrame([("AC", 2024, 1, '{\n  "a": "é"\n}\n'), ("SP", 2024, 2, "{}\n")], "uf string, ano int, mes int, text string")
    control.write_documents(docs, str(tmp_path), "sia-pa")
    back = documents.scan_provenance(spark, str(tmp_path), "sia-pa")
    assert rows(back, "uf", "ano", "mes", "text") == rows(docs)
    assert back.filter("uf = 'AC'").first().key == "sia-pa/provenance/ano=2024/uf=AC/mes=01/part.provenance.json"
    bad = docs.withColumn("uf", F.lit("../x"))
    with pytest.raises(PySparkException, match="upload refused"):
        control.write_documents(bad, str(tmp_path), "sia-pa")


def test_state_log(spark, tmp_path):
    root = str(tmp_path / "state")

    def entries(size):
        return spark.createDataFrame([("AC", "2024-01", size, None)], "uf string, period string, size bigint, mtime timestamp")

    control.append_state(entries(1), root, 0)
    control.append_state(entries(2), root, 1)
    control.append_state(entries(2), root, 1)
    assert rows(control.latest_state(spark, root)) == [("AC", "2024-01", 2, None)]
    assert rows(control.latest_state(spark, root, before_run=1)) == [("AC", "2024-01", 1, None)]


def test_skip_existing_and_quarantine(spark, tmp_path):
    key = "uf string, ano int, mes int"
    targets = spark.createDataFrame([("AC", 2024, m) for m in (1, 2, 3, 4)], key)
    existing = spark.createDataFrame([("AC", 2024, 1, 10), ("AC", 2024, 2, 0)], key + ", bytes bigint")
    status = spark.createDataFrame([("AC", 2024, 3, "skipped"), ("AC", 2024, 4, "failed")], key + ", status string")
    assert rows(sink.skip_existing(targets, existing, status), "mes") == [(2,), (4,)]
    data = micro(spark)
    rejected = spark.createDataFrame([("SP", 2024, 1)], key)
    kept = sink.quarantine_rejected(data, rejected, str(tmp_path / "rejected"))
    assert kept.count() == 200
    assert records.scan_dataset(spark, str(tmp_path / "rejected")).count() == 100
    outcomes = spark.createDataFrame([("SP", 2024, 1, "unchanged", "f", "p")], key + ", outcome string, fingerprint string, published_at string")
    changed, markers = sink.divert_unchanged(data, outcomes)
    assert changed.count() == 0 and markers.first().status == "unchanged"


def test_reports_and_metrics(spark, tmp_path):
    key = "uf string, ano int, mes int"
    targets = spark.createDataFrame([("SP", 2024, 1), ("AC", 2023, 2), ("AC", 2024, 2)], key)
    written = spark.createDataFrame([("SP", 2024, 1, 100), ("AC", 2023, 2, 5)], key + ", rows bigint")
    assert tuple(control.run_metrics(targets, written).first()) == (3, 1, 105, "AC,SP", "2023,2024")
    seen_df, seen = control.observe_run(targets, "obs")
    seen_df.write.format("noop").mode("overwrite").save()
    assert seen.get["rows_emitted"] == 3
    parts = spark.createDataFrame([("sia-pa", "SP", 2024, 1, 9)], "dataset string, uf string, ano int, mes int, bytes bigint")
    control.write_manifest(catalog.manifest_document(catalog.summarize_manifest(parts), F.lit("g")), str(tmp_path / "manifest"))
    assert json.loads(spark.read.text(str(tmp_path / "manifest")).first().value)["datasets"]["sia-pa"]["bytes"] == 9
    control.write_audit_report(targets, targets.limit(1), targets.limit(1), str(tmp_path / "audit"))
    assert spark.read.parquet(str(tmp_path / "audit/problems")).count() == 3


# --- jobs -------------------------------------------------------------------


def test_a_full_cycle(spark, tmp_path):
    """Listing → pending → archive → verify → unchanged → provenance → manifest → state."""
    names = {"PAAC2401.dbc": ("AC", 1, 3), "PASP2401a.dbc": ("SP", 1, 4), "PASP2401b.dbc": ("SP", 1, 5), "PAMG2402.dbc": ("MG", 2, 6)}
    source = listing(spark, [(n, 100 + i, "2026-01-01T00:00") for i, n in enumerate(names)])
    state = spark.createDataFrame([], "uf string, period string, size bigint, mtime timestamp")
    found = jobs.detect_new(source, state, window_months=12)
    assert rows(found.reasons) == [("novo", 3)] and found.latest_pending.first().newest == "2024-02"
    assert found.previous_newest.first().newest is None

    data = [
        (f"2024{mes:02d}", f"{i:07d}", i, uf, 2024, mes, n)
        for n, (uf, mes, count) in names.items()
        for i in range(count)
    ]
    decoded = spark.createDataFrame(data, "PA_CMP string, PA_CODUNI string, PA_QTDPRO bigint, uf string, ano int, mes int, source_name string")
    # MG is cached at another size than listed: it must fail as a whole.
    cache = spark.createDataFrame(
        [(n, 100 + i + (n == "PAMG2402.dbc"), f"2026-02-0{i + 1}T00:00:00.000Z", f"{i + 1}" * 64) for i, n in enumerate(names)],
        "name string, bytes bigint, mtime string, sha256 string",
    )
    root, lineage_root = str(tmp_path / "sia-pa"), str(tmp_path / "lineage")
    key = "uf string, ano int, mes int"
    status = jobs.archive(
        found.pending.select("uf", "ano", "mes"),
        spark.createDataFrame([], key + ", bytes bigint"),
        spark.createDataFrame([], key + ", status string"),
        source, decoded, cache, root, lineage_root,
    )
    assert rows(status, "uf", "status") == [("AC", "written"), ("MG", "failed"), ("SP", "written")]
    staged = records.scan_dataset(spark, root)
    assert rows(verification.partition_row_counts(staged), "uf", "rows") == [("AC", 3), ("SP", 9)]

    headers = spark.createDataFrame([(f"{SOURCE_DIR}/{n}", c[2]) for n, c in names.items()], "path string, records bigint")
    result, verified, rejected = jobs.verify(found.pending, staged, headers)
    assert rows(result, "uf", "status") == [("AC", "ok"), ("MG", "sem-parquet"), ("SP", "ok")]

    record_texts = spark.read.parquet(lineage_root).withColumn("ano", F.col("ano").cast("int")).withColumn("mes", F.col("mes").cast("int"))
    partitions = record_texts.select("uf", "ano", "mes", "record_text", F.lit(None).cast("string").alias("kept_text"), F.lit("f" * 64).alias("parquet_sha"))
    pipeline = {"archiveScript": "a@1", "datasusSdk": "s@1", "decoder": "d@1"}
    emitted = jobs.emit_provenance(staged, partitions, cache, "sia-pa", F.lit("2026-12-01T00:00:00.000Z"), pipeline)
    assert rows(emitted, "uf", "kind", "problem") == [("AC", "escrito", None), ("SP", "escrito", None)]
    docs = {r.uf: json.loads(r.text) for r in emitted.collect()}
    assert docs["AC"]["source"]["file"] == "PAAC2401.dbc" and "sources" not in docs["AC"]
    assert docs["SP"]["source"] is None and [s["file"] for s in docs["SP"]["sources"]] == ["PASP2401a.dbc", "PASP2401b.dbc"]
    assert docs["SP"]["output"]["rows"] == 9

    control.write_documents(emitted.filter("uf = 'AC'").select("uf", "ano", "mes", "text"), str(tmp_path), "sia-pa")
    published = documents.scan_provenance(spark, str(tmp_path), "sia-pa")
    outcomes, release = jobs.skip_unchanged(verified, staged, published, F.lit("2023-12"))
    assert rows(outcomes, "uf", "outcome") == [("AC", "unchanged"), ("SP", "changed")]
    assert release.first().release == "2024-01"

    manifest = jobs.build_manifest(listings.scan_local_tree(spark, str(tmp_path)))
    assert (manifest.first().partitions, manifest.first().ufs) == (2, ["AC", "SP"])
    assert jobs.build_manifest(listings.scan_local_tree(spark, str(tmp_path)), manifest).count() == 1

    new_state, marked = jobs.mark_processed(state, found.pending, status, verified)
    assert rows(marked, "uf", "outcome") == [("AC", "merged"), ("MG", "not-archived"), ("SP", "merged")]
    again = jobs.detect_new(source, new_state)
    assert rows(again.pending, "uf") == [("MG",)]

    by_name = headers.select(F.element_at(F.split("path", "/"), -1).alias("name"), "records")
    problems, extra, summary = jobs.audit(source, by_name, staged)
    assert rows(problems, "uf") == [("MG",)] and extra.count() == 0 and tuple(summary.first()) == (3, 1, 0, 1)


def test_catchup_job(spark):
    p = "ano=2008/uf=AC/mes=01"
    objects = spark.createDataFrame([(f"sia-pa/{p}/part.parquet", 10, "e", ts("2026-04-25 12:00"))], "key string, size bigint, etag string, last_modified timestamp")
    none = spark.createDataFrame([], "key string, text string")
    pending = spark.createDataFrame([], "uf string, ano int, mes int")
    state = spark.createDataFrame([("AC", "2008-01", 575335, None)], "uf string, period string, size bigint, mtime timestamp")
    cache = spark.createDataFrame([("PAAC0801.dbc", 575335, "2026-04-23T21:57:22.789Z", "5" * 64)], "name string, bytes bigint, mtime string, sha256 string")
    headers = spark.createDataFrame([("PAAC0801.dbc", 5)], "name string, records bigint")

    def described(wanted):
        info = spark.createDataFrame(
            [("AC", 2008, 1, 5, "v1:5:A:B", [("PA_N", "BIGINT")], "1" * 64)],
            "uf string, ano int, mes int, rows bigint, fingerprint string, schema array<struct<name:string,type:string>>, sha256 string",
        )
        return info.join(wanted, ["uf", "ano", "mes"], "left_semi")

    run = jobs.provenance_catchup(
        objects, none, pending, listing(spark, [("PAAC0801.dbc", 575335, "2026-01-01T00:00")]), state, cache, headers,
        described, "sia-pa", F.lit("2026-12-01T00:00:00.000Z"), {"archiveScript": "a", "datasusSdk": "s", "decoder": "d"}, "notes",
    )
    assert rows(run.outcomes, "uf", "outcome") == [("AC", "written")]
    (doc,) = [json.loads(r.text) for r in run.documents.collect()]
    assert list(doc)[-2:] == ["source", "reconstructed"]
    assert doc["reconstructed"]["previous"] is None and doc["reconstructed"]["reason"] == "ausente"

    def with_sources(fetched):
        found = jobs.provenance_catchup(
            objects, none, pending, listing(spark, [("PAAC0801.dbc", 575335, "2026-01-01T00:00")]), state, cache, headers,
            described, "sia-pa", F.lit("2026-12-01T00:00:00.000Z"), {"archiveScript": "a", "datasusSdk": "s", "decoder": "d"}, "notes", fetched=fetched,
        )
        return rows(found.outcomes, "uf", "outcome", "reason"), found.documents.count()

    # A missing source, or one unlike its listing, fails and writes no document.
    assert with_sources(cache.limit(0)) == ([("AC", "failed", "unreadable")], 0)
    assert with_sources(cache.withColumn("bytes", F.lit(7).cast("bigint"))) == ([("AC", "failed", "size-changed")], 0)


def test_nested_numbers_are_printed_as_elsewhere(spark, tmp_path):
    path = str(tmp_path / "nested.parquet")
    con = duckdb.connect()
    con.execute(f"""
      COPY (SELECT * FROM (VALUES
        (1, {{x: 1e8, d: DATE '2024-01-02', t: TIMESTAMP '2024-01-02 03:04:05.5', s: 'q"', e: 1.50::DECIMAL(10,2), n: NULL::INT}},
         [1e10, 1e-5, 1e21, 1e22, 0.1, 17.0, 1e-7, 0.0, -0.0, NULL]::DOUBLE[], [0.1, 1e10, NULL]::FLOAT[],
         MAP{{'k': 1e9::DOUBLE}}, [DATE '2024-01-02'], [{{v: 1e12::DOUBLE}}, NULL], [1, 2]),
        (2, NULL, [], NULL, NULL, [], [], NULL),
        (3, NULL, [0.5, 2], [0.25], MAP{{}}, NULL, [{{v: NULL}}], [NULL])
      ) t(id, s, a, f, m, days, records, whole)) TO '{path}'
    """)
    for columns in ("*", "id, a", "id, f, whole", "id, records", "id, m, days", "id, s"):
        wanted = con.execute(f"SELECT cast(to_json(t) AS varchar) FROM (SELECT {columns} FROM '{path}' ORDER BY id) t").fetchall()
        df = spark.read.parquet(path).orderBy("id").selectExpr(*columns.split(", "))
        assert df.select(fingerprint.row_payload(df)).collect() == wanted


# --- streaming --------------------------------------------------------------


def test_stream_listings(spark, tmp_path):
    src, state_root, pending_root, cp = (str(tmp_path / d) for d in ("in", "state", "pending", "cp"))
    os.makedirs(src)
    schema = "name string, size bigint, mtime timestamp"
    incremental.seed_state(spark.createDataFrame([("AC", "2024-01", 5, None)], "uf string, period string, size bigint, mtime timestamp"), state_root)

    def arrive(n, items):
        lines = [json.dumps({"name": a, "size": b, "mtime": c}) for a, b, c in items]
        (tmp_path / "in" / f"{n}.json").write_text("\n".join(lines))
        stream = spark.readStream.schema(schema).json(src)
        incremental.stream_listings(spark, stream, state_root, pending_root, cp).awaitTermination()
        return rows(spark.read.parquet(pending_root).groupBy("run").pivot("reason", ["novo", "alterado"]).count())

    arrive(0, [("PAAC2401.dbc", 5, None), ("PASP2401.dbc", 7, "2026-01-01T00:00:00Z")])
    assert rows(spark.read.parquet(pending_root), "uf", "period", "reason") == [("SP", "2024-01", "novo")]
    # A late revision of an old period is picked up; an unchanged listing adds nothing.
    arrive(1, [("PAAC2401.dbc", 6, None), ("PASP2401.dbc", 7, "2026-01-01T00:00:00Z")])
    assert rows(spark.read.parquet(pending_root), "uf", "reason") == [("AC", "alterado"), ("SP", "novo")]
    assert rows(control.latest_state(spark, state_root), "uf", "size") == [("AC", 6), ("SP", 7)]


def test_stream_republications(spark, tmp_path):
    src, prints, cp = (str(tmp_path / d) for d in ("in", "prints", "cp"))
    schema = "k string, v bigint"

    def arrive(items):
        spark.createDataFrame(items, schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        incremental.stream_republications(spark, stream, ["k"], prints, cp).awaitTermination()

    arrive([("a", 1), ("a", 2), ("b", 1)])
    arrive([("a", 2), ("a", 1), ("b", 2)])
    got = spark.read.parquet(prints)
    assert rows(got, "run", "k", "changed") == [("0", "a", True), ("0", "b", True), ("1", "a", False), ("1", "b", True)]


def test_a_replayed_run_leaves_nothing_of_its_first_try(spark, tmp_path):
    from partledger.sinks.runs import read_runs, start_log, write_run

    root = str(tmp_path / "log")
    start_log(spark, root, "k string")
    assert read_runs(spark, root, "k string").count() == 0
    frame = lambda *keys: spark.createDataFrame([(k,) for k in keys], "k string")
    write_run(frame("a"), root, 0)
    write_run(frame("b", "c"), root, 1)
    start_log(spark, root, "k string")
    assert rows(read_runs(spark, root)) == [("a", 0), ("b", 1), ("c", 1)]
    write_run(frame("d"), root, 1)
    assert rows(read_runs(spark, root)) == [("a", 0), ("d", 1)]
    write_run(frame(), root, 1)
    assert rows(read_runs(spark, root)) == [("a", 0)]
    # A try without its commit mark is not there.
    stopped = frame("z").withColumn("run", F.lit(2)).withColumn("attempt", F.lit("x"))
    stopped.write.mode("append").partitionBy("run", "attempt").parquet(root)
    assert rows(read_runs(spark, root, "k string")) == [("a", 0)]
    assert read_runs(spark, root, "k string", before_run=0).count() == 0


def test_a_batch_is_replayed_after_its_commit_is_lost(spark, tmp_path):
    from partledger.sinks.runs import read_runs

    src, counts, cp = (str(tmp_path / d) for d in ("in", "counts", "cp"))
    for n in range(2):
        spark.createDataFrame([("a",), ("b",)], "k string").coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema("k string").parquet(src)
        incremental.stream_partition_counts(spark, stream, ["k"], counts, cp).awaitTermination()
    for name in ("1", ".1.crc"):
        os.remove(os.path.join(cp, "commits", name))
    incremental.stream_partition_counts(spark, spark.readStream.schema("k string").parquet(src), ["k"], counts, cp).awaitTermination()
    assert rows(read_runs(spark, counts)) == [("a", 1, 0), ("a", 1, 1), ("b", 1, 0), ("b", 1, 1)]


def test_halves_move_no_rows(spark):
    from checks.analytics_queries import halves
    from checks.derive import read_parquet

    lines = read_parquet(spark, f"{TABLES}/lineitem.parquet")
    parts = halves(lines)
    assert all("Exchange" not in p._jdf.queryExecution().executedPlan().toString() for p in parts)
    assert rows(parts[0].unionByName(parts[1])) == rows(lines)
    # Both halves have rows of nearly every month, so a batch never has a whole partition.
    months = [p.groupBy(F.trunc("l_shipdate", "month")).count().count() for p in parts]
    assert min(months) > 70


def test_reexports_cut_by_batches(spark, tmp_path):
    from partledger.sinks.runs import read_runs

    parts, prints = str(tmp_path / "parts"), str(tmp_path / "prints")
    schema = "k string, v bigint, export int"
    declared = spark.createDataFrame([("a", 1, 3), ("a", 2, 3), ("a", 3, 3), ("b", 1, 1), ("b", 2, 2)], "k string, export int, rows bigint")
    frame = lambda *items: spark.createDataFrame(items, schema)
    handle = incremental.reexport_batch(spark, frame(), ["k"], declared, parts, prints)
    found = lambda: rows(read_runs(spark, prints), "k", "export", "rows", "changed", "run")

    handle(frame(("a", 1, 1), ("a", 1, 1), ("b", 5, 1)), 0)
    assert found() == [("b", 1, 1, True, 0)]
    handle(frame(("a", 2, 1), (None, 9, 1)), 1)
    handle(frame(("a", 2, 2), ("a", 1, 2), ("b", 5, 2)), 2)
    # The same batch again changes nothing; two exports of one partition end together.
    handle(frame(("a", 2, 2), ("a", 1, 2), ("b", 5, 2)), 2)
    handle(frame(("a", 1, 2), ("a", 7, 3), ("a", 7, 3), ("a", 7, 3)), 3)
    assert found() == [("a", 1, 3, True, 1), ("a", 2, 3, False, 3), ("a", 3, 3, True, 3), ("b", 1, 1, True, 0)]
    assert rows(incremental.open_reexports(spark, declared, ["k"], parts)) == [("b", 2, 2, 1)]
    whole = incremental.fingerprint.content_fingerprint(spark.createDataFrame([("a", 1), ("a", 1), ("a", 2)], "k string, v bigint"), ["k"])
    assert whole.first()["fingerprint"] == read_runs(spark, prints).filter("k = 'a' and export = 1").first()["fingerprint"]


def test_stream_counts(spark, tmp_path):
    src, out, cp = (str(tmp_path / d) for d in ("in", "out", "cp"))
    spark.createDataFrame([("a",), ("a",), ("b",)], "k string").write.parquet(src)
    stream = spark.readStream.schema("k string").parquet(src)
    incremental.stream_partition_counts(spark, stream, ["k"], out, cp).awaitTermination()
    assert rows(spark.read.parquet(out).groupBy("k").agg(F.sum("rows"))) == [("a", 2), ("b", 1)]


def test_lineage_type_names(spark):
    assert lineage.type_name(spark.range(1).schema["id"].dataType) == "BIGINT"
    assert delta.newest_period(spark.createDataFrame([], "period string")).first().newest is None
    assert ls.parse_years("2024") == [2024]


def test_lineage_of_other_units_stays_and_empty_targets_stay_pending(spark, tmp_path):
    from partledger.operators import delta
    from partledger.sinks import archive as sink

    lineage_root, data_root = str(tmp_path / "lineage"), str(tmp_path / "data")
    schema = "PA_CMP string, PA_CODUNI string, PA_QTDPRO bigint, uf string, ano int, mes int"
    status = []
    for units in (["AC", "SP"], ["RJ", "MG"]):
        texts = spark.createDataFrame([(u, 2024, 1, "{}") for u in units], "uf string, ano int, mes int, record_text string")
        data = spark.createDataFrame([("202401", "1", 1, u, 2024, 1) for u in units if u != "MG"], schema)
        result = sink.write_lineage_then_data(texts, data, lineage_root, data_root)
        status += rows(result, "uf", "status")
        assert "MG" not in {r.uf for r in delta.archived_status(result).collect()}
    assert status == [("AC", "written"), ("SP", "written"), ("MG", "empty"), ("RJ", "written")]
    assert rows(spark.read.parquet(lineage_root), "uf") == [("AC",), ("RJ",), ("SP",)]
    assert rows(records.scan_dataset(spark, data_root), "uf") == [("AC",), ("RJ",), ("SP",)]


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from partledger.session import shared_folder

    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(cluster, "x")
