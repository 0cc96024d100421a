"""Listings, deltas, verification, unchanged content, catalog and ordering."""

import json

import pytest
from helpers import SOURCE_DIR, listing, rows, ts
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from partledger.operators import catalog, delta, ordering, unchanged, verification
from partledger.operators import listing as ls
from partledger.spec import UFS


def test_group_listing(spark):
    got = ls.group_listing(
        listing(
            spark,
            [
                ("PAMG2508b.dbc", 20, "2026-09-17T17:27"),
                ("PAMG2508a.dbc", 10, "2026-09-17T17:28"),
                ("PAAC0801.dbc", 5, None),
                ("LEIAME.txt", 1, None),
                ("PAAC0813.dbc", 1, None),
            ],
        )
    ).orderBy("uf")
    ac, mg = got.collect()
    assert (ac.uf, ac.ano, ac.mes, ac["size"], ac.mtime) == ("AC", 2008, 1, 5, None)
    assert (mg["size"], mg.mtime) == (30, ts("2026-09-17 17:28"))
    assert [(v.suffix, v.path) for v in mg.variants] == [
        ("a", f"{SOURCE_DIR}/PAMG2508a.dbc"),
        ("b", f"{SOURCE_DIR}/PAMG2508b.dbc"),
    ]


def test_epoch_is_unknown(spark):
    got = ls.group_listing(listing(spark, [("PAAC0801.dbc", 5, "1970-01-01T00:00"), ("PAAC0801a.dbc", 6, "2020-01-01T00:00")])).first()
    assert got.mtime == ts("2020-01-01") and [v.mtime for v in got.variants] == [None, ts("2020-01-01")]


def test_copies_do_not_grow_the_group(spark):
    copies = spark.range(0, 20000, 1, 4).select(
        F.lit("PASP2401a.dbc").alias("name"), F.lit(2).cast("bigint").alias("size"), F.lit(None).cast("timestamp").alias("mtime")
    )
    got = ls.group_listing(copies.unionByName(listing(spark, [("PASP2401b.dbc", 5, None)]))).first()
    assert got["size"] == 40005 and [v.suffix for v in got.variants] == ["a", "b"]


def test_resolve_partition_files(spark):
    sizes = [142415543, 143198291, 166896052, 198744482, 24123300]
    items = [(f"PASP2608{c}.dbc", s, None) for c, s in zip("abcde", sizes)][::-1]
    items += [("PARR2508.dbc", 7, None), ("PARR2508a.dbc", 8, None)]
    items += [("PAMG2606c.dbc", 3, None), ("PAMG2606a.dbc", 1, None), ("PAMG2606b.dbc", 2, None)]
    items += [("PAAC0801.DBC", 9, None), ("paac0802.dbc", 9, None)]
    got = ls.resolve_partition_files(ls.group_listing(listing(spark, items)))
    assert rows(got, "uf", "position", "name", "size") == sorted(
        [("SP", i, f"PASP2608{c}.dbc", s) for i, (c, s) in enumerate(zip("abcde", sizes))]
        + [("RR", 0, "PARR2508.dbc", 7)]
        + [("MG", i, f"PAMG2606{c}.dbc", i + 1) for i, c in enumerate("abc")]
    )


def test_variant_contiguity(spark):
    items = [
        ("PAAC0101a.dbc", 1), ("PAAC0101c.dbc", 1),
        ("PAAC0102a.dbc", 1),
        ("PAAC0103b.dbc", 1), ("PAAC0103c.dbc", 1),
        ("PAAC0104a.dbc", 1), ("PAAC0104b.dbc", 0), ("PAAC0104c.dbc", 1),
        ("PAAC0105a.dbc", 1), ("PAAC0105b.dbc", 1),
        ("PAAC0106.dbc", 1), ("PAAC0106c.dbc", 1),
        ("PAAC0107.dbc", 0), ("PAAC0107a.dbc", 1), ("PAAC0107b.dbc", 1),
    ]
    groups = ls.group_listing(listing(spark, [(n, s, None) for n, s in items]))
    got = {r.mes: (r.suffixes, r.gap, r.lone_variant) for r in ls.variant_contiguity(groups).collect()}
    assert got == {
        1: ("ac", "b", False),
        2: ("a", None, True),
        3: ("bc", "a", False),
        4: ("ac", "b", False),
        5: ("ab", None, False),
        6: ("", None, False),
        7: ("ab", None, False),
    }


def groups_of(spark, items):
    data = [(u, y, m, s, ts(t) if t else None) for u, y, m, s, t in items]
    return spark.createDataFrame(data, "uf string, ano int, mes int, size bigint, mtime timestamp")


def state_of(spark, items):
    data = [(u, p, s, ts(t) if t else None) for u, p, s, t in items]
    return spark.createDataFrame(data, "uf string, period string, size bigint, mtime timestamp")


KNOWN = [("AC", "2024-06", 10, None), ("AC", "2025-07", 20, None), ("AC", "2026-06", 30, None)]
SEEN = [("AC", 2024, 6, 10, None), ("AC", 2025, 7, 20, None), ("AC", 2026, 6, 30, None)]


def test_select_pending(spark):
    state = state_of(spark, KNOWN)
    fresh = groups_of(spark, SEEN + [("AC", 2026, 7, 40, None)])
    got = delta.select_pending(fresh, state, window_months=13)
    assert rows(got, "period", "reason") == [("2025-07", "janela"), ("2026-06", "janela"), ("2026-07", "novo")]
    assert rows(delta.select_pending(fresh, state), "period", "reason") == [("2026-07", "novo")]
    # Without a delta the window opens nothing.
    assert delta.select_pending(groups_of(spark, SEEN), state, 13).count() == 0
    changed = groups_of(spark, SEEN[:2] + [("AC", 2026, 6, 31, None)])
    assert rows(delta.select_pending(changed, state), "period", "reason") == [("2026-06", "alterado")]
    counts = delta.reason_counts(got)
    assert rows(counts) == [("janela", 2), ("novo", 1)]


def test_legacy_rescan(spark):
    state = state_of(spark, [("AC", "2024-06", 10, None), ("AC", "2024-07", 10, "2026-01-01"), ("AC", "2024-08", 10, None)])
    groups = groups_of(
        spark,
        [("AC", 2024, 6, 10, "2026-11-01"), ("AC", 2024, 7, 10, "2026-01-01"), ("AC", 2024, 8, 10, "2026-10-31")],
    )
    assert delta.select_pending(groups, state).count() == 0
    got = delta.select_pending(groups, state, legacy_since=ts("2026-11-01"))
    assert rows(got, "period", "reason") == [("2024-06", "alterado")]


@pytest.mark.parametrize(
    "published,previous,expected",
    [
        (["2025-10", "2026-09", "2026-03"], "2026-08", "2026-09"),
        (["2026-07"], "2026-08", None),
        (["2026-07", "2026-08"], "2026-08", None),
        (["2025-01", "2026-09"], None, "2026-09"),
        ([], "2026-08", None),
        ([], None, None),
    ],
)
def test_release_period(spark, published, previous, expected):
    df = spark.createDataFrame([(p,) for p in published], "period string")
    assert delta.release_period(df, F.lit(previous).cast("string")).first().release == expected


def keys(spark, items, extra=""):
    return spark.createDataFrame(items, f"uf string, ano int, mes int{extra}")


def test_mark_processed_and_state(spark):
    pending = keys(spark, [("AC", 2026, 6, 11, None), ("AC", 2026, 7, 12, None), ("SP", 2026, 7, 13, None)], ", size bigint, mtime timestamp")
    status = keys(spark, [("AC", 2026, 6, "written"), ("AC", 2026, 7, "skipped"), ("SP", 2026, 7, "failed")], ", status string")
    archived = delta.archived_status(status)
    without = delta.mark_processed(pending, archived)
    assert rows(without, "uf", "mes", "outcome") == [("AC", 6, "merged"), ("AC", 7, "merged"), ("SP", 7, "not-archived")]
    # With verification, a skipped partition stays pending.
    checked = delta.mark_processed(pending, archived, keys(spark, [("AC", 2026, 6)]))
    assert rows(checked, "uf", "mes", "outcome") == [("AC", 6, "merged"), ("AC", 7, "not-verified"), ("SP", 7, "not-archived")]
    state = state_of(spark, [("AC", "2026-06", 1, None), ("AC", "2025-01", 2, None)])
    merged = state_of(spark, [("AC", "2026-06", 11, "2026-08-01"), ("RJ", "2026-06", 5, None)])
    after = delta.upsert_state(state, merged)
    assert rows(after, "uf", "period", "size") == [("AC", "2025-01", 2), ("AC", "2026-06", 11), ("RJ", "2026-06", 5)]
    only = delta.state_vs_published(after, keys(spark, [("AC", 2026, 6), ("TO", 2020, 1)]))
    assert rows(only) == [("AC", "2025-01", "state"), ("RJ", "2026-06", "state"), ("TO", "2020-01", "published")]


def test_detect_upsert_detect_is_noop(spark):
    items = [("PAAC2401.dbc", 5, "2026-01-01T00:00"), ("PASP2401a.dbc", 6, None), ("PASP2401b.dbc", 7, "2026-02-01T00:00")]
    groups = ls.group_listing(listing(spark, items))
    first = delta.select_pending(groups, state_of(spark, []), 12)
    assert first.count() == 2
    state = delta.upsert_state(state_of(spark, []), first)
    assert delta.select_pending(groups, state, 12).count() == 0


def test_verify_partitions(spark):
    pending = ls.group_listing(
        listing(
            spark,
            [(n, 1, None) for n in ("PAAC2401.dbc", "PAAC2402a.dbc", "PAAC2402b.dbc", "PAAC2403.dbc", "PAAC2404.dbc", "PAAC2405a.dbc", "PAAC2405b.dbc")],
        )
    )
    local = keys(spark, [("AC", 2024, 1, 10), ("AC", 2024, 2, 30), ("AC", 2024, 3, 5), ("AC", 2024, 5, 3)], ", rows bigint")
    headers = spark.createDataFrame(
        [(f"{SOURCE_DIR}/{n}", c) for n, c in [("PAAC2401.dbc", 10), ("PAAC2402a.dbc", 10), ("PAAC2402b.dbc", 20), ("PAAC2403.dbc", 6), ("PAAC2404.dbc", 9), ("PAAC2405a.dbc", 3), ("PAAC2405b.dbc", None)]],
        "path string, records bigint",
    )
    got = verification.verify_partitions(pending, local, headers)
    assert rows(got, "mes", "rows", "source_rows", "status") == [
        (1, 10, 10, "ok"),
        (2, 30, 30, "ok"),
        (3, 5, 6, "divergente"),
        (4, None, None, "sem-parquet"),
        (5, 3, None, "ftp-ilegivel"),
    ]
    good, bad = verification.split_verified(got)
    assert (good.count(), bad.count()) == (2, 3)


def test_audit_partitions(spark):
    files = spark.createDataFrame([(n,) for n in ("PAAC2401.dbc", "PAAC2402a.dbc", "PAAC2402b.dbc", "PAAC2403.dbc", "x.txt")], "name string")
    headers = spark.createDataFrame([("PAAC2401.dbc", 10), ("PAAC2402a.dbc", 10), ("PAAC2402b.dbc", 20)], "name string, records bigint")
    published = keys(spark, [("AC", 2024, 1, 10), ("AC", 2024, 2, 31), ("AC", 2024, 12, 7), ("AC", 2019, 1, 7)], ", rows bigint")
    audit = verification.audit_partitions(files, headers, published)
    assert rows(audit, "ano", "mes", "status", "scope") == [
        (2024, 1, "ok", "listed"),
        (2024, 12, None, "published-only"),
        (2024, 2, "divergente", "listed"),
        (2024, 3, "sem-parquet", "listed"),
    ]
    assert tuple(verification.audit_summary(audit).first()) == (3, 2, 1, 3)
    assert rows(verification.only_in_published(audit), "mes") == [(12,)]
    assert rows(verification.audit_problems(audit), "mes") == [(2,), (3,)]


def test_check_record_count(spark):
    outputs = keys(spark, [("AC", 2024, 1, 10), ("AC", 2024, 2, 10), ("AC", 2024, 3, 10)], ", rows bigint")
    headers = keys(spark, [("AC", 2024, 1, 4), ("AC", 2024, 1, 6), ("AC", 2024, 2, 9), ("AC", 2024, 3, 10), ("AC", 2024, 3, None)], ", records bigint")
    got = verification.check_record_count(outputs, headers, ["uf", "ano", "mes"])
    assert rows(got, "mes", "problem") == [(1, None), (2, "mismatch"), (3, "unreadable-header")]


def test_skip_unchanged(spark):
    verified = keys(spark, [("AC", 2026, m) for m in (1, 2, 3, 4)])
    local = keys(spark, [("AC", 2026, 1, 5, "v1:5:A:B"), ("AC", 2026, 2, 5, "v1:5:A:B"), ("AC", 2026, 3, 5, "v1:5:A:B")], ", rows bigint, fingerprint string")

    def doc(fp):
        return json.dumps({"generatedAt": "2026-05-01", "output": {"fingerprint": fp}})

    texts = keys(spark, [("AC", 2026, 1, doc("v1:5:A:B")), ("AC", 2026, 2, doc("v1:5:A:C")), ("AC", 2026, 4, doc("v1:5:A:B"))], ", text string")
    got = unchanged.skip_unchanged(verified, local, unchanged.published_fingerprints(texts))
    assert rows(got, "mes", "outcome", "published_at") == [(1, "unchanged", "2026-05-01"), (2, "changed", None), (3, "changed", None)]
    assert tuple(unchanged.unchanged_summary(got).first()) == (1, 2, 1)
    assert unchanged.release_of_run(got, F.lit("2026-02")).first()[0] == "2026-03"
    assert unchanged.release_of_run(got, F.lit("2026-03")).first()[0] is None


def test_manifest(spark):
    parts = spark.createDataFrame(
        [("sia-pa", "SP", 2024, 2, 10), ("sia-pa", "AC", 2024, 1, 5), ("sia-pa", "AC", 2024, 2, 6), ("sih-rd", "AC", 2023, 12, 1)],
        "dataset string, uf string, ano int, mes int, bytes bigint",
    )
    manifest = catalog.summarize_manifest(parts)
    sia = manifest.filter("dataset = 'sia-pa'").first()
    assert (sia.bytes, sia.partitions, sia.competencias, sia.ufs, sia.years) == (21, 3, ["2024-01", "2024-02"], ["AC", "SP"], [2024])
    doc = json.loads(catalog.manifest_document(manifest, F.lit("2026-12-01T00:00:00.000Z")).first().value)
    assert list(doc["datasets"]) == ["sia-pa", "sih-rd"] and doc["generatedAt"] == "2026-12-01T00:00:00.000Z"
    assert doc["datasets"]["sih-rd"] == {"bytes": 1, "competencias": ["2023-12"], "partitions": 1, "ufs": ["AC"], "years": [2023]}
    announced = catalog.manifest_partitions(manifest, "sia-pa", ufs=["AC"], since="2024-02")
    assert rows(announced) == [("AC", 2024, 2, "sia-pa/ano=2024/uf=AC/mes=02/part.parquet")]
    assert catalog.manifest_partitions(manifest, "sia-pa", prefix="2024").count() == 4
    smaller = catalog.summarize_manifest(parts.filter("bytes > 5"))
    assert rows(catalog.manifest_regressions(smaller, manifest), "dataset", "partitions") == [("sia-pa", 2), ("sih-rd", None)]
    assert catalog.guard_manifest(manifest, smaller).count() == 2
    with pytest.raises(PySparkException, match="fewer partitions"):
        catalog.guard_manifest(smaller, manifest).collect()


def test_coverage(spark):
    have = keys(spark, [(u, 2024, m) for u in UFS for m in range(1, 13) if (u, m) not in {("SP", 3), ("AC", 12)}])
    assert rows(catalog.coverage_gaps(have)) == [("AC", 2024, 12), ("SP", 2024, 3)]
    year = catalog.coverage_by_year(have).first()
    assert (year.published, year.expected) == (322, 324)


def test_orders_and_report(spark):
    targets = keys(spark, [("SP", 2026, 2), ("SP", 2026, 1), ("AC", 2025, 12), ("AC", 2026, 1)])
    chrono = [tuple(r) for r in ordering.sort_targets(targets).collect()]
    assert chrono == [("AC", 2025, 12), ("AC", 2026, 1), ("SP", 2026, 1), ("SP", 2026, 2)]
    newest = [tuple(r) for r in ordering.sort_targets(targets, "newest-first").collect()]
    assert newest == [("SP", 2026, 2), ("AC", 2026, 1), ("SP", 2026, 1), ("AC", 2025, 12)]
    with pytest.raises(ValueError):
        ordering.sort_targets(targets, "random")
    by_unit = [tuple(r) for r in ordering.sort_unchanged(targets).collect()]
    assert by_unit == [("AC", 2025, 12), ("AC", 2026, 1), ("SP", 2026, 1), ("SP", 2026, 2)]
    by_year = [tuple(r) for r in ordering.sort_partitions(targets).collect()]
    assert by_year == [("AC", 2025, 12), ("AC", 2026, 1), ("SP", 2026, 1), ("SP", 2026, 2)]
    report = ordering.report_top_n(targets, ["uf", "ano", "mes"], 3).collect()
    assert len(report) == 3 and {r.more for r in report} == {1}
    assert {r.more for r in ordering.report_top_n(targets, ["uf"], 50).collect()} == {0}


def test_target_grid(spark):
    grid = ls.target_grid(spark, ["SP", "AC"], ls.parse_years("2008-2009,2015"), [1, 2])
    assert grid.count() == 12
    assert ls.select_period_listing(grid, ufs=["SP"], years=[2009], months=[2]).count() == 1
    with pytest.raises(ValueError):
        ls.target_grid(spark, ["SP"], [2008], [13])
    with pytest.raises(ValueError):
        ls.parse_years("abc")
