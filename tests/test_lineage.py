"""Sources records, choice of sources, documents and the retroactive run."""

import json
from decimal import Decimal

from helpers import SOURCE_DIR, listing, rows, ts
from pyspark.sql import functions as F

from partledger.operators import catchup, lineage
from partledger.operators import listing as ls
from partledger.spec import EMPTY_SHA256

A = ("PAMG2508a.dbc", 166934835, "2026-09-30T22:02:10.000Z", "a" * 64)
B = ("PAMG2508b.dbc", 213060888, "2026-09-30T22:03:10.000Z", "b" * 64)
C = ("PAMG2508c.dbc", 15204829, "2026-09-30T22:04:10.000Z", "c" * 64)
CACHE = "name string, bytes bigint, mtime string, sha256 string"


def entry(f, **change):
    e = {"bytes": f[1], "cacheMtime": f[2], "file": f[0], "ftpMtime": "2026-09-30T21:51:00.000Z", "ftpPath": f"{SOURCE_DIR}/{f[0]}"}
    e.update(change)
    return {k: v for k, v in e.items() if v != "absent"}


def record(files, mes=8, **change):
    r = {"files": files, "partition": {"ano": 2025, "mes": mes, "uf": "MG"}, "version": 1}
    r.update(change)
    return json.dumps(r)


ABC = [entry(A), entry(B), entry(C)]


def test_parse_sources_record(spark):
    texts = {
        record(ABC): None,
        record([entry(A, ftpMtime=None)]): None,
        "{": "record-not-json",
        "null": "record-version",
        record(ABC, version=2): "record-version",
        record(ABC, mes=9): "record-of-other-partition",
        record(ABC, partition=None): "record-partition",
        record([]): "record-without-files",
        record({}): "record-without-files",
        record([None]): "record-file-malformed",
        record([entry(A, file="absent")]): "record-file-malformed",
        record([entry(A, ftpPath=f"{SOURCE_DIR}/other.dbc")]): "record-file-malformed",
        record([entry(A, bytes=0)]): "record-file-malformed",
        record([entry(A, bytes=1.5)]): "record-file-malformed",
        record([entry(A, bytes="5")]): "record-file-malformed",
        record([entry(A, cacheMtime="")]): "record-file-malformed",
        record([entry(A, ftpMtime=5)]): "record-file-malformed",
        record([entry(A, ftpMtime="absent")]): "record-file-malformed",
    }
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    parsed = df.select("i", lineage.parse_sources_record(F.col("t"), F.lit("MG"), F.lit(2025), F.lit(8)).alias("r")).orderBy("i").collect()
    assert [p.r.problem for p in parsed] == list(texts.values())
    assert [f.file for f in parsed[0].r.files] == [A[0], B[0], C[0]]
    assert parsed[1].r.files[0].ftpMtime is None


def choose(spark, text, cache, fallback=False):
    parts = spark.createDataFrame([("MG", 2025, 8, text)], "uf string, ano int, mes int, record_text string")
    return lineage.choose_sources(parts, spark.createDataFrame(cache, CACHE), allow_cache_fallback=fallback).first()


def test_sources_from_record(spark):
    empty_canonical = ("PAMG2508.dbc", 0, "2026-09-30T22:02:05.930Z", EMPTY_SHA256)
    ok = choose(spark, record(ABC), [C, empty_canonical, B, A])
    assert ok.problem is None and ok.from_cache is False
    assert [tuple(s) for s in ok.sources] == [(f[1], f[0], f"{SOURCE_DIR}/{f[0]}", f[2], f[3]) for f in (A, B, C)]
    cases = [
        ([A, B], "not-in-cache", C[0]),
        ([A, (B[0], B[1] - 1, B[2], B[3]), C], "size-differs-from-record", B[0]),
        ([A, (B[0], 0, B[2], EMPTY_SHA256), C], "empty-in-cache", B[0]),
        ([A, (B[0], B[1], "2026-10-07T03:00:00.000Z", B[3]), C], "downloaded-after-archive", B[0]),
        ([A, (B[0], B[1], B[2], "zz"), C], "bad-sha256", B[0]),
    ]
    for cache, problem, file in cases:
        got = choose(spark, record(ABC), cache)
        assert (got.problem, got.problem_file, got.sources) == (problem, file, None)
    # A variant outside the record is ignored, and a recorded lone variant is accepted.
    assert [s.file for s in choose(spark, record(ABC[:2]), [A, B, C]).sources] == [A[0], B[0]]
    assert [s.file for s in choose(spark, record(ABC[:1]), [A]).sources] == [A[0]]
    # The record decides even when the fallback is allowed.
    assert choose(spark, record(ABC), [A, B], fallback=True).problem == "not-in-cache"


def test_record_must_follow_the_rule(spark):
    other = entry(("PAMG2509a.dbc", 1, A[2], A[3]))
    elsewhere = [entry(f, ftpPath=f"/other/{f[0]}") for f in (A, B, C)]
    for files in (ABC[::-1], [other], elsewhere, [entry(A), entry(A)]):
        assert choose(spark, record(files), [A, B, C]).problem == "record-against-rule"


def test_sources_from_cache(spark):
    assert choose(spark, None, [A, B, C]).problem == "no-record"
    ok = choose(spark, None, [("PAMG2508.dbc", 0, "t", EMPTY_SHA256), B, A, C], fallback=True)
    assert ok.from_cache is True and [s.file for s in ok.sources] == [A[0], B[0], C[0]]
    canonical = ("PAMG2508.dbc", 9, "t", "d" * 64)
    assert [s.file for s in choose(spark, None, [A, canonical], fallback=True).sources] == ["PAMG2508.dbc"]
    cases = [
        ([A, C], "variant-gap"),
        ([B, C], "variant-gap"),
        ([A, (B[0], 0, B[2], EMPTY_SHA256), C], "variant-gap"),
        ([A], "lone-variant"),
        ([], "nothing-in-cache"),
        ([("PAMG2508.dbc", 0, "t", EMPTY_SHA256)], "nothing-in-cache"),
        ([("PAMG2508.DBC", 5, "t", "d" * 64)], "nothing-in-cache"),
        ([A, (B[0], B[1], "", B[3])], "no-mtime"),
    ]
    for cache, problem in cases:
        assert choose(spark, None, cache, fallback=True).problem == problem


def test_emission_outcomes(spark):
    sha = "d" * 64

    def kept(source, out=sha):
        return json.dumps({"output": {"sha256": out}, "source": source})

    good = {"bytes": 1, "sha256": "a" * 64}
    cases = [  # uf, record, kept document -> kind, legacy, problem, drop
        ("AA", record(ABC).replace("MG", "AA"), None, "escrito", None, None, False),
        ("BB", None, kept(good), "anterior-ao-registro", False, None, False),
        ("CC", None, kept({"bytes": 0}), "anterior-ao-registro", True, None, False),
        ("DD", None, kept(good, "e" * 64), "falhou", None, "other-parquet", True),
        ("EE", None, "{", "falhou", None, "not-json", True),
        ("FF", None, None, "falhou", None, "no-record", False),
        ("GG", "{", kept(good), "falhou", None, "record-not-json", True),
    ]
    cache = [(f[0].replace("MG", "AA"), *f[1:]) for f in (A, B, C)]
    parts = spark.createDataFrame(
        [(u, 2025, 8, r, k, sha) for u, r, k, *_ in cases],
        "uf string, ano int, mes int, record_text string, kept_text string, parquet_sha string",
    )
    chosen = lineage.choose_sources(parts, spark.createDataFrame(cache, CACHE))
    got = lineage.emission_outcomes(chosen)
    assert rows(got, "uf", "kind", "legacy", "problem", "drop_document") == [(c[0], *c[3:]) for c in cases]
    # With the fallback, kept documents are not consulted.
    fallback = lineage.emission_outcomes(lineage.choose_sources(parts, spark.createDataFrame(cache, CACHE), allow_cache_fallback=True), True)
    assert dict(rows(fallback, "uf", "problem"))["BB"] == "nothing-in-cache"


def test_build_sources_record(spark):
    files = spark.createDataFrame(
        [("MG", 2025, 8, 1, "PAMG2508b.dbc", 2, None, "t2"), ("MG", 2025, 8, 0, "PAMG2508a.dbc", 1, ts("2026-09-30 21:51"), "t1")],
        "uf string, ano int, mes int, position int, name string, size bigint, mtime timestamp, cache_mtime string",
    )
    text = lineage.build_sources_record(files).select(lineage.sources_record_text(F.col("record"))).first()[0]
    expected = {
        "files": [
            {"bytes": 1, "cacheMtime": "t1", "file": "PAMG2508a.dbc", "ftpMtime": "2026-09-30T21:51:00.000Z", "ftpPath": f"{SOURCE_DIR}/PAMG2508a.dbc"},
            {"bytes": 2, "cacheMtime": "t2", "file": "PAMG2508b.dbc", "ftpMtime": None, "ftpPath": f"{SOURCE_DIR}/PAMG2508b.dbc"},
        ],
        "partition": {"ano": 2025, "mes": 8, "uf": "MG"},
        "version": 1,
    }
    assert text == json.dumps(expected, indent=2) + "\n"


SCHEMA = [("PA_N", "BIGINT"), ("PA_CODUNI", "VARCHAR"), ("ano", "BIGINT"), ("mes", "VARCHAR"), ("uf", "VARCHAR")]
PIPELINE = {"archiveScript": "archive@1", "datasusSdk": "sdk@2.1.1", "decoder": "dbc@2.0.4"}


def document_row(spark, sources):
    row = ("AC", 2024, 1, 5, "v1:5:1DC05102C17B0D44F:EDAC004461FD6683", SCHEMA, "1" * 64, sources)
    return spark.createDataFrame(
        [row],
        "uf string, ano int, mes int, rows bigint, fingerprint string, schema array<struct<name:string,type:string>>,"
        " sha256 string, sources array<struct<bytes:bigint,file:string,ftpPath:string,mtime:string,sha256:string>>",
    )


def expected_document(**tail):
    return {
        "dataset": "sia-pa",
        "generatedAt": "2026-11-19T20:24:41.059Z",
        "output": {
            "columns": 5,
            "file": "ano=2024/uf=AC/mes=01/part.parquet",
            "fingerprint": "v1:5:1DC05102C17B0D44F:EDAC004461FD6683",
            "rows": 5,
            "schema": [{"name": n, "type": t} for n, t in SCHEMA],
            "sha256": "1" * 64,
        },
        "partition": {"ano": 2024, "mes": 1, "uf": "AC"},
        "pipeline": {**PIPELINE, "notes": "Conversão 1:1 DBC→Parquet, sem filtro, sem enriquecimento."},
        **tail,
    }


SOURCE = {"bytes": 2767043, "file": "PAAC2401.dbc", "ftpPath": f"{SOURCE_DIR}/PAAC2401.dbc", "mtime": "2026-04-23T17:52:39.500Z", "sha256": "b" * 64}


def test_provenance_document(spark):
    def text(sources):
        df = document_row(spark, [tuple(s.values()) for s in sources])
        df = lineage.provenance_body(df, "sia-pa", F.lit("2026-11-19T20:24:41.059Z"), PIPELINE)
        return df.select(lineage.provenance_text(F.col("body"))).first()[0]

    def dump(doc):
        return json.dumps(doc, indent=2, ensure_ascii=False) + "\n"

    assert text([SOURCE]) == dump(expected_document(source=SOURCE))
    assert text([SOURCE, SOURCE]) == dump(expected_document(source=None, sources=[SOURCE, SOURCE]))


def test_reconstructed_document(spark):
    previous = ("2026-05-21T18:33:02.373Z", "d" * 64, {"a": "1"})
    extra = spark.createDataFrame(
        [("AC", ts("2026-01-01"), ts("2026-04-25 12:00"), 575335, previous, "legado")],
        "uf string, ftp_newest_mtime timestamp, last_modified timestamp, state_size bigint,"
        " previous struct<generatedAt:string,outputSha256:string,pipeline:map<string,string>>, reason string",
    )
    df = document_row(spark, [tuple(SOURCE.values())]).join(extra, "uf")
    df = lineage.provenance_body(df, "sia-pa", F.lit("2026-11-19T20:24:41.059Z"), PIPELINE)
    text = catchup.add_reconstruction(df, "how").select(lineage.provenance_text(F.col("body"), True)).first()[0]
    tail = {
        "source": SOURCE,
        "reconstructed": {
            "certification": {
                "dbcRecordCount": 5,
                "ftpNewestMtime": "2026-01-01T00:00:00.000Z",
                "minAgeHours": 24,
                "parquetLastModified": "2026-04-25T12:00:00.000Z",
                "stateSourceSize": 575335,
            },
            "notes": "how",
            "previous": {"generatedAt": previous[0], "outputSha256": previous[1], "pipeline": previous[2]},
            "reason": "legado",
        },
    }
    assert text == json.dumps(expected_document(**tail), indent=2, ensure_ascii=False) + "\n"


def test_describe_output(spark):
    df = spark.createDataFrame([("AC", 2024, 1, "x", Decimal("1.5"))], "uf string, ano int, mes int, c string, d decimal(5,2)")
    got = lineage.describe_output(df).first()
    assert (got.rows, got.columns) == (1, 5)
    assert [tuple(s) for s in got.schema] == [("uf", "VARCHAR"), ("ano", "INTEGER"), ("mes", "INTEGER"), ("c", "VARCHAR"), ("d", "DECIMAL(5,2)")]


def test_validate_provenance(spark):
    docs = document_row(spark, [tuple(SOURCE.values())])
    files = spark.createDataFrame([("PAAC2401.dbc", 2767043, "b" * 64)], "name string, size bigint, sha256 string")
    outputs = docs.select("uf", "ano", "mes", "sha256")
    assert lineage.validate_provenance(docs, files, outputs).count() == 0
    bad = lineage.validate_provenance(docs, files.withColumn("sha256", F.lit("x")), outputs.withColumn("sha256", F.lit("y")))
    assert rows(bad, "name", "problem") == [("PAAC2401.dbc", "source-hash"), ("part.parquet", "output-hash")]
    more = spark.createDataFrame([("PAAC2401.dbc",), ("PAAC2401a.dbc",), ("PAAC2402.dbc",)], "name string")
    assert rows(lineage.listed_but_undocumented(docs, more), "name") == [("PAAC2401a.dbc",)]


def key_of(uf, ano, mes, provenance=False):
    p = f"ano={ano}/uf={uf}/mes={mes:02d}"
    return f"sia-pa/provenance/{p}/part.provenance.json" if provenance else f"sia-pa/{p}/part.parquet"


def test_selection(spark):
    data = [("RJ", 2025, 5), ("AC", 2008, 1), ("AC", 2008, 2), ("AM", 2008, 1), ("SP", 2023, 1), ("PR", 2024, 7), ("MG", 2025, 8)]
    current = json.dumps({"output": {}, "source": {"bytes": 1, "sha256": "5" * 64}})
    legacy = json.dumps({"generatedAt": "g", "output": {"sha256": "d"}, "pipeline": {"x": "y"}, "source": {"bytes": 0}})
    texts = {
        key_of("RJ", 2025, 5, True): legacy,
        key_of("AC", 2008, 2, True): current,
        key_of("PR", 2024, 7, True): "{",
        key_of("MG", 2025, 8, True): json.dumps({"source": None, "sources": []}),
        key_of("TO", 2019, 1, True): current,
    }
    names_ = [key_of(*d) for d in data] + list(texts) + [key_of("SP", 2023, 1, True), "manifest.json"]
    objects = spark.createDataFrame([(k, 1000, "e" * 32, ts("2026-04-25 12:32:18")) for k in names_], "key string, size bigint, etag string, last_modified timestamp")
    documents = spark.createDataFrame(list(texts.items()), "key string, text string")
    parts = catchup.published_partitions(objects, documents, "sia-pa")
    assert rows(parts, "uf", "ano", "mes") == sorted(data)
    pending = spark.createDataFrame([("AM", 2008, 1)], "uf string, ano int, mes int")
    sel = catchup.select_candidates(parts, pending)
    assert rows(sel, "uf", "ano", "selection", "reason") == [
        ("AC", 2008, "candidate", "ausente"),
        ("AC", 2008, "current", None),
        ("AM", 2008, "pending", None),
        ("MG", 2025, "current", None),
        ("PR", 2024, "unreadable", None),
        ("RJ", 2025, "candidate", "legado"),
        ("SP", 2023, "unreadable", None),
    ]
    previous = sel.filter("uf = 'RJ'").first().previous
    assert (previous.generatedAt, previous.outputSha256, previous.pipeline) == ("g", "d", {"x": "y"})
    order = [r.uf for r in catchup.sort_candidates(sel.filter("selection = 'candidate'")).collect()]
    assert order == ["AC", "RJ"]


def test_certify_sources(spark):
    published, ok, late = ts("2026-04-25 12:00"), "2026-04-24T12:00", "2026-04-24T12:01"
    cases = {  # uf -> files, state size, expected (reason, file)
        "AA": ([("PAAA0801.dbc", 575335, ok)], 575335, (None, None)),
        "BB": ([("PABB0801b.dbc", 20, ok), ("PABB0801a.dbc", 10, "2025-06-01T00:00")], 30, (None, None)),
        "CC": ([("PACC0801.dbc", 30, ok), ("PACC0801a.dbc", 10, ok)], 40, (None, None)),
        "DD": ([("PADD0801a.dbc", 10, ok), ("PADD0801b.dbc", 20, late)], 30, ("fonte reescrita depois do archive", "PADD0801b.dbc")),
        "EE": ([("PAEE0801.dbc", 575336, ok)], 575335, ("tamanho diferente do state", None)),
        "FF": ([("PAFF0801.dbc", 1, "1970-01-01T00:00")], 1, ("mtime do FTP ilegível", "PAFF0801.dbc")),
        "GG": ([], 1, ("ausente no FTP", None)),
        "HH": ([("PAHH0801.dbc", 1, ok)], None, ("sem entrada no state", None)),
        "II": ([("PAII0801.DBC", 1, ok)], 1, ("ausente no FTP", None)),
        "JJ": ([("PAJJ0801a.dbc", 1, late), ("PAJJ0801b.dbc", 1, None)], 9, ("fonte reescrita depois do archive", "PAJJ0801a.dbc")),
    }
    candidates = spark.createDataFrame([(u, 2008, 1, published) for u in cases], "uf string, ano int, mes int, last_modified timestamp")
    groups = ls.group_listing(listing(spark, [f for c in cases.values() for f in c[0]]))
    state = spark.createDataFrame([(u, "2008-01", c[1]) for u, c in cases.items() if c[1] is not None], "uf string, period string, size bigint")
    got = catchup.certify_sources(candidates, groups, state)
    assert rows(got, "uf", "skip_reason", "skip_file") == [(u, *c[2]) for u, c in cases.items()]
    files = {r.uf: [f.name for f in r.files] for r in got.collect() if r.files is not None}
    assert files == {"AA": ["PAAA0801.dbc"], "BB": ["PABB0801a.dbc", "PABB0801b.dbc"], "CC": ["PACC0801.dbc"]}
    cache = spark.createDataFrame([("PABB0801a.dbc", 10), ("PACC0801.dbc", 0)], "name string, bytes bigint")
    need = catchup.download_need(got.filter("skip_reason is null"), cache)
    assert rows(need, "uf", "need") == [("AA", 575335), ("BB", 20), ("CC", 30)]


def budget_items(spark, needs):
    data = [("AC", 2008 + i // 12, i % 12 + 1, n) for i, n in enumerate(needs)]
    return spark.createDataFrame(data, "uf string, ano int, mes int, need bigint")


def decisions(df):
    return [r.decision for r in df.orderBy("ano", "mes", "uf").collect()]


def test_budget_prefix_cut(spark):
    gb = 10**9
    got = catchup.budget_prefix_cut(budget_items(spark, [8 * gb, 8 * gb, 8 * gb, 1]), 20 * gb)
    assert decisions(got) == ["selected", "selected", "blocked", "remaining"]
    got = catchup.budget_prefix_cut(budget_items(spark, [0, 5, 0]), 0)
    assert decisions(got) == ["selected", "blocked", "remaining"]
    assert decisions(catchup.budget_prefix_cut(budget_items(spark, [5, 5]), 10)) == ["selected"] * 2
    same_month = spark.createDataFrame([("AC", 2008, 1, 6), ("AL", 2008, 1, 6), ("AC", 2008, 2, 1)], "uf string, ano int, mes int, need bigint")
    assert decisions(catchup.budget_prefix_cut(same_month, 10)) == ["selected", "blocked", "remaining"]


def test_budget_matches_a_plain_loop(spark):
    import random

    rng = random.Random(7)
    data = [(u, y, m, rng.choice([0, 1, 5, 9])) for y in (2008, 2009) for m in range(1, 13) for u in ("AC", "AL", "SP")]
    df = spark.createDataFrame(data, "uf string, ano int, mes int, need bigint").repartition(5)
    for budget in (0, 37, 10**6):
        expected, spent, blocked = [], 0, False
        for _, _, _, need in sorted(data, key=lambda d: (d[1], d[2], d[0])):
            if blocked:
                expected.append("remaining")
            elif spent + need > budget:
                expected.append("blocked")
                blocked = True
            else:
                expected.append("selected")
                spent += need
        assert decisions(catchup.budget_prefix_cut(df, budget)) == expected


def test_run_outcomes(spark):
    cert = spark.createDataFrame([("AC", 2008, 1, None), ("AC", 2008, 2, "ausente no FTP")], "uf string, ano int, mes int, skip_reason string")
    budgeted = spark.createDataFrame([("AC", 2008, 1, "selected"), ("AC", 2008, 3, "selected"), ("AC", 2008, 4, "blocked")], "uf string, ano int, mes int, decision string")
    counts = spark.createDataFrame([("AC", 2008, 1, None), ("AC", 2008, 3, "mismatch")], "uf string, ano int, mes int, problem string")
    out = catchup.run_outcomes(cert, budgeted, counts)
    assert rows(out, "mes", "outcome", "reason") == [
        (1, "written", None),
        (2, "skipped", "ausente no FTP"),
        (3, "skipped", "linhas diferentes do cabeçalho dos DBCs"),
        (4, "remaining", None),
    ]
    assert rows(catchup.outcome_counts(out)) == [("remaining", 1), ("skipped", 2), ("written", 1)]


def test_reusable_local_objects(spark):
    import hashlib

    data = b"0123456789"
    tag = hashlib.md5(data).hexdigest()
    objects = spark.createDataFrame([("a", 10, tag), ("b", 10, tag), ("c", 9, tag)], "key string, size bigint, etag string")
    local = spark.createDataFrame([("a", 10, bytearray(data)), ("b", 10, bytearray(b"x" * 10)), ("c", 10, bytearray(data))], "key string, size bigint, content binary")
    assert rows(catchup.reusable_local_objects(objects, local), "key") == [("a",)]
