import hashlib
import json
import struct

import pytest
from helpers import column_of, rows, ts, value
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partledger.functions import digests, jsontext, names, rules, times
from partledger.spec import DATASETS, EMPTY_SHA256, SIA_PA


def test_source_names(spark):
    good = ["PAAC2401.dbc", "PASP2403a.dbc", "PAMG2312b.dbc", "pasp2403A.dbc", "PASP2608z.dbc"]
    bad = [
        "PAAC2400.dbc", "PAAC2413.dbc", "PASP2608ab.dbc", "PASP26081.dbc", "PAAC2401.dbf",
        "SIHAC2401.dbc", "PAAC2401.dbc\n", "xPAAC2401.dbc", "",
    ]
    got = column_of(spark, good + bad, "string", lambda c: names.parse_source_name(c, SIA_PA))
    assert [tuple(r) for r in got[:5]] == [
        ("AC", 2024, 1, ""),
        ("SP", 2024, 3, "a"),
        ("MG", 2023, 12, "b"),
        ("SP", 2024, 3, "a"),
        ("SP", 2026, 8, "z"),
    ]
    assert got[5:] == [None] * len(bad)


@pytest.mark.parametrize(
    "dataset,name,expected",
    [
        ("sih-rd", "RDSP2401.dbc", ("SP", 2024, 1, "")),
        ("sim", "DOAC2019.dbc", ("AC", 2019, None, "")),
        ("sinasc", "DNRJ2020.dbc", ("RJ", 2020, None, "")),
        ("sinan", "DENGBR19.dbc", ("DENG", 2019, None, "")),
        ("cnes-st", "STMG2512.dbc", ("MG", 2025, 12, "")),
    ],
)
def test_other_datasets(spark, dataset, name, expected):
    assert tuple(value(spark, names.parse_source_name(F.lit(name), DATASETS[dataset]))) == expected


def test_base_and_candidate_names(spark):
    args = (F.lit("MG"), F.lit(2025), F.lit(8))
    assert value(spark, names.source_base_name(SIA_PA, *args)) == "PAMG2508"
    got = value(spark, names.candidate_names(SIA_PA, *args))
    assert got == ["PAMG2508.dbc"] + [f"PAMG2508{c}.dbc" for c in "abcdefghijklmnopqrstuvwxyz"]


def test_partition_keys(spark):
    p = "ano=2025/uf=MG/mes=08"
    keys = [
        f"sia-pa/{p}/part.parquet",
        f"sia-pa/provenance/{p}/part.provenance.json",
        f"sia-pa/provenance/{p}/part.parquet",
        f"sia-pa/{p}/part.provenance.json",
        f"sih-rd/{p}/part.parquet",
        "manifest.json",
        f"sia-pa/../sia-pa/{p}/part.parquet",
        f"/sia-pa/{p}/part.parquet",
        f"sia-pa/{p}/part.parquet.skipped",
    ]
    got = column_of(spark, keys, "string", lambda c: names.parse_partition_key(c, "sia-pa"))
    assert [tuple(r)[1:] if r else None for r in got] == [
        (2025, "MG", 8, "parquet"),
        (2025, "MG", 8, "provenance"),
    ] + [None] * 7
    allowed = column_of(
        spark, keys, "string", lambda c: names.is_provenance_upload_key(c, "sia-pa")
    )
    assert allowed == [False, True] + [False] * 7
    with pytest.raises(PySparkException, match="upload refused"):
        column_of(spark, keys[:1], "string", lambda c: names.require_provenance_upload_key(c, "sia-pa"))
    assert value(spark, names.parquet_key(F.lit("sia-pa"), F.lit(2025), F.lit("MG"), F.lit(8))) == keys[0]
    assert value(spark, names.provenance_key(F.lit("sia-pa"), F.lit(2025), F.lit("MG"), F.lit(8))) == keys[1]
    assert value(spark, names.partition_key(F.lit("MG"), F.lit(2025), F.lit(8))) == "MG|2025-08"


def test_dos_mtime(spark):
    raw = [
        "10-30-26 09:51PM", "01-05-26 12:30AM", "01-05-26 12:30PM", "  10-30-26   09:51pm ",
        "10-30-26 00:05AM", "10-30-26 13:05PM",
        "02-30-26 09:51PM", "13-01-26 09:51PM", "02-10-26 09:60PM", "Oct 30 21:51", "", "00-10-26 09:51PM",
    ]
    got = column_of(spark, raw, "string", times.parse_dos_mtime)
    assert got == [
        ts("2026-10-30 21:51"),
        ts("2026-01-05 00:30"),
        ts("2026-01-05 12:30"),
        ts("2026-10-30 21:51"),
        ts("2026-10-30 00:05"),
        ts("2026-10-30 13:05"),
    ] + [None] * 6


def test_unknown_mtime(spark):
    got = column_of(
        spark, [ts("1970-01-01 00:00"), None, ts("2026-01-01 00:00")], "timestamp", times.is_unknown_mtime
    )
    assert got == [True, True, False]


def test_window_start(spark):
    cases = [("2026-08", 12, "2025-09"), ("2026-01", 2, "2025-12"), ("2026-07", 1, "2026-07"), ("2026-12", 12, "2026-01")]
    for latest, size, start in cases:
        assert value(spark, times.window_start(F.lit(latest), size)) == start
    assert value(spark, times.window_start(F.lit("2026-07"), 0)) is None
    assert value(spark, times.in_window(F.lit("2026-07"), F.lit("2026-07"))) is True
    assert value(spark, times.in_window(F.lit("2026-07"), F.lit(None))) is False
    with pytest.raises(PySparkException, match="invalid period"):
        value(spark, times.window_start(F.lit("2026-7"), 12))


def test_header_record_count(spark):
    def header(n, size=12):
        return bytearray((b"\x03\x1a\x0b\x1e" + struct.pack("<I", n) + b"\0" * 4)[:size])

    got = column_of(
        spark,
        [header(1592573), header(26508), header(2**32 - 1), header(5, 8), header(5, 7)],
        "binary",
        digests.header_record_count,
    )
    assert got == [1592573, 26508, 2**32 - 1, 5, None]


def test_etag(spark):
    data = b"0123456789"
    md5 = lambda b: hashlib.md5(b).digest()
    multi = hashlib.md5(md5(data[:4]) + md5(data[4:8]) + md5(data[8:])).hexdigest()
    simple = md5(data).hex()
    tags = [simple, f'"{simple}"', f"{multi}-3", f"{multi}-2", "not-a-tag", simple.upper(), None]
    got = column_of(
        spark, tags, "string", lambda c: digests.etag_matches(c, F.lit(bytearray(data)), 4)
    )
    assert got == [True, True, True, False, False, False, False]
    assert value(spark, digests.etag_matches(F.lit(f"{multi}-3"), F.lit(bytearray(data)), 5)) is False


def test_swap_and_limb_sum(spark):
    nums = [0, 1, -1, 2**63 - 1, -(2**63), 0x0123456789ABCDEF]
    got = column_of(spark, nums, "bigint", digests.swap_bytes)
    assert [g & (2**64 - 1) for g in got] == [
        int.from_bytes((n & (2**64 - 1)).to_bytes(8, "little"), "big") for n in nums
    ]
    df = spark.createDataFrame([(n,) for n in nums * 50], "v bigint")
    low, middle, high = digests.limbs(F.col("v"))
    sums = df.agg(F.sum(low).alias("l"), F.sum(middle).alias("m"), F.sum(high).alias("h"))
    total = sums.select(digests.limb_sum_hex(F.col("l"), F.col("m"), F.col("h"))).first()[0]
    assert total == format(sum(n & (2**64 - 1) for n in nums) * 50, "X")
    assert value(spark, digests.limb_sum_hex(*[F.lit(0).cast("bigint")] * 3)) == "0"


def test_json_number(spark):
    cases = {
        0.0: "0.0", 17.0: "17.0", 123.45: "123.45", 1e10: "10000000000.0", -1.5e10: "-15000000000.0",
        12345678.9: "12345678.9", 1e-5: "0.00001", -2.5e-4: "-0.00025", 1e-6: "0.000001", 1e-7: "1e-7",
        1e20: "100000000000000000000.0", 1e21: "1e21", 1.5e300: "1.5e300", float("nan"): '"NaN"',
    }
    got = column_of(spark, list(cases), "double", jsontext.json_number)
    assert got == list(cases.values())
    assert column_of(spark, [-0.0], "double", jsontext.json_number) == ["-0.0"]


def test_row_json_mixes_types(spark):
    df = spark.createDataFrame(
        [("a\"\\\n</é", 1, 1e10, None, True), (None, None, None, ts("2024-01-02 03:04:05"), None)],
        "s string, i bigint, d double, t timestamp, b boolean",
    )
    fields = [(f.name, F.col(f.name), f.dataType) for f in df.schema.fields]
    got = [r[0] for r in df.select(jsontext.row_json(fields)).collect()]
    assert got == [
        '{"s":"a\\"\\\\\\n</é","i":1,"d":10000000000.0,"t":null,"b":true}',
        '{"s":null,"i":null,"d":null,"t":"2024-01-02 03:04:05","b":null}',
    ]


def test_pretty_json(spark):
    schema = T.StructType.fromDDL("a string, n int, xs array<struct<k:string>>, e array<int>, m map<string,string>")
    data = ("é\"", None, [("x",), ("y",)], [], {"p": "q"})
    df = spark.createDataFrame([(data,)], T.StructType().add("v", schema))
    got = df.select(jsontext.pretty_json(F.col("v"), schema)).first()[0]
    expected = {"a": "é\"", "n": None, "xs": [{"k": "x"}, {"k": "y"}], "e": [], "m": {"p": "q"}}
    assert got == json.dumps(expected, indent=2, ensure_ascii=False)


def test_has_changed(spark):
    t1, t2 = ts("2026-09-17 17:27"), ts("2026-09-17 17:28")
    df = spark.createDataFrame(
        [(0, 10, t1, 10, t1), (1, 10, t1, 11, t1), (2, 10, t1, 10, t2), (3, 10, None, 10, t2), (4, 10, t1, 10, None), (5, 10, None, 11, None)],
        "i int, ks bigint, km timestamp, s bigint, m timestamp",
    )
    got = df.select("i", rules.has_changed(*[F.col(c) for c in ("ks", "km", "s", "m")]).alias("v"))
    assert [r.v for r in got.orderBy("i").collect()] == [False, True, True, False, False, True]


def test_classify_counts(spark):
    df = spark.createDataFrame(
        [(0, 10, 10), (1, 9, 10), (2, None, None), (3, 10, None), (4, None, 10), (5, 1585442, 1592573)],
        "i int, r bigint, s bigint",
    )
    got = df.select("i", rules.classify_counts(F.col("r"), F.col("s")).alias("v")).orderBy("i").collect()
    assert [r.v for r in got] == ["ok", "divergente", "sem-parquet", "ftp-ilegivel", "sem-parquet", "divergente"]


def provenance(source="absent", **extra):
    body = {"generatedAt": "2026-05-21T18:33:02.373Z", "output": {"sha256": "d" * 64}, **extra}
    if source != "absent":
        body["source"] = source
    return json.dumps(body)


GOOD_SOURCE = {"bytes": 575335, "file": "PAAC0801.dbc", "sha256": "5" * 64}


def test_classify_provenance(spark):
    texts = [
        provenance(GOOD_SOURCE), provenance(None, sources=[GOOD_SOURCE] * 2),
        provenance({**GOOD_SOURCE, "bytes": 0}), provenance({**GOOD_SOURCE, "sha256": ""}),
        provenance({**GOOD_SOURCE, "sha256": EMPTY_SHA256}), provenance({**GOOD_SOURCE, "sha256": 5}),
        provenance(), provenance("x"), "{", "null", "[]", "", None,
    ]
    got = column_of(spark, texts, "string", rules.classify_provenance)
    assert got == ["atual"] * 2 + ["legado"] * 6 + ["ilegivel"] * 5


def test_previous_provenance(spark):
    pipe = {"archiveScript": "z@1", "decoder": "d@2", "another": "a"}
    texts = [
        provenance({"bytes": 0}, pipeline=pipe),
        json.dumps({"generatedAt": 1, "output": None, "pipeline": "x", "source": {"bytes": 0}}),
    ]
    full, bare = column_of(spark, texts, "string", rules.previous_provenance)
    assert full.generatedAt == "2026-05-21T18:33:02.373Z" and full.outputSha256 == "d" * 64
    assert list(full.pipeline.items()) == list(pipe.items())
    assert tuple(bare) == (None, None, None)


def test_published_fingerprint(spark):
    texts = [
        json.dumps({"output": {"fingerprint": "v1:10:AA:BB"}, "generatedAt": "t"}),
        json.dumps({"output": {}}), json.dumps({"output": {"fingerprint": "v0:10:AA:BB"}}),
        json.dumps({"output": {"fingerprint": 42}}), json.dumps({"output": None}), "{", "null", None,
    ]
    assert column_of(spark, texts, "string", rules.published_fingerprint) == ["v1:10:AA:BB"] + [None] * 7
    assert column_of(spark, texts, "string", rules.published_at) == ["t"] + [None] * 7


def test_is_unchanged(spark):
    assert value(spark, rules.is_unchanged(F.lit("a"), F.lit("a"))) is True
    assert value(spark, rules.is_unchanged(F.lit("a"), F.lit("b"))) is False
    assert value(spark, rules.is_unchanged(F.lit("a"), F.lit(None).cast("string"))) is False


def test_assess_kept(spark):
    sha = "d" * 64
    texts = [provenance(GOOD_SOURCE), provenance({"bytes": 0}), provenance(None), json.dumps({"output": {"sha256": "e" * 64}}), "{", json.dumps({"source": None}), "null"]
    got = column_of(spark, texts, "string", lambda c: rules.assess_kept(c, F.lit(sha)))
    assert [tuple(r) for r in got] == [
        (None, False), (None, True), (None, False), ("other-parquet", None), ("not-json", None),
        ("no-output-sha", None), ("no-output-sha", None),
    ]


def test_source_problem(spark):
    df = spark.createDataFrame(
        [(0, 5, 5, "a" * 64, "t"), (1, None, 5, "a" * 64, "t"), (2, 6, 5, "a" * 64, "t"), (3, 5, 5, "A" * 64, "t"), (4, 5, 5, EMPTY_SHA256, "t"), (5, 5, 5, "a" * 64, "")],
        "i int, b bigint, l bigint, s string, m string",
    )
    got = df.select("i", rules.source_problem(*[F.col(c) for c in "blsm"]).alias("v"))
    assert [r[1] for r in rows(got)] == [None, "unreadable", "size-changed", "bad-sha256", "bad-sha256", "no-mtime"]


def test_size_mismatch_and_age(spark):
    assert value(spark, rules.size_mismatch(F.lit(5), F.lit(5))) is None
    assert tuple(value(spark, rules.size_mismatch(F.lit(5), F.lit(4)))) == (5, 4)
    limit = F.lit(ts("2026-04-24 12:00"))
    published = F.lit(ts("2026-04-25 12:00"))
    assert value(spark, rules.old_enough(limit, published, 24)) is True
    assert value(spark, rules.old_enough(F.lit(ts("2026-04-24 12:01")), published, 24)) is False
