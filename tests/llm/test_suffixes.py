"""Suffix sorting and removal of repeats against plain Python."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from partledger.llm import suffixdedup, suffixes

DOCS = "doc_id long, text string"


def plain_order(data):
    return sorted(range(len(data) - 1), key=lambda i: data[i:], reverse=True)


def plain_common(data, a, b, cap):
    k = 0
    while k < cap and max(a, b) + k < len(data) and data[a + k] == data[b + k]:
        k += 1
    return k


@pytest.mark.parametrize("block", [1 << 16, 3])
def test_order_and_common_prefixes(tmp_path, monkeypatch, block):
    """In memory, and with almost everything in scratch files and recursion down to the end."""
    monkeypatch.setattr(suffixes, "BLOCK", block)
    rng = random.Random(5)
    for k in range(150):
        data = bytes(rng.randint(1, rng.randint(1, 5)) for _ in range(rng.randint(1, 150))) * rng.randint(1, 2) + b"\0"
        cap, memory, in_memory = rng.randint(1, 12), rng.choice([1, 300, 10**6]), rng.choice([1, 30, 10**6])
        folder = tmp_path / f"{block}-{k}"
        folder.mkdir()
        text = np.frombuffer(data, np.uint8).astype(rng.choice([np.uint8, np.uint16]))
        got = list(suffixes.with_common_prefixes(text, cap, in_memory, suffixes.Scratch(str(folder), memory)))
        order = [int(p) for positions, _ in got for p in positions]
        assert order == plain_order(data)
        common = [int(c) for _, lengths in got for c in lengths]
        assert common == [0] + [plain_common(data, a, b, cap) for a, b in zip(order, order[1:])]


def brute(rows, length):
    """Spans and kept bytes of every row."""
    texts = [(t or "").encode() for _, t in rows]
    uses = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc_id, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if uses[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        edges = [i for i in range(len(t) + 1) if (gone[i] if i < len(t) else 0) != (gone[i - 1] if i else 0)]
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((doc_id, tuple(zip(edges[::2], edges[1::2])), kept))
    return sorted(out, key=repr)


def some_rows():
    rng = random.Random(3)

    def noise(n):
        return "".join(rng.choice("abcdé ") for _ in range(n))

    passage, other = noise(70), noise(45)
    rows = [(k, noise(rng.randint(0, 60)) + passage + noise(rng.randint(0, 60))) for k in range(40)]
    rows += [(100 + k, noise(30) + other[: 20 + k] + noise(9)) for k in range(20)]
    rows += [(200, passage), (201, passage), (201, passage), (202, other * 3), (203, "a" * 90), (204, "ab" * 40)]
    rows += [(None, None), (205, None), (206, ""), (None, "short"), (207, "a" * 24), (208, noise(3000) + passage + noise(3000) + other)]
    return rows


def found(spark, rows, **options):
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    got = suffixdedup.remove_repeats(docs, **options).collect()
    return sorted(((r["doc_id"], tuple((s["start"], s["stop"]) for s in r["spans"]), bytes(r["kept"])) for r in got), key=repr)


@pytest.mark.parametrize(
    "options",
    [{"length": 25}, {"length": 25, "hot": 1, "shard_bytes": 500}, {"length": 40, "hot": 3, "memory": 200, "in_memory": 5}, {"length": 1}],
)
def test_removal_against_brute_force(spark, options):
    rows = some_rows()
    assert found(spark, rows, **options) == brute(rows, options["length"])


def test_long_text_is_cut_with_overlap(spark):
    data = [np.random.default_rng(k).integers(97, 123, 50_000, dtype=np.uint8).tobytes() for k in (1, 2)]
    polynomial = suffixdedup.Polynomial(12)
    whole = list(suffixdedup.pieces_of(data[0], 60, polynomial))
    before = suffixdedup.WINDOWS
    try:
        suffixdedup.WINDOWS = 7_001
        parts = list(suffixdedup.pieces_of(data[0], 60, polynomial))
    finally:
        suffixdedup.WINDOWS = before
    for pieces in (whole, parts):
        spans = [suffixdedup.parts_of(s) for _, _, s in pieces]
        assert [w for start, n, _ in spans for w in range(start, start + n)] == list(range(50_000 - 59))
    assert {a for a, _, _ in parts} == {a for a, _, _ in whole}


def test_no_rows_and_clashing_columns(spark):
    assert suffixdedup.remove_repeats(spark.createDataFrame([], DOCS)).count() == 0
    schema = "text string, k1 string, k2 string, spans string, kept string, row string, text_key string, cut string"
    docs = spark.createDataFrame([("x" * 30, *"abcdefg"), ("y", *"abcdefg")], schema)
    got = suffixdedup.remove_repeats(docs, length=10)
    assert got.columns == ["text", "k1", "k2", "row", "text_key", "cut", "spans", "kept"]
    assert sorted(len(r["kept"]) for r in got.collect()) == [0, 1]


def test_lengths_out_of_range(spark):
    with pytest.raises(ValueError):
        suffixdedup.repeated_spans(spark.createDataFrame([], DOCS), length=0)
