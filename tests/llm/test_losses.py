"""Cases in which rows could get lost: repeated ids, NULL ids, slots that were empty, clashing names."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from partledger.llm import jaccard, sharding
from test_operators import brute_components

DOCS = "doc_id long, text string"
WORDS = "the of and river stone house green light under winter harbour letter window garden paper silver".split()


def text(seed, n=40):
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(WORDS[(x >> 16) % len(WORDS)])
    return " ".join(out)


def kept(spark, rows, **options):
    return sorted((tuple(r) for r in jaccard.keep_one(spark.createDataFrame(rows, DOCS), **options).collect()), key=repr)


def test_an_id_of_two_texts_loses_neither(spark):
    a, b = text(1), text(2)
    assert kept(spark, [(1, a), (2, a), (2, b)]) == [(1, a), (2, b)]


def test_near_copies_under_one_id_or_none(spark):
    a, b, c = text(1), text(2), text(3)
    near = a + " end"
    got = kept(spark, [(5, a), (5, near), (None, b), (None, b), (None, b + " end"), (None, c), (9, c)])
    assert len(got) == 3
    assert {r[0] for r in got} == {5, None, 9}
    assert [t for i, t in got if i == 9] == [c]


def test_rows_without_words_stay(spark):
    rows = [(1, None), (1, None), (None, ""), (2, "  \t"), (3, text(4)), (3, text(4))]
    assert kept(spark, rows) == sorted([*rows[:4], rows[4]], key=repr)


def test_clashing_columns(spark):
    a, b = text(1), text(2)
    names = ["row", "id", "text_hash", "component", "cls", "best", "n", "_drop", "_again", "slot", "_slot", "shard"]
    docs = spark.createDataFrame([(1, a, *names), (2, a, *names), (3, b, *names)], f"{DOCS}, " + ", ".join(f"{c} string" for c in names))
    out = jaccard.keep_one(docs)
    assert out.columns == docs.columns and sorted(r["doc_id"] for r in out.collect()) == [1, 3]
    placed = sharding.assign_shards(docs, sharding.next_map(spark, sharding.slot_loads(docs), 4, sharding.new_folder(spark, "t"), 1))
    assert placed.columns == [c for c in docs.columns if c != "shard"] + ["shard", "virtual_slot"]
    assert placed.count() == 3


def test_a_map_serves_records_that_come_later(spark, tmp_path):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    first = sharding.next_map(spark, sharding.slot_loads(docs.filter("doc_id < 100")), 7, str(tmp_path), 1)
    assert first.count() == sharding.SLOTS
    placed = sharding.assign_shards(docs, first)
    assert placed.count() == 300
    second = sharding.next_map(spark, sharding.slot_loads(docs), 7, str(tmp_path), 2, first)
    moved = first.join(second.withColumnRenamed("shard", "now"), "virtual_slot").filter("shard <> now").count()
    assert second.count() == sharding.SLOTS and moved < 200


# --- groups of one size and prefix in the n-gram Jaccard join


def crowd_of_short_texts():
    """Texts of few shingles from few words: many sets have their size and short prefix in common."""
    rows, x = [], 5
    for k in range(500):
        words = []
        x = (x * 1103515245 + 12345) % 2**31
        for _ in range(5 + (x >> 16) % 8):
            x = (x * 1103515245 + 12345) % 2**31
            words.append("abc"[(x >> 16) % 3])
        rows.append((k, " ".join(words)))
    return rows + [(500, None), (None, rows[7][1]), (3, rows[3][1])]


@pytest.mark.parametrize("percent, short_list, piece", [(50, 4, 3), (70, 1000, 2), (85, 1000, 512)])
def test_groups_equal_brute_force(spark, monkeypatch, percent, short_list, piece):
    rows = crowd_of_short_texts()
    monkeypatch.setattr(jaccard, "LIST_PIECE", piece)
    groups, original = [], jaccard.prefix_groups

    def seen(prefixes):
        groups.append(original(prefixes))
        return groups[0]

    monkeypatch.setattr(jaccard, "prefix_groups", seen)
    docs = spark.createDataFrame(rows, DOCS)
    got = [tuple(r) for r in jaccard.similar_documents(docs, percent=percent, short_list=short_list).collect()]
    expected = brute_components([(*r, None, None, None) for r in rows], percent)
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    # Groups there are, and some whose members are not all alike.
    assert groups[0].count() > groups[0].select("gid").distinct().count() > 0


def test_parity_maps_keep_similar_pairs(spark):
    """The share of differing bits never exceeds the sets' difference, and tells most others apart."""
    import numpy as np

    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 300, dtype=np.uint64)
    sets = [np.sort(np.concatenate([base[k:], rng.integers(0, 2**63, k, dtype=np.uint64)])) for k in range(0, 150, 3)]
    table = spark.createDataFrame([(k, v.tobytes()) for k, v in enumerate(sets)], "cls long, shingles binary")
    maps = jaccard.with_parity(table)
    left = maps.select(F.col("cls").alias("a"), F.col("n").alias("an"), F.col("parity").alias("ap"), F.lit(1).alias("k"))
    right = maps.select(F.col("cls").alias("b"), F.col("n").alias("bn"), F.col("parity").alias("bp"), F.lit(1).alias("k"))
    passed = {(r["a"], r["b"]) for r in left.join(right, "k").filter("a < b").filter(jaccard.parity_fits(85)).collect()}
    alike = {
        (a, b)
        for a in range(len(sets))
        for b in range(a + 1, len(sets))
        if 100 * len(np.intersect1d(sets[a], sets[b])) >= 85 * len(np.union1d(sets[a], sets[b]))
    }
    assert alike <= passed and len(passed) < len(sets) * (len(sets) - 1) / 4
