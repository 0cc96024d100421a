"""The Merkle manifest against a tree built in plain Python, and on awkward rows."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from partledger.llm import manifest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes):
    """All levels over ``nodes``, the last of one node."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([sha("".join(low[k : k + 3])) for k in range(0, len(low), 3)])
    return levels


def way(levels, at):
    out = []
    for low in levels[:-1]:
        run = at // 3 * 3
        out.append((at % 3, [d for k, d in enumerate(low[run : run + 3]) if run + k != at]))
        at //= 3
    return out


def brute(rows):
    """doc_id, leaf, subroot, root, proof, folded of every row, by the contract."""
    trees = defaultdict(list)
    for doc_id, text, lang, source, n in rows:
        bare = text
        if text is not None and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
            bare = text.replace("\n", "")
        trees[source].append((doc_id, leaf((doc_id, source, lang, n, text)), leaf((doc_id, source, lang, n, bare))))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    low = {}
    for s in order:
        trees[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        low[s] = climb([r[1] for r in trees[s]])
    top = climb([low[s][-1][0] for s in order]) if order else None
    out = []
    for k, s in enumerate(order):
        for at, (doc_id, own, claim) in enumerate(trees[s]):
            steps = way(low[s], at) + way(top, k)
            digest = claim
            for digit, others in steps:
                digest = sha("".join([*others[:digit], digest, *others[digit:]]))
            proof = sha("".join(d for _, others in steps for d in others))
            out.append((doc_id, own, low[s][-1][0], top[-1][0], proof, digest))
    return sorted(out, key=repr)


def found(spark, rows, levels, **options):
    docs = spark.createDataFrame(rows, DOCS)
    bare = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit("")))
    claim = manifest.leaf_digest(*(F.col(c) for c in FIELDS[:-1]), F.coalesce(bare, F.col("text")))
    made = manifest.build_manifest(docs, FIELDS, claim=claim, levels=levels)
    got = manifest.proofs(made, **options)
    hexed = [F.lower(F.hex(c)) for c in ("leaf", "subroot", "root", "proof", "folded")]
    return made, got, sorted((tuple(r) for r in got.select("leaf_id", *hexed).collect()), key=repr)


AWKWARD = [
    (None, None, None, None, None),
    (None, None, None, None, None),
    (7, "twice\n", "en", "hot", 6),
    (7, "twice\n", "en", "hot", 6),
    (7, "other text of an id", "en", "hot", None),
    (1, "", "de", "", 0),
    (2, "é\n\n" * 3000, "fr", "É", 5),
]


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_against_plain_tree(spark, levels):
    many = [(100 + k, f"line {k}\nend", "en", "hot", k) for k in range(31)]
    lone = [(500 + k, f"text {k}", "en", f"source{k}", k) for k in range(5)]
    rows = AWKWARD + many + lone
    made, _, got = found(spark, rows, levels)
    assert got == brute(rows)
    assert made.records().groupBy("digest").count().filter("count > 1").isEmpty()


def test_repeated_rows_only(spark):
    rows = [(3, "same\n", "en", "s", 1)] * 40
    assert found(spark, rows, 1)[2] == brute(rows)


def test_lone_leaf_and_no_rows(spark):
    rows = [(3, "alone", "en", "s", 1)]
    assert found(spark, rows, 7)[2] == brute(rows)
    assert found(spark, [], 7)[2] == []


def test_some_leaves_and_their_paths(spark):
    rows = [(k, f"text {k}", "en", "s", k) for k in range(20)] + [(50, "x", "en", "t", 1)]
    made, _, _ = found(spark, rows, 1)
    some = made.leaves.filter("leaf_id in (0, 13, 50)")
    got = manifest.proofs(made, some, with_path=True).collect()
    assert sorted(r["leaf_id"] for r in got) == [0, 13, 50]
    for r in got:
        assert r["root"] == r["folded"]
        assert hashlib.sha256(b"".join(r["path"]).hex().encode()).digest() == r["proof"]


def test_clashing_columns(spark):
    rows = [(k, "s", "a", "b", "c", "d") for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, tree string, rank string, total string, _read string")
    got = manifest.proofs(manifest.build_manifest(docs, ["doc_id", "source"]))
    assert got.filter("folded = root").count() == 5
