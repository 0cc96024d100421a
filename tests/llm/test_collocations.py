"""Phrases against plain counting, also with fingerprints so narrow that many clash."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest

from partledger.llm import collocations

DOCS = "doc_id long, text string, lang string"
LOWER = {c: c + 32 for c in range(65, 91)}


def counts(rows):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang or "und", tuple(w[i : i + k])] += 1
    return f, n


def brute(rows, top, least):
    f, n = counts(rows)
    found = defaultdict(list)
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    for (lang, p), a in candidates.items():
        cuts = [(10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        inside = (b for (other, q), b in candidates.items() if other == lang and len(q) > len(p) and p in (q[:2], q[1:]))
        if not any(100 * b >= 50 * a for b in inside):
            found[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {
        (lang, rank, p.decode(), -a, left, right, n[lang], -score)
        for lang, all_ in found.items()
        for rank, (score, a, p, left, right) in enumerate(sorted(all_)[:top], 1)
    }


def text_of(seed, n):
    """Words by a rule, with punctuation, tabs, runs of spaces and a few repeated phrases."""
    vocabulary = "Alpha beta gamma delta épsilon zeta eta a a theta".split()
    out, x = [], seed * 7919 + 13
    for k in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(vocabulary[(x >> 12) % len(vocabulary)] + ("", "", "", " ", "\t", ",", ". ", "\n")[(x >> 20) % 8])
    return " ".join(out)


ROWS = (
    [(k, text_of(k, 60), ("en", "de", None, "und")[k % 4]) for k in range(24)]
    + [(None, None, "en"), (None, None, None), (1, "", "en"), (2, " \t\n.;", "fr"), (3, "one", "fr")]
    + [(4, "new york city", "en")] * 30
    + [(5, "x\x0by\x0cz! new  york\tcity new york", "en")] * 3
    + [(6, text_of(99, 40_000), "de")]
)


@pytest.mark.parametrize("bits", [64, 7])
def test_against_plain_counting(spark, bits):
    docs = spark.createDataFrame(ROWS, DOCS).repartition(3)
    got = collocations.mine_collocations(docs, top=40, least=5, bits=bits)
    assert {tuple(r) for r in got.collect()} == brute(ROWS, 40, 5)


def test_ties_end_by_bytes(spark):
    rows = [(1, "b c. é f. z z", "en")] * 10
    got = collocations.mine_collocations(spark.createDataFrame(rows, DOCS), top=2).collect()
    assert {tuple(r) for r in got} == brute(rows, 2, 10)
    assert [r["phrase"] for r in sorted(got, key=lambda r: r["rank"])] == ["b c", "é f"]


def test_no_rows_and_clashing_columns(spark):
    assert collocations.mine_collocations(spark.createDataFrame([], DOCS)).count() == 0
    schema = "text string, lang string, row string, print string, short string, asked string"
    docs = spark.createDataFrame([("p q", "en", "a", "b", "c", "d")] * 12, schema)
    assert [tuple(r) for r in collocations.mine_collocations(docs).collect()] == [("en", 1, "p q", 12, 12, 12, 24, 10**6)]


def test_scores_are_exact_beyond_64_bits(spark):
    many = 3 * 10**13
    known = [("en", 1, "u", many + 1), ("en", 1, "v", many + 2), ("en", 2, "u v", many)]
    row = collocations.scored(spark.createDataFrame(known, "lang string, n int, phrase string, f long")).first()
    assert row["score"] == 10**6 * many * many // ((many + 1) * (many + 2)) == 999999


def test_places_beyond_the_pointer(spark):
    """A pointer whose place is cut off still finds its phrase, by its fingerprint."""
    text = "one two. " + "filler " * 50 + "late phrase"
    runs = collocations.Runs([text.encode()])
    hashers, seeds = collocations.Hashers.new(64), collocations.lang_seeds(["en"])
    runs.hash(hashers)
    word = runs.first_words(2)[-1:]
    mark, check = runs.fingerprints(hashers, word, 2, seeds)
    pointer = collocations.LAST_PLACE << 2 | 2
    asked = [[(int(mark.view("int64")[0]), pointer, int(check[0]))]]
    rows = spark.createDataFrame([(text, "en", asked[0])], "text string, lang string, asked array<struct<print: long, pointer: long, low: int>>")
    got = rows.select(collocations.phrases_udf(64)("text", "lang", "asked").alias("p")).first()["p"]
    assert [(r["n"], r["phrase"]) for r in got] == [(2, "late phrase")]
