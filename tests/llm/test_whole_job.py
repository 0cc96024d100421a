"""Cases in which an operator once did less than the whole job."""

from __future__ import annotations

import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from partledger.llm import languages, quality_rules, site_quality, toxicity
from test_operators import DOCS, brute_components, prose, shingles, toxic_corpus

TABLES = "/root/testdata/sf0.001"


# --- near copies in the pipeline


def near_rows():
    """Bases, each with a copy that has some words appended or replaced."""
    rows = []
    for k in range(8):
        base = prose(900 + k, 120)
        rows.append((10 * k, " ".join(base)))
        rows.append((10 * k + 1, " ".join(base + [f"tail{k}x{j}" for j in range(21 + k)])))
        rows.append((10 * k + 2, " ".join(base[: 100 + k] + [f"new{k}x{j}" for j in range(20 - k)])))
    return [(i, t, "en", "s0", 0) for i, t in rows]


def test_near_copy_stage_equals_brute_force(spark, monkeypatch):
    rows = near_rows()
    sets = {r[0]: shingles(r[1], 5) for r in rows}
    alike = [len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in sets for b in sets if a < b]
    assert sum(0.80 <= x < 0.85 for x in alike) >= 5
    monkeypatch.setattr("test_operators.shingles", lambda text: shingles(text, 5))
    expected = {i for i, _, component in brute_components(rows, 80) if i == component}
    kept = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, DOCS), TABLES)
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted(expected)
    assert len(expected) < len({i for i, _, component in brute_components(rows, 85) if i == component})


# --- sites of a document


def test_site_quality_counts_every_site(spark):
    pages = [(k, f"http://{h}.org/{f}/{k}") for k in range(40) for h, f in (("a", "en"), ("b", "en" if k % 2 else "de"))]
    pages += [(k, f"http://{'z' if k % 3 else 'b'}.org/fr/{k}") for k in range(30)] + [(3, "http://a.org/en/x/3")]
    sites = site_quality.page_sites(spark.createDataFrame(pages, "page_id long, url string"))
    found = {tuple(r) for r in sites.collect()}
    assert sites.count() == len(found) == 110 and {h for _, h, _ in found} == {"a.org", "b.org", "z.org"}

    rows = [(k, " ".join(w + "$" * (k % 4) for w in prose(k, 60 + k))) for k in range(50)] + [(3, " ".join(prose(3, 9)))]
    rows += [rows[5], (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 4 < 2), 0) for k in range(50)], "doc_id long, quality int, toxic int")
    got = site_quality.judge_quality(docs, sites, labels).collect()
    assert len(got) == len(rows)

    # Every document counts on each of its paths and hosts; the two prior weights are as estimated.
    p = [(r["doc_id"], r["doc_quality"]) for r in got]
    mean = sum(x for _, x in p) / len(p)
    on = defaultdict(set)
    for k, h, f in found:
        on[k].add((h, f))
    hosts, paths = defaultdict(list), defaultdict(list)
    for k, x in p:
        for h in {h for h, _ in on[k]}:
            hosts[h].append(x)
        for site in on[k]:
            paths[site].append(x)

    def weight(groups, centre):
        many = {k: v for k, v in groups.items() if len(v) > 1}
        n = sum(map(len, many.values()))
        within = sum(sum(x * x for x in v) - sum(v) ** 2 / len(v) for v in many.values()) / (n - len(many))
        between = sum(len(v) * (sum(v) / len(v) - centre(k)) ** 2 for k, v in many.items()) / n
        rest = max(between - within * sum(1 / len(v) for v in many.values()) / len(many), 1e-9)
        return min(max(within / rest, 2.0), 1000.0)

    wh = weight(hosts, lambda h: mean)
    wp = weight(paths, lambda s: sum(hosts[s[0]]) / len(hosts[s[0]]))
    logit = lambda q: math.log(q / (1 - q))
    for r in got:
        k, x = r["doc_id"], r["doc_quality"]
        if not on[k]:
            assert r["host"] is None and r["path_quality"] == pytest.approx(mean)
            continue
        one = {h: (wh * mean + sum(hosts[h]) - x) / (wh + len(hosts[h]) - 1) for h, _ in on[k]}
        two = [logit((wp * one[s[0]] + sum(paths[s]) - x) / (wp + len(paths[s]) - 1)) for s in on[k]]
        assert (r["host"], r["path"]) == min(on[k])
        assert logit(r["path_quality"]) == pytest.approx(sum(two) / len(two), abs=1e-6)
        assert logit(r["quality"]) == pytest.approx(logit(x) + sum(two) / len(two) - logit(mean), abs=1e-6)


# --- trusted documents


def test_every_trusted_document_counts(spark):
    labels = spark.range(20_500).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    assert quality_rules.trusted_ids(labels).count() == 20_500
    docs = spark.range(20_600).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    assert set(quality_rules.gram_weights(docs.filter("doc_id < 20500"), quality_rules.trusted_ids(labels), 8)) == {0.0}


def test_trusted_fit_is_bounded_and_its_threshold_is_not(spark):
    trusted = spark.range(5000).select(F.col("id").alias("doc_id"))
    some = {r[0] for r in quality_rules.fit_ids(trusted, 500).collect()}
    assert 400 < len(some) < 600 and some == {r[0] for r in quality_rules.fit_ids(trusted.repartition(5), 500).collect()}
    assert quality_rules.fit_ids(trusted, 5000).count() == 5000

    docs = spark.range(400).select(
        F.col("id").alias("doc_id"), F.expr("repeat(concat('w', id % 7, ' v', id % 5, ' '), 3) || repeat('u ', 60 + int(id % 3))").alias("text")
    )
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    got = {r["doc_id"]: r for r in quality_rules.apply_rules(docs, labels, trusted_loss=0.25, fit_rows=20).collect()}
    good = sorted(got[k]["llr"] for k in range(1, 400, 2))
    least = good[math.ceil(0.25 * len(good)) - 1]
    assert all(r["kept"] == (not r["base_failed"] and r["llr"] >= least) for r in got.values())


def test_language_sample_takes_one_row_of_a_repeated_id(spark):
    """An id with two thirds of all rows, and rows without an id, do not fill the sample."""
    rows = [(k, f"the cat and the dog number {k} went home", "en") for k in range(60)]
    rows += [(k, f"le chat et le chien numero {k} rentrent", "fr") for k in range(60, 120)]
    rows += [(7, f"the house {k % 3} is old", "en") for k in range(300)] + [(None, "der hund", "de")] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    original = languages.LanguageModel

    class Spy(original):
        def __init__(self, x, names, *rest):
            seen.append((len(x), sorted(names)))
            super().__init__(x, names, *rest)

    languages.LanguageModel = Spy
    try:
        model = languages.learn(docs)
        again = languages.learn(docs.repartition(7))
    finally:
        languages.LanguageModel = original
    assert seen[0] == seen[1] and seen[0][0] == 121
    assert all((model.machines[k] == again.machines[k]).all() for k in model.machines)
    assert model.predict("the dog and the cat")[0] == "en" and model.predict("le chien et le chat")[0] == "fr"


def test_toxic_sample_takes_one_row_of_a_repeated_id(spark):
    texts, labels = toxic_corpus()
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    copies = docs.filter("doc_id < 3").withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(40)))).select("doc_id", "text")
    assert vars(toxicity.learn(docs, table)) == vars(toxicity.learn(docs.unionByName(copies).repartition(6), table))
