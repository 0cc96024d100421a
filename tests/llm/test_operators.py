"""The training-data operators against brute force, and on awkward input."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from partledger.llm import (
    decontamination,
    jaccard,
    languages,
    linededup,
    mixing,
    quality_rules,
    sharding,
    site_quality,
    toxicity,
    urlrules,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LETTER = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
VOCABULARY = "the of and river stone house green light under winter harbour letter window garden paper silver".split()


def low(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def prose(seed, n):
    """Words by a rule: the same for the same seed."""
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(VOCABULARY[(x >> 16) % len(VOCABULARY)] + str((x >> 8) % 7))
    return out


def corpus():
    """Documents with copies, near copies, short, empty, long and missing texts, and repeated rows."""
    rows = []
    for k in range(24):
        rows.append((k, " ".join(prose(k, 40 + 9 * k)), "en", f"s{k % 4}", 0))
    base = prose(99, 120)
    for k in range(30):
        words = list(base)
        for j in range(k % 5):
            words[(17 * j + 5 * k) % 120] = f"edit{k}x{j}"
        rows.append((100 + k, " ".join(words), "en", "s0", 0))
    shared = prose(500, 30)
    for k in range(20):
        rows.append((200 + k, " ".join(prose(600 + k, 25) + shared + prose(700 + k, 25)), "de", "s1", 0))
    rows += [
        (300, None, None, None, None),
        (301, "", "en", "s2", 0),
        (302, " \t\n ", "en", None, 0),
        (303, "one two", "en", "s2", 0),
        (304, "ONE\ttwo", "en", "s2", 0),
        (305, "one two three", "en", "s2", 0),
        (306, " ".join(prose(5, 6000)), "fr", "s3", 0),
        (307, "Ü ß 漢字 one two", "de", "s3", 0),
        (None, " ".join(base), "en", "s0", 0),
        (None, "nobody else has this text", "en", "s0", 0),
        (308, "repeated row here again", "en", "s1", 0),
        (308, "repeated row here again", "en", "s1", 0),
    ]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def collected(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


# --- n-gram Jaccard join


def shingles(text, width=4):
    words = SPACE.findall(low(text))
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def brute_components(rows, percent=85):
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)].append(r[0])
    return [(r[0], len(s), min(least[find(i)], default=None) if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets))]


@pytest.mark.parametrize("short_list", [2, 6, 32])
def test_jaccard_equals_brute_force(docs, short_list):
    rows = collected(docs, *DOCS_COLUMNS)
    got = collected(jaccard.similar_documents(docs, short_list=short_list))
    key = lambda t: tuple((x is None, x or 0) for x in t)
    assert sorted(got, key=key) == sorted(brute_components(rows), key=key)


DOCS_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_jaccard_keeps_one_of_each(docs):
    kept = jaccard.keep_one(docs)
    assert kept.columns == DOCS_COLUMNS
    expected = {r[0] for r in brute_components(collected(docs, *DOCS_COLUMNS)) if r[0] is not None and r[0] == r[2]}
    ids = [r[0] for r in collected(kept, "doc_id")]
    assert {i for i in ids if i is not None} == expected
    # Of the rows without an id, the one with a text of its own stays; the other is a copy of row 0.
    assert ids.count(308) == 1 and ids.count(None) == 1


def test_jaccard_of_nothing(empty):
    assert collected(jaccard.similar_documents(empty)) == []


def test_jaccard_ignores_other_columns(docs):
    names = ["n", "cls", "region", "component", "_id"]
    more = docs.withColumns({c: F.lit("x") for c in names})
    got = collected(jaccard.similar_documents(more).filter("doc_id >= 100"))
    assert sorted(got) == sorted(collected(jaccard.similar_documents(docs).filter("doc_id >= 100")))


# --- decontamination


def brute_contamination(rows, items, window=10):
    windows = defaultdict(set)
    for item, text in items:
        words = LETTER.findall(low(text))
        if item is not None and words:
            for i in range(max(1, len(words) - window + 1)):
                windows[tuple(words[i : i + window])].add(str(item))
    result = []
    for r in rows:
        words, hit, found = LETTER.findall(low(r[1])), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(words[i : i + n])]
        result.append((r[0], len(words), len(hit), sorted(found)))
    return result


@pytest.fixture(scope="module")
def benchmark(spark):
    items = [
        (1, " ".join(prose(500, 30)[4:26])),
        (2, " ".join(prose(99, 120)[50:75])),
        (20, " ".join(prose(99, 120)[60:85])),
        (3, "one, TWO!"),
        (4, None),
        (5, "..."),
        (None, "one two three"),
        (6, "nowhere to be found in any of these documents at all " * 3),
        (7, " ".join(prose(5, 6000)[5990:])),
        (7, " ".join(prose(5, 6000)[5990:])),
        (8, "the0 the0 the0 the0 the0 the0 the0 the0 the0 the0 the0 the0"),
    ]
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_decontamination_equals_brute_force(docs, benchmark, block_bytes):
    more = docs.unionByName(
        docs.sparkSession.createDataFrame([(400, "the0 " * 60, None, None, None)], DOCS)
    ).withColumn("found", F.lit("clash"))
    found = decontamination.find_contamination(more, benchmark, block_bytes=block_bytes).collect()
    got = [
        (r["doc_id"], r["found"]["n_words"], sum(s["to"] - s["from"] for s in r["found"]["spans"]), sorted(r["found"]["items"]))
        for r in found
    ]
    expected = brute_contamination(collected(more, "doc_id", "text"), collected(benchmark))
    key = lambda t: (t[0] is None, t)
    assert sorted(got, key=str) == sorted(expected, key=str), key
    assert sum(bool(g[2]) for g in got) > 50


def test_decontamination_cuts_passages(docs, benchmark):
    cleaned = decontamination.remove_contamination(docs, benchmark)
    assert cleaned.columns == DOCS_COLUMNS
    again = brute_contamination(collected(cleaned, *DOCS_COLUMNS), collected(benchmark))
    assert not any(r[2] for r in again)
    before = {r[0]: r[1] for r in corpus() if r[0] is not None}
    after = {r[0]: r[1] for r in collected(cleaned, *DOCS_COLUMNS)}
    assert after[200] == " ".join(prose(600, 25) + prose(500, 30)[:4]) + "  " + " ".join(prose(500, 30)[26:] + prose(700, 25))
    assert after[0] == before[0] and 303 not in after and 300 in after


def test_decontamination_of_nothing(empty, docs, benchmark):
    assert collected(decontamination.find_contamination(empty, benchmark)) == []
    none = decontamination.find_contamination(docs, benchmark.limit(0))
    assert none.filter(F.size("found.spans") > 0).count() == 0
    assert none.filter("found.n_words > 0").count() > 50


# --- mixing


def test_mixing_meets_targets(docs):
    mixed = mixing.mixed_rows(docs, block_words=16).toPandas()
    again = mixing.mixed_rows(docs.repartition(5), block_words=16).toPandas()
    sort = lambda m: m.fillna(-1).sort_values(list(m.columns)).reset_index(drop=True)
    assert sort(mixed).equals(sort(again))
    rows = collected(docs, *DOCS_COLUMNS)
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(SPACE.findall(r[1] or ""))
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    target, free, left = {}, set(names), sum(sizes.values())
    while free:
        unit = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * unit > 3 * sizes[s]}
        if not full:
            target |= {s: weight[s] * unit for s in free}
            break
        target |= {s: 3 * sizes[s] for s in full}
        left -= sum(3 * sizes[s] for s in full)
        free -= full
    assert len(mixed) == len(rows)
    assert (mixed["taken"] <= 3 * mixed["size"]).all()
    source = {r[0]: r[3] for r in rows}
    taken = Counter()
    for r in mixed.itertuples():
        s = source[None if math.isnan(r.doc_id) else int(r.doc_id)]
        if not math.isnan(r.doc_id):
            assert r.source_size == sizes[s] and abs(r.target - target[s]) < 1e-3
        taken[s] += r.taken
    for s in names:
        assert abs(taken[s] - target[s]) <= 17, s


def test_quotas_are_highest_quotients(spark):
    votes = {"a": 1000.0, "b": 370.5, "c": 12.0, "d": 0.0, None: 256.0}
    targets = spark.createDataFrame([(s, int(v), v) for s, v in votes.items()], "source string, source_size long, target double")
    got = collected(mixing.shard_quotas(targets, seed=1, block_words=10, shards=4), "source", "shard", "blocks")
    total = sum(votes.values())
    house = round(total / 10)
    seats = Counter()
    for _ in range(house):
        best = max(votes, key=lambda s: votes[s] / (2 * seats[s] + 1))
        seats[best] += 1
    by_source = Counter()
    for s, _, n in got:
        assert n >= 0
        by_source[s] += n
    assert by_source == seats


def test_mixed_documents_repeat_rows(docs):
    out = mixing.mixed_documents(docs)
    assert out.columns == DOCS_COLUMNS
    assert out.filter("text is null").count() == 0
    most = out.groupBy("doc_id", "text").count().agg(F.max("count")).first()[0]
    assert 1 <= most <= 6  # a repeated row counts twice


def test_mixing_of_nothing(empty, docs):
    assert collected(mixing.mixed_rows(empty)) == []
    silent = docs.filter("text is null")
    assert collected(mixing.mixed_rows(silent), "size", "taken") == [(0, 0)]


# --- sharding


def test_sharding_levels_bytes(docs):
    got = sharding.shard_documents(docs, shards=4).collect()
    assert len(got) == docs.count()
    expected = Counter((r[0], len((r[1] or "").encode()) + 16) for r in corpus())
    assert Counter((r["doc_id"], r["size"]) for r in got) == expected
    weight = Counter()
    for r in got:
        weight[r["shard"]] += r["size"]
    largest = max(n for _, n in expected)
    assert max(weight.values()) - min(weight.values()) <= largest
    for shard in weight:
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in got)))


def test_sharding_edits_its_map(spark, docs, tmp_path):
    loads = sharding.slot_loads(docs.filter("doc_id <> 306"))
    first = sharding.next_map(spark, loads, 4, str(tmp_path), 1)
    second = sharding.next_map(spark, loads, 5, str(tmp_path), 2, first)
    old = {r["virtual_slot"]: r["shard"] for r in first.collect()}
    new = {r["virtual_slot"]: r["shard"] for r in second.collect()}
    assert old.keys() == new.keys()
    moved = [s for s in new if new[s] != old[s]]
    assert 0 < len(moved) < len(new) / 2
    assert {p.name for p in tmp_path.iterdir()} == {"version=1", "version=2"}
    again = sharding.rebalance(new, {r["virtual_slot"]: r["slot_bytes"] for r in second.collect()}, 5)
    assert again == new


def test_sharding_of_nothing(empty):
    assert collected(sharding.shard_documents(empty)) == []


# --- URL rules


URLS = [
    "http://a.net/en/x",
    "https://www.EXAMPLE.net/en/1?q=/fr/",
    "http://example.net/de/",
    "http://example.com/de/1",
    "http://x.example.com/DE/1",
    "http://notexample.com/de/",
    "http://a.org/fr/",
    "http://a.b.org/fr/x#y",
    "http://net",
    "http://net/",
    "http://net?x",
    "http://example.net.evil.com/en/",
    "ftp://user@example.net:80/en/",
    "http://.net/",
    "http://a..example.com/de/x",
    "no scheme/de/",
    "",
    None,
    "http://",
    "http://x-example.net/en/\nsecond",
    "http://example.com-a/de/",
    "http://example.com/de/1",
]


def brute_verdict(url, rules):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (low(m[1]), m[2]) if m else ("", "")
    fit = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule = max(fit)[1:] if fit else (None, urlrules.DEFAULT)
    return host, path, *rule


@pytest.mark.parametrize("partitions", [1, 7])
@pytest.mark.parametrize("more", [[], [("a.b.org", "/", "block"), ("org", "/", "block"), ("example.net", "/", "allow"), ("example.net", "/en/1", "block")]])
def test_url_rules_equal_brute_force(spark, partitions, more):
    rules = [*urlrules.RULES, *more]
    pages = spark.createDataFrame([(k, u, "x") for k, u in enumerate(URLS)], "page_id long, url string, key string")
    got = collected(urlrules.judge_urls(pages, urlrules.rule_table(spark, rules), partitions=partitions))
    assert sorted(got) == [(k, *brute_verdict(u, rules)) for k, u in enumerate(URLS)]


def test_url_rules_of_nothing(spark):
    pages = spark.createDataFrame([(None, "http://a.net/"), (1, "http://a.net/"), (1, "http://a.net/")], "page_id long, url string")
    assert collected(urlrules.judge_urls(pages.limit(0), urlrules.rule_table(spark))) == []
    none = urlrules.judge_urls(pages, urlrules.rule_table(spark).limit(0))
    assert sorted(collected(none, "rule", "verdict"), key=str) == [(None, "allow")] * 3
    assert urlrules.judge_urls(pages, urlrules.rule_table(spark)).filter("rule = 'net/'").count() == 3


# --- line dedup


def test_line_dedup(spark):
    menu = "<nav>Home</nav><!-- x\n<p>unseen</p> --><script>var a = '</p>';</script>"
    rows = [(k, f"http://big.org/{k}", f"{menu}<p>own {k}</p><p>own {k}</p>") for k in range(6)]
    rows += [(10, "http://small.org/1", f"{menu}<p>a</p>"), (11, "http://small.org/2", f"{menu}<p>a</p>")]
    rows += [(20, None, None), (21, "", ""), (None, "http://big.org/z", "plain <b>bold</b> text"), (22, None, "<p>lost</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("line", F.lit(1))
    got = {r["page_id"]: tuple(r)[1:] for r in linededup.drop_boilerplate(pages).collect()}
    assert got[0] == ("big.org", 3, 1, "own 0\nown 0")
    assert got[10] == ("small.org", 2, 0, "Home\na")
    assert got[20] == ("", 0, 0, "") and got[22] == ("", 1, 0, "lost")
    assert got[None] == ("big.org", 1, 0, "plain bold text")
    assert collected(linededup.drop_boilerplate(pages.limit(0))) == []


# --- quality rules


def brute_rules(text):
    t = text or ""
    words = SPACE.findall(t)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in t.split("\n") if SPACE.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in t),
        len(lines) - len(set(lines)),
        len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


def test_quality_rules_equal_brute_force(spark, docs):
    extra = [
        (500, "a b c a b c x y z", None, None, None),
        (501, "same same same same " * 20, None, None, None),
        (502, "l1\nl2\nl1\n \n \nl1\r", None, None, None),
        (503, "*** $$ | <b> & %", None, None, None),
        (504, "\n".join(["one line of text"] * 3) + " ü漢", None, None, None),
    ]
    both = docs.unionByName(spark.createDataFrame(extra, DOCS)).withColumn("n_words", F.lit("clash"))
    labels = spark.createDataFrame([(k, k % 2, None) for k in range(24)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    got = quality_rules.apply_rules(both, labels).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    expected = sorted(((r[0], *brute_rules(r[1])) for r in collected(both, "doc_id", "text")), key=str)
    assert sorted(((r["doc_id"], *(r[n] for n in names)) for r in got), key=str) == expected
    assert not any(r["kept"] for r in got if r["base_failed"])
    trusted = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 24 and r["doc_id"] % 2 and not r["base_failed"]]
    assert all(r["kept"] for r in trusted)
    assert [r["llr"] for r in got if r["doc_id"] == 300] == [0.0]


def test_quality_ratio_is_the_log_likelihood_ratio(spark):
    rows = [(1, "a b a"), (2, "a c"), (3, "d d d d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    weights = quality_rules.gram_weights(docs, spark.createDataFrame([(1,)], "doc_id long"), 1 << 10)
    ten = 1 << 10
    raw, target = 15 + ten, 5 + ten  # words and pairs of all and of the trusted document
    a = (1 + 3, 1 + 2)
    assert round(math.log(a[1] / target) - math.log(a[0] / raw), 4) in weights
    docs = docs.withColumn("text", F.lit(None).cast("string"))
    assert set(quality_rules.gram_weights(docs, spark.createDataFrame([(1,)], "doc_id long"), 8)) == {0.0}


def test_quality_rules_of_nothing(spark, empty, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert collected(quality_rules.apply_rules(empty, labels)) == []
    without = quality_rules.apply_rules(docs, labels)
    assert without.filter("kept = base_failed").count() == 0


# --- toxicity


def toxic_corpus():
    rows, labels = [], []
    for k in range(240):
        words = prose(k, 30 + k % 50)
        toxic = int(k % 4 == 0)
        if toxic:
            words[k % 20] = ("grotbag", "Gr0tbag,", "grоtbags", "plonker", "PLONK3R!")[k % 5]
        if k % 4 == 1:
            words[3] = "plonkington"
        rows.append((k, " ".join(words)))
        labels.append((k, 1, toxic))
    return rows, labels


def test_toxicity_learns_and_scores(spark):
    rows, labels = toxic_corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame(labels + [(None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    lexicon = toxicity.learn(docs.filter("doc_id % 5 <> 1"), table.filter("doc_id % 5 <> 1"))
    scored = toxicity.score_toxicity(docs.withColumn("score", F.lit("clash")), lexicon).collect()
    truth = {r[0]: r[2] for r in labels}
    assert all(r["predicted"] == truth[r["doc_id"]] for r in scored)
    assert all(0 <= r["score"] <= 1 for r in scored)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "x" * 200_000 + " grotbag"), (4, "grotbag"), (4, "grotbag")], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(odd, lexicon).collect()}
    assert got[1] == got[2] == 0 and got[4] > 0.5 and got[3] > 0
    assert collected(toxicity.score_toxicity(docs.limit(0), lexicon)) == []


def test_toxicity_exceptions_and_folding():
    lexicon = toxicity.Lexicon({" plonk": 2.0}, [" plonk wine "], 0.5)
    trie = lexicon.automaton()
    assert lexicon.density("a plonk", trie) > 0
    assert lexicon.density("a plonk wine", trie) == 0
    assert lexicon.density("p1onk рlonk", trie) > 0
    assert lexicon.density("explonk", trie) == 0
    assert toxicity.fold("Ｐl​0nk") == " plonk "


def test_toxicity_without_labels(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    lexicon = toxicity.learn(docs, labels)
    assert toxicity.score_toxicity(docs, lexicon).filter("score > 0").count() == 0


# --- languages


LANGUAGES = {
    "en": "the quick brown fox jumps over a lazy dog while they think that nothing of this is strange at all".split(),
    "de": "der schnelle braune fuchs springt über den faulen hund und sie denken dass nichts davon seltsam ist".split(),
    "fr": "le rapide renard brun saute par dessus un chien paresseux et ils pensent que rien de cela est étrange".split(),
    "es": "el rápido zorro marrón salta sobre un perro perezoso y ellos piensan que nada de esto es extraño".split(),
}


def test_languages_on_held_out_rows(spark):
    rows = []
    for k in range(160):
        lang = list(LANGUAGES)[k % 4]
        words = [LANGUAGES[lang][(7 * k + 3 * j * (1 + k % 5)) % len(LANGUAGES[lang])] for j in range(12 + k % 9)]
        rows.append((k, " ".join(words), lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = languages.learn(docs.filter("doc_id < 120"))
    got = languages.predict_languages(docs.filter("doc_id >= 120"), model).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 38
    assert all(0 <= r["score"] <= 1 for r in got)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 ... 4"), (4, "the dog " * 30_000), (5, "ß")], "doc_id long, text string")
    answers = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in languages.predict_languages(odd, model).collect()}
    assert answers[1] == answers[2] == answers[3] == ("und", 0.0)
    assert answers[4][0] == "en" and answers[5][0] in LANGUAGES


def test_languages_of_nothing(spark, empty, docs):
    model = languages.learn(empty)
    assert collected(languages.predict_languages(empty, model)) == []
    assert {r[0] for r in collected(languages.predict_languages(docs, model), "lang_pred")} == {"und"}


# --- site quality


def test_site_quality_shrinks_to_its_site(spark):
    rows, labels, pages = [], [], []
    for k in range(200):
        bad = k % 10 == 0 or (k < 60 and k % 2 == 0)
        words = prose(k, 60)
        rows.append((k, " ".join(w + "$$$" for w in words) if bad else " ".join(words)))
        labels.append((k, int(not bad), 0))
        if k < 150:
            host = "farm.example.org" if k < 60 else "good.example.org"
            pages.append((k, f"http://{host}/en/{k}"))
    docs = spark.createDataFrame(rows + [(None, None), (900, ""), (5, rows[5][1])], "doc_id long, text string").withColumn("p", F.lit(1))
    table = spark.createDataFrame(labels[:100] + [(None, 1, 1)], "doc_id long, quality int, toxic int")
    sites = site_quality.page_sites(spark.createDataFrame(pages + [(1, None), (2, "x")], "page_id long, url string"))
    got = {r["doc_id"]: r for r in site_quality.judge_quality(docs, sites, table).collect()}
    assert len(got) == 202
    assert all(got[k]["kept"] == bool(labels[k][1]) for k in range(200))
    assert got[1]["path_quality"] < got[61]["path_quality"]
    assert got[1]["host"] == "farm.example.org" and got[1]["path"] == "/en/" and got[180]["host"] is None
    assert collected(site_quality.judge_quality(docs.limit(0), sites, table)) == []
    assert site_quality.judge_quality(docs, sites.limit(0), table.limit(0)).filter("not kept").count() == 0


def test_digest_of_no_items():
    assert hashlib.sha256(b"").hexdigest() == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
