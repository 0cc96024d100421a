"""A task with several Python functions in a row holds a worker for each, and an executor keeps them all."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from partledger.llm import decontamination, jaccard
from test_operators import DOCS, DOCS_COLUMNS, brute_components, collected, prose

ITEMS = [(k, " ".join(prose(500 + k, 30)[3 * k : 3 * k + 12])) for k in range(4)]


def most_in_a_row(node) -> int:
    """The longest row of Python nodes without a shuffle between them."""
    below = max((most_in_a_row(node.children().apply(k)) for k in range(node.children().size())), default=0)
    name = node.nodeName()
    return 0 if name.startswith("Repartition") else below + ("Python" in name or "Arrow" in name)


def workers(df) -> int:
    return most_in_a_row(df._jdf.queryExecution().optimizedPlan())


@pytest.fixture
def stored(monkeypatch):
    """Workers a task of each table that the n-gram Jaccard join stores."""
    seen, store = [], jaccard.store

    def noted(df, purpose):
        seen.append((purpose, workers(df)))
        return store(df, purpose)

    monkeypatch.setattr(jaccard, "store", noted)
    return seen


def test_prefixes_of_whole_sets_take_one_worker(spark, stored):
    # All but one word are in every text, so most regions hold too few shingles that do not come last.
    base = prose(7, 60)
    rows = [(k, " ".join(base[k % 3 :] + [f"own{k}"] + base[: k % 5]), "en", "s0", 0) for k in range(30)]
    got = jaccard.similar_documents(spark.createDataFrame(rows, DOCS), short_list=2).collect()
    assert sorted(map(tuple, got)) == sorted(brute_components(rows, jaccard.PERCENT))
    assert [purpose for purpose, n in stored if n].count("jaccard-prefixes") == 2
    assert max(n for _, n in stored) == 1


@pytest.mark.parametrize("block_bytes, blocks", [(1 << 20, 1), (100, 5)])
def test_cutting_takes_no_worker_besides_the_search(spark, block_bytes, blocks):
    rows = [(k, " ".join(prose(600 + k, 25) + prose(500 + k, 30) + prose(700 + k, 25)), "en", "s0", 0) for k in range(4)]
    docs = spark.createDataFrame([*rows, (9, None, "en", "s0", 0), (10, ITEMS[0][1], "en", "s0", 0)], DOCS)
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string").coalesce(1)
    assert len(list(decontamination.item_blocks(benchmark, block_bytes))) == blocks
    cleaned = decontamination.remove_contamination(docs, benchmark, block_bytes=block_bytes)
    assert workers(cleaned) == blocks
    expected = {9: None}
    for k in range(4):
        part = prose(500 + k, 30)
        expected[k] = " ".join(prose(600 + k, 25) + part[: 3 * k]) + "  " + " ".join(part[3 * k + 12 :] + prose(700 + k, 25))
    assert {r[0]: r[1] for r in collected(cleaned, *DOCS_COLUMNS)} == expected


def brute_rarest(sets, percent):
    """Shingle, set, place and count of prefixes, and each set's centre, from the definition."""
    count = Counter(s for own in sets.values() for s in own)
    out = []
    for cls, own in sets.items():
        order = sorted((count[s] > 1 and (count[s], s) or (1, s)) for s in own)
        room = len(own) - -(-len(own) * percent // 100) + 1
        centre = sum(c for c, _ in order if c > 1) / len(own)
        out += [(s, cls, place, c, round(centre, 9)) for place, (c, s) in enumerate(order[:room]) if c > 1]
    return sorted(out)


@pytest.mark.parametrize("frequent", [100_000, 60, 1])
def test_only_what_can_be_in_a_prefix_is_listed(spark, monkeypatch, frequent):
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    sets, x = {}, 3
    for cls in range(40):
        own = set(range(-50, 50)) - {cls - 20, cls - 19}
        for _ in range(8):
            x = (x * 1103515245 + 12345) % 2**31
            own.add(1000 + (x >> 16) % 150)
        sets[cls] = sorted(own)
    rows = [(c, len(own), bytearray(np.array(own, np.int64).view(np.uint64).tobytes())) for c, own in sets.items()]
    table = spark.createDataFrame(rows, "cls long, n long, shingles binary")
    got = jaccard.rarest_first(table, 80).collect()
    assert sorted((r["shingle"], r["cls"], r["place"], r["c"], round(r["centre"], 9)) for r in got) == brute_rarest(sets, 80)
    if frequent == 100_000:
        listed = jaccard.rarest_candidates(table, jaccard.shared_shingles(table), 80)
        assert workers(listed) == 1
        # Each of the 40 sets has some 106 shingles, of which 22 have room.
        assert listed.count() <= 40 * 24
