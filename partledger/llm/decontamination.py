"""Benchmark decontamination with an FM-index per training shard."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partledger.llm.words import BY_LETTER, pieces, split_words

#: Words of a test phrase.
WINDOW = 10
#: Text of benchmark items that one pass over the documents searches, in bytes.
ITEM_BLOCK_BYTES = 32 << 20
#: Every so many suffix positions are kept.
SAMPLE_RATE = 16


class RankBits:
    """A bit sequence with the number of ones before each 64-bit word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        packed = np.concatenate([packed, np.zeros(-len(packed) % 8 + 8, np.uint8)])
        self.words = packed.view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones in the first ``i`` bits."""
        word, bit = i >> 6, (i & 63).astype(np.uint64)
        low = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(low)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)


class WaveletTree:
    """Ranks of symbols, one bit sequence a level, highest bit first, zeros sorted before ones."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.levels = []
        for bit in range(max(1, int(largest).bit_length()) - 1, -1, -1):
            ones = (symbols >> bit) & 1 == 1
            self.levels.append((bit, RankBits(ones), int((~ones).sum())))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        first = np.full(largest + 2, 0, np.int64)
        values, at = np.unique(symbols, return_index=True)
        first[values] = at
        self.first = first

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs in the first ``i`` places."""
        for bit, ones, zeros in self.levels:
            before = ones.rank(i)
            i = np.where((symbol >> bit) & 1 == 1, zeros + before, i - before)
        return i - self.first[symbol]

    def symbol_and_rank(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at place ``i`` and how often it occurs before."""
        symbol = np.zeros(len(i), np.int64)
        for bit, ones, zeros in self.levels:
            one, before = ones.get(i) == 1, ones.rank(i)
            symbol = symbol | (one.astype(np.int64) << bit)
            i = np.where(one, zeros + before, i - before)
        return symbol, i - self.first[symbol]


def suffix_order(codes: np.ndarray) -> np.ndarray:
    """Start places of all suffixes in order; code 0 ends a run and counts by its place.

    Prefix doubling: sorted by 1, 2, 4 ... symbols until no two suffixes tie. Only suffixes
    still tied are sorted again.
    """
    n = len(codes)
    rank = codes.astype(np.int64).copy()
    ends = rank == 0
    n_ends = int(ends.sum())
    rank[ends] = np.arange(n_ends)
    rank[~ends] += n_ends
    order = np.argsort(rank, kind="stable")
    s = rank[order]
    new = np.concatenate([[True], s[1:] != s[:-1]])
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank[order] = head  # a suffix's rank is the place of the first one tied with it
    step = 1
    while True:
        tied = ~(new & np.concatenate([new[1:], [True]]))
        at = np.flatnonzero(tied)
        if not len(at):
            return order
        suffix = order[at]
        # A tied suffix has no end in its first symbols, so the place after them exists.
        key = rank[suffix] * n + rank[suffix + step]
        by = np.argsort(key, kind="stable")
        order[at] = suffix[by]
        key = key[by]
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        new[at] |= fresh
        head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[order[at]] = head[at]
        step *= 2


class FmIndex:
    """Counts and locates phrases in runs of word codes, each run closed by a 0."""

    def __init__(self, codes: np.ndarray, sample_rate: int = SAMPLE_RATE):
        n, largest = len(codes), int(codes.max())
        order = suffix_order(codes)
        self.tree = WaveletTree(codes[order - 1].astype(np.int64), largest)
        self.starts = np.searchsorted(codes[order], np.arange(largest + 2)).astype(np.int64)
        ends = codes == 0
        run_start = np.concatenate([[True], ends[:-1]])
        place = np.arange(n) - np.maximum.accumulate(np.where(run_start, np.arange(n), 0))
        # Run starts are sampled too, so that walking left never leaves a run.
        sampled = (place % sample_rate == 0)[order]
        self.sampled = RankBits(sampled)
        self.samples = order[sampled]
        self.size = n

    def ranges(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of all phrases (rows, left-aligned) at once: from and to in suffix order."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.size, np.int64)
        for back in range(phrases.shape[1]):
            live = np.flatnonzero((lengths > back) & (low < high))
            if not len(live):
                continue
            symbol = phrases[live, lengths[live] - 1 - back]
            known = symbol < len(self.starts) - 1
            symbol = np.where(known, symbol, 0)
            base = self.starts[symbol]
            new_low = base + self.tree.rank(symbol, low[live])
            new_high = base + self.tree.rank(symbol, high[live])
            low[live] = np.where(known, new_low, 0)
            high[live] = np.where(known, new_high, 0)
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text places of rows of the suffix order, walking left to a sampled one."""
        place, at, steps, todo = np.zeros(len(rows), np.int64), rows.copy(), 0, np.arange(len(rows))
        while len(todo):
            hit = self.sampled.get(at) == 1
            place[todo[hit]] = self.samples[self.sampled.rank(at[hit])] + steps
            todo, at = todo[~hit], at[~hit]
            if len(todo):
                symbol, before = self.tree.symbol_and_rank(at)
                at = self.starts[symbol] + before
            steps += 1
        return place


def test_phrases(items: list[tuple[str, str]], window: int = WINDOW) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """Vocabulary, phrases as code rows, their lengths, and the item of each; item names."""
    texts = pa.array([t for _, t in items], pa.large_string())
    words, counts = split_words(texts, BY_LETTER) if items else (pa.array([], pa.large_string()), np.zeros(0, int))
    coded = words.dictionary_encode()
    vocabulary = coded.dictionary
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
    rows, lengths, owner = [], [], []
    start = 0
    for k, n in enumerate(counts):
        run = codes[start : start + n]
        start += n
        for i in range(max(1, n - window + 1) if n else 0):
            part = run[i : i + window]
            rows.append(np.pad(part, (0, window - len(part))))
            lengths.append(len(part))
            owner.append(k)
    table = np.array(rows, np.int64).reshape(len(rows), window)
    return vocabulary, table, np.array(lengths, np.int64), np.array(owner, np.int64), [i for i, _ in items]


def merge_spans(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Overlapping spans as one, in order."""
    spans: list[tuple[int, int]] = []
    for k in np.argsort(starts, kind="stable"):
        s, e = int(starts[k]), int(ends[k])
        if spans and s <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(spans[-1][1], e))
        else:
            spans.append((s, e))
    return spans


def search_texts(texts: pa.Array, phrases) -> tuple[np.ndarray, dict[int, tuple[list[tuple[int, int]], list[str]]]]:
    """Words of each text; for those with a hit, merged word spans and the items found.

    Words outside the items' vocabulary are in no occurrence. They part the texts into runs;
    the index covers every run that is as long as the shortest phrase.
    """
    vocabulary, table, lengths, owner, names = phrases
    words, counts = split_words(texts, BY_LETTER)
    found: dict[int, tuple[list[tuple[int, int]], list[str]]] = {}
    if not len(words) or not len(table):
        return counts, found
    codes = pc.fill_null(pc.index_in(words, value_set=vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    doc = np.repeat(np.arange(len(counts)), counts)
    first_word = np.concatenate([[0], np.cumsum(counts)])
    known = codes > 0
    begins = known & np.concatenate([[True], ~known[:-1] | (doc[1:] != doc[:-1])])
    closes = known & np.concatenate([~known[1:] | (doc[1:] != doc[:-1]), [True]])
    run_from, run_to = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    long = run_to - run_from >= lengths.min()
    run_from, run_to = run_from[long], run_to[long]
    if not len(run_from):
        return counts, found
    size = run_to - run_from + 1  # with the closing 0
    at = np.concatenate([[0], np.cumsum(size)])
    source = np.arange(at[-1]) - np.repeat(at[:-1], size) + np.repeat(run_from, size)
    runs = codes[np.minimum(source, len(codes) - 1)]
    runs[at[1:] - 1] = 0
    index = FmIndex(runs)
    low, high = index.ranges(table, lengths)
    hits = np.flatnonzero(low < high)
    if not len(hits):
        return counts, found
    width = high[hits] - low[hits]
    phrase = np.repeat(hits, width)
    rows = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width) + np.repeat(low[hits], width)
    place = source[index.locate(rows)]
    owner_doc = doc[place]
    for d in np.unique(owner_doc):
        mine = owner_doc == d
        start = place[mine] - first_word[d]
        items = sorted({names[k] for k in owner[phrase[mine]]})
        found[int(d)] = (merge_spans(start, start + lengths[phrase[mine]]), items)
    return counts, found


def item_blocks(benchmark: DataFrame, block_bytes: int = ITEM_BLOCK_BYTES) -> Iterator[list[tuple[str, str]]]:
    """Items as (id, text), in blocks of bounded size, read one partition at a time."""
    block, size = [], 0
    known = benchmark.filter("item_id is not null and text is not null")
    for r in known.select(F.col("item_id").cast("string").alias("i"), "text").distinct().toLocalIterator():
        block.append((r["i"], r["text"]))
        size += len(r["text"]) + 32
        if size >= block_bytes:
            yield block
            block, size = [], 0
    yield block


#: A word as `BY_LETTER` has it, in the characters of a text.
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def cut_out(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the given word spans, and the blanks around a cut as one."""
    places = [m.span() for m in LETTERS.finditer(text)]
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at : places[start][0]])
        at = places[end - 1][1]
    return "".join([*kept, text[at:]]).strip()


FOUND = "n_words long, spans array<struct<from: int, to: int>>, items array<string>"
REST = ", rest string"


def _found_udf(phrases, with_rest: bool = False):
    kind = pa.struct(
        [
            ("n_words", pa.int64()),
            ("spans", pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))),
            ("items", pa.list_(pa.string())),
            *[("rest", pa.string())] * with_rest,
        ]
    )

    @F.arrow_udf(FOUND + REST * with_rest)
    def found(texts: pa.Array, before: pa.Array) -> pa.Array:
        out = []
        earlier = before.to_pylist()
        for piece in pieces(texts):
            counts, hits = search_texts(piece, phrases)
            for k, n in enumerate(counts):
                spans, items = hits.get(k, ([], []))
                old = earlier[len(out)]
                if old is not None and old["spans"]:
                    both = [(s["from"], s["to"]) for s in old["spans"]] + spans
                    spans = merge_spans(np.array([s for s, _ in both]), np.array([e for _, e in both]))
                    items = sorted({*old["items"], *items})
                own = {"n_words": int(n), "spans": [{"from": s, "to": e} for s, e in spans], "items": items}
                if with_rest and spans:
                    own["rest"] = cut_out(texts[len(out)].as_py(), spans)
                out.append(own)
        return pa.array(out, kind)

    return found


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = ITEM_BLOCK_BYTES) -> DataFrame:
    """``docs`` with a column ``found``: words, merged removal spans (in words), items.

    Texts are cut into training shards of a few MB, whole documents each, and each shard gets
    an FM-index in the task that reads it: a lost executor's shards are simply indexed again,
    and no row moves. Test phrases are the windows of ``window`` words of the items, or a
    whole shorter item. Items are sent to the tasks in blocks of bounded size, one pass each.

    NULL and empty texts have no words; items with NULL text or id, or without words, have no
    phrase; an item given twice counts once. Repeated rows are searched each on its own. A
    column named ``found`` is replaced, others kept. Empty tables give no rows or no hits.
    """
    return _search(docs, [test_phrases(block, window) for block in item_blocks(benchmark, block_bytes)])


def _search(docs: DataFrame, tables: list, with_rest: bool = False) -> DataFrame:
    """``docs`` with ``found``; ``with_rest`` the last pass also cuts the spans of all passes out of the text."""
    kept = [c for c in docs.columns if c != "found"]
    none = F.lit(None).cast(f"struct<{FOUND.replace(' long', ': long').replace('spans ', 'spans: ').replace('items ', 'items: ')}>")
    result = docs.select(*kept, none.alias("found"))
    for phrases in tables:
        udf = _found_udf(phrases, with_rest and phrases is tables[-1])
        if with_rest:
            # Else the planner would search once more, in a worker of its own, for each filter on the result.
            udf = udf.asNondeterministic()
        result = result.select(*kept, udf("text", "found").alias("found"))
    return result


def remove_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = ITEM_BLOCK_BYTES
) -> DataFrame:
    """``docs`` with the removal spans cut out of ``text`` and ``n_chars``, if there, set anew.

    Documents of which no word is left are dropped; documents without a hit stay as they are.
    """
    found = _search(docs, [test_phrases(block, window) for block in item_blocks(benchmark, block_bytes)], with_rest=True)
    n_cut = F.aggregate("found.spans", F.lit(0), lambda a, s: a + s["to"] - s["from"])
    hit = F.size("found.spans") > 0
    left = found.filter(~hit | (n_cut < F.col("found.n_words")))
    text = F.when(hit, F.col("found.rest")).otherwise(F.col("text"))
    columns = [text.alias("text") if c == "text" else F.col(c) for c in docs.columns]
    result = left.select(*columns, hit.alias("_hit"))
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        result = result.withColumn(
            "n_chars", F.when(F.col("_hit"), F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        )
    return result.select(*docs.columns)
