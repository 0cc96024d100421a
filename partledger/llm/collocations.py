"""Frequent phrases whose words belong together, found by Rabin-Karp fingerprints.

Prefix polynomials give the fingerprint of every run of words. A shuffle adds up the
occurrences of each fingerprint and keeps a pointer to one of them; only the text behind the
pointers of frequent fingerprints is ever written as phrases.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from partledger.llm.bitfilter import filter_of, in_filter
from partledger.llm.common import small_batches, store
from partledger.llm.words import byte_table, mix, pieces

MOST_WORDS = 3
MIN_COUNT = 10
TOP = 2000
#: A longer phrase with this share of a phrase's occurrences takes its place.
COVERED_PERCENT = 50
#: Fingerprints that a task adds up before it hands them to the shuffle.
LOCAL = 500_000
#: A pointer has 38 bits of a row's hash, 24 of the word's place and 2 of the phrase's length.
PLACE_BITS = 24
LAST_PLACE = (1 << PLACE_BITS) - 1
NO_LANG = "und"

#: Separators of pieces, and of words in a piece: fixed values.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytearray(byte_table({32, 9}))
for _byte in PIECE_ENDS:
    _TABLE[_byte] = 10
TABLE = bytes(_TABLE)


class Polynomial:
    """Hashes of slices of a byte string modulo 2**64, from sums of its prefixes."""

    def __init__(self, seed: int):
        made = np.random.default_rng(seed).integers(1, 2**63, 257, dtype=np.int64).astype(np.uint64)
        self.values = made[:256]
        self.base = int(made[256]) | 1
        self.powers = self.inverses = np.ones(1, np.uint64)

    def prefixes(self, data: np.ndarray) -> np.ndarray:
        if len(self.powers) <= len(data):
            for name, base in (("powers", self.base), ("inverses", pow(self.base, -1, 2**64))):
                factors = np.full(len(data) + 1, base, np.uint64)
                factors[0] = 1
                setattr(self, name, np.multiply.accumulate(factors))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[: len(data)], out=sums[1:])
        return sums

    def slices(self, prefixes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (prefixes[ends] - prefixes[starts]) * self.inverses[starts]


@dataclass
class Hashers:
    main: Polynomial
    check: Polynomial
    mask: np.uint64

    @classmethod
    def new(cls, bits: int) -> Hashers:
        return cls(Polynomial(1), Polynomial(2), np.uint64(2**bits - 1))


class Runs:
    """The words of some texts in normal form: lower case, one space between the words of a
    piece, and one newline between pieces or texts."""

    def __init__(self, texts: list[bytes]):
        raw = np.frombuffer(b"\n".join(texts).translate(TABLE) + b"\n", np.uint8)
        inside = np.concatenate([[False], (raw != 32) & (raw != 10)])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        breaks = np.cumsum(raw == 10)
        #: Whether a word has the next one in its piece.
        self.joined = np.zeros(len(starts), bool)
        self.joined[:-1] = breaks[starts[1:]] == breaks[ends[:-1] - 1]
        firsts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.text = np.searchsorted(firsts, starts, side="right") - 1
        self.counts = np.bincount(self.text, minlength=len(texts))
        self.place = np.arange(len(starts)) - (np.cumsum(self.counts) - self.counts)[self.text]
        keep = inside[1:].copy()
        keep[ends] = True
        self.data = raw[keep]
        sizes = ends - starts + 1
        self.ends = np.cumsum(sizes) - 1
        self.starts = self.ends - sizes + 1
        self.data[self.ends] = np.where(self.joined, 32, 10)

    def hash(self, hashers: Hashers) -> None:
        with np.errstate(over="ignore"):
            self.sums = hashers.main.prefixes(self.data), hashers.check.prefixes(self.data)

    def first_words(self, n: int) -> np.ndarray:
        """The words that begin a run of ``n`` words of one piece."""
        fits = np.ones(max(len(self.starts) - n + 1, 0), bool)
        for k in range(n - 1):
            fits &= self.joined[k : k + len(fits)]
        return np.flatnonzero(fits)

    def fingerprints(self, hashers: Hashers, words: np.ndarray, n: int, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprint and check value of the runs of ``n`` words that begin at ``words``."""
        starts, ends = self.starts[words], self.ends[words + n - 1]
        seed = seeds[self.text[words]]
        with np.errstate(over="ignore"):
            main = mix(hashers.main.slices(self.sums[0], starts, ends) + seed) & hashers.mask
            check = mix(hashers.check.slices(self.sums[1], starts, ends) + seed) >> np.uint64(32)
        return main, check.astype(np.uint32).view(np.int32)

    def phrase(self, word: int, n: int) -> str:
        return self.data[self.starts[word] : self.ends[word + n - 1]].tobytes().decode()


def lang_seeds(langs: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(x) for x in langs], np.uint64)


def total_print(seeds: np.ndarray, hashers: Hashers) -> np.ndarray:
    """The fingerprint under which a language's words are counted."""
    return mix(seeds ^ np.uint64(0x9E3779B97F4A7C15)) & hashers.mask


Batch = tuple[list[bytes], list[str], np.ndarray]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[Batch]:
    """Texts, languages and row hashes, about a megabyte at a time."""
    for batch in batches:
        at = 0
        for piece in pieces(batch.column("text")):
            end = at + len(piece)
            langs = batch.column("lang").slice(at, len(piece)).to_pylist()
            hashes = batch.column("row").slice(at, len(piece)).to_numpy().view(np.uint64)
            yield piece.cast(pa.large_binary()).to_pylist(), langs, hashes
            at = end


PRINTS = "print long, uses long, pointer long, low int, high int"


def _add_up(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    prints, uses, pointers, checks = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(prints)
    prints = prints[order]
    first = np.flatnonzero(np.concatenate([[True], prints[1:] != prints[:-1]]))
    checks = checks[order]
    columns = {
        "print": prints[first].view(np.int64),
        "uses": np.add.reduceat(uses[order], first),
        "pointer": np.minimum.reduceat(pointers[order], first),
        "low": np.minimum.reduceat(checks, first),
        "high": np.maximum.reduceat(checks, first),
    }
    return pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in columns.items()})


def prints_of(sizes: tuple[int, ...], bits: int, kept=None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Added-up fingerprints of the runs of ``sizes`` words; 0 stands for all words of a language.

    With ``kept``, a broadcast filter, only runs all of whose parts one word shorter pass it.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashers, parts, held = Hashers.new(bits), [], 0
        for texts, langs, rows in _texts(batches):
            runs, seeds = Runs(texts), lang_seeds(langs)
            runs.hash(hashers)
            for n in sizes:
                if n == 0:
                    some = np.flatnonzero(runs.counts)
                    prints, checks = total_print(seeds[some], hashers), np.zeros(len(some), np.int32)
                    uses, text, place = runs.counts[some].astype(np.int64), some, np.zeros(len(some), np.int64)
                else:
                    words = runs.first_words(n)
                    if kept is not None:
                        passed = np.ones(len(words), bool)
                        for k in range(2):
                            passed &= in_filter(kept.value, runs.fingerprints(hashers, words + k, n - 1, seeds)[0])
                        words = words[passed]
                    prints, checks = runs.fingerprints(hashers, words, n, seeds)
                    uses, text, place = np.ones(len(words), np.int64), runs.text[words], runs.place[words]
                short = (rows[text] >> np.uint64(26)).astype(np.int64) << 26
                pointers = short | np.minimum(place, LAST_PLACE) << 2 | n
                parts.append((prints, uses, pointers, checks))
                held += len(prints)
            if held >= LOCAL:
                yield _add_up(parts)
                parts, held = [], 0
        if held:
            yield _add_up(parts)

    return emit


def counted(rows: DataFrame) -> DataFrame:
    return rows.groupBy("print").agg(
        F.sum("uses").alias("uses"), F.min("pointer").alias("pointer"), F.min("low").alias("low"), F.max("high").alias("high")
    )


def phrases_udf(bits: int):
    """The texts behind a row's pointers, if they have the fingerprints that are asked for."""

    def phrases(texts: pa.Array, langs: pa.Array, asked: pa.Array) -> pa.Array:
        hashers, out = Hashers.new(bits), []
        for text, lang, wanted in zip(texts, langs, asked):
            runs, seeds = Runs([(text.as_py() or "").encode()]), lang_seeds([lang.as_py()])
            runs.hash(hashers)
            found, of_size = [], {}
            for want in wanted.as_py():
                target, n, place = np.uint64(want["print"] % 2**64), want["pointer"] & 3, want["pointer"] >> 2 & LAST_PLACE
                if n == 0:
                    if total_print(seeds, hashers)[0] == target:
                        found.append({"print": want["print"], "n": 0, "phrase": ""})
                    continue
                if n not in of_size:
                    words = runs.first_words(n)
                    of_size[n] = (words, *runs.fingerprints(hashers, words, n, seeds))
                words, prints, checks = of_size[n]
                if place < LAST_PLACE:
                    at = int(np.searchsorted(words, place))
                    tried = range(at, min(at + 1, len(words)))
                else:
                    tried = np.flatnonzero(prints == target).tolist()
                for at in tried:
                    if prints[at] == target and checks[at] == want["low"]:
                        found.append({"print": want["print"], "n": n, "phrase": runs.phrase(int(words[at]), n)})
                        break
            out.append(found)
        kind = pa.struct([("print", pa.int64()), ("n", pa.int32()), ("phrase", pa.string())])
        return pa.array(out, pa.list_(kind))

    return F.arrow_udf(phrases, "array<struct<print: long, n: int, phrase: string>>")


def spelled_out(sizes: tuple[int, ...], bits: int, kept) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Every run that passes a filter as text, added up per megabyte of input."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashers = Hashers.new(bits)
        for texts, langs, _ in _texts(batches):
            runs, seeds, seen = Runs(texts), lang_seeds(langs), {}
            runs.hash(hashers)
            for n in sizes:
                words = runs.first_words(n)
                prints, _ = runs.fingerprints(hashers, words, n, seeds)
                passed = in_filter(kept.value, prints)
                for word, mark in zip(words[passed].tolist(), prints[passed].view(np.int64).tolist()):
                    key = (mark, langs[runs.text[word]], n, runs.phrase(word, n))
                    seen[key] = seen.get(key, 0) + 1
            names = ("print", "lang", "n", "phrase")
            columns = dict(zip(names, zip(*seen))) if seen else {k: [] for k in names}
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.string())
            arrays = [pa.array(columns[k], t) for k, t in zip(names, kinds)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(list(seen.values()), pa.int64())], names=[*names, "f"])

    return emit


def frequent_phrases(docs: DataFrame, least: int = MIN_COUNT, text_col: str = "text", lang_col: str = "lang", bits: int = 64) -> DataFrame:
    """``lang, n, phrase, f`` of the runs of one to three words that occur ``least`` times, stored.

    A row with ``n = 0`` has the language's words. ``bits`` is the width of fingerprints; with
    any width the result is the same, for a fingerprint whose occurrences differ in a second
    hash is counted again by its texts.

    Words are runs of anything but space and tab in pieces that punctuation and line ends part;
    A-Z counts as a-z. NULL and empty texts have none, a NULL language is ``und``. Repeated rows
    count each time. Texts of any length are read whole, about a megabyte at once. Other columns
    are ignored, whatever their names; no rows give no phrases.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(text_col).alias("text"), F.coalesce(F.col(lang_col), F.lit(NO_LANG)).alias("lang"))
    rows = rows.withColumn("row", F.xxhash64("text", "lang"))
    with small_batches(spark):
        prints, kept, last = None, None, None
        for sizes in ((0, 1), (2,), (MOST_WORDS,)):
            if last is not None:
                # A run is frequent only if both its parts one word shorter are.
                kept = spark.sparkContext.broadcast(filter_of(last.select("print")))
            found = counted(rows.mapInArrow(prints_of(sizes, bits, kept), PRINTS)).filter(F.col("uses") >= least)
            last = store(found, f"phrases-{sizes[-1]}")
            prints = last if prints is None else prints.unionByName(last)
        # Runs of different lengths may share a narrow fingerprint: then they are counted again.
        repeated = prints.groupBy("print").agg((F.count(F.lit(1)) > 1).alias("again"), F.max(F.col("low") != F.col("high")).alias("mixed"))
        clash = store(repeated.filter("again or mixed").select("print"), "phrases-clashes")
        clean = prints.join(clash, "print", "left_anti")
        asked = clean.groupBy(F.shiftright("pointer", 26).alias("short")).agg(F.collect_list(F.struct("print", "pointer", "low")).alias("asked"))
        asked = store(asked, "phrases-asked")
        texts = rows.join(asked, F.shiftright("row", 26) == F.col("short")).select(
            "lang", F.explode(phrases_udf(bits)("text", "lang", "asked")).alias("p")
        )
        named = texts.groupBy("p.print").agg(F.min("lang").alias("lang"), F.min("p.n").alias("n"), F.min("p.phrase").alias("phrase"))
        result = named.join(clean.select("print", "uses"), "print").select("lang", "n", "phrase", F.col("uses").alias("f"))
        result = store(result, "phrases-named")
        if clash.isEmpty():
            return result
        filled = spark.sparkContext.broadcast(filter_of(clash))
        again = rows.mapInArrow(spelled_out((1, 2, MOST_WORDS), bits, filled), "print long, lang string, n int, phrase string, f long")
        exact = again.join(clash, "print", "left_semi").groupBy("lang", "n", "phrase").agg(F.sum("f").alias("f"))
        whole = result.filter("n > 0").unionByName(exact.filter(F.col("f") >= least)).unionByName(word_totals(rows))
        return store(whole, "phrases-counted")


def word_totals(rows: DataFrame) -> DataFrame:
    """The words of each language, counted without fingerprints."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, langs, _ in _texts(batches):
            yield pa.RecordBatch.from_pydict({"lang": pa.array(langs, pa.string()), "f": pa.array(Runs(texts).counts.astype(np.int64))})

    counts = rows.mapInArrow(emit, "lang string, f long").groupBy("lang").agg(F.sum("f").alias("f"))
    return counts.filter("f > 0").select("lang", F.lit(0).alias("n"), F.lit("").alias("phrase"), "f")


def scored(phrases: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of the phrases of two words or more.

    Of the ways to cut a phrase in two, the one of the lowest score counts, of equal ones the
    first. Products have 38 decimal digits, which hold a count of 10**15 squared, times 10**6.
    """
    known = phrases.filter("n > 0")
    words = F.split("phrase", " ")
    cuts = known.filter("n > 1").select(
        "lang", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("cut"), words.alias("words")
    )
    cuts = cuts.select(
        "lang",
        "phrase",
        "a",
        "cut",
        F.array_join(F.slice("words", F.lit(1), F.col("cut")), " ").alias("head"),
        F.array_join(F.slice("words", F.col("cut") + 1, F.size("words") - F.col("cut")), " ").alias("tail"),
    )
    heads = known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = known.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    value = F.expr("(1000000BD * cast(a as decimal(16,0)) * cast(a as decimal(16,0))) div (cast(l as decimal(16,0)) * cast(r as decimal(16,0)))")
    both = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).withColumn("score", value)
    least = both.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    return least.select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def uncovered(phrases: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates that no candidate one word longer contains with enough of their occurrences."""
    words = F.split("phrase", " ")
    parts = F.array(F.array_join(F.slice(words, 1, MOST_WORDS - 1), " "), F.array_join(F.slice(words, 2, MOST_WORDS - 1), " "))
    longer = phrases.filter(F.col("n") == MOST_WORDS).select("lang", F.explode(parts).alias("phrase"), "f")
    longer = longer.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    return candidates.join(longer, ["lang", "phrase"], "left").filter(
        F.coalesce(100 * F.col("most") < COVERED_PERCENT * F.col("a"), F.lit(True))
    ).drop("most")


def mine_collocations(docs: DataFrame, top: int = TOP, least: int = MIN_COUNT, text_col: str = "text", lang_col: str = "lang", bits: int = 64) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top`` phrases.

    Ties end by the phrase's bytes. Ranks are taken per language and slice first, so that no
    task sorts all phrases of a language. For odd input see ``frequent_phrases``.
    """
    spark = docs.sparkSession
    phrases = frequent_phrases(docs, least, text_col, lang_col, bits)
    left = uncovered(phrases, scored(phrases))
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    sliced = left.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(slices)))
    first = sliced.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    totals = phrases.filter("n = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
