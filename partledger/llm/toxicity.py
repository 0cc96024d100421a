"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton on folded text."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled rows of either class that the lexicon is learned from, at most.
SAMPLE_ROWS = 8000
#: Candidate terms looked at, and terms kept, at most.
CANDIDATES = 4000
MOST_TERMS = 1000
#: Length of the word beginnings that can become terms.
TERM_LENGTHS = (4, 5, 6, 8)

#: Digits and signs used for letters, and letters of other alphabets of the same look.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "ԁ": "d",
    "ո": "n", "м": "m", "т": "t", "к": "k", "в": "b", "н": "h", "г": "r", "α": "a", "ο": "o", "ε": "e", "ρ": "p",
    "τ": "t", "υ": "u", "ν": "v", "ι": "i", "κ": "k", "ı": "i", "ɑ": "a", "ℓ": "l",
}


def folding_table() -> dict[int, str]:
    table = {b: " " for b in range(128) if not chr(b).isalnum()}
    table |= {ord(k): v for k, v in SUBSTITUTES.items()} | {ord(k): v for k, v in HOMOGLYPHS.items()}
    table |= {0xFEE0 + b: chr(b).lower() for b in range(0x21, 0x7F)}  # full-width forms
    table |= dict.fromkeys((0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF), "")
    table |= {c: " " for c in (0xA0, 0xAB, 0xBB, 0x85, *range(0x2000, 0x200B), *range(0x2010, 0x2030))}
    return table


FOLDING = folding_table()


def fold(text: str) -> str:
    """Lower case, look-alikes and substituted signs as letters, anything between words as blanks."""
    return f" {text.lower().translate(FOLDING)} "


def terms_of(folded: str) -> set[str]:
    """A blank and the beginnings of each word; for words of four letters or more, also the whole word."""
    found = set()
    for w in set(folded.split()):
        if len(w) >= TERM_LENGTHS[0]:
            found.update(f" {w[:k]}" for k in TERM_LENGTHS if len(w) >= k)
    return found


@dataclass
class Lexicon:
    """Weighted terms, exception phrases, and the density at which a score is one half."""

    weights: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    threshold: float = 1.0

    def automaton(self):
        trie = ahocorasick.Automaton()
        for phrase in self.exceptions:
            trie.add_word(phrase, (len(phrase), None))
        for term, weight in self.weights.items():
            trie.add_word(term, (len(term), weight))
        if len(trie):
            trie.make_automaton()
        return trie

    def density(self, text: str | None, trie) -> float:
        """Weight of the hits outside exception phrases, over the root of the number of words.

        Of terms that begin at one place only the heaviest counts.
        """
        if not text or not len(trie):
            return 0.0
        folded = fold(text)
        hits: dict[int, float] = {}
        excused: list[tuple[int, int]] = []
        for end, (length, weight) in trie.iter(folded):
            start = end - length + 1
            if weight is None:
                excused.append((start, end))
            else:
                hits[start] = max(hits.get(start, 0.0), weight)
        if not hits:
            return 0.0
        total = sum(w for s, w in hits.items() if not any(a <= s < b for a, b in excused))
        return total / math.sqrt(max(1, len(folded.split())))

    def score(self, density: float) -> float:
        return density / (density + self.threshold) if density > 0 else 0.0


def labelled_sample(labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, toxic``: of either class the ``rows`` with the smallest hash, a bounded table."""
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    one = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64(F.lit(7), "doc_id"), F.col("doc_id")]
    parts = [one.filter(F.col("toxic") == k).orderBy(*order).limit(rows) for k in (1, 0)]
    return parts[0].unionByName(parts[1])


def learn(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, exceptions: Iterable[str] = ()
) -> Lexicon:
    """A lexicon of word beginnings that tell toxic from clean labelled documents.

    Terms are counted over the sample by Spark. The driver gets the ``CANDIDATES`` strongest
    with the toxic documents that have each. They are chosen one by one; a document counts
    less with every term it already has, and copies of one another count as one, so
    rare words that merely come with a copied text are passed over. Words that are clean
    although they begin like a term become exceptions, besides the given phrases.
    """
    ids = labelled_sample(labels, sample_rows)
    found = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").filter("text is not null")
    # An id that is repeated counts once, with the text that hashes least.
    sample = found.groupBy("doc_id", "toxic").agg(
        F.min(F.struct(F.xxhash64("text").alias("h"), "text")).getField("text").alias("text")
    )

    @F.arrow_udf("struct<terms: array<string>, words: array<string>, marks: array<long>>")
    def described(texts: pa.Array) -> pa.Array:
        import xxhash

        rows = []
        for t in texts.to_pylist():
            folded = fold(t)
            words = sorted({w for w in folded.split() if len(w) >= TERM_LENGTHS[0]})
            h = np.array([xxhash.xxh3_64_intdigest(w) >> 1 for w in words] or [0], np.uint64)
            # Four minimum hashes of the words: copies agree in most.
            marks = [int((h * np.uint64(k) >> np.uint64(1)).min()) for k in (3, 0x9E3779B1, 0x85EBCA77C2B2AE3D, 0xC2B2AE3D27D4EB4F)]
            rows.append({"terms": sorted(terms_of(folded)), "words": words, "marks": marks})
        return pa.array(rows, described_type)

    described_type = pa.struct(
        [("terms", pa.list_(pa.string())), ("words", pa.list_(pa.string())), ("marks", pa.list_(pa.int64()))]
    )
    from partledger.llm.common import store

    made = store(sample.select("doc_id", "toxic", described("text").alias("d")).select("doc_id", "toxic", "d.*"), "toxic-sample")
    size = {r["toxic"]: r["n"] for r in made.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_pos, n_neg = size.get(1, 0), size.get(0, 0)
    if not n_pos:
        return Lexicon({}, [f" {e.strip()} " for e in exceptions])

    def counted(column: str) -> DataFrame:
        return (
            made.select("toxic", F.explode(column).alias("term"))
            .groupBy("term")
            .agg(F.sum("toxic").alias("pos"), F.sum(1 - F.col("toxic")).alias("neg"))
        )

    odds = F.log((F.col("pos") + 0.5) / (n_pos + 1)) - F.log((F.col("neg") + 0.5) / (n_neg + 1))
    strong = (
        counted("terms")
        .withColumn("weight", odds)
        .filter((F.col("pos") >= 2) & (F.col("weight") >= 3))
        .orderBy((F.col("weight") * F.col("pos")).desc(), "term")
        .limit(CANDIDATES)
    )
    has = (
        made.filter("toxic = 1")
        .select("doc_id", F.explode("terms").alias("term"))
        .join(F.broadcast(strong.select("term", "weight", "neg")), "term")
        .groupBy("term", "weight", "neg")
        .agg(F.collect_set("doc_id").alias("docs"))
        .collect()
    )
    marks = {r["doc_id"]: r["marks"] for r in made.filter("toxic = 1").select("doc_id", "marks").collect()}
    # Documents that agree in two minimum hashes count as copies of one another.
    halves = lambda m: ((0, m[0], m[1]), (1, m[2], m[3]))
    alike: dict[tuple, int] = {}
    for m in marks.values():
        for k in halves(m):
            alike[k] = alike.get(k, 0) + 1
    worth = {d: 1 / max(alike[k] for k in halves(m)) for d, m in marks.items()}

    found = {r["term"]: r for r in has}
    chosen: dict[str, float] = {}
    rest = dict(worth)
    gains = {t: sum(rest[d] for d in r["docs"]) for t, r in found.items()}
    least = max(1.5, 0.0005 * sum(worth.values()))
    while gains and len(chosen) < MOST_TERMS:
        # The bound from an earlier round is an upper bound: gains only shrink.
        term = max(gains, key=lambda t: (round(gains[t], 9), len(t), t))
        now = sum(rest[d] for d in found[term]["docs"])
        if now < gains[term] - 1e-9:
            gains[term] = now
            continue
        if now < least:
            break
        del gains[term]
        chosen[term] = found[term]["weight"]
        for d in found[term]["docs"]:
            rest[d] *= 0.7
        gains = {t: g for t, g in gains.items() if not t.startswith(term) and not term.startswith(t)}


    excused = []
    if chosen:
        clean = (F.col("neg") >= 2) & (F.col("neg") * n_pos >= F.col("pos") * n_neg)
        starts = F.array(*[F.lit(t.strip()) for t in chosen])
        excused = [
            r["term"]
            for r in counted("words").filter(clean).filter(F.exists(starts, lambda s: F.startswith("term", s))).orderBy("term").collect()
        ]
    lexicon = Lexicon(chosen, [f" {e.strip()} " for e in (*exceptions, *excused)])

    trie_of = lexicon.automaton

    @F.arrow_udf("double")
    def densities(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        trie = trie_of()
        for texts in batches:
            yield pa.array([lexicon.density(t, trie) for t in texts.to_pylist()], pa.float64())

    seen = [(r["x"], r["toxic"]) for r in sample.select("toxic", densities("text").alias("x")).collect()]
    lexicon.threshold = best_threshold(seen)
    return lexicon


def best_threshold(seen: list[tuple[float, int]]) -> float:
    """The density that best parts the classes, both weighing the same; halfway to the next lower one."""
    x = np.array([s[0] for s in seen])
    y = np.array([s[1] for s in seen])
    if not (x > 0).any():
        return 1.0
    cuts = np.unique(x[x > 0])
    n_pos, n_neg = max(1, (y == 1).sum()), max(1, (y == 0).sum())
    pos, neg = np.sort(x[y == 1]), np.sort(x[y == 0])
    gain = (len(pos) - np.searchsorted(pos, cuts)) / n_pos - (len(neg) - np.searchsorted(neg, cuts)) / n_neg
    at = int(np.argmax(gain))
    below = x[x < cuts[at]].max() if (x < cuts[at]).any() else 0.0
    return float((below + cuts[at]) / 2)


def score_udf(lexicon: Lexicon):
    """Column function: score between 0 and 1 of a whole text."""

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        trie = lexicon.automaton()
        for texts in batches:
            yield pa.array([lexicon.score(lexicon.density(t, trie)) for t in texts.to_pylist()], pa.float64())

    return scored


def score_toxicity(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 from one half on).

    NULL texts, empty ones and texts without a lexicon term score 0. Rows are independent:
    repeated rows get equal scores, an empty table none. Columns named ``score`` and
    ``predicted`` are replaced, all others kept. An empty lexicon scores everything 0.
    """
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    return docs.select(*kept, score_udf(lexicon)("text").alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )
