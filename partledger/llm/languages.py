"""Language identification: the family first, then one-versus-one linear SVMs within it."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partledger.llm.common import hash_share, small_batches

#: Hashed character n-gram features.
FEATURES = 2048
#: Rows that the machines are fitted on, at most, shared evenly by the languages.
TRAIN_ROWS = 6000
UNKNOWN = "und"
#: Families of common languages; others are a family of their own name's.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
    "ru": "slavic", "uk": "slavic", "pl": "slavic", "cs": "slavic", "bg": "slavic", "sr": "slavic",
}


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


def features(text: str, size: int = FEATURES) -> np.ndarray:
    """Square roots of the shares of hashed 1- to 4-grams of characters, of the whole text."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    c = np.where((c < 128) & ~((c >= 97) & (c <= 122)), np.uint64(32), c)
    c = np.concatenate([[np.uint64(32)], c, [np.uint64(32)]])
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] != 32) | (c[:-1] != 32)  # runs of other characters count as one
    c = c[keep]
    out = np.zeros(size, np.float32)
    h = np.zeros(len(c), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(4):
            if len(c) <= k:
                break
            h = (h[: len(c) - k] * np.uint64(0x9E3779B97F4A7C15)) + c[k:]
            g = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)
            out += np.bincount((g % np.uint64(size)).astype(np.int64), minlength=size).astype(np.float32) / len(h)
    return np.sqrt(out)


def fit_svm(x: np.ndarray, y: np.ndarray, rounds: int = 400, penalty: float = 1e-4) -> np.ndarray:
    """Weights and, last, the bias of a linear SVM with squared hinge loss; y is +1 or -1.

    Classes weigh the same however many rows they have. Gradient descent with momentum.
    """
    x1 = np.hstack([x, np.ones((len(x), 1), np.float32)])
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w, step, speed = np.zeros(x1.shape[1], np.float32), 0.1, np.zeros(x1.shape[1], np.float32)
    for _ in range(rounds):
        slack = np.maximum(0, 1 - y * (x1 @ w))
        gradient = penalty * w - 2 * x1.T @ (share * y * slack)
        speed = 0.9 * speed - step * gradient
        w = w + speed
    return w


class LanguageModel:
    """Machines between each two families, and between each two languages of a family."""

    def __init__(self, x: np.ndarray, languages: list[str], families: dict[str, str] = FAMILIES):
        self.family = {g: families.get(g, g) for g in sorted(set(languages))}
        names, groups = np.array(languages), np.array([self.family[g] for g in languages])
        self.machines = {}
        for a, b in combinations(sorted(set(groups)), 2):
            rows = (groups == a) | (groups == b)
            self.machines["family", a, b] = fit_svm(x[rows], np.where(groups[rows] == a, 1, -1).astype(np.float32))
        for a, b in combinations(sorted(self.family), 2):
            if self.family[a] == self.family[b]:
                rows = (names == a) | (names == b)
                self.machines["language", a, b] = fit_svm(x[rows], np.where(names[rows] == a, 1, -1).astype(np.float32))

    def vote(self, kind: str, candidates: list[str], x: np.ndarray) -> tuple[str, float]:
        """The candidate with most wins, margins breaking ties, and its weakest confidence."""
        wins, margins = dict.fromkeys(candidates, 0), dict.fromkeys(candidates, 0.0)
        sure = {}
        for a, b in combinations(candidates, 2):
            w = self.machines[kind, a, b]
            m = float(x @ w[:-1] + w[-1])
            wins[a if m >= 0 else b] += 1
            margins[a] += m
            margins[b] -= m
            p = 1 / (1 + np.exp(-np.clip(4 * m, -30, 30)))
            sure[a] = min(sure.get(a, 1.0), p)
            sure[b] = min(sure.get(b, 1.0), 1 - p)
        best = min(candidates, key=lambda c: (-wins[c], -margins[c], c))
        return best, float(sure.get(best, 1.0))

    def predict(self, text: str | None) -> tuple[str, float]:
        if not has_letter(text) or not self.family:
            return UNKNOWN, 0.0
        x = features(text)
        family, p = self.vote("family", sorted(set(self.family.values())), x)
        language, q = self.vote("language", [g for g, f in self.family.items() if f == family], x)
        return language, p * q


def learn(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> LanguageModel:
    """Fits a model on about ``train_rows`` rows with text and language, the same number of each language.

    Ids are chosen by their hash, from the share of a language's ids that its number calls for (counted
    to within some 5%), so no language is sorted. An id that is repeated counts once, with the row whose text and
    language hash least; a NULL id is an id like others. Features are made on the executors, the
    driver gets the vectors. Equal tables give equal models.
    """
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.approx_count_distinct(key).alias("n")).collect()}
    each = max(1, train_rows // max(1, len(sizes)))
    shares = docs.sparkSession.createDataFrame(
        [(g, min(1.0, each / max(1, n))) for g, n in sizes.items()], "lang string, _share double"
    )

    @F.arrow_udf("binary")
    def vectors(texts: pa.Array) -> pa.Array:
        made = (features(t).astype(np.float16).tobytes() if has_letter(t) else None for t in texts.to_pylist())
        return pa.array(made, pa.binary())

    # Few rows are left here; copies of an id are reduced to one before they are shuffled.
    picked = known.join(F.broadcast(shares), "lang").filter(hash_share(5, key, F.col("_share")))
    once = picked.groupBy(key.alias("_key")).agg(
        F.min(F.struct(F.xxhash64("text", "lang").alias("h"), "text", "lang")).alias("r")
    )
    with small_batches(docs.sparkSession):
        rows = once.select("_key", "r.lang", vectors("r.text").alias("v")).filter("v is not null").collect()
    rows.sort(key=lambda r: r["_key"])
    x = np.array([np.frombuffer(r["v"], np.float16) for r in rows], np.float32).reshape(len(rows), FEATURES)
    return LanguageModel(x, [r["lang"] for r in rows])


def predict_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, from the whole text alone.

    NULL texts and texts without a letter are ``und`` with score 0, as is everything if
    nothing was learned. Rows are independent: repeated rows get equal answers, an empty
    table none. Columns named ``lang_pred`` and ``score`` are replaced, others kept.
    """

    @F.arrow_udf("lang_pred string, score double")
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            answers = [model.predict(t) for t in texts.to_pylist()]
            yield pa.StructArray.from_arrays(
                [pa.array([a[0] for a in answers], pa.string()), pa.array([a[1] for a in answers], pa.float64())],
                ["lang_pred", "score"],
            )

    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    return docs.select(*kept, predicted("text").alias("_p")).select(*kept, "_p.lang_pred", "_p.score")
