"""Quality rules with a hashed n-gram log-likelihood ratio."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partledger.llm.common import WORD, hash_share, let, store, words_of

#: Buckets of the hashed n-gram multinomials.
BUCKETS = 8192
#: Trusted documents that the trusted multinomial is fitted on, about, at most.
FIT_ROWS = 100_000
#: Share of the trusted documents that may fall below the threshold.
TRUSTED_LOSS = 0.002
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _characters(text: Column, drop: str) -> Column:
    """How many characters of ``drop`` the text has."""
    return F.length(text) - F.length(F.translate(text, drop, ""))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def repeat_words(hashes: Column) -> Column:
    """Words inside 3-word windows that the text has twice or more."""

    def marked(windows: Column) -> Column:
        pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            same = lambda k, d: F.coalesce(F.get(s, k)["h"] == F.get(s, k + d)["h"], F.lit(False))
            at = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda k: same(k, -1) | same(k, 1))
            return F.array_sort(F.transform(at, lambda k: F.get(s, k)["i"]))

        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(
            let(pairs, places),
            start,
            lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")),
            lambda a: a["n"],
        )

    windows = F.transform(
        F.sequence(F.lit(0), F.size(hashes) - 3),
        lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1), F.get(hashes, i + 2)),
    )
    zero = F.lit(0).cast("long")
    found = let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), zero).otherwise(marked(w)))
    return F.when(F.size(hashes) < 3, zero).otherwise(found)


def gram_buckets(hashes: Column, buckets: int) -> Column:
    """Buckets of all words and word pairs."""
    single = F.transform(hashes, lambda h: F.pmod(h, F.lit(buckets)).cast("int"))
    pair = F.transform(
        F.slice(hashes, F.lit(2), F.greatest(F.size(hashes) - 1, F.lit(0))),
        lambda h, i: F.pmod(F.xxhash64(F.get(hashes, i), h), F.lit(buckets)).cast("int"),
    )
    return F.concat(single, pair)


def word_hashes(text: Column) -> Column:
    return F.transform(words_of(text), lambda w: F.xxhash64(w))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of all documents labelled good."""
    return labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()


def fit_ids(trusted: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """About ``fit_rows`` of the distinct trusted ids, by their hash; all of them if there are no more."""
    n = trusted.count()
    return trusted.filter(hash_share(17, F.col("doc_id"), fit_rows / n)) if n > fit_rows else trusted


def gram_weights(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> list[float]:
    """Log ratio of each bucket's probability in the trusted and in all documents.

    Counts run over every document; a task sends one row per bucket. ``buckets`` numbers
    reach the driver, whatever the input's size.
    """
    grams = docs.join(trusted.withColumn("_trusted", F.lit(True)), "doc_id", "left").select(
        "_trusted", F.explode(let(word_hashes(F.col("text")), lambda h: gram_buckets(h, buckets))).alias("bucket")
    )
    counts = grams.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("raw"), F.count("_trusted").alias("target")
    )
    raw, target = [1.0] * buckets, [1.0] * buckets
    for r in counts.collect():
        raw[r["bucket"]] += r["raw"]
        target[r["bucket"]] += r["target"]
    import math

    shift = math.log(sum(raw)) - math.log(sum(target))
    return [round(math.log(t) - math.log(r) + shift, 4) for t, r in zip(target, raw)]


def apply_rules(
    docs: DataFrame,
    labels: DataFrame,
    buckets: int = BUCKETS,
    trusted_loss: float = TRUSTED_LOSS,
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """Counts, ``base_failed``, ``llr`` and ``kept`` of every row of ``docs``.

    ``llr`` is the mean over a text's words and word pairs of the log ratio between the
    trusted and the raw multinomial. The raw one counts every document, the trusted one those of
    about ``fit_rows`` trusted ids, few enough to be sent to the texts. The threshold is the
    ``trusted_loss`` quantile of the means of all trusted documents, found from stored figures
    without their texts, so it is fixed by the tables and every document is judged alike. Without trusted documents nothing but the base rules decides.

    NULL and empty texts have no words, ``llr`` 0 and fail the base rules; a NULL id is never
    trusted; repeated rows are judged each on its own. Columns of ``docs`` other than
    ``doc_id`` and ``text`` are ignored. Empty tables give no rows.
    """
    picked = docs.select("doc_id", "text")
    trusted = store(trusted_ids(labels), "trusted-ids")
    weights = gram_weights(picked, F.broadcast(fit_ids(trusted, fit_rows)), buckets)
    table = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<double>")
    text = F.coalesce(F.col("text"), F.lit(""))

    def judged(h: Column) -> Column:
        n = F.size(h)
        total = F.aggregate(
            h,
            F.struct(F.lit(0.0).alias("sum"), F.lit(None).cast("long").alias("last")),
            lambda a, x: F.struct(
                (
                    a["sum"]
                    + F.get(table, F.pmod(x, F.lit(buckets)).cast("int"))
                    + F.when(a["last"].isNull(), F.lit(0.0)).otherwise(
                        F.get(table, F.pmod(F.xxhash64(a["last"], x), F.lit(buckets)).cast("int"))
                    )
                ).alias("sum"),
                x.alias("last"),
            ),
            lambda a: a["sum"],
        )
        return F.struct(
            n.cast("long").alias("n_words"),
            repeat_words(h).alias("n_repeat_words"),
            F.when(n > 0, total / (2 * n - 1)).otherwise(F.lit(0.0)).alias("llr"),
        )

    features = picked.select(
        "doc_id",
        (F.length(text) - _characters(text, " \t\n\x0b\x0c\r")).cast("long").alias("word_chars"),
        _characters(text, "#*$%&|<>").cast("long").alias("n_symbols"),
        duplicate_lines(text).alias("n_dup_lines"),
        let(word_hashes(text), judged).alias("_judged"),
    ).select("doc_id", "word_chars", "n_symbols", "n_dup_lines", "_judged.*")
    features = store(features, "quality-features")
    least = (
        features.select("doc_id", "llr")
        .join(trusted, "doc_id", "left_semi")
        .agg(F.percentile_approx("llr", F.lit(trusted_loss), F.lit(10_000)))
        .first()[0]
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    verdict = F.lit(True) if least is None else F.col("llr") >= F.lit(least)
    return features.withColumn("base_failed", failed).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & verdict).alias("kept"),
        "llr",
    )
