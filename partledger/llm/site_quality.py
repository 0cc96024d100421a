"""Document quality by hierarchical empirical Bayes over hosts and paths."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partledger.llm.common import let, store, words_of
from partledger.llm.quality_rules import duplicate_lines
from partledger.llm.urlrules import url_host, url_path

#: Labelled rows that the document classifier is fitted on, at most.
SAMPLE_ROWS = 20_000
#: Bounds of the prior's weight, in documents.
PRIOR_WEIGHT = (2.0, 1000.0)
FEATURES = ("length", "symbols", "letters", "word_length", "distinct", "repeated", "bars", "capitals", "digits")


def text_features(text: Column) -> list[Column]:
    """Cheap figures of a whole text, each about between 0 and 10."""
    t = F.coalesce(text, F.lit(""))
    size = F.greatest(F.length(t), F.lit(1))

    def share(pattern: str) -> Column:
        return F.length(F.regexp_replace(t, pattern, "")) / size

    def of_words(w: Column) -> Column:
        n = F.greatest(F.size(w), F.lit(1))
        total = F.aggregate(w, F.lit(0), lambda a, x: a + F.length(x))
        return F.struct(
            F.log1p(F.size(w).cast("double")).alias("length"),
            F.least(total / n, F.lit(20.0)).alias("word_length"),
            (F.size(F.array_distinct(w)) / n).alias("distinct"),
            (duplicate_lines(t) / F.greatest(F.size(F.split(t, "\n", -1)), F.lit(1))).alias("repeated"),
        )

    words = let(words_of(t), of_words)
    symbols = F.length(t) - F.length(F.translate(t, "#*$%&<>", ""))
    bars = F.length(t) - F.length(F.translate(t, "|", ""))
    return [
        words.alias("w"),
        F.least(10 * symbols / size, F.lit(10.0)).alias("symbols"),
        share(r"[^\p{L}]+").alias("letters"),
        F.least(20 * bars / size, F.lit(10.0)).alias("bars"),
        share(r"[^\p{Lu}]+").alias("capitals"),
        share(r"[^0-9]+").alias("digits"),
    ]


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> tuple[float, list[float]]:
    """Bias and weights of a ridge logistic regression, by Newton steps."""
    x1 = np.hstack([np.ones((len(x), 1)), x])
    w, ridge = np.zeros(x1.shape[1]), np.diag([1e-6] + [penalty] * x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        hessian = (x1 * (p * (1 - p))[:, None]).T @ x1 + ridge
        w = w - np.linalg.solve(hessian, x1.T @ (p - y) + ridge @ w)
    return float(w[0]), [float(v) for v in w[1:]]


def page_sites(pages: DataFrame) -> DataFrame:
    """Distinct ``doc_id, host, path``: a page stands for the document whose number its path ends on.

    The path is the first folder. A document has a row for each of its sites.
    """
    path = url_path(F.col("url"))
    found = pages.select(
        F.expr("try_cast(regexp_extract(split(split(url, '#', 2)[0], '[?]', 2)[0], '/([0-9]+)(?:[.]html)?/?$', 1) AS bigint)").alias("doc_id"),
        url_host(F.col("url")).alias("host"),
        F.regexp_extract(path, "^(/[^/]*/)", 1).alias("path"),
    ).filter("doc_id is not null")
    return found.distinct()


def _prior_weight(stats: DataFrame, mean: Column) -> float:
    """Variance within groups over variance between them, by moments; one row to the driver."""
    many = stats.filter("n > 1")
    within = F.sum(F.col("s2") - F.col("s") * F.col("s") / F.col("n")) / F.sum(F.col("n") - 1)
    gap = F.col("s") / F.col("n") - mean
    between = F.sum(F.col("n") * gap * gap) / F.sum("n")
    r = many.agg(within.alias("w"), between.alias("b"), F.avg(1 / F.col("n")).alias("i")).first()
    if r["w"] is None or r["b"] is None:
        return PRIOR_WEIGHT[1]
    rest = max(r["b"] - r["w"] * r["i"], 1e-9)
    return float(min(max(r["w"] / rest, PRIOR_WEIGHT[0]), PRIOR_WEIGHT[1]))


def judge_quality(
    docs: DataFrame,
    sites: DataFrame,
    labels: DataFrame,
    sample_rows: int = SAMPLE_ROWS,
    features: Sequence[str] = FEATURES,
) -> DataFrame:
    """``doc_id, host, path, doc_quality, host_quality, path_quality, quality, kept`` of every row.

    A logistic classifier, fitted on ``sample_rows`` labelled documents at most, gives each
    document's own probability. Hosts shrink towards the mean of all documents and paths
    towards their host, by prior weights estimated from all groups; a document is left out of
    its own site's figures. A document on several sites counts once for each path and once for
    each host, and gets the mean log-odds of its hosts and of its paths; ``host`` and ``path``
    name the first site. Log-odds add up: document plus path minus overall mean. ``kept``
    is ``quality`` of one half or more.

    Documents without a site get the overall mean for one. NULL and empty texts have features
    of an empty text. A NULL id has no site and no label; repeated rows count each. Without
    labels of both kinds every document has the probability one half and is kept. Other
    columns are ignored; an empty table gives no rows.
    """
    figures = docs.select("doc_id", *text_features(F.col("text"))).select("doc_id", "w.*", "symbols", "letters", "bars", "capitals", "digits")
    figures = store(figures, "quality-figures")
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    sample = known.groupBy("doc_id").agg(F.max("quality").alias("label")).orderBy(F.xxhash64(F.lit(13), "doc_id"), "doc_id").limit(sample_rows)
    rows = figures.join(F.broadcast(sample), "doc_id").limit(2 * sample_rows).collect()
    y = np.array([float(r["label"]) for r in rows])
    if len(rows) and 0 < y.mean() < 1:
        x = np.array([[float(r[f]) for f in features] for r in rows])
        bias, weights = fit_logistic(x, y)
    else:
        bias, weights = 0.0, [0.0] * len(features)
    logit = F.lit(bias)
    for f, w in zip(features, weights):
        logit = logit + F.lit(w) * F.col(f)
    own = 1 / (1 + F.exp(-F.least(F.greatest(logit, F.lit(-12.0)), F.lit(12.0))))
    judged = store(figures.select("doc_id", own.alias("p")), "quality-evidence")
    mean = judged.agg(F.avg("p")).first()[0]
    mean = 0.5 if mean is None else min(max(mean, 1e-4), 1 - 1e-4)

    # Repeated rows are one row with a count before they meet their sites.
    counted = judged.filter("doc_id is not null").groupBy("doc_id", "p").agg(F.count(F.lit(1)).alias("c"))
    known_sites = sites.filter("host is not null").select("doc_id", "host", "path").distinct()
    placed = store(counted.join(known_sites, "doc_id"), "quality-sites")

    def stats(rows: DataFrame, *keys: str) -> DataFrame:
        p, c = F.col("p"), F.col("c")
        return rows.groupBy(*keys).agg(F.sum("c").alias("n"), F.sum(c * p).alias("s"), F.sum(c * p * p).alias("s2"))

    by_path = store(stats(placed, "host", "path"), "quality-paths")
    by_host = store(stats(placed.select("doc_id", "p", "c", "host").distinct(), "host"), "quality-hosts")
    host_weight = _prior_weight(by_host, F.lit(mean))
    hosts = by_host.select("host", F.col("n").alias("host_n"), F.col("s").alias("host_s"))
    paths = by_path.join(hosts, "host")
    path_weight = _prior_weight(paths, F.col("host_s") / F.col("host_n"))
    table = paths.select(
        F.col("host").alias("_host"), F.col("path").alias("_path"), "host_n", "host_s", "n", "s"
    )
    joined = placed.join(table, (F.col("host") == F.col("_host")) & F.col("path").eqNullSafe(F.col("_path")))
    host_quality = (host_weight * mean + F.col("host_s") - F.col("p")) / (host_weight + F.col("host_n") - 1)
    path_quality = (path_weight * F.col("host_quality") + F.col("s") - F.col("p")) / (path_weight + F.col("n") - 1)

    def odds(p: Column) -> Column:
        q = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
        return F.log(q / (1 - q))

    def chance(x: Column) -> Column:
        return 1 / (1 + F.exp(-x))

    of_sites = (
        joined.withColumn("host_quality", host_quality)
        .withColumn("path_quality", path_quality)
        .groupBy(F.col("doc_id").alias("_id"), F.col("p").alias("_p"))
        .agg(
            F.min(F.struct("host", "path")).alias("site"),
            chance(F.avg(odds(F.col("host_quality")))).alias("host_quality"),
            chance(F.avg(odds(F.col("path_quality")))).alias("path_quality"),
        )
    )
    total = odds(F.col("p")) + odds(F.col("path_quality")) - odds(F.lit(mean))
    return (
        judged.join(of_sites, (F.col("doc_id") == F.col("_id")) & (F.col("p") == F.col("_p")), "left")
        .withColumn("host_quality", F.coalesce("host_quality", F.lit(mean)))
        .withColumn("path_quality", F.coalesce("path_quality", F.lit(mean)))
        .withColumn("quality", chance(total))
        .select(
            "doc_id",
            "site.host",
            "site.path",
            F.col("p").alias("doc_quality"),
            "host_quality",
            "path_quality",
            "quality",
            (F.col("quality") >= 0.5).alias("kept"),
        )
    )
