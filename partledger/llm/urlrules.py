"""URL filters as a sort-merge range join of reversed hosts with nested rules."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from partledger.llm.common import store

#: (host, path, verdict); a rule fits its host, all subdomains, and paths that start with its own.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
#: The verdict where no rule fits.
DEFAULT = "allow"
#: Range partitions of the sweep.
SWEEP_PARTITIONS = 64


def url_host(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """Text after the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def reversed_host(host: Column) -> Column:
    """``www.example.com`` as ``com.example.www.``: subdomains share their domain's prefix."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def rule_stacks(rules: DataFrame) -> DataFrame:
    """``key, stack``: the rules in force from a point of the key order to the next.

    A rule's keys are an interval: from its reversed host to that host with ``/`` for the
    last ``.``, the next character. Intervals nest, so at a start the stack holds the rules
    of the host and its parents, and at an end those of the parents alone.
    """
    keyed = (
        rules.filter("host is not null and path is not null and verdict is not null")
        .distinct()
        .select(
            reversed_host(F.lower("host")).alias("owner"),
            F.struct(
                F.length(F.concat("host", "path")).alias("length"),
                F.length("host").alias("host_length"),
                F.concat("host", "path").alias("rule"),
                F.col("path"),
                F.col("verdict"),
            ).alias("entry"),
        )
    )
    nodes = keyed.select(F.col("owner").alias("node")).distinct()
    labels = F.split("node", r"\.", -1)
    depth = F.size(labels) - 1
    parents = nodes.select(
        "node",
        depth.alias("depth"),
        F.explode(F.sequence(F.lit(1), depth)).alias("k"),
        labels.alias("labels"),
    ).select("node", (F.col("k") == F.col("depth")).alias("own"), F.concat(F.array_join(F.slice("labels", F.lit(1), F.col("k")), "."), F.lit(".")).alias("owner"))
    chains = parents.join(keyed, "owner")
    # Longest first; of equal ones the longer host, then the name, then block before allow.
    stack = F.reverse(F.array_sort(F.collect_list("entry")))
    starts = chains.groupBy(F.col("node").alias("key")).agg(stack.alias("stack"))
    ends = (
        chains.groupBy("node")
        .agg(F.reverse(F.array_sort(F.collect_list(F.when(~F.col("own"), F.col("entry"))))).alias("stack"))
        .select(F.regexp_replace("node", r"\.$", "/").alias("key"), "stack")
    )
    return starts.unionByName(ends)


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = DEFAULT,
    partitions: int = SWEEP_PARTITIONS,
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row.

    Points where the stack of active rules changes and urls are sorted together by reversed
    host. A sweep over each range carries the last stack along; the stack that a range opens
    with is the last one of the ranges before it, one row per range. Of the stack, the longest
    rule whose path the url's path starts with decides. The ranges also split by path and id,
    so a host with a third of all urls spreads over many tasks.

    NULL urls and urls without ``://`` have an empty host and path and get the default, as do
    urls that no rule fits; their rule is NULL. Repeated rows are judged each on its own.
    Other columns are ignored; empty tables give no rows.
    """
    urls = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).select(
        "page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path")
    )
    stacks = rule_stacks(rules)
    keyed = urls.select(reversed_host(F.col("host")).alias("key"), F.lit(1).alias("kind"), "page_id", "host", "path")
    points = stacks.select(
        "key",
        F.lit(0).alias("kind"),
        F.lit(None).cast(dict(urls.dtypes)["page_id"]).alias("page_id"),
        F.lit(None).cast("string").alias("host"),
        F.lit(None).cast("string").alias("path"),
        "stack",
    )
    events = keyed.unionByName(points, allowMissingColumns=True)
    ranged = store(
        events.repartitionByRange(partitions, "key", "kind", "path", "page_id").withColumn(
            "range", F.spark_partition_id()
        ),
        "url-ranges",
    )
    last = ranged.filter("kind = 0").groupBy("range").agg(F.max_by("stack", "key").alias("last_stack"))
    ranges = ranged.select("range").distinct().join(last, "range", "left")
    carried = ranges.select(
        F.col("range").alias("_range"),
        F.last("last_stack", ignorenulls=True)
        .over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
        .alias("_opening"),
    )
    sweep = Window.partitionBy("range").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = ranged.withColumn("active", F.last("stack", ignorenulls=True).over(sweep)).filter("kind = 1")
    # One row per range, a fixed number.
    joined = swept.join(F.broadcast(carried), F.col("range") == F.col("_range"), "left")
    active = F.coalesce("active", "_opening")
    found = F.get(F.filter(active, lambda r: F.startswith(F.col("path"), r["path"])), F.lit(0))
    return joined.withColumn("found", found).select(
        "page_id",
        "host",
        "path",
        F.col("found")["rule"].alias("rule"),
        F.coalesce(F.col("found")["verdict"], F.lit(default)).alias("verdict"),
    )
