"""Line dedup by site-relative frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partledger.llm.common import store
from partledger.llm.urlrules import url_host

#: A line on more than this share of a host's pages is boilerplate,
MAX_RATIO = 0.3
#: if it is on so many pages at least.
MIN_PAGES = 3

_UNSEEN = r"(?is)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->"
_BREAKS = r"(?i)</?(p|div|br|h[1-6]|li|ul|ol|nav|footer|header|article|section|title|table|tr|td|blockquote|pre)( [^>]*)?/?>"
_TAGS = r"(?s)<[^>]*>"


def visible_lines(html: Column) -> Column:
    """Trimmed lines of text with a character, in order: block tags break lines, others vanish."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), _UNSEEN, "")
    text = F.regexp_replace(F.regexp_replace(text, _BREAKS, "\n"), _TAGS, "")
    return F.filter(F.transform(F.split(text, "\n", -1), lambda x: F.trim(x)), lambda x: x != "")


def line_digest(line: Column) -> Column:
    """16 bytes that stand for a line while lines are counted and looked up."""
    return F.unhex(F.md5(line.cast("binary")))


def drop_boilerplate(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """``page_id, host, n_lines, n_dropped, text`` of every page.

    For each host, the pages that contain a line are divided by the host's pages. Lines above
    ``max_ratio`` are dropped wherever they stand; the rest stay in order, also if repeated
    within a page. Lines are counted once a page and summed where they are read, so a line on
    every page of a hot host moves one row per task; MD5 digests stand for the lines, so no text
    is shuffled to be counted. A host cannot have more boilerplate lines than lines on its
    average page divided by ``max_ratio``, so its list is one small array. The lists are stored:
    by their known size Spark sends them to the pages, or beyond its broadcast limit joins by
    host and splits hot hosts.

    NULL urls and urls without ``://`` share the empty host; NULL and empty pages have no lines
    but count as pages; repeated rows count each. Other columns are ignored. An empty table
    gives no rows.
    """
    lines = pages.select(
        F.col(id_col).alias("page_id"),
        url_host(F.col(url_col)).alias("host"),
        visible_lines(F.col(html_col)).alias("lines"),
    )
    totals = pages.groupBy(url_host(F.col(url_col)).alias("host")).agg(F.count(F.lit(1)).alias("host_pages"))
    counts = (
        lines.select("host", F.explode(F.transform(F.array_distinct("lines"), line_digest)).alias("line"))
        .groupBy("host", "line")
        .agg(F.count(F.lit(1)).alias("line_pages"))
    )
    boiler = store(
        counts.filter(F.col("line_pages") >= min_pages)
        .join(totals, "host")
        .filter(F.col("line_pages") > F.lit(max_ratio) * F.col("host_pages"))
        .groupBy(F.col("host").alias("_site"))
        .agg(F.collect_list("line").alias("boiler")),
        "boilerplate",
    )
    joined = lines.join(boiler, F.col("host") == F.col("_site"), "left")
    others = F.filter("lines", lambda x: ~F.array_contains("boiler", line_digest(x)))
    kept = F.when(F.col("boiler").isNull(), F.col("lines")).otherwise(others)
    return joined.withColumn("kept", kept).select(
        "page_id",
        "host",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
        F.array_join("kept", "\n").alias("text"),
    )


#: DuckDB SQL of ``drop_boilerplate`` over ``pages`` with its defaults.
SQL = rf"""
WITH cut AS (
  SELECT row_number() OVER () AS k, page_id, lower_host AS host, list_filter(list_transform(
      string_split(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
        '{_UNSEEN}', '', 'g'), '{_BREAKS}', chr(10), 'g'), '{_TAGS}', '', 'g'), chr(10)),
      lambda x: trim(x, ' ')), lambda x: x <> '') AS lines
  FROM (SELECT *, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_host FROM pages)),
totals AS (SELECT host, count(*) AS host_pages FROM cut GROUP BY host),
counts AS (SELECT host, line, count(*) AS line_pages
  FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM cut) GROUP BY host, line),
boiler AS (SELECT host, list(line) AS boiler FROM counts JOIN totals USING (host)
  WHERE line_pages >= {MIN_PAGES} AND line_pages > {MAX_RATIO} * host_pages GROUP BY host),
kept AS (SELECT page_id, cut.host, lines,
    list_filter(lines, lambda x: NOT list_contains(coalesce(boiler, []), x)) AS kept
  FROM cut LEFT JOIN boiler ON cut.host = boiler.host)
SELECT page_id, host, len(lines)::BIGINT AS n_lines, (len(lines) - len(kept))::BIGINT AS n_dropped,
  array_to_string(kept, chr(10)) AS text FROM kept
"""
