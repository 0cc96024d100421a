"""Fingerprints, revisions, reading and writing archived data: registered queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.control_queries import PENDED, pending
from checks.registry import Inputs, register
from partledger.operators import catalog, fingerprint, lineage, unchanged, verification
from partledger.plans import analytics
from partledger.session import store
from partledger.sinks import archive as sink
from partledger.sinks import control
from partledger.sources import listings, records
from partledger.spec import KEY

COLUMNS = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax"
    " l_returnflag l_linestatus l_shipdate"
).split()
_COLS = ", ".join(COLUMNS)


def _print_sql(source: str, by: str, columns: str) -> str:
    """Fingerprint per group, computed by the other engine's own hash functions."""
    return f"""
      SELECT {by}, count(*) AS rows,
             concat('v1:', cast(count(*) AS varchar), ':', to_hex(sum(cast(md5_number_lower(j) AS hugeint))), ':',
                    to_hex(bit_xor(md5_number_upper(j)))) AS fingerprint
      FROM (SELECT {by}, cast(to_json(s) AS varchar) AS j FROM (SELECT {by}, struct_pack({columns}) AS s FROM {source}) a) b
      GROUP BY {by}
    """


_PACKED = ", ".join(f"{c} := {c}" for c in COLUMNS)
_ARCHIVED = f"{_PACKED}, ano := cast(ano AS bigint), mes := lpad(cast(mes AS varchar), 2, '0'), uf := uf"
CURRENT = {"current_prints": _print_sql("lines", "uf, ano, mes", _PACKED)}
PRINTS = {
    **CURRENT,
    "published_prints": _print_sql("published_lines", "uf, ano, mes", _PACKED),
    "outcomes": """
      SELECT c.uf, c.ano, c.mes, c.rows, c.fingerprint, p.rows AS published_rows, p.fingerprint AS published_fingerprint,
             CASE WHEN p.fingerprint IS NULL THEN 'new' WHEN p.fingerprint = c.fingerprint THEN 'unchanged' ELSE 'changed' END AS outcome
      FROM current_prints c LEFT JOIN published_prints p ON c.uf = p.uf AND c.ano = p.ano AND c.mes = p.mes
    """,
}


def _prints(df):
    return fingerprint.content_fingerprint(df, KEY, fingerprint.row_payload(df, COLUMNS))


@register("content_fingerprint", "lines", "SELECT * FROM current_prints", CURRENT)
def _(t):
    return _prints(t.lines)


@register("partition_changes", "lines published_lines", "SELECT * FROM outcomes", PRINTS)
def _(t):
    return fingerprint.compare_fingerprints(_prints(t.lines), _prints(t.published_lines), KEY)


def _table_fingerprint(name: str, by: str, columns: str):
    packed = ", ".join(f"{c} := {c}" for c in columns.split())

    @register(f"fingerprint_{name}", sql=_print_sql(name, by, packed))
    def _(t):
        df = getattr(t, name)
        return fingerprint.content_fingerprint(
            df, by.split(", "), fingerprint.row_payload(df, columns.split())
        )


_table_fingerprint("orders", "o_orderstatus", "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority")
_table_fingerprint("events", "event_type", "event_id ts user_id event_type value props")
_table_fingerprint("documents", "lang, source", "doc_id text lang source n_chars")
_table_fingerprint("conversations", "role", "conv_id turn role text")
_table_fingerprint("embeddings", "label", "vec_id embedding label")
_table_fingerprint("customer", "c_mktsegment", "c_custkey c_name c_nationkey c_acctbal c_mktsegment")


@register(
    "fingerprint_pages",
    sql=_print_sql("(SELECT *, 'all' AS scope FROM pages) p", "scope", "page_id := page_id, url := url, html := html"),
)
def _(t):
    return fingerprint.content_fingerprint(
        t.pages.withColumn("scope", F.lit("all")), ["scope"], fingerprint.row_payload(t.pages)
    )


def _outcomes(t: Inputs):
    """The unchanged step on fingerprints that a provenance document published."""
    published = _prints(t.published_lines)
    text = F.to_json(
        F.struct(F.struct("fingerprint", "rows").alias("output"), F.lit("2012-01-01").alias("generatedAt"))
    )
    documents = unchanged.published_fingerprints(published.select(*KEY, text.alias("text")))
    local = _prints(t.lines)
    return unchanged.skip_unchanged(local.filter("uf <> 'UN' OR ano > 1995"), local, documents)


_SKIPPED = "SELECT * FROM outcomes WHERE uf <> 'UN' OR ano > 1995"


@register(
    "skip_unchanged",
    "lines published_lines",
    f"""
    SELECT uf, ano, mes, rows, CASE WHEN outcome = 'unchanged' THEN 'unchanged' ELSE 'changed' END AS outcome,
           CASE WHEN outcome = 'unchanged' THEN '2012-01-01' END AS published_at FROM ({_SKIPPED}) s
    """,
    PRINTS,
)
def _(t):
    return _outcomes(t).select(*KEY, "rows", "outcome", "published_at")


@register(
    "unchanged_summary",
    "lines published_lines",
    f"""
    SELECT count(*) FILTER (outcome = 'unchanged') AS unchanged, count(*) FILTER (outcome <> 'unchanged') AS changed,
           count(*) FILTER (outcome = 'new') AS without_fingerprint FROM ({_SKIPPED}) s
    """,
    PRINTS,
)
def _(t):
    return unchanged.unchanged_summary(_outcomes(t))


@register(
    "release_period",
    "lines published_lines",
    f"""
    SELECT max(concat(cast(ano AS varchar), '-', lpad(cast(mes AS varchar), 2, '0'))) AS release
    FROM ({_SKIPPED}) s WHERE outcome <> 'unchanged'
    """,
    PRINTS,
)
def _(t):
    newest = t.published_lines.agg(F.date_format(F.max("l_shipdate"), "yyyy-MM")).scalar()
    return unchanged.release_of_run(_outcomes(t), newest)


_DIFF = f"""
  SELECT {_COLS}, CASE WHEN sum(w) > 0 THEN 'added' ELSE 'removed' END AS change, cast(abs(sum(w)) AS bigint) AS copies
  FROM (SELECT {_COLS}, 1 AS w FROM lines UNION ALL SELECT {_COLS}, -1 FROM published_lines) u
  GROUP BY ALL HAVING sum(w) <> 0
"""
DIFF = {"diff": _DIFF}


def _diff(t: Inputs):
    return fingerprint.revision_diff(t.published_lines, t.lines, COLUMNS, KEY)


@register(
    "revision_diff",
    "lines published_lines",
    "SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate) FROM diff",
    DIFF,
)
def _(t):
    return _diff(t).withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


@register(
    "revision_summary",
    "lines published_lines",
    """
    SELECT l_returnflag, cast(year(l_shipdate) AS int) AS year, cast(coalesce(sum(copies) FILTER (change = 'added'), 0) AS bigint) AS added,
           cast(coalesce(sum(copies) FILTER (change = 'removed'), 0) AS bigint) AS removed,
           coalesce(sum(copies) FILTER (change = 'removed'), 0) = 0 AS pure_append
    FROM diff GROUP BY l_returnflag, year(l_shipdate)
    """,
    DIFF,
)
def _(t):
    d = _diff(t).withColumn("year", F.year("l_shipdate"))
    return fingerprint.revision_summary(d, ["l_returnflag", "year"])


@register(
    "diff_changed_partitions",
    "lines published_lines",
    "SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate) FROM diff",
    DIFF,
)
def _(t):
    outcomes = store(
        fingerprint.compare_fingerprints(_prints(t.lines), _prints(t.published_lines), KEY), "outcomes"
    )
    diff = fingerprint.diff_changed_partitions(t.published_lines, t.lines, outcomes, KEY, COLUMNS)
    return diff.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


@register(
    "revised_partitions",
    "lines published_lines",
    """
    SELECT uf, ano, mes, count(*) AS n FROM lines WHERE (uf, ano, mes) IN (SELECT (uf, ano, mes) FROM outcomes WHERE outcome <> 'unchanged')
    GROUP BY uf, ano, mes
    """,
    PRINTS,
)
def _(t):
    changed = fingerprint.compare_fingerprints(_prints(t.lines), _prints(t.published_lines), KEY)
    return analytics.count_by(fingerprint.changed_partitions(t.lines, changed, KEY), KEY)


@register(
    "new_establishments",
    "lines published_lines",
    """
    SELECT DISTINCT l_suppkey, uf, ano FROM lines l
    WHERE NOT EXISTS (SELECT 1 FROM published_lines p WHERE p.l_suppkey = l.l_suppkey AND p.uf = l.uf AND p.ano = l.ano)
    """,
)
def _(t):
    return fingerprint.new_entities(t.published_lines, t.lines, ["l_suppkey", "uf", "ano"])


# --- archived tree ----------------------------------------------------------


def archived(t: Inputs) -> str:
    """The order lines written as an archive, once per application."""

    def build(path):
        sink.write_partitions(t.lines, path, sort_cols=["l_shipdate", "l_suppkey"])

    return t.once("archive", build)


def scanned(t: Inputs):
    return records.scan_dataset(t.spark, archived(t), t.lines.drop(*KEY).schema)


@register(
    "write_and_scan",
    "lines",
    f"SELECT * FROM ({_print_sql('lines', 'uf, ano, mes', _ARCHIVED)}) w",
)
def _(t):
    data = scanned(t)
    return fingerprint.content_fingerprint(data, KEY, fingerprint.archived_payload(data))


@register("published_row_counts", "lines", "SELECT uf, ano, mes, count(*) AS rows FROM lines GROUP BY uf, ano, mes")
def _(t):
    return verification.partition_row_counts(scanned(t))


@register(
    "scan_partition",
    "lines",
    "SELECT l_suppkey, count(*) AS n, cast(sum(l_linenumber) AS bigint) AS lines FROM lines WHERE ano = 1997 AND uf = 'UR' AND mes = 3 GROUP BY l_suppkey",
)
def _(t):
    one = records.scan_partition(t.spark, archived(t), 1997, "UR", 3, ["l_suppkey", "l_linenumber"])
    return one.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").alias("lines"))


@register("scan_dataset", "lines", "SELECT ano, count(*) AS n FROM lines GROUP BY ano")
def _(t):
    return analytics.count_by(scanned(t), ["ano"]).orderBy("ano")


@register(
    "scan_from_manifest",
    "lines",
    "SELECT mes, count(*) AS n FROM lines WHERE ano >= 1998 AND uf IN ('UA', 'UR') GROUP BY mes",
)
def _(t):
    tree = listings.scan_local_tree(t.spark, archived(t)).withColumn("dataset", F.lit("lines"))
    manifest = catalog.summarize_manifest(tree)
    announced = catalog.manifest_partitions(manifest, "lines", ufs=["UA", "UR"], since="1998-01")
    return analytics.count_by(records.scan_from_manifest(scanned(t), announced), ["mes"]).orderBy("mes")


@register("scan_local_tree", "lines", "SELECT DISTINCT uf, ano, mes, true AS has_bytes FROM lines")
def _(t):
    tree = listings.scan_local_tree(t.spark, archived(t))
    return tree.select(*KEY, (F.col("bytes") > 0).alias("has_bytes"))


@register(
    "period_filter",
    "lines",
    "SELECT l_suppkey, count(*) AS n FROM lines WHERE ano = 2000 AND mes = 2 AND l_linestatus = 'F' GROUP BY l_suppkey",
)
def _(t):
    return analytics.count_in_period(scanned(t).filter("ano = 2000 AND mes = 2"), "l_suppkey", "l_linestatus", "F")


def _vintages(t: Inputs) -> str:
    """A tree whose older years lack a column and hold another type."""

    def build(path):
        lines = t.lines.withColumn("mes", F.lpad("mes", 2, "0"))
        old = lines.filter("ano < 1998").drop("l_tax").withColumn("l_suppkey", F.col("l_suppkey").cast("int"))
        new = lines.filter("ano >= 1998").withColumn("l_suppkey", F.lpad(F.col("l_suppkey").cast("string"), 7, "0"))
        for part in (old, new):
            arranged = sink.arrange_partitions(part, ["ano", "uf", "mes"], ["l_shipdate"])
            arranged.write.mode("append").partitionBy("ano", "uf", "mes").parquet(path)

    return t.once("vintages", build)


@register(
    "scan_union_by_name",
    "lines",
    """
    SELECT ano, l_suppkey, count(*) AS n, count(l_tax) AS with_tax FROM (
      SELECT ano, CASE WHEN ano < 1998 THEN cast(l_suppkey AS varchar) ELSE lpad(cast(l_suppkey AS varchar), 7, '0') END AS l_suppkey,
             CASE WHEN ano >= 1998 THEN l_tax END AS l_tax FROM lines) v
    GROUP BY ano, l_suppkey
    """,
)
def _(t):
    data = records.scan_union_by_name(t.spark, _vintages(t))
    return data.groupBy("ano", "l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.count("l_tax").alias("with_tax"))


@register(
    "scan_records",
    sql="SELECT event_type, count(*) AS n, cast(sum(user_id) AS bigint) AS users, cast(sum(length(props)) AS bigint) AS chars,"
    " max(value) AS largest, cast(sum(round(value * 1000)) AS bigint) AS thousandths, min(epoch_us(ts)) AS first, max(epoch_us(ts)) AS last FROM events GROUP BY event_type",
)
def _(t):
    fields = t.events
    # Written to the microsecond: the writer's own pattern stops at milliseconds.
    path = t.once("ndjson", fields.write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json)
    data = records.scan_records(t.spark, path, fields.schema)
    return data.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("user_id").alias("users"),
        F.sum(F.length("props").cast("bigint")).alias("chars"),
        F.max("value").alias("largest"),
        F.sum(F.round(F.col("value") * 1000).cast("bigint")).alias("thousandths"),
        F.min(F.unix_micros(F.col("ts").cast("timestamp"))).alias("first"),
        F.max(F.unix_micros(F.col("ts").cast("timestamp"))).alias("last"),
    )


@register(
    "concat_variants",
    "order_rows",
    "SELECT uf, ano, mes, count(*) AS n, count(o_orderpriority) AS with_priority FROM ("
    " SELECT uf, ano, mes, CASE WHEN suffix = '' THEN o_orderpriority END AS o_orderpriority FROM order_rows) v GROUP BY uf, ano, mes",
)
def _(t):
    rows = t.order_rows
    pieces = [rows.filter(F.col("suffix") == s) for s in ("", "a", "b", "c")]
    united = records.concat_variants([pieces[0]] + [p.drop("o_orderpriority") for p in pieces[1:]])
    return united.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n"), F.count("o_orderpriority").alias("with_priority")
    )


@register(
    "select_all",
    "lines",
    f"SELECT count(*) AS n, cast({len(COLUMNS) + 3} AS int) AS columns FROM lines",
)
def _(t):
    data = scanned(t)
    return data.agg(F.count(F.lit(1)).alias("n")).withColumn("columns", F.lit(len(data.columns)))


@register(
    "describe_output",
    "lines",
    """
    SELECT uf, ano, mes, count(*) AS rows, cast(14 AS int) AS columns, 'l_orderkey BIGINT,l_partkey BIGINT,l_suppkey BIGINT,l_linenumber INTEGER,'
           || 'l_quantity DOUBLE,l_extendedprice DOUBLE,l_discount DOUBLE,l_tax DOUBLE,l_returnflag VARCHAR,l_linestatus VARCHAR,'
           || 'l_shipdate TIMESTAMP,uf VARCHAR,ano INTEGER,mes INTEGER' AS schema
    FROM lines GROUP BY uf, ano, mes
    """,
)
def _(t):
    out = lineage.describe_output(scanned(t).select(*COLUMNS, *KEY))
    line = F.transform("schema", lambda s: F.concat(s["name"], F.lit(" "), s["type"]))
    return out.withColumn("schema", F.array_join(line, ","))


@register(
    "quarantine_rejected",
    "lines",
    "SELECT uf, ano, 'kept' AS side, count(*) AS n FROM lines WHERE NOT (uf = 'UR' AND mes > 9) GROUP BY uf, ano"
    " UNION ALL SELECT uf, ano, 'rejected', count(*) FROM lines WHERE uf = 'UR' AND mes > 9 GROUP BY uf, ano",
)
def _(t):
    data = scanned(t)
    rejected = verification.partition_row_counts(data).filter("uf = 'UR' AND mes > 9")
    path = t.folder("rejected")
    kept = sink.quarantine_rejected(data, rejected, path, sort_cols=["l_shipdate"])
    apart = records.scan_dataset(t.spark, path, data.drop(*KEY).schema)
    sides = [df.withColumn("side", F.lit(s)) for df, s in ((kept, "kept"), (apart, "rejected"))]
    return analytics.count_by(sides[0].unionByName(sides[1]), ["uf", "ano", "side"])


@register(
    "divert_unchanged",
    "lines published_lines",
    f"""
    SELECT uf, count(*) AS n, 'published' AS what FROM lines
    WHERE (uf, ano, mes) IN (SELECT (uf, ano, mes) FROM ({_SKIPPED}) s WHERE outcome <> 'unchanged') GROUP BY uf
    UNION ALL SELECT uf, count(*), 'marker' FROM ({_SKIPPED}) s WHERE outcome = 'unchanged' GROUP BY uf
    """,
    PRINTS,
)
def _(t):
    changed, markers = sink.divert_unchanged(t.lines, _outcomes(t))
    a = analytics.count_by(changed, ["uf"]).withColumn("what", F.lit("published"))
    return a.unionByName(analytics.count_by(markers, ["uf"]).withColumn("what", F.lit("marker")))


@register("count_all", "lines", "SELECT count(*) AS n FROM lines")
def _(t):
    return scanned(t).agg(F.count(F.lit(1)).alias("n"))


@register("count_by_period", sql="SELECT strftime(l_shipdate, '%Y%m') AS period, count(*) AS n FROM lineitem GROUP BY 1")
def _(t):
    return analytics.count_by(t.lineitem.withColumn("period", F.date_format("l_shipdate", "yyyyMM")), ["period"])


@register("count_by_establishment", sql="SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey")
def _(t):
    return analytics.count_by(t.lineitem, ["l_suppkey"])


@register("distinct_targets", "listing state", "SELECT DISTINCT uf, ano FROM pending", PENDED)
def _(t):
    return pending(t).select("uf", "ano").distinct()


@register(
    "write_manifest",
    "lines",
    "SELECT count(DISTINCT (uf, ano, mes)) AS partitions, count(DISTINCT uf) AS ufs FROM lines",
)
def _(t):
    tree = listings.scan_local_tree(t.spark, archived(t)).withColumn("dataset", F.lit("lines"))
    path = t.folder("manifest")
    control.write_manifest(
        catalog.manifest_document(catalog.summarize_manifest(tree), F.lit("2026-12-01T00:00:00.000Z")), path
    )
    doc = t.spark.read.text(path)
    return doc.select(
        F.get_json_object("value", "$.datasets.lines.partitions").cast("bigint").alias("partitions"),
        F.size(F.from_json(F.get_json_object("value", "$.datasets.lines.ufs"), "array<string>")).cast("bigint").alias("ufs"),
    )
