"""Publishing under published names, counts from footers, schemas per partition: registered queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.data_queries import COLUMNS, _print_sql, archived
from checks.registry import Inputs, register
from partledger.functions import names
from partledger.operators import fingerprint, lineage
from partledger.sinks import control, publish
from partledger.sources import documents, records
from partledger.spec import DATASETS, KEY, PARQUET_FILE

_DIR = "concat('ano=', cast(ano AS varchar), '/uf=', uf, '/mes=', lpad(cast(mes AS varchar), 2, '0'))"
_SORT = ["l_shipdate", "l_suppkey"]
SIM = DATASETS["sim"]


def published(t: Inputs) -> str:
    """The order lines published as a data set, once per application."""

    def build(path):
        publish.publish(t.lines, f"{path}/sia-pa", "1", sort_cols=_SORT)

    return f"{t.once('published', build)}/sia-pa"


@register(
    "published_round_trip",
    "lines",
    f"""
    SELECT uf, ano, mes, concat('sia-pa/', {_DIR}, '/part.parquet') AS key, 'parquet' AS kind, count(*) AS rows,
           true AS has_bytes, true AS as_recorded, true AS tag_matches FROM lines GROUP BY uf, ano, mes
    """,
)
def _(t):
    root = published(t)
    found = publish.hashed_files(t.spark, root)
    key = F.regexp_extract("path", r"/(sia-pa/ano=.*)\z", 1)
    parsed = names.parse_partition_key(key, "sia-pa")
    listed = found.select(key.alias("key"), parsed.alias("p"), "bytes", "sha256", "etag").select("key", "p.*", "bytes", "sha256", "etag")
    recorded = publish.published_files(t.spark, root).select(
        *KEY, F.col("bytes").alias("b"), F.col("sha256").alias("s"), F.col("etag").alias("e")
    )
    counts = records.footer_row_counts(t.spark, root)
    return listed.join(recorded, KEY).join(counts, KEY).select(
        *KEY,
        "key",
        "kind",
        "rows",
        (F.col("bytes") > 0).alias("has_bytes"),
        ((F.col("bytes") == F.col("b")) & (F.col("sha256") == F.col("s"))).alias("as_recorded"),
        (F.col("etag") == F.col("e")).alias("tag_matches"),
    )


@register(
    "validate_published_tree",
    "lines",
    f"SELECT DISTINCT uf, ano, mes, '{PARQUET_FILE}' AS name, 'output-hash' AS problem FROM lines WHERE uf = 'UN' AND mes = 7",
)
def _(t):
    """Documents of a first run, and a tree in which some partitions were written again since."""
    root = f"{t.folder('altered')}/sia-pa"
    first = publish.publish(t.lines, root, "1", sort_cols=_SORT)
    none = F.array().cast("array<struct<file: string, bytes: bigint, sha256: string>>")
    path = t.folder("documents")
    publish.outputs(first).withColumn("sources", none).write.parquet(path)
    changed = t.lines.filter("uf = 'UN' AND mes = 7").withColumn("l_tax", F.col("l_tax") + 1)
    publish.publish(changed, root, "2", sort_cols=_SORT)
    actual = publish.outputs(publish.hashed_files(t.spark, root))
    cached = t.cache.select("name", F.col("bytes").alias("size"), "sha256")
    return lineage.validate_provenance(t.spark.read.parquet(path), cached, actual)


@register("footer_row_counts", "lines", "SELECT uf, ano, mes, count(*) AS rows FROM lines GROUP BY uf, ano, mes")
def _(t):
    return records.footer_row_counts(t.spark, archived(t))


@register("published_yearly", "lines", "SELECT uf, ano, count(*) AS rows, cast(1 AS bigint) AS files FROM lines GROUP BY uf, ano")
def _(t):
    root = f"{t.folder('yearly')}/sim"
    files = publish.publish(t.lines.drop("mes"), root, "1", SIM, _SORT)
    counts = records.footer_row_counts(t.spark, root, ["uf", "ano"])
    return publish.outputs(files, SIM).join(counts, ["uf", "ano"]).select("uf", "ano", "rows", "files")


@register("staged_again", "lines", "SELECT uf, ano, mes, count(*) AS rows FROM lines WHERE uf <> 'UN' GROUP BY uf, ano, mes")
def _(t):
    """A run staged twice, with fewer partitions the second time, before it is committed."""
    root = f"{t.folder('staged')}/sia-pa"
    publish.stage(t.lines, root, "1", sort_cols=_SORT)
    publish.stage(t.lines.filter("uf <> 'UN'"), root, "1", sort_cols=_SORT)
    for run in publish.unfinished_runs(t.spark, root):
        publish.commit(t.spark, root, run)
    return records.footer_row_counts(t.spark, root)


def drifting(t: Inputs) -> str:
    """A tree whose schema changes in the middle of every year."""

    def build(path):
        early = t.lines.filter("mes <= 6").drop("l_tax").withColumn("l_suppkey", F.col("l_suppkey").cast("int"))
        late = t.lines.filter("mes > 6").withColumn("l_suppkey", F.lpad(F.col("l_suppkey").cast("string"), 7, "0"))
        for run, part in (("1", early), ("2", late)):
            publish.publish(part, f"{path}/sia-pa", run, sort_cols=["l_shipdate"])

    return f"{t.once('drifting', build)}/sia-pa"


@register(
    "scan_published",
    "lines",
    """
    SELECT ano, mes, l_suppkey, count(*) AS n, count(l_tax) AS with_tax FROM (
      SELECT ano, mes, CASE WHEN mes <= 6 THEN cast(l_suppkey AS varchar) ELSE lpad(cast(l_suppkey AS varchar), 7, '0') END AS l_suppkey,
             CASE WHEN mes > 6 THEN l_tax END AS l_tax FROM lines) v
    GROUP BY ano, mes, l_suppkey
    """,
)
def _(t):
    root = drifting(t)
    data = records.scan_published(t.spark, root, publish.published_files(t.spark, root))
    return data.groupBy("ano", "mes", "l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.count("l_tax").alias("with_tax"))


_EARLY = [c for c in COLUMNS if c != "l_tax"]
_PATH = "ano := cast(ano AS bigint), mes := lpad(cast(mes AS varchar), 2, '0'), uf := uf"
_EARLY_PACKED = ", ".join(f"{c} := cast(l_suppkey AS int)" if c == "l_suppkey" else f"{c} := {c}" for c in _EARLY)
_LATE_PACKED = ", ".join(
    f"{c} := lpad(cast(l_suppkey AS varchar), 7, '0')" if c == "l_suppkey" else f"{c} := {c}" for c in COLUMNS
)
_TYPES = {"l_linenumber": "INTEGER", "l_returnflag": "VARCHAR", "l_linestatus": "VARCHAR", "l_shipdate": "TIMESTAMP"} | dict.fromkeys(
    ("l_quantity", "l_extendedprice", "l_discount", "l_tax"), "DOUBLE"
)


def _described(columns, suppkey: str) -> str:
    data = [f"{c} {suppkey if c == 'l_suppkey' else _TYPES.get(c, 'BIGINT')}" for c in columns]
    return ",".join([*data, "ano BIGINT", "mes VARCHAR", "uf VARCHAR"])


@register(
    "describe_published",
    "lines",
    f"""
    SELECT uf, ano, mes, rows, fingerprint, cast({len(_EARLY) + 3} AS int) AS columns, '{_described(_EARLY, "INTEGER")}' AS schema
    FROM ({_print_sql("(SELECT * FROM lines WHERE mes <= 6) e", "uf, ano, mes", f"{_EARLY_PACKED}, {_PATH}")}) x
    UNION ALL
    SELECT uf, ano, mes, rows, fingerprint, cast({len(COLUMNS) + 3} AS int), '{_described(COLUMNS, "VARCHAR")}'
    FROM ({_print_sql("(SELECT * FROM lines WHERE mes > 6) l", "uf, ano, mes", f"{_LATE_PACKED}, {_PATH}")}) y
    """,
)
def _(t):
    """Each partition described and fingerprinted by the columns it was written with."""
    root = drifting(t)
    files = publish.published_files(t.spark, root)
    prints = fingerprint.fingerprint_by_schema(records.schema_groups(t.spark, root, files))
    line = F.array_join(F.transform("schema", lambda s: F.concat(s["name"], F.lit(" "), s["type"])), ",")
    return publish.describe_published(files).withColumn("schema", line).join(prints, KEY).select(
        *KEY, "rows", "fingerprint", "columns", "schema"
    )


@register("stale_document_gone", "lines", "SELECT DISTINCT uf, ano, mes FROM lines WHERE mes <> 3")
def _(t):
    root = t.folder("stale")
    keys = t.lines.select(*KEY).distinct()
    control.write_documents(keys.withColumn("text", F.lit("{}\n")), root, "sia-pa")
    publish.drop_documents(keys.filter("mes = 3"), root, "sia-pa")
    return documents.scan_provenance(t.spark, root, "sia-pa").select(*KEY)
