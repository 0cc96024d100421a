"""Sources, provenance documents and the retroactive run: registered queries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from checks.control_queries import CHOOSING, groups
from checks.data_queries import COLUMNS
from checks.registry import Inputs, register
from partledger.functions import rules, times
from partledger.operators import catchup, fingerprint, lineage, verification
from partledger.operators import listing as ls
from partledger.plans import jobs
from partledger.session import store
from partledger.sinks import archive as sink
from partledger.sinks import control
from partledger.sources import documents, listings, records
from partledger.spec import KEY, SIA_PA

# The derived order lines, sorted by their own columns.
_LINES = replace(SIA_PA, sort_cols=("l_shipdate", "l_suppkey"))

PIPELINE = {"archiveScript": "archive@1", "datasusSdk": "sdk@1", "decoder": "dbc@1"}
NOW = "2026-12-01T00:00:00.000Z"

# --- selection --------------------------------------------------------------

_SITUATION = """
  SELECT s.uf, s.ano, s.mes, s.newest,
         CASE WHEN s.uf = 'UE' THEN 'ausente' WHEN s.uf = 'UA' OR s.uf = 'UC' THEN 'atual'
              WHEN s.uf = 'UB' THEN 'legado' WHEN s.mes < 7 THEN 'ilegivel' ELSE 'legado' END AS situation,
         CASE WHEN s.mes = 5 THEN s.newest + INTERVAL 12 HOUR ELSE s.newest + INTERVAL 2 DAY END AS last_modified
  FROM stored s
"""
_SELECTED = """
  SELECT uf, ano, mes, last_modified, CASE WHEN mes = 12 AND uf = 'UE' THEN 'pending' WHEN situation = 'atual' THEN 'current'
         WHEN situation = 'ilegivel' THEN 'unreadable' ELSE 'candidate' END AS selection, situation FROM situation
"""
SELECTING = {"situation": _SITUATION, "selected": _SELECTED}


def _selection(t: Inputs):
    parts = catchup.published_partitions(t.objects, t.documents_text.select("key", "text"), "sia-pa")
    return catchup.select_candidates(parts, t.stored.filter("mes = 12 AND uf = 'UE'"))


@register(
    "classify_provenance",
    "documents_text",
    "SELECT uf, ano, mes, CASE WHEN uf IN ('UA', 'UC') THEN 'atual' WHEN uf = 'UD' AND mes < 7 THEN 'ilegivel' ELSE 'legado' END AS situation"
    " FROM documents_text",
)
def _(t):
    return t.documents_text.select(*KEY, rules.classify_provenance(F.col("text")).alias("situation"))


@register(
    "published_fingerprint",
    "documents_text stored",
    """
    SELECT d.uf, d.ano, d.mes, CASE WHEN d.uf = 'UA' THEN concat('v1:', cast(s.n AS varchar), ':AA:BB') END AS fingerprint,
           CASE WHEN d.uf IN ('UA', 'UB') THEN '2012-01-01' END AS published_at
    FROM documents_text d JOIN stored s ON d.uf = s.uf AND d.ano = s.ano AND d.mes = s.mes
    """,
)
def _(t):
    text = F.col("text")
    return t.documents_text.select(
        *KEY, rules.published_fingerprint(text).alias("fingerprint"), rules.published_at(text).alias("published_at")
    )


@register(
    "published_partitions",
    "stored documents_text",
    "SELECT uf, ano, mes, bytes AS size, uf <> 'UE' AS listed, uf <> 'UE' AS has_text FROM stored",
)
def _(t):
    parts = catchup.published_partitions(t.objects, t.documents_text.select("key", "text"), "sia-pa")
    return parts.select(*KEY, "parquet.size", "listed", F.col("text").isNotNull().alias("has_text"))


@register(
    "select_candidates",
    "stored",
    "SELECT uf, ano, mes, selection, CASE WHEN selection = 'candidate' THEN situation END AS reason FROM selected",
    SELECTING,
)
def _(t):
    return _selection(t).select(*KEY, "selection", "reason")


@register(
    "previous_provenance",
    "stored",
    """
    SELECT uf, ano, mes, CASE WHEN uf = 'UB' THEN '2012-01-01' END AS generated_at,
           CASE WHEN uf = 'UB' THEN concat(md5(dir), md5(dir)) END AS output_sha, CASE WHEN uf = 'UB' THEN 'd@1' END AS decoder
    FROM stored WHERE uf IN ('UB', 'UC', 'UD')
    """,
)
def _(t):
    docs = t.documents_text.filter("uf IN ('UB', 'UC', 'UD')")
    previous = rules.previous_provenance(F.col("text"))
    return docs.select(*KEY, previous.alias("p")).select(
        *KEY,
        F.col("p.generatedAt").alias("generated_at"),
        F.col("p.outputSha256").alias("output_sha"),
        F.col("p.pipeline")["decoder"].alias("decoder"),
    )


@register(
    "assess_kept",
    "stored",
    """
    SELECT uf, ano, mes, CASE WHEN uf = 'UD' AND mes < 7 THEN 'not-json' WHEN uf IN ('UC', 'UD') THEN 'no-output-sha'
             WHEN mes > 6 THEN 'other-parquet' END AS problem,
           CASE WHEN mes <= 6 AND uf IN ('UA', 'UB') THEN uf = 'UB' END AS legacy
    FROM stored WHERE uf <> 'UE'
    """,
)
def _(t):
    both = t.documents_text.join(t.stored.select(*KEY, "dir"), KEY)
    sha = F.when(F.col("mes") > 6, F.lit("0" * 64)).otherwise(F.concat(F.md5("dir"), F.md5("dir")))
    return both.select(*KEY, rules.assess_kept(F.col("text"), sha).alias("a")).select(*KEY, "a.problem", "a.legacy")


# --- certification ----------------------------------------------------------

_CERTIFIED = """
  SELECT c.uf, c.ano, c.mes,
    CASE WHEN g.uf IS NULL THEN 'ausente no FTP' WHEN s.uf IS NULL THEN 'sem entrada no state'
         WHEN b.bad = 'unknown' THEN 'mtime do FTP ilegível' WHEN b.bad = 'late' THEN 'fonte reescrita depois do archive'
         WHEN g.size <> s.size THEN 'tamanho diferente do state' WHEN h.n IS NULL THEN 'ausente no FTP' END AS skip_reason,
    CASE WHEN g.uf IS NOT NULL AND s.uf IS NOT NULL THEN b.name END AS skip_file, s.size AS state_size, h.n AS files
  FROM (SELECT *, concat(cast(ano AS varchar), '-', lpad(cast(mes AS varchar), 2, '0')) AS period FROM selected WHERE selection = 'candidate') c
  LEFT JOIN groups g ON c.uf = g.uf AND c.ano = g.ano AND c.mes = g.mes
  LEFT JOIN state s ON c.uf = s.uf AND c.period = s.period
  LEFT JOIN (SELECT uf, ano, mes, arg_min(bad, suffix) AS bad, arg_min(name, suffix) AS name FROM (
      SELECT f.*, CASE WHEN f.mtime IS NULL THEN 'unknown' WHEN f.mtime > x.last_modified - INTERVAL 24 HOUR THEN 'late' END AS bad
      FROM files f JOIN selected x ON f.uf = x.uf AND f.ano = x.ano AND f.mes = x.mes) q WHERE bad IS NOT NULL GROUP BY uf, ano, mes) b
    ON c.uf = b.uf AND c.ano = b.ano AND c.mes = b.mes
  LEFT JOIN (SELECT uf, ano, mes, cast(count(*) AS int) AS n FROM chosen GROUP BY uf, ano, mes) h ON c.uf = h.uf AND c.ano = h.ano AND c.mes = h.mes
"""
CERTIFYING = {**CHOOSING, **SELECTING, "certified": _CERTIFIED}


def _certification(t: Inputs):
    candidates = _selection(t).filter("selection = 'candidate'").withColumn("last_modified", F.col("parquet.last_modified"))
    return catchup.certify_sources(candidates, groups(t), t.state)


@register(
    "certify_sources",
    "stored listing state",
    "SELECT uf, ano, mes, skip_reason, skip_file, CASE WHEN skip_reason IS NULL THEN files END AS files FROM certified",
    CERTIFYING,
)
def _(t):
    files = F.when(F.col("files").isNotNull(), F.size("files"))
    return _certification(t).select(*KEY, "skip_reason", "skip_file", files.alias("files"))


_NEED = """
  SELECT c.uf, c.ano, c.mes, cast(sum(CASE WHEN k.bytes = c.size THEN 0 ELSE c.size END) AS bigint) AS need
  FROM chosen c JOIN certified x ON c.uf = x.uf AND c.ano = x.ano AND c.mes = x.mes AND x.skip_reason IS NULL
  LEFT JOIN cache k ON c.name = k.name AND k.name NOT LIKE 'PA__07%' GROUP BY c.uf, c.ano, c.mes
"""
BUDGET = 60_000
_BUDGETED = f"""
  SELECT uf, ano, mes, need, spent, CASE WHEN spent <= {BUDGET} THEN 'selected' WHEN spent - need <= {BUDGET} THEN 'blocked' ELSE 'remaining' END AS decision
  FROM (SELECT *, cast(sum(need) OVER (ORDER BY ano, mes, uf ROWS UNBOUNDED PRECEDING) AS bigint) AS spent FROM need) q
"""
BUDGETING = {**CERTIFYING, "need": _NEED, "budgeted": _BUDGETED}


def _need(t: Inputs):
    held = t.cache.filter("name NOT LIKE 'PA__07%'")
    return catchup.download_need(_certification(t).filter("skip_reason IS NULL"), held)


@register("download_need", "stored listing state cache", "SELECT * FROM need", BUDGETING)
def _(t):
    return _need(t)


@register("budget_prefix_cut", "stored listing state cache", "SELECT * FROM budgeted", BUDGETING)
def _(t):
    return catchup.budget_prefix_cut(_need(t), BUDGET)


@register(
    "budget_over_all_partitions",
    "stored",
    """
    SELECT uf, ano, mes, CASE WHEN spent <= half THEN 'selected' WHEN spent - bytes <= half THEN 'blocked' ELSE 'remaining' END AS decision
    FROM (SELECT *, sum(bytes) OVER (ORDER BY ano, mes, uf ROWS UNBOUNDED PRECEDING) AS spent, 5000000 AS half FROM stored) q
    """,
)
def _(t):
    return catchup.budget_prefix_cut(t.stored.withColumnRenamed("bytes", "need"), 5_000_000).select(*KEY, "decision")


_OUTCOMES = """
  SELECT uf, ano, mes, 'skipped' AS outcome, skip_reason AS reason FROM certified WHERE skip_reason IS NOT NULL
  UNION ALL
  SELECT b.uf, b.ano, b.mes, CASE WHEN b.decision <> 'selected' THEN 'remaining' WHEN l.rows IS NULL THEN 'failed'
           WHEN h.records IS NULL OR h.records <> l.rows THEN 'skipped' ELSE 'written' END,
         CASE WHEN b.decision = 'selected' AND l.rows IS NOT NULL AND (h.records IS NULL OR h.records <> l.rows)
           THEN 'linhas diferentes do cabeçalho dos DBCs' END
  FROM budgeted b
  LEFT JOIN (SELECT uf, ano, mes, count(*) AS rows FROM staged GROUP BY uf, ano, mes) l ON b.uf = l.uf AND b.ano = l.ano AND b.mes = l.mes
  LEFT JOIN (SELECT f.uf, f.ano, f.mes, CASE WHEN count(*) = count(h.records) THEN sum(h.records) END AS records
             FROM chosen f JOIN headers h ON f.name = h.name GROUP BY f.uf, f.ano, f.mes) h ON b.uf = h.uf AND b.ano = h.ano AND b.mes = h.mes
"""
FINISHING = {**BUDGETING, "run_outcomes": _OUTCOMES}
# Partitions with a source that was not read, or not at its listed size.
_FAULTS = """
  SELECT uf, ano, mes, arg_min(p, position) FILTER (p IS NOT NULL) AS problem
  FROM (SELECT f.*, CASE WHEN k.name IS NULL THEN 'unreadable' WHEN k.bytes <> f.size THEN 'size-changed' END AS p
        FROM chosen f LEFT JOIN cache k ON f.name = k.name) q GROUP BY uf, ano, mes HAVING count(p) > 0
"""


def _run_outcomes(t: Inputs):
    certification = store(_certification(t), "certification")
    held = t.cache.filter("name NOT LIKE 'PA__07%'")
    need = catchup.download_need(certification.filter("skip_reason IS NULL"), held)
    budgeted = catchup.budget_prefix_cut(need, BUDGET)
    files = ls.resolve_partition_files(groups(t))
    per_file = files.join(t.headers.select("name", "records"), "name").select(*KEY, "records")
    counts = verification.check_record_count(verification.partition_row_counts(t.staged), per_file, KEY)
    return catchup.run_outcomes(certification, budgeted, counts)


@register("run_outcomes", "stored listing state cache staged headers", "SELECT * FROM run_outcomes", FINISHING)
def _(t):
    return _run_outcomes(t)


@register(
    "outcome_counts",
    "stored listing state cache staged headers",
    "SELECT outcome, count(*) AS n FROM run_outcomes GROUP BY outcome",
    FINISHING,
)
def _(t):
    return catchup.outcome_counts(_run_outcomes(t))


# --- choice of sources ------------------------------------------------------

_CACHED = """
  SELECT k.*, substr(k.name, 3, 2) AS uf, 2000 + cast(substr(k.name, 5, 2) AS int) AS ano, cast(substr(k.name, 7, 2) AS int) AS mes,
         regexp_extract(k.name, '([a-z]?).dbc$', 1) AS suffix FROM cache k WHERE k.name LIKE '%.dbc'
"""
# Recorded partitions (even months): every recorded file must be cached at its size.
_FROM_RECORD = """
  SELECT c.uf, c.ano, c.mes, arg_min(p, position) FILTER (p IS NOT NULL) AS problem, cast(count(*) AS int) AS files
  FROM (SELECT c.*, CASE WHEN k.name IS NULL THEN 'not-in-cache' WHEN k.bytes = 0 THEN 'empty-in-cache'
                         WHEN k.bytes <> c.size THEN 'size-differs-from-record' END AS p
        FROM chosen c LEFT JOIN cached k ON c.name = k.name) c GROUP BY c.uf, c.ano, c.mes
"""
# The others are chosen from what the cache holds.
_FROM_CACHE = """
  SELECT s.uf, s.ano, s.mes, CASE WHEN k.n IS NULL THEN 'nothing-in-cache' WHEN k.first <> '' AND k.suffixes <> substr('abcdefgh', 1, cast(k.n AS int)) THEN 'variant-gap'
         WHEN k.first <> '' AND k.n = 1 THEN 'lone-variant' END AS problem, cast(k.n AS int) AS files
  FROM stored s LEFT JOIN (
    SELECT uf, ano, mes, count(*) AS n, min(suffix) AS first, string_agg(suffix, '' ORDER BY suffix) AS suffixes
    FROM (SELECT *, bool_or(suffix = '') OVER (PARTITION BY uf, ano, mes) AS has_canonical FROM cached WHERE bytes > 0) q
    WHERE suffix = '' OR NOT has_canonical GROUP BY uf, ano, mes) k ON s.uf = k.uf AND s.ano = k.ano AND s.mes = k.mes
"""
_SOURCED = """
  SELECT s.uf, s.ano, s.mes, r.uf IS NULL OR s.mes % 2 = 1 AS from_cache,
         CASE WHEN r.uf IS NOT NULL AND s.mes % 2 = 0 THEN r.problem ELSE k.problem END AS problem,
         CASE WHEN r.uf IS NOT NULL AND s.mes % 2 = 0 THEN r.files ELSE k.files END AS files
  FROM stored s LEFT JOIN from_record r ON s.uf = r.uf AND s.ano = r.ano AND s.mes = r.mes
  LEFT JOIN from_cache k ON s.uf = k.uf AND s.ano = k.ano AND s.mes = k.mes
"""
SOURCING = {**CHOOSING, "cached": _CACHED, "from_record": _FROM_RECORD, "from_cache": _FROM_CACHE, "sourced": _SOURCED}


def _records(t: Inputs):
    """Sources records of the even months, as the archive would write them."""
    files = ls.resolve_partition_files(groups(t)).filter(F.col("mes") % 2 == 0)
    mtime = F.concat(F.substring("name", 5, 4), F.lit("-00-00"))
    return lineage.build_sources_record(files.withColumn("cache_mtime", mtime))


def _partitions(t: Inputs):
    texts = _records(t).select(*KEY, lineage.sources_record_text(F.col("record")).alias("record_text"))
    return t.stored.select(*KEY).join(texts, KEY, "left")


def _chosen(t: Inputs, fallback: bool = True):
    return lineage.choose_sources(_partitions(t), t.cache, allow_cache_fallback=fallback)


@register(
    "choose_sources",
    "stored listing cache",
    "SELECT uf, ano, mes, from_cache, problem, CASE WHEN problem IS NULL THEN files END AS files FROM sourced",
    SOURCING,
)
def _(t):
    files = F.when(F.col("sources").isNotNull(), F.size("sources"))
    return _chosen(t).select(*KEY, "from_cache", "problem", files.alias("files"))


@register(
    "choose_sources_without_fallback",
    "stored listing cache",
    "SELECT uf, ano, mes, CASE WHEN from_cache THEN 'no-record' ELSE problem END AS problem FROM sourced",
    SOURCING,
)
def _(t):
    return _chosen(t, False).select(*KEY, "problem")


@register(
    "single_or_split",
    "stored listing cache",
    "SELECT files = 1 AS single, count(*) AS n FROM sourced WHERE problem IS NULL GROUP BY files = 1",
    SOURCING,
)
def _(t):
    good = _chosen(t).filter("problem IS NULL")
    single = lineage.single_or_split(F.col("sources")).isNotNull()
    return good.groupBy(single.alias("single")).agg(F.count(F.lit(1)).alias("n"))


@register(
    "build_sources_record",
    "listing",
    """
    SELECT uf, ano, mes, string_agg(name, ',' ORDER BY position) AS files, cast(sum(size) AS bigint) AS bytes,
           count(mtime) AS known_times FROM chosen WHERE mes % 2 = 0 GROUP BY uf, ano, mes
    """,
    CHOOSING,
)
def _(t):
    text = lineage.sources_record_text(F.col("record"))
    parsed = lineage.parse_sources_record(text, F.col("uf"), F.col("ano"), F.col("mes"))
    rows = _records(t).select(*KEY, parsed.alias("p")).filter("p.problem IS NULL").select(*KEY, "p.files")
    return rows.select(
        *KEY,
        F.array_join(F.transform("files", lambda f: f["file"]), ",").alias("files"),
        F.aggregate("files", F.lit(0).cast("bigint"), lambda a, f: a + f["bytes"]).alias("bytes"),
        F.size(F.filter("files", lambda f: f["ftpMtime"].isNotNull())).cast("bigint").alias("known_times"),
    )


@register(
    "record_follows_rule",
    "listing",
    "SELECT uf, ano, mes, count(*) = 1 OR uf <> 'UC' AS follows FROM chosen WHERE mes % 2 = 0 GROUP BY uf, ano, mes",
    CHOOSING,
)
def _(t):
    # Records of one unit list their files backwards.
    files = F.when(F.col("uf") == "UC", F.reverse("record.files")).otherwise(F.col("record.files"))
    follows = lineage.record_follows_rule(files, F.col("uf"), F.col("ano"), F.col("mes"))
    return _records(t).select(*KEY, follows.alias("follows"))


_EMITTED = """
  SELECT s.uf, s.ano, s.mes,
    CASE WHEN s.from_cache AND s.uf <> 'UE' THEN
           CASE WHEN s.uf = 'UD' AND s.mes < 7 THEN 'not-json' WHEN s.uf IN ('UC', 'UD') THEN 'no-output-sha' END
         WHEN s.from_cache THEN 'no-record' ELSE s.problem END AS problem,
    CASE WHEN s.from_cache AND s.uf IN ('UA', 'UB') THEN 'anterior-ao-registro'
         WHEN NOT s.from_cache AND s.problem IS NULL THEN 'escrito' ELSE 'falhou' END AS kind,
    CASE WHEN s.from_cache AND s.uf IN ('UA', 'UB') THEN s.uf = 'UB' END AS legacy FROM sourced s
"""
EMITTING = {**SOURCING, "emitted": _EMITTED}


def _emitted(t: Inputs):
    kept = t.documents_text.select(*KEY, F.col("text").alias("kept_text"))
    sha = t.stored.select(*KEY, F.concat(F.md5("dir"), F.md5("dir")).alias("parquet_sha"))
    chosen = _chosen(t, False).join(kept, KEY, "left").join(sha, KEY)
    return lineage.emission_outcomes(chosen)


@register("emission_outcomes", "stored listing cache", "SELECT * FROM emitted", EMITTING)
def _(t):
    return _emitted(t).select(*KEY, "problem", "kind", "legacy")


@register(
    "drop_stale_provenance",
    "stored listing cache",
    "SELECT uf, ano, mes FROM emitted WHERE kind = 'falhou' AND uf <> 'UE'",
    EMITTING,
)
def _(t):
    _, failures = control.publishable_documents(_emitted(t))
    return failures.filter("drop_document").select(*KEY)


# --- documents --------------------------------------------------------------


@register(
    "emit_provenance",
    "stored listing cache",
    """
    SELECT q.uf, q.ano, q.mes, 'sia-pa' AS dataset, concat(s.dir, '/part.parquet') AS file, s.n AS rows, '6' AS columns,
           CASE WHEN q.files = 1 THEN 'single' ELSE 'split' END AS form, concat(md5(s.dir), md5(s.dir)) AS sha256
    FROM sourced q JOIN stored s ON q.uf = s.uf AND q.ano = s.ano AND q.mes = s.mes WHERE q.problem IS NULL
    """,
    SOURCING,
)
def _(t):
    sha = t.stored.select(*KEY, F.concat(F.md5("dir"), F.md5("dir")).alias("parquet_sha"))
    parts = _partitions(t).join(sha, KEY).withColumn("kept_text", F.lit(None).cast("string"))
    staged = t.order_rows.select("o_orderkey", "o_custkey", "o_orderstatus", *KEY)
    out = jobs.emit_provenance(
        staged, parts, t.cache, "sia-pa", F.lit(NOW), PIPELINE, allow_cache_fallback=True
    ).filter("kind = 'escrito'")
    at = lambda p: F.get_json_object("text", p)
    return out.select(
        *KEY,
        at("$.dataset").alias("dataset"),
        at("$.output.file").alias("file"),
        at("$.output.rows").cast("bigint").alias("rows"),
        at("$.output.columns").alias("columns"),
        F.when(at("$.source.file").isNotNull(), "single").when(at("$.sources[1].file").isNotNull(), "split").alias("form"),
        at("$.output.sha256").alias("sha256"),
    )


def _written_documents(t: Inputs) -> str:
    def build(path):
        control.write_documents(t.documents_text.select(*KEY, "text"), path, "sia-pa")

    return t.once("provenance", build)


@register(
    "scan_source_files",
    "documents_text",
    """
    SELECT sha256(concat(text, chr(10))) AS sha256, cast(octet_length(encode(text)) + 1 AS bigint) AS bytes,
           substr(concat(text, chr(10)), 1, 12) AS header FROM documents_text
    """,
)
def _(t):
    files = listings.scan_source_files(t.spark, _written_documents(t), "txt")
    return files.select("sha256", "bytes", F.decode("header", "UTF-8").alias("header"))


@register(
    "provenance_round_trip",
    "documents_text",
    "SELECT key, md5(text) AS digest FROM documents_text",
)
def _(t):
    docs = documents.scan_provenance(t.spark, _written_documents(t), "sia-pa")
    # The sink ends every document with a line break.
    return docs.select("key", F.md5(F.regexp_replace("text", r"\n\z", "").cast("binary")).alias("digest"))


@register(
    "reconstructed_provenance",
    "stored listing state",
    f"""
    SELECT c.uf, c.ano, c.mes, s.n AS records, c.state_size, strftime(x.last_modified, '%Y-%m-%dT%H:%M:%S.000Z') AS last_modified,
           x.situation AS reason, CASE WHEN x.situation = 'legado' AND c.uf = 'UB' THEN '2012-01-01' END AS previous
    FROM certified c JOIN stored s ON c.uf = s.uf AND c.ano = s.ano AND c.mes = s.mes
    JOIN selected x ON c.uf = x.uf AND c.ano = x.ano AND c.mes = x.mes WHERE c.skip_reason IS NULL
    """,
    CERTIFYING,
)
def _(t):
    good = _certification(t).filter("skip_reason IS NULL")
    described = (
        t.stored.select(*KEY, F.col("n").alias("rows"), F.lit("v1:0::").alias("fingerprint"), F.md5("dir").alias("sha256"))
        .withColumn("schema", F.array(F.struct(F.lit("PA_CMP").alias("name"), F.lit("VARCHAR").alias("type"))))
    )
    source = F.transform(
        "files",
        lambda f: F.struct(
            f["size"].alias("bytes"), f["name"].alias("file"), f["path"].alias("ftpPath"),
            times.iso_millis(f["mtime"]).alias("mtime"), F.md5(f["name"]).alias("sha256"),
        ),
    )
    body = lineage.provenance_body(
        good.join(described, KEY).withColumn("sources", source), "sia-pa", F.lit(NOW), PIPELINE
    )
    text = lineage.provenance_text(F.col("body"), True)
    docs = catchup.add_reconstruction(body, "rebuilt").select(*KEY, text.alias("text"))
    at = lambda p: F.get_json_object("text", f"$.reconstructed.{p}")
    return docs.select(
        *KEY,
        at("certification.dbcRecordCount").cast("bigint").alias("records"),
        at("certification.stateSourceSize").cast("bigint").alias("state_size"),
        at("certification.parquetLastModified").alias("last_modified"),
        at("reason").alias("reason"),
        at("previous.generatedAt").alias("previous"),
    )


@register(
    "validate_provenance",
    "listing cache",
    """
    SELECT c.uf, c.ano, c.mes, c.name, CASE WHEN k.name IS NULL THEN 'source-not-listed' WHEN k.bytes <> c.size THEN 'source-size' END AS problem
    FROM chosen c LEFT JOIN cache k ON c.name = k.name WHERE k.name IS NULL OR k.bytes <> c.size
    UNION ALL SELECT uf, ano, mes, 'part.parquet', 'output-hash' FROM chosen WHERE mes = 9 GROUP BY uf, ano, mes
    """,
    CHOOSING,
)
def _(t):
    files = ls.resolve_partition_files(groups(t))
    entry = F.struct(
        F.col("size").alias("bytes"), F.col("name").alias("file"), F.concat(F.md5("name"), F.md5("name")).alias("sha256")
    )
    docs = files.groupBy(*KEY).agg(F.collect_list(entry).alias("sources")).withColumn("sha256", F.lit("x"))
    actual = docs.select(*KEY, F.when(F.col("mes") == 9, "y").otherwise("x").alias("sha256"))
    cached = t.cache.withColumnRenamed("bytes", "size")
    return lineage.validate_provenance(docs, cached, actual)


@register(
    "listed_but_undocumented",
    "listing",
    "SELECT f.uf, f.ano, f.mes, f.name FROM files f WHERE NOT EXISTS (SELECT 1 FROM chosen c WHERE c.name = f.name)"
    " AND EXISTS (SELECT 1 FROM chosen c WHERE c.uf = f.uf AND c.ano = f.ano AND c.mes = f.mes)",
    CHOOSING,
)
def _(t):
    files = ls.resolve_partition_files(groups(t))
    docs = files.groupBy(*KEY).agg(F.collect_list(F.struct(F.col("name").alias("file"))).alias("sources"))
    return lineage.listed_but_undocumented(docs, t.listing)


@register(
    "reusable_local_objects",
    sql="SELECT concat('k', cast(doc_id AS varchar)) AS key FROM documents WHERE lang <> 'en'",
)
def _(t):
    content = F.col("text").cast("binary")
    key = F.concat(F.lit("k"), F.col("doc_id").cast("string"))
    local = t.documents.select(key.alias("key"), F.length(content).cast("bigint").alias("size"), content.alias("content"))
    # Objects of one language were replaced since they were fetched.
    tag = F.when(F.col("lang") == "en", F.md5(F.lit(b"other"))).otherwise(F.md5(content))
    objects = t.documents.select(key.alias("key"), F.length(content).cast("bigint").alias("size"), tag.alias("etag"))
    return catchup.reusable_local_objects(objects, local).select("key")


@register(
    "archive_job",
    "listing stored order_rows cache",
    """
    SELECT o.uf, o.ano, o.mes, count(*) AS rows, cast(sum(o.o_custkey) AS bigint) AS total
    FROM order_rows o
    JOIN (SELECT c.uf, c.ano, c.mes FROM chosen c LEFT JOIN cache k ON c.name = k.name AND k.bytes = c.size
          GROUP BY c.uf, c.ano, c.mes HAVING count(*) = count(k.name)) w ON o.uf = w.uf AND o.ano = w.ano AND o.mes = w.mes
    JOIN chosen c ON c.uf = o.uf AND c.ano = o.ano AND c.mes = o.mes AND c.suffix = o.suffix
    WHERE NOT (o.uf = 'UA' AND o.mes = 1) AND NOT (o.uf = 'UB' AND o.mes = 2)
    GROUP BY o.uf, o.ano, o.mes
    """,
    CHOOSING,
)
def _(t):
    def build(path):
        rows = t.order_rows
        ext = F.when((F.col("uf") == "UE") & (F.col("suffix") == ""), ".DBC").otherwise(".dbc")
        stem = F.concat(F.lit("PA"), "uf", F.lpad((F.col("ano") - 2000).cast("string"), 2, "0"), F.lpad(F.col("mes").cast("string"), 2, "0"))
        decoded = rows.select(
            F.concat(F.col("ano").cast("string"), F.col("mes").cast("string")).alias("PA_CMP"),
            F.col("o_custkey").cast("string").alias("PA_CODUNI"),
            "o_orderkey", "o_custkey", *KEY, F.concat(stem, "suffix", ext).alias("source_name"),
        )
        there = t.stored.filter("uf = 'UA' AND mes = 1").select(*KEY, "bytes")
        status = t.stored.filter("uf = 'UB' AND mes = 2").select(*KEY, F.lit("skipped").alias("status"))
        jobs.archive(
            t.stored.select(*KEY), there, status, t.listing, decoded, t.cache, f"{path}/data", f"{path}/lineage"
        )

    data = records.scan_dataset(t.spark, t.once("archive_job", build) + "/data")
    return data.groupBy(*KEY).agg(F.count(F.lit(1)).alias("rows"), F.sum("o_custkey").alias("total"))


@register(
    "write_lineage_then_data",
    "lines",
    f"SELECT uf, ano, mes, count(*) AS rows, 'written' AS status FROM lines WHERE NOT (uf = 'UN' AND mes = 4) GROUP BY uf, ano, mes"
    " UNION ALL SELECT DISTINCT uf, ano, mes, cast(0 AS bigint), 'failed' FROM lines WHERE uf = 'UN' AND mes = 4",
)
def _(t):
    path = t.folder("lineage_first")
    counts = verification.partition_row_counts(t.lines)
    # Records of one unit's Aprils could not be built.
    texts = counts.select(
        *KEY, F.when(~((F.col("uf") == "UN") & (F.col("mes") == 4)), F.lit("{}")).alias("record_text")
    )
    status = sink.write_lineage_then_data(texts, t.lines.select(*COLUMNS, *KEY), f"{path}/lineage", f"{path}/data", _LINES)
    written = verification.partition_row_counts(records.scan_dataset(t.spark, f"{path}/data"))
    return status.join(written, KEY, "left").select(*KEY, F.coalesce("rows", F.lit(0)).alias("rows"), "status")


@register(
    "provenance_catchup_job",
    "stored listing state cache staged headers",
    """
    SELECT r.uf, r.ano, r.mes, coalesce(s.outcome, r.outcome) AS outcome, coalesce(s.problem, r.reason) AS reason,
           CASE WHEN coalesce(s.outcome, r.outcome) = 'written' THEN d.sources END AS sources
    FROM run_outcomes r
    LEFT JOIN (SELECT f.uf, f.ano, f.mes, 'failed' AS outcome, f.problem FROM source_faults f
               JOIN budgeted b ON b.uf = f.uf AND b.ano = f.ano AND b.mes = f.mes WHERE b.decision = 'selected') s
      ON s.uf = r.uf AND s.ano = r.ano AND s.mes = r.mes
    LEFT JOIN (SELECT f.uf, f.ano, f.mes, string_agg(concat_ws(' ', f.name, k.bytes, k.sha256, k.mtime), ',' ORDER BY f.position) AS sources
               FROM chosen f JOIN cache k ON f.name = k.name GROUP BY f.uf, f.ano, f.mes) d
      ON d.uf = r.uf AND d.ano = r.ano AND d.mes = r.mes
    """,
    {**FINISHING, "source_faults": _FAULTS},
)
def _(t):
    def described(wanted):
        chosen = t.staged.join(wanted, KEY, "left_semi")
        prints = fingerprint.content_fingerprint(chosen, KEY, fingerprint.archived_payload(t.staged))
        return prints.join(lineage.describe_output(chosen).select(*KEY, "schema"), KEY).withColumn("sha256", F.md5("fingerprint"))

    run = jobs.provenance_catchup(
        t.objects, t.documents_text.select("key", "text"), t.stored.filter("mes = 12 AND uf = 'UE'"), t.listing,
        t.state, t.cache.filter("name NOT LIKE 'PA__07%'"), t.headers, described, "sia-pa", F.lit(NOW), PIPELINE, "rebuilt", budget=BUDGET,
        fetched=t.cache,
    )
    one = "struct<file string, bytes bigint, sha256 string, mtime string>"
    said = F.from_json("text", f"source {one}, sources array<{one}>")
    files = F.coalesce(F.col("said.sources"), F.array("said.source"))
    told = F.transform(files, lambda f: F.concat_ws(" ", f["file"], f["bytes"].cast("string"), f["sha256"], f["mtime"]))
    docs = run.documents.withColumn("said", said).select(*KEY, F.array_join(told, ",").alias("sources"))
    return run.outcomes.join(docs, KEY, "full").select(*KEY, "outcome", "reason", "sources")


