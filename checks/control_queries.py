"""Listings, deltas, reconciliation, catalog: registered queries and their SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from checks.registry import Inputs, register
from partledger.functions import digests, names, rules, times
from partledger.operators import catalog, delta, ordering, verification
from partledger.operators import listing as ls
from partledger.plans import jobs
from partledger.sinks import archive as sink
from partledger.sinks import control
from partledger.sources import documents, listings
from partledger.spec import DATASETS, KEY, SIA_PA

LEGACY_SINCE = datetime(1996, 7, 1)
PERIOD = "concat(cast(ano AS varchar), '-', lpad(cast(mes AS varchar), 2, '0'))"

# The checks take listings apart on their own, without the library's column functions.
FILES = r"""
  SELECT name, size, mtime, recs, upper(substr(name, 3, 2)) AS uf, 2000 + cast(substr(name, 5, 2) AS int) AS ano,
         cast(substr(name, 7, 2) AS int) AS mes, lower(regexp_extract(name, '^PA[A-Z]{2}[0-9]{4}([a-z]?)\.(dbc|DBC)$', 1)) AS suffix
  FROM listing
"""
GROUPS = f"""
  SELECT uf, ano, mes, {PERIOD} AS period, cast(sum(size) AS bigint) AS size, max(mtime) AS mtime,
         string_agg(suffix, ',' ORDER BY suffix) AS suffixes FROM files GROUP BY uf, ano, mes
"""
EXACT = "SELECT *, bool_or(suffix = '') OVER (PARTITION BY uf, ano, mes) AS has_canonical FROM files WHERE name LIKE '%.dbc'"
CHOSEN = """
  SELECT *, row_number() OVER (PARTITION BY uf, ano, mes ORDER BY suffix) - 1 AS position
  FROM exact WHERE suffix = '' OR NOT has_canonical
"""
DELTA = """
  SELECT g.uf, g.ano, g.mes, g.period, g.size, g.mtime,
    CASE WHEN s.uf IS NULL THEN 'novo' WHEN s.size <> g.size THEN 'alterado'
         WHEN s.mtime IS NOT NULL AND g.mtime IS NOT NULL AND s.mtime <> g.mtime THEN 'alterado'
         WHEN s.mtime IS NULL AND g.mtime >= timestamp '1996-07-01' THEN 'alterado' END AS reason
  FROM groups g LEFT JOIN state s ON g.uf = s.uf AND g.period = s.period
"""
PENDING = """
  SELECT uf, ano, mes, period, size, mtime, coalesce(reason, 'janela') AS reason FROM delta
  WHERE reason IS NOT NULL
     OR (ano * 12 + mes >= (SELECT max(ano * 12 + mes) - 11 FROM delta)
         AND EXISTS (SELECT 1 FROM delta d WHERE d.reason IS NOT NULL))
"""
STEPS = {"files": FILES, "groups": GROUPS, "exact": EXACT, "chosen": CHOSEN, "delta": DELTA, "pending": PENDING}


def steps(*wanted: str) -> dict[str, str]:
    return {n: q for n, q in STEPS.items() if n in wanted}


GROUPED = steps("files", "groups")
CHOOSING = steps("files", "groups", "exact", "chosen")
PENDED = steps("files", "groups", "delta", "pending")


def groups(t: Inputs):
    return ls.group_listing(t.listing)


def pending(t: Inputs):
    return delta.select_pending(groups(t), t.state, 12, LEGACY_SINCE)


# --- names, keys and times --------------------------------------------------


@register("parse_source_name", "listing", "SELECT name, uf, ano, mes, suffix FROM files", steps("files"))
def _(t):
    return ls.parse_listing(t.listing).select("name", "uf", "ano", "mes", F.col("variant").alias("suffix"))


@register(
    "parse_all_dataset_names",
    "stored",
    """
    SELECT name, upper(regexp_extract(name, '(?i)^[A-Z]{2}([A-Z]{2})', 1)) AS uf, ano FROM (
      SELECT concat('RD', uf, lpad(cast(ano - 2000 AS varchar), 2, '0'), lpad(cast(mes AS varchar), 2, '0'), '.dbc') AS name, ano FROM stored
      UNION ALL SELECT concat('DO', uf, cast(ano AS varchar), '.dbc'), ano FROM stored GROUP BY uf, ano
      UNION ALL SELECT lower(concat('DN', uf, cast(ano AS varchar), '.dbc')), ano FROM stored GROUP BY uf, ano)
    """,
)
def _(t):
    s = t.stored
    yearly = s.select("uf", "ano").distinct()
    year = F.col("ano").cast("string")
    rd = s.select(
        F.concat(names.source_base_name(DATASETS["sih-rd"], F.col("uf"), F.col("ano"), F.col("mes")), F.lit(".dbc")).alias("name")
    )
    do = yearly.select(F.concat(F.lit("DO"), "uf", year, F.lit(".dbc")).alias("name"))
    dn = yearly.select(F.lower(F.concat(F.lit("DN"), "uf", year, F.lit(".dbc"))).alias("name"))
    parts = [
        df.select("name", names.parse_source_name(F.col("name"), DATASETS[d]).alias("p"))
        for df, d in ((rd, "sih-rd"), (do, "sim"), (dn, "sinasc"))
    ]
    return parts[0].union(parts[1]).union(parts[2]).select("name", "p.uf", "p.ano")


@register(
    "candidate_names",
    "stored",
    """
    SELECT uf, ano, mes, concat('PA', uf, lpad(cast(ano % 100 AS varchar), 2, '0'), lpad(cast(mes AS varchar), 2, '0'), s, '.dbc') AS name
    FROM stored, unnest(list_concat([''], string_split('a,b,c,d,e,f,g,h,i,j,k,l,m,n,o,p,q,r,s,t,u,v,w,x,y,z', ','))) AS u(s)
    """,
)
def _(t):
    found = names.candidate_names(SIA_PA, F.col("uf"), F.col("ano"), F.col("mes"))
    return t.stored.select(*KEY, F.explode(found).alias("name"))


@register(
    "parse_partition_key",
    "objects",
    r"""
    SELECT key, cast(regexp_extract(key, 'ano=([0-9]{4})', 1) AS int) AS ano, regexp_extract(key, 'uf=([A-Z]{2})', 1) AS uf,
           cast(regexp_extract(key, 'mes=([0-9]{2})', 1) AS int) AS mes,
           CASE WHEN key LIKE 'sia-pa/provenance/%' THEN 'provenance' ELSE 'parquet' END AS kind
    FROM objects WHERE key NOT LIKE '%.skipped'
    """,
)
def _(t):
    parsed = t.objects.select("key", names.parse_partition_key(F.col("key"), "sia-pa").alias("p"))
    return parsed.filter("p IS NOT NULL").select("key", "p.ano", "p.uf", "p.mes", "p.kind")


@register(
    "partition_key_columns",
    "stored",
    f"""
    SELECT concat(uf, '|', {PERIOD}) AS key, concat(uf, ' ', {PERIOD}) AS label,
           concat('sia-pa/', dir, '/part.parquet') AS parquet_key,
           concat('sia-pa/provenance/', dir, '/part.provenance.json') AS provenance_key FROM stored
    """,
)
def _(t):
    uf, ano, mes = (F.col(c) for c in KEY)
    return t.stored.select(
        names.partition_key(uf, ano, mes).alias("key"),
        names.partition_label(uf, ano, mes).alias("label"),
        names.parquet_key(F.lit("sia-pa"), ano, uf, mes).alias("parquet_key"),
        names.provenance_key(F.lit("sia-pa"), ano, uf, mes).alias("provenance_key"),
    )


@register(
    "guard_publish_key",
    "objects",
    "SELECT key, key LIKE 'sia-pa/provenance/%' AS allowed FROM objects",
)
def _(t):
    return t.objects.select("key", names.is_provenance_upload_key(F.col("key"), "sia-pa").alias("allowed"))


_DOS_PARTS = """
  SELECT o_orderkey, 1 + o_orderkey % 13 AS mo, 1 + o_custkey % 31 AS dd, o_custkey % 30 AS yy,
         o_orderkey % 24 AS hh, o_custkey % 61 AS mi, CASE WHEN o_orderstatus = 'F' THEN 'AM' ELSE 'pm' END AS half
  FROM orders
"""


@register(
    "parse_dos_mtime",
    sql="""
    SELECT o_orderkey, strftime(try_cast(concat(cast(2000 + yy AS varchar), '-', lpad(cast(mo AS varchar), 2, '0'), '-',
             lpad(cast(dd AS varchar), 2, '0'), ' ', lpad(cast(hh % 12 + CASE WHEN half = 'pm' THEN 12 ELSE 0 END AS varchar), 2, '0'), ':',
             lpad(cast(mi AS varchar), 2, '0'), ':00') AS timestamp), '%Y-%m-%d %H:%M:%S') AS mtime
    FROM dos
    """,
    extra={"dos": _DOS_PARTS},
)
def _(t):
    t.orders.createOrReplaceTempView("orders")
    two = {c: names.two_digits(F.col(c)) for c in ("mo", "dd", "yy", "hh", "mi")}
    raw = F.concat(
        F.lit(" "), two["mo"], F.lit("-"), two["dd"], F.lit("-"), two["yy"], F.lit("  "), two["hh"], F.lit(":"), two["mi"], F.col("half")
    )
    parsed = times.parse_dos_mtime(raw)
    return t.spark.sql(_DOS_PARTS).select(
        "o_orderkey", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("mtime")
    )


@register(
    "header_record_count",
    sql="SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE (o_orderkey * 7919 + o_custkey) % 4294967296 END AS records FROM orders",
)
def _(t):
    big = F.lpad(F.hex((F.col("o_orderkey") * 7919 + F.col("o_custkey")) % 4294967296), 8, "0")
    little = F.concat(*[F.substring(big, i, 2) for i in (7, 5, 3, 1)])
    # Headers of one status are cut short and cannot be read.
    tail = F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.lit("00000000"))
    short = F.when(F.col("o_orderstatus") == "P", F.substring(little, 1, 6)).otherwise(little)
    header = F.unhex(F.concat(F.lit("031A0B1E"), short, tail))
    return t.orders.select("o_orderkey", digests.header_record_count(header).alias("records"))


@register(
    "etag_matches",
    sql="""
    SELECT doc_id, CASE WHEN lang = 'en' THEN false ELSE source IS NOT NULL END AS same FROM documents
    """,
)
def _(t):
    # Tags are plain MD5s, parts of 4 KiB, or (for one language) of another object.
    content = F.col("text").cast("binary")
    step = 4096
    parts = F.ceil(F.length(content) / step).cast("int")
    pieces = F.transform(
        F.sequence(F.lit(0), parts - 1),
        lambda i: F.unhex(F.md5(F.substring(content, i * step + 1, F.lit(step)))),
    )
    joined = F.aggregate(pieces, F.lit(b"").cast("binary"), lambda a, b: F.concat(a, b))
    multipart = F.concat(F.md5(joined), F.lit("-"), parts.cast("string"))
    tag = (
        F.when(F.col("lang") == "en", F.md5(F.concat(content, F.lit("x").cast("binary"))))
        .when(F.col("doc_id") % 2 == 0, multipart)
        .otherwise(F.md5(content))
    )
    return t.documents.select(
        "doc_id", digests.etag_matches(F.concat(F.lit('"'), tag, F.lit('"')), content, step).alias("same")
    )


# --- listings ---------------------------------------------------------------


@register(
    "group_listing",
    "listing",
    "SELECT uf, ano, mes, size, strftime(mtime, '%Y-%m-%d') AS mtime, suffixes FROM groups",
    GROUPED,
)
def _(t):
    return groups(t).select(
        *KEY,
        "size",
        F.date_format("mtime", "yyyy-MM-dd").alias("mtime"),
        F.array_join(F.transform("variants", lambda v: v["suffix"]), ",").alias("suffixes"),
    )


@register(
    "resolve_partition_files",
    "listing",
    "SELECT uf, ano, mes, cast(position AS int) AS position, name, size FROM chosen",
    CHOOSING,
)
def _(t):
    return ls.resolve_partition_files(groups(t)).select(*KEY, "position", "name", "size")


@register(
    "variant_contiguity",
    "listing",
    """
    SELECT g.uf, g.ano, g.mes, coalesce(string_agg(suffix, '' ORDER BY suffix), '') AS suffixes,
           chr(cast(min(CASE WHEN suffix <> '' AND ascii(suffix) - 97 <> position THEN 97 + position END) AS int)) AS gap,
           coalesce(count(suffix) = 1 AND max(suffix) <> '', false) AS lone_variant
    FROM groups g LEFT JOIN chosen c ON g.uf = c.uf AND g.ano = c.ano AND g.mes = c.mes GROUP BY g.uf, g.ano, g.mes
    """,
    CHOOSING,
)
def _(t):
    return ls.variant_contiguity(groups(t))


# --- delta ------------------------------------------------------------------


@register("detect_new", "listing state", "SELECT uf, ano, mes, reason FROM pending", PENDED)
def _(t):
    return jobs.detect_new(t.listing, t.state, SIA_PA, 12, LEGACY_SINCE).pending.select(*KEY, "reason")


@register(
    "detect_without_window",
    "listing state",
    "SELECT uf, ano, mes, reason FROM delta WHERE reason IS NOT NULL",
    steps("files", "groups", "delta"),
)
def _(t):
    return delta.select_pending(groups(t), t.state, 0, LEGACY_SINCE).select(*KEY, "reason")


@register("reason_counts", "listing state", "SELECT reason, count(*) AS n FROM pending GROUP BY reason", PENDED)
def _(t):
    return delta.reason_counts(pending(t))


@register(
    "pending_summary",
    "listing state",
    "SELECT 'now' AS detected_at, count(*) AS pending, max(period) AS latest_period FROM pending",
    PENDED,
)
def _(t):
    return control.pending_summary(pending(t), F.lit("now"))


@register("newest_period", "listing state", "SELECT max(period) AS newest FROM pending", PENDED)
def _(t):
    return delta.newest_period(pending(t))


@register("previous_newest", "state", "SELECT max(period) AS newest FROM state")
def _(t):
    return delta.newest_period(t.state)


@register(
    "revision_window",
    "listing",
    "SELECT uf, period FROM groups WHERE ano * 12 + mes > (SELECT max(ano * 12 + mes) - 12 FROM groups)",
    GROUPED,
)
def _(t):
    g = groups(t).withColumn("period", names.period(F.col("ano"), F.col("mes")))
    start = g.agg(times.window_start(F.max("period"), 12)).scalar()
    return g.filter(times.in_window(F.col("period"), start)).select("uf", "period")


@register("sort_pending", "listing state", "SELECT uf, ano, mes, reason FROM pending ORDER BY uf, ano, mes", PENDED)
def _(t):
    return delta.sort_pending(pending(t)).select(*KEY, "reason")


@register("sort_targets", "listing state", "SELECT uf, ano, mes FROM pending ORDER BY ano DESC, mes DESC, uf", PENDED)
def _(t):
    return ordering.sort_targets(pending(t).select(*KEY), ordering.NEWEST_FIRST)


@register("sort_partitions", "stored", "SELECT uf, ano, mes FROM stored ORDER BY ano, uf, mes")
def _(t):
    return ordering.sort_partitions(t.stored.select(*KEY))


@register(
    "report_top_n",
    "listing state",
    "SELECT uf, ano, mes, size, greatest(cast((SELECT count(*) FROM pending) - 50 AS bigint), 0) AS more"
    " FROM pending ORDER BY size DESC, uf, ano, mes LIMIT 50",
    PENDED,
)
def _(t):
    return ordering.report_top_n(pending(t).select(*KEY, "size"), [F.desc("size"), *KEY], 50)


_STATUS = """
  SELECT uf, ano, mes, CASE WHEN mes IN (1, 2) THEN 'skipped' WHEN mes = 3 THEN 'failed' WHEN mes = 4 THEN 'unchanged'
         ELSE 'written' END AS status FROM stored
"""
_MARKED = """
  SELECT p.*, CASE WHEN s.status IS NULL OR s.status = 'failed' THEN 'not-archived'
                   WHEN v.uf IS NULL THEN 'not-verified' ELSE 'merged' END AS outcome
  FROM pending p LEFT JOIN status s ON p.uf = s.uf AND p.ano = s.ano AND p.mes = s.mes
  LEFT JOIN (SELECT uf, ano, mes FROM stored WHERE mes > 2 AND uf <> 'UE') v ON p.uf = v.uf AND p.ano = v.ano AND p.mes = v.mes
"""
MARKED = {**PENDED, "status": _STATUS, "marked": _MARKED}


def _marked(t: Inputs):
    t.stored.createOrReplaceTempView("stored")
    status = t.spark.sql(_STATUS)
    verified = t.stored.filter("mes > 2 AND uf <> 'UE'")
    return jobs.mark_processed(t.state, pending(t), status, verified)


@register("mark_processed", "listing state stored", "SELECT uf, ano, mes, outcome FROM marked", MARKED)
def _(t):
    return _marked(t)[1].select(*KEY, "outcome")


@register(
    "publish_filter",
    "stored",
    "SELECT uf, ano, mes FROM status WHERE status <> 'failed'",
    {"status": _STATUS},
)
def _(t):
    t.stored.createOrReplaceTempView("stored")
    return delta.archived_status(t.spark.sql(_STATUS))


@register(
    "upsert_state",
    "listing state stored",
    """
    SELECT uf, period, size, strftime(mtime, '%Y-%m-%d') AS mtime FROM marked WHERE outcome = 'merged'
    UNION ALL
    SELECT uf, period, size, strftime(mtime, '%Y-%m-%d') FROM state s
    WHERE NOT EXISTS (SELECT 1 FROM marked m WHERE m.outcome = 'merged' AND m.uf = s.uf AND m.period = s.period)
    """,
    MARKED,
)
def _(t):
    return _marked(t)[0].withColumn("mtime", F.date_format("mtime", "yyyy-MM-dd"))


@register(
    "state_vs_published",
    "state stored",
    f"""
    SELECT coalesce(s.uf, p.uf) AS uf, coalesce(s.period, p.period) AS period,
           CASE WHEN p.uf IS NULL THEN 'state' ELSE 'published' END AS only_in
    FROM state s FULL JOIN (SELECT uf, {PERIOD} AS period FROM stored WHERE uf <> 'UE') p ON s.uf = p.uf AND s.period = p.period
    WHERE s.uf IS NULL OR p.uf IS NULL
    """,
)
def _(t):
    return delta.state_vs_published(t.state, t.stored.filter("uf <> 'UE'"))


@register(
    "skip_existing",
    "listing state stored",
    """
    SELECT p.uf, p.ano, p.mes FROM pending p
    WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.uf = p.uf AND s.ano = p.ano AND s.mes = p.mes AND s.uf IN ('UA', 'UB') AND s.n > 10)
      AND NOT EXISTS (SELECT 1 FROM status s WHERE s.uf = p.uf AND s.ano = p.ano AND s.mes = p.mes AND s.status = 'skipped')
    """,
    {**PENDED, "status": _STATUS},
)
def _(t):
    t.stored.createOrReplaceTempView("stored")
    existing = t.stored.filter("uf IN ('UA', 'UB')").select(
        *KEY, F.when(F.col("n") > 10, F.col("bytes")).otherwise(F.lit(0)).alias("bytes")
    )
    return sink.skip_existing(pending(t).select(*KEY), existing, t.spark.sql(_STATUS))


# --- reconciliation ---------------------------------------------------------

_VERIFIED = """
  SELECT p.uf, p.ano, p.mes, l.rows, CASE WHEN l.rows IS NOT NULL THEN h.records END AS source_rows,
         CASE WHEN l.rows IS NULL THEN 'sem-parquet' WHEN h.records IS NULL THEN 'ftp-ilegivel'
              WHEN l.rows = h.records THEN 'ok' ELSE 'divergente' END AS status
  FROM pending p
  LEFT JOIN (SELECT uf, ano, mes, count(*) AS rows FROM staged GROUP BY uf, ano, mes) l ON p.uf = l.uf AND p.ano = l.ano AND p.mes = l.mes
  LEFT JOIN (SELECT f.uf, f.ano, f.mes, CASE WHEN count(*) = count(h.records) THEN cast(sum(h.records) AS bigint) END AS records
             FROM files f LEFT JOIN headers h ON f.name = h.name GROUP BY f.uf, f.ano, f.mes) h
    ON p.uf = h.uf AND p.ano = h.ano AND p.mes = h.mes
"""
VERIFYING = {**PENDED, "verified": _VERIFIED}


def _verification(t: Inputs):
    return jobs.verify(pending(t), t.staged, t.headers)


@register("verify_partitions", "listing state staged headers", "SELECT * FROM verified", VERIFYING)
def _(t):
    return _verification(t)[0]


@register(
    "split_verified",
    "listing state staged headers",
    "SELECT uf, ano, mes, 'approved' AS side FROM verified WHERE status = 'ok' UNION ALL SELECT uf, ano, mes, 'rejected' FROM verified WHERE status <> 'ok'",
    VERIFYING,
)
def _(t):
    _, good, bad = _verification(t)
    return good.select(*KEY, F.lit("approved").alias("side")).union(bad.select(*KEY, F.lit("rejected").alias("side")))


@register(
    "sum_or_null",
    "headers",
    """
    SELECT substr(name, 3, 2) AS uf, CASE WHEN count(*) = count(records) THEN cast(sum(records) AS bigint) END AS records
    FROM headers GROUP BY substr(name, 3, 2)
    """,
)
def _(t):
    h = t.headers.withColumn("uf", F.substring("name", 3, 2))
    return ls.sum_or_null(h, "records", ["uf"])


@register("partition_row_counts", "staged", "SELECT uf, ano, mes, count(*) AS rows FROM staged GROUP BY uf, ano, mes")
def _(t):
    return verification.partition_row_counts(t.staged)


_PUBLISHED_COUNTS = "SELECT uf, ano, mes, count(*) AS rows FROM staged WHERE uf <> 'UE' OR ano > 2006 GROUP BY uf, ano, mes"
_AUDIT = """
  SELECT coalesce(s.uf, p.uf) AS uf, coalesce(s.ano, p.ano) AS ano, coalesce(s.mes, p.mes) AS mes, p.rows, s.records AS source_rows,
         CASE WHEN s.uf IS NULL THEN NULL WHEN p.rows IS NULL THEN 'sem-parquet' WHEN s.records IS NULL THEN 'ftp-ilegivel'
              WHEN p.rows = s.records THEN 'ok' ELSE 'divergente' END AS status,
         CASE WHEN s.uf IS NULL THEN 'published-only' ELSE 'listed' END AS scope
  FROM (SELECT f.uf, f.ano, f.mes, CASE WHEN count(*) = count(h.records) THEN cast(sum(h.records) AS bigint) END AS records
        FROM files f LEFT JOIN headers h ON f.name = h.name WHERE NOT (f.uf = 'UB' AND f.mes = 2) GROUP BY f.uf, f.ano, f.mes) s
  FULL JOIN (SELECT * FROM published_counts) p ON s.uf = p.uf AND s.ano = p.ano AND s.mes = p.mes
"""
AUDITING = {"published_counts": _PUBLISHED_COUNTS, **steps("files"), "audit": _AUDIT}


def _audit(t: Inputs):
    # One unit's Februaries have left the source but are still published.
    still_listed = t.listing.filter("NOT (name LIKE 'PAUB__02%')")
    published = t.staged.filter("uf <> 'UE' OR ano > 2006")
    return verification.audit_partitions(
        still_listed, t.headers, verification.partition_row_counts(published)
    )


@register("audit_partitions", "listing headers staged", "SELECT * FROM audit", AUDITING)
def _(t):
    return _audit(t)


@register(
    "audit_summary",
    "listing headers staged",
    """
    SELECT count(*) FILTER (scope = 'listed') AS checked, count(*) FILTER (status <> 'ok') AS problems,
           count(*) FILTER (scope = 'published-only') AS only_in_published,
           count(*) FILTER (status <> 'ok') + count(*) FILTER (scope = 'published-only') AS divergent FROM audit
    """,
    AUDITING,
)
def _(t):
    return verification.audit_summary(_audit(t))


@register(
    "only_in_published",
    "listing headers staged",
    "SELECT uf, ano, mes, rows FROM audit WHERE scope = 'published-only'",
    AUDITING,
)
def _(t):
    return verification.only_in_published(_audit(t))


@register(
    "audit_report",
    "listing headers staged",
    "SELECT uf, ano, mes, rows, source_rows, status, scope, greatest(cast((SELECT count(*) FROM audit WHERE status <> 'ok') - 100 AS bigint), 0) AS more"
    " FROM audit WHERE status <> 'ok' ORDER BY uf, ano, mes LIMIT 100",
    AUDITING,
)
def _(t):
    return ordering.report_top_n(verification.audit_problems(_audit(t)), KEY, 100)


@register(
    "check_record_count",
    "staged headers listing",
    """
    SELECT l.uf, l.ano, l.mes, CASE WHEN h.records IS NULL THEN 'unreadable-header' WHEN h.records <> l.rows THEN 'mismatch' END AS problem
    FROM (SELECT uf, ano, mes, count(*) AS rows FROM staged GROUP BY uf, ano, mes) l
    LEFT JOIN (SELECT f.uf, f.ano, f.mes, CASE WHEN count(*) = count(h.records) THEN sum(h.records) END AS records
               FROM files f JOIN headers h ON f.name = h.name GROUP BY f.uf, f.ano, f.mes) h ON l.uf = h.uf AND l.ano = h.ano AND l.mes = h.mes
    """,
    steps("files"),
)
def _(t):
    per_file = ls.parse_listing(t.headers).select(*KEY, "records")
    counts = verification.partition_row_counts(t.staged)
    return verification.check_record_count(counts, per_file, KEY).select(*KEY, "problem")


@register(
    "size_mismatch",
    "listing cache",
    "SELECT l.name, l.size AS expected, c.bytes AS actual FROM listing l LEFT JOIN cache c ON l.name = c.name WHERE c.bytes IS DISTINCT FROM l.size",
)
def _(t):
    both = t.listing.join(t.cache.select("name", "bytes"), "name", "left")
    wrong = rules.size_mismatch(F.col("size"), F.col("bytes"))
    return both.select("name", wrong.alias("w")).filter("w IS NOT NULL").select("name", "w.expected", "w.actual")


@register(
    "describe_source",
    "listing cache",
    """
    SELECT l.name, CASE WHEN c.bytes IS NULL THEN 'unreadable' WHEN c.bytes <> l.size THEN 'size-changed' END AS problem
    FROM listing l LEFT JOIN cache c ON l.name = c.name
    """,
)
def _(t):
    both = t.listing.select("name", "size").join(t.cache, "name", "left")
    return both.select(
        "name",
        rules.source_problem(F.col("bytes"), F.col("size"), F.col("sha256"), F.col("mtime")).alias("problem"),
    )


# --- catalog ----------------------------------------------------------------

_MANIFEST = f"""
  SELECT 'sia-pa' AS dataset, cast(sum(bytes) AS bigint) AS bytes, count(*) AS partitions,
         array_to_string(list_sort(list_distinct(list({PERIOD}))), ',') AS competencias,
         array_to_string(list_sort(list_distinct(list(uf))), ',') AS ufs,
         array_to_string(list_sort(list_distinct(list(ano))), ',') AS years FROM stored
"""


def _partitions(t: Inputs):
    return t.stored.select(F.lit("sia-pa").alias("dataset"), *KEY, "bytes")


def _flat(manifest):
    return manifest.select(
        "dataset",
        "bytes",
        "partitions",
        F.array_join("competencias", ",").alias("competencias"),
        F.array_join("ufs", ",").alias("ufs"),
        F.array_join(F.transform("years", lambda y: y.cast("string")), ",").alias("years"),
    )


@register("manifest", "stored", _MANIFEST)
def _(t):
    return _flat(jobs.build_manifest(_partitions(t)))


@register(
    "manifest_partitions",
    "stored",
    f"""
    SELECT u.uf, p.ano, p.mes, concat('sia-pa/ano=', cast(p.ano AS varchar), '/uf=', u.uf, '/mes=', lpad(cast(p.mes AS varchar), 2, '0'), '/part.parquet') AS path
    FROM (SELECT DISTINCT ano, mes, {PERIOD} AS period FROM stored) p, (SELECT DISTINCT uf FROM stored) u WHERE p.period >= '2008-01'
    """,
)
def _(t):
    return catalog.manifest_partitions(catalog.summarize_manifest(_partitions(t)), "sia-pa", since="2008-01")


@register(
    "manifest_document",
    "stored",
    "SELECT cast(sum(bytes) AS bigint) AS bytes, count(*) AS partitions, count(DISTINCT ano * 12 + mes) AS periods FROM stored",
)
def _(t):
    doc = catalog.manifest_document(catalog.summarize_manifest(_partitions(t)), F.lit("2026-12-01T00:00:00.000Z"))
    at = lambda p: F.get_json_object("value", f"$.datasets.sia-pa.{p}")
    periods = F.from_json(at("competencias"), "array<string>")
    return doc.select(
        at("bytes").cast("bigint").alias("bytes"),
        at("partitions").cast("bigint").alias("partitions"),
        F.size(periods).cast("bigint").alias("periods"),
    )


@register(
    "manifest_regressions",
    "stored",
    """
    SELECT uf AS dataset, count(*) AS published_partitions, nullif(count(*) FILTER (mes <> 12 AND uf <> 'UE'), 0) AS partitions
    FROM stored WHERE uf <> 'UA' GROUP BY uf
    """,
)
def _(t):
    by_unit = t.stored.select(F.col("uf").alias("dataset"), *KEY, "bytes")
    new = catalog.summarize_manifest(by_unit.filter("uf <> 'UE' AND (mes <> 12 OR uf = 'UA')"))
    return catalog.manifest_regressions(new, catalog.summarize_manifest(by_unit))


@register(
    "guard_manifest",
    "stored",
    _MANIFEST,
)
def _(t):
    old = catalog.summarize_manifest(_partitions(t).filter("mes < 12"))
    return _flat(jobs.build_manifest(_partitions(t), old))


@register(
    "coverage_gaps",
    "stored",
    """
    SELECT u.uf, y.ano, m.mes FROM (SELECT DISTINCT uf FROM stored) u, (SELECT DISTINCT ano FROM stored) y,
           (SELECT cast(i AS int) AS mes FROM range(1, 13) r(i)) m
    WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.uf = u.uf AND s.ano = y.ano AND s.mes = m.mes)
    """,
)
def _(t):
    return catalog.coverage_gaps(t.stored, ("UA", "UB", "UC", "UD", "UE"))


@register(
    "coverage_by_year",
    "stored",
    "SELECT ano, count(*) AS published, cast(60 AS int) AS expected, count(*) / 60 AS coverage FROM stored GROUP BY ano",
)
def _(t):
    return catalog.coverage_by_year(t.stored, ("UA", "UB", "UC", "UD", "UE"))


@register(
    "target_grid",
    "stored",
    "SELECT u.uf, y.ano, cast(m.mes AS int) AS mes FROM (SELECT DISTINCT uf FROM (VALUES ('UA'), ('UC')) v(uf)) u,"
    " (SELECT DISTINCT ano FROM stored) y, range(1, 13) m(mes) WHERE m.mes IN (3, 6)",
)
def _(t):
    grid = catalog.expected_partitions(t.stored, ("UA", "UB", "UC", "UD", "UE"))
    return ls.select_period_listing(grid, ufs=["UA", "UC"], months=[3, 6])


@register(
    "run_metrics",
    "listing state staged",
    """
    SELECT count(*) AS target_count, count(*) FILTER (l.rows IS NULL) AS skipped, cast(coalesce(sum(l.rows), 0) AS bigint) AS rows_emitted,
           array_to_string(list_sort(list_distinct(list(p.uf))), ',') AS ufs,
           array_to_string(list_sort(list_distinct(list(p.ano))), ',') AS years
    FROM pending p LEFT JOIN (SELECT uf, ano, mes, count(*) AS rows FROM staged GROUP BY uf, ano, mes) l
      ON p.uf = l.uf AND p.ano = l.ano AND p.mes = l.mes
    """,
    PENDED,
)
def _(t):
    return control.run_metrics(pending(t), verification.partition_row_counts(t.staged))


# --- documents --------------------------------------------------------------


def _pages(df, item, by, field):
    """One JSON document per group of ``by`` with the items in an array."""
    return df.groupBy(*by).agg(F.to_json(F.struct(F.collect_list(item).alias(field))).alias("value"))


@register(
    "scan_object_listing",
    "objects",
    "SELECT key, size, etag, strftime(last_modified, '%Y-%m-%d %H:%M:%S') AS last_modified FROM objects",
)
def _(t):
    item = F.struct(
        F.concat(F.lit('"'), "etag", F.lit('"')).alias("ETag"),
        F.col("key").alias("Key"),
        F.date_format("last_modified", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("LastModified"),
        F.col("size").alias("Size"),
    )
    page = F.regexp_extract("key", "ano=([0-9]+)/uf=(..)", 0).alias("page")
    docs = _pages(t.objects.withColumn("page", page), item, ["page"], "Contents")
    return listings.parse_object_listing(docs).withColumn(
        "last_modified", F.date_format("last_modified", "yyyy-MM-dd HH:mm:ss")
    )


@register(
    "scan_object_lines",
    "stored",
    "SELECT 'sia-pa' AS dataset, uf, ano, mes, bytes FROM stored",
)
def _(t):
    line = F.concat_ws(
        " ", F.date_format("last_modified", "yyyy-MM-dd HH:mm:ss"), F.lpad(F.col("size").cast("string"), 12, " "), "key"
    )
    return listings.parse_object_lines(t.objects.select(line.alias("value")))


@register(
    "scan_listing_file",
    "listing",
    "SELECT name, size, strftime(mtime, '%Y-%m-%d') AS mtime FROM listing",
)
def _(t):
    item = F.struct(times.iso_millis(F.col("mtime")).alias("mtime"), "name", "size")
    docs = t.listing.groupBy(F.substring("name", 3, 4).alias("page")).agg(
        F.to_json(F.collect_list(item), {"ignoreNullFields": "false"}).alias("value")
    )
    return listings.parse_listing_documents(docs).withColumn("mtime", F.date_format("mtime", "yyyy-MM-dd"))


@register("scan_pending", "listing state", "SELECT uf, ano, mes FROM pending WHERE uf <> 'UD'", PENDED)
def _(t):
    dataset = F.when(F.col("uf") == "UD", F.lit("sih-rd")).otherwise(F.lit("sia-pa"))
    item = F.struct(dataset.alias("dataset"), "uf", F.col("ano").alias("year"), F.col("mes").alias("month"))
    return documents.parse_pending(_pages(pending(t), item, ["ano"], "pending"), "sia-pa")


@register(
    "scan_state",
    "state",
    "SELECT uf, period, size, strftime(mtime, '%Y-%m-%d') AS mtime FROM state",
)
def _(t):
    doc = documents.state_document(t.state, F.lit("2026-12-01T00:00:00.000Z"))
    return documents.parse_state(doc).withColumn("mtime", F.date_format("mtime", "yyyy-MM-dd"))


@register(
    "scan_verified",
    "listing state staged headers",
    f"SELECT uf, ano, mes, concat(uf, '|', {PERIOD}) AS key FROM verified WHERE status = 'ok'",
    VERIFYING,
)
def _(t):
    item = F.struct("uf", F.col("ano").alias("year"), F.col("mes").alias("month"))
    return documents.parse_verified(_pages(_verification(t)[1], item, ["ano"], "verified"))


@register(
    "state_log",
    "state listing",
    """
    SELECT coalesce(g.uf, s.uf) AS uf, coalesce(g.period, s.period) AS period, coalesce(g.size, s.size) AS size
    FROM state s FULL JOIN (SELECT * FROM groups WHERE uf IN ('UB', 'UC')) g ON g.uf = s.uf AND g.period = s.period
    """,
    GROUPED,
)
def _(t):
    def build(path):
        control.append_state(t.state, path, 0)
        later = groups(t).filter("uf IN ('UB', 'UC')")
        later = later.withColumn("period", names.period(F.col("ano"), F.col("mes")))
        control.append_state(later, path, 1)
        control.append_state(later, path, 1)

    return control.latest_state(t.spark, t.once("state_log", build)).select("uf", "period", "size")


@register(
    "write_pending",
    "listing state",
    """
    SELECT uf, year, reason, count(*) AS n, cast(sum(files) AS bigint) AS files FROM (
      SELECT p.uf, cast(p.ano AS bigint) AS year, p.reason, length(g.suffixes) - length(replace(g.suffixes, ',', '')) + 1 AS files
      FROM pending p JOIN groups g ON p.uf = g.uf AND p.period = g.period) q GROUP BY uf, year, reason
    """,
    PENDED,
)
def _(t):
    path = t.folder("pending_json")
    control.write_pending(pending(t), path)
    back = t.spark.read.schema("uf string, year bigint, reason string, variants array<struct<suffix:string>>").json(path)
    return back.groupBy("uf", "year", "reason").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.size("variants").cast("bigint")).alias("files")
    )


@register(
    "report_of_run",
    "stored",
    "SELECT count(*) AS rows_emitted FROM stored",
)
def _(t):
    watched, seen = control.observe_run(t.stored, "run")
    watched.write.mode("overwrite").parquet(t.folder("observed"))
    return t.spark.createDataFrame([(seen.get["rows_emitted"],)], "rows_emitted bigint")
