"""Analytic and streaming queries: registered queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.control_queries import GROUPED
from checks.data_queries import COLUMNS, PRINTS
from checks.registry import Inputs, register
from partledger.functions import names
from partledger.plans import analytics
from partledger.sinks.runs import read_runs
from partledger.spec import KEY
from partledger.streaming import incremental


@register(
    "birth_risk_rates",
    "births",
    """
    SELECT uf, ano, count(*) AS births, count(*) FILTER (PESO < 2500) / count(PESO) AS low_weight_rate,
           count(*) FILTER (SEMAGESTAC < 37) / count(SEMAGESTAC) AS premature_rate,
           count(*) FILTER (PESO < 2500 OR SEMAGESTAC < 37) / count(PESO < 2500 OR SEMAGESTAC < 37) AS either_rate FROM births GROUP BY uf, ano
    """,
)
def _(t):
    return analytics.birth_risk_rates(t.births)


@register(
    "caesarean_rate",
    "births",
    """
    SELECT uf, ano, count(*) AS births, count(*) FILTER (PARTO = '2') / count(*) FILTER (PARTO IN ('1', '2')) AS caesarean_rate
    FROM births GROUP BY uf, ano
    """,
)
def _(t):
    return analytics.caesarean_rate(t.births)


@register(
    "adequate_prenatal",
    "births",
    """
    SELECT RACACORMAE, ano, count(*) AS births,
           count(*) FILTER (coalesce(CONSPRENAT >= 7, CONSULTAS = '4')) / count(coalesce(CONSPRENAT >= 7, CONSULTAS = '4')) AS adequate_rate
    FROM births GROUP BY RACACORMAE, ano
    """,
)
def _(t):
    return analytics.adequate_prenatal(t.births, ["RACACORMAE", "ano"])


SCALE = {"1": "0", "2": "1", "3": "2", "4": "3", "5": "5"}


@register(
    "harmonized_schooling",
    "births",
    """
    SELECT ano, coalesce(ESCMAE2010, CASE ESCMAE WHEN '1' THEN '0' WHEN '2' THEN '1' WHEN '3' THEN '2' WHEN '4' THEN '3' WHEN '5' THEN '5' END) AS schooling,
           count(*) AS n FROM births GROUP BY ALL
    """,
)
def _(t):
    rows = analytics.harmonized_schooling(t.births, "ESCMAE2010", "ESCMAE", SCALE)
    return analytics.count_by(rows, ["ano", "schooling"])


@register(
    "epidemic_curve",
    "notifications",
    "SELECT ID_AGRAVO, SEM_PRI, count(*) AS cases FROM notifications WHERE CLASSI_FIN IN ('1') GROUP BY ID_AGRAVO, SEM_PRI",
)
def _(t):
    return analytics.epidemic_curve(t.notifications, confirmed={"CLASSI_FIN": ["1"]})


@register(
    "mortality_by_cause",
    "deaths",
    """
    SELECT substr(CAUSABAS, 1, 3) AS cause, ano, uf, count(*) FILTER (TIPOBITO = '1') AS fetal,
           count(*) FILTER (TIPOBITO IS DISTINCT FROM '1') AS non_fetal FROM deaths GROUP BY 1, 2, 3
    """,
)
def _(t):
    return analytics.mortality_by_cause(t.deaths, 3)


@register(
    "decode_age",
    "deaths",
    """
    SELECT substr(IDADE, 1, 1) AS unit, cast(substr(IDADE, 2, 3) AS int) AS value, count(*) AS n FROM deaths GROUP BY 1, 2
    """,
)
def _(t):
    rows = t.deaths.select(analytics.decode_age(F.col("IDADE")).alias("a")).select("a.unit", "a.value")
    return analytics.count_by(rows, ["unit", "value"])


@register(
    "hospital_age",
    "admissions",
    """
    SELECT CASE COD_IDADE WHEN '1' THEN 'day' WHEN '2' THEN 'month' WHEN '3' THEN 'year' WHEN '4' THEN 'year' END AS unit,
           cast(CASE WHEN COD_IDADE = '4' THEN IDADE + 100 WHEN COD_IDADE IN ('1', '2', '3') THEN IDADE END AS int) AS value, count(*) AS n
    FROM admissions GROUP BY 1, 2
    """,
)
def _(t):
    rows = t.admissions.select(analytics.hospital_age(F.col("COD_IDADE"), F.col("IDADE")).alias("a"))
    return analytics.count_by(rows.select("a.unit", "a.value"), ["unit", "value"])


@register(
    "hospital_mortality",
    "admissions",
    """
    SELECT PROC_REA, uf, count(*) AS admissions, count(*) FILTER (MORTE = '1') AS deaths, count(*) FILTER (MORTE = '1') / count(*) AS mortality,
           cast(sum(VAL_TOT) AS bigint) AS spend_cents FROM admissions GROUP BY PROC_REA, uf
    """,
)
def _(t):
    return analytics.hospital_mortality(t.admissions)


@register(
    "name_establishments",
    "lines snapshots",
    """
    SELECT c.uf, c.PA_CODUNI, c.period, c.n, s.NO_FANTASI AS name FROM (
      SELECT uf, lpad(cast(l_suppkey AS varchar), 7, '0') AS PA_CODUNI, strftime(l_shipdate, '%Y%m') AS period, count(*) AS n FROM lines GROUP BY 1, 2, 3) c
    LEFT JOIN (SELECT uf, CNES, COMPETEN, NO_FANTASI FROM snapshots) s ON c.uf = s.uf AND c.PA_CODUNI = s.CNES AND c.period = s.COMPETEN
    """,
)
def _(t):
    code = F.lpad(F.col("l_suppkey").cast("string"), 7, "0")
    rows = t.lines.select("uf", code.alias("PA_CODUNI"), F.date_format("l_shipdate", "yyyyMM").alias("period"))
    counts = analytics.count_by(rows, ["uf", "PA_CODUNI", "period"])
    return analytics.name_establishments(counts, t.snapshots, by=["uf"])


_MONTHS = {"months": "SELECT DISTINCT CNES, ano * 12 + mes - 1 AS i FROM snapshots"}


@register(
    "establishment_presence",
    "snapshots",
    """
    SELECT CNES, concat(cast(min(i) // 12 AS varchar), '-', lpad(cast(min(i) % 12 + 1 AS varchar), 2, '0')) AS first_period,
           concat(cast(max(i) // 12 AS varchar), '-', lpad(cast(max(i) % 12 + 1 AS varchar), 2, '0')) AS last_period,
           count(*) AS months_present, max(i) - min(i) + 1 - count(*) AS months_missing FROM months GROUP BY CNES
    """,
    _MONTHS,
)
def _(t):
    return analytics.establishment_presence(t.snapshots)


@register(
    "presence_gaps",
    "snapshots",
    """
    SELECT CNES, cast(b AS int) AS last_index, cast(i AS int) AS next_index FROM (
      SELECT CNES, i, lag(i) OVER (PARTITION BY CNES ORDER BY i) AS b FROM months) q WHERE i - b > 1
    """,
    _MONTHS,
)
def _(t):
    return analytics.presence_gaps(t.snapshots)


@register("inventory", "snapshots", "SELECT COMPETEN, TP_UNID, uf, count(*) AS establishments FROM snapshots GROUP BY ALL")
def _(t):
    return analytics.inventory(t.snapshots)


@register(
    "beds_by_municipality",
    "snapshots",
    "SELECT COMPETEN, CODUFMUN, cast(sum(coalesce(QTLEIT01, 0) + coalesce(QTLEIT02, 0)) AS bigint) AS beds FROM snapshots GROUP BY ALL",
)
def _(t):
    return analytics.beds_by_municipality(t.snapshots, ["QTLEIT01", "QTLEIT02"])


@register(
    "join_municipalities",
    "snapshots municipalities",
    """
    SELECT m.municipality, count(*) AS n FROM snapshots s LEFT JOIN municipalities m ON substr(m.code, 1, 6) = substr(s.CODUFMUN, 1, 6)
    GROUP BY m.municipality
    """,
)
def _(t):
    # One row per code meets the register, not one per snapshot.
    per_code = analytics.count_by(t.snapshots, ["CODUFMUN"])
    named = analytics.join_municipalities(per_code, t.municipalities, "CODUFMUN")
    return named.groupBy("municipality").agg(F.sum("n").alias("n"))


# --- incremental runs -------------------------------------------------------

_EARLIER = {
    "earlier": """
      SELECT uf, concat(cast(ano AS varchar), '-', lpad(cast(mes AS varchar), 2, '0')) AS period, size, newest AS mtime FROM known
    """,
    **GROUPED,
    "late": """
      SELECT g.uf, g.period, g.size, CASE WHEN e.uf IS NULL THEN 'novo' ELSE 'alterado' END AS reason
      FROM groups g LEFT JOIN earlier e ON g.uf = e.uf AND g.period = e.period
      WHERE e.uf IS NULL OR e.size <> g.size OR (g.mtime IS NOT NULL AND e.mtime <> g.mtime)
    """,
}


@register(
    "stream_listings",
    "listing known",
    "SELECT uf, period, reason, '1' AS run FROM late UNION ALL SELECT uf, period, 'novo', '0' FROM earlier",
    _EARLIER,
)
def _(t):
    def build(path):
        known = t.known
        name = F.concat(F.lit("PA"), "uf", names.two_digits(F.col("ano") - 2000), names.two_digits(F.col("mes")), F.lit(".dbc"))
        earlier = known.select(name.alias("name"), "size", F.col("newest").alias("mtime"))
        empty = t.state.filter("false")
        incremental.seed_state(empty, f"{path}/state")
        schema = earlier.schema
        for snapshot in (earlier, t.listing.select("name", "size", "mtime")):
            snapshot.coalesce(1).write.mode("append").parquet(f"{path}/in")
            arriving = t.spark.readStream.schema(schema).parquet(f"{path}/in")
            query = incremental.stream_listings(t.spark, arriving, f"{path}/state", f"{path}/pending", f"{path}/checkpoint")
            query.awaitTermination()

    return t.spark.read.parquet(t.once("stream_listings", build) + "/pending").select("uf", "period", "reason", "run")


@register(
    "stream_republications",
    "lines published_lines",
    """
    SELECT uf, ano, mes, rows, outcome <> 'unchanged' AS changed, '1' AS run FROM outcomes
    UNION ALL SELECT uf, ano, mes, rows, true, '0' FROM published_prints
    """,
    PRINTS,
)
def _(t):
    def build(path):
        schema = t.lines.select(*COLUMNS, *KEY).schema
        for version in (t.published_lines, t.lines):
            version.select(*COLUMNS, *KEY).write.mode("append").parquet(f"{path}/in")
            arriving = t.spark.readStream.schema(schema).parquet(f"{path}/in")
            query = incremental.stream_republications(t.spark, arriving, KEY, f"{path}/prints", f"{path}/checkpoint")
            query.awaitTermination()

    return t.spark.read.parquet(t.once("stream_republications", build) + "/prints").select(
        "uf", F.col("ano").cast("int").alias("ano"), F.col("mes").cast("int").alias("mes"), "rows", "changed", "run"
    )


@register(
    "replayed_batch",
    "listing known",
    "SELECT uf, period, reason, 2 AS run FROM late UNION ALL SELECT uf, period, 'novo', 0 FROM earlier",
    _EARLIER,
)
def _(t):
    """Run 1 is tried with the whole listing and replayed with nothing, so run 2 finds everything again."""

    def build(path):
        name = F.concat(F.lit("PA"), "uf", names.two_digits(F.col("ano") - 2000), names.two_digits(F.col("mes")), F.lit(".dbc"))
        earlier = t.known.select(name.alias("name"), "size", F.col("newest").alias("mtime"))
        listing = t.listing.select("name", "size", "mtime")
        incremental.seed_state(t.state.filter("false"), f"{path}/state")
        handle = incremental.listing_batch(t.spark, f"{path}/state", f"{path}/pending")
        for batch, run in ((earlier, 0), (earlier, 0), (listing, 1), (listing.filter("false"), 1), (listing, 2)):
            handle(batch, run)

    return read_runs(t.spark, t.once("replayed_batch", build) + "/pending").select("uf", "period", "reason", "run")


def halves(version: DataFrame) -> list[DataFrame]:
    """Two parts of about as many rows, cut by a hash: rows are filtered where they lie, so a half has as
    many tasks and files as the table, not one."""
    side = F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), F.lit(2))
    return [version.filter(side == k) for k in (0, 1)]


@register(
    "split_reexports",
    "lines published_lines",
    """
    SELECT uf, ano, mes, 2 AS export, rows, fingerprint, outcome <> 'unchanged' AS changed FROM outcomes
    UNION ALL SELECT uf, ano, mes, 1, rows, fingerprint, true FROM published_prints
    """,
    PRINTS,
)
def _(t):
    """Two exports arrive in halves that cut every partition, a batch for each half."""

    def build(path):
        versions = [v.select(*COLUMNS, *KEY).withColumn("export", F.lit(n)) for n, v in ((1, t.published_lines), (2, t.lines))]
        declared = versions[0].unionByName(versions[1]).groupBy(*KEY, "export").agg(F.count(F.lit(1)).alias("rows"))
        declared.write.parquet(f"{path}/declared")
        declared = t.spark.read.schema(declared.schema).parquet(f"{path}/declared")
        for half in [half for version in versions for half in halves(version)]:
            half.write.mode("append").parquet(f"{path}/in")
            arriving = t.spark.readStream.schema(half.schema).parquet(f"{path}/in")
            incremental.stream_reexports(
                t.spark, arriving, KEY, declared, f"{path}/parts", f"{path}/prints", f"{path}/checkpoint", payload=COLUMNS
            ).awaitTermination()

    return read_runs(t.spark, t.once("split_reexports", build) + "/prints").select(
        "uf", F.col("ano").cast("int").alias("ano"), F.col("mes").cast("int").alias("mes"), "export", "rows", "fingerprint", "changed"
    )


@register(
    "stream_partition_counts",
    sql="SELECT event_type, cast(ts AS date) AS day, count(*) AS rows FROM events GROUP BY 1, 2",
)
def _(t: Inputs):
    def build(path):
        schema = t.events.schema
        arriving = t.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(t.sf_dir)
        days = arriving.withColumn("day", F.to_date("ts"))
        incremental.stream_partition_counts(
            t.spark, days, ["event_type", "day"], f"{path}/counts", f"{path}/checkpoint"
        ).awaitTermination()

    counts = read_runs(t.spark, t.once("stream_counts", build) + "/counts")
    return counts.groupBy("event_type", "day").agg(F.sum("rows").alias("rows"))
