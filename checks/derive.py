"""Control tables and microdata derived from the given tables.

The definitions are plain SQL that Spark and other engines read alike, so a query and
its check start from the same input. Everything is computed from whole tables: orders
become source files (one per unit, month and status), order lines become microdata, and an
"earlier" version of each leaves out what had not arrived by then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partledger.session import apply_settings

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()

_PERIOD = "concat(cast(ano AS varchar(4)), '-', lpad(cast(mes AS varchar(2)), 2, '0'))"
_DIR = "concat('ano=', cast(ano AS varchar(4)), '/uf=', uf, '/mes=', lpad(cast(mes AS varchar(2)), 2, '0'))"
_FILE = "concat('PA', uf, lpad(cast(ano - 2000 AS varchar(4)), 2, '0'), lpad(cast(mes AS varchar(2)), 2, '0'), suffix"

CTES = {
    # Orders as decoded source rows: unit, period and the file variant they came in.
    "order_rows": """
      SELECT *, cast(year(o_orderdate) + 10 AS int) AS ano, cast(month(o_orderdate) AS int) AS mes,
             CASE WHEN uf IN ('UA', 'UB') THEN ''
                  WHEN o_orderstatus = 'F' THEN 'a'
                  WHEN uf = 'UC' THEN CASE WHEN o_orderstatus = 'O' THEN 'b' ELSE 'c' END
                  WHEN o_orderstatus = 'P' THEN ''
                  WHEN uf = 'UD' THEN 'b' ELSE 'c' END AS suffix
      FROM (SELECT *, concat('U', translate(substr(o_orderpriority, 1, 1), '12345', 'ABCDE')) AS uf FROM orders) q
    """,
    # What the source lists today.
    "listing": f"""
      SELECT {_FILE}, CASE WHEN uf = 'UE' AND suffix = '' THEN '.DBC' ELSE '.dbc' END) AS name,
             cast(sum(o_custkey + 1) AS bigint) AS size,
             CASE WHEN uf = 'UD' AND suffix = 'b' AND ano = 2006 THEN NULL ELSE max(o_orderdate) END AS mtime,
             count(*) AS recs
      FROM order_rows GROUP BY uf, ano, mes, suffix
    """,
    # What the archive knew: the newest months and some late files had not arrived.
    "known": """
      SELECT uf, ano, mes, cast(sum(o_custkey + 1) AS bigint) AS size, max(o_orderdate) AS newest
      FROM order_rows
      WHERE o_orderdate < (SELECT date_trunc('month', max(o_orderdate)) - INTERVAL 2 MONTH FROM orders)
        AND NOT (uf = 'UB' AND o_orderstatus = 'P' AND ano >= 2010)
      GROUP BY uf, ano, mes
    """,
    "state": f"""
      SELECT uf, {_PERIOD} AS period, size,
             CASE WHEN ano < 2007 THEN NULL WHEN uf = 'UC' AND ano = 2009 THEN newest - INTERVAL 1 DAY
                  ELSE newest END AS mtime
      FROM known
    """,
    # Rows the archive step produced.
    "staged": """
      SELECT uf, ano, mes, o_orderkey, o_custkey, o_totalprice FROM order_rows
      WHERE NOT (uf = 'UD' AND ano = 2010 AND o_orderstatus = 'O') AND NOT (uf = 'UA' AND mes = 8)
    """,
    # Record counts of source headers; some cannot be read.
    "headers": f"""
      SELECT name, concat('/dissemin/publicos/SIASUS/200801_/Dados/', name) AS path,
             CASE WHEN name LIKE 'PAUC06%c.dbc' THEN NULL ELSE recs END AS records
      FROM listing
    """,
    # Files in the local cache: some missing, empty or of another size.
    "cache": f"""
      SELECT name,
             CASE WHEN name LIKE 'PAUB__03%' THEN size + 1 WHEN name LIKE 'PAUC__04c%' THEN 0 ELSE size END AS bytes,
             concat(substr(name, 5, 4), '-00-00') AS mtime, concat(md5(name), md5(name)) AS sha256
      FROM listing WHERE name NOT LIKE 'PAUC__06b%'
    """,
    # Stored objects and the provenance documents among them.
    "stored": f"""
      SELECT uf, ano, mes, cast(sum(o_custkey + 1) AS bigint) AS bytes, count(*) AS n,
             max(o_orderdate) AS newest, {_DIR} AS dir
      FROM order_rows GROUP BY uf, ano, mes
    """,
    "objects": f"""
      SELECT concat('sia-pa/', dir, '/part.parquet') AS key, bytes AS size, md5(dir) AS etag,
             CASE WHEN mes = 5 THEN newest + INTERVAL 12 HOUR ELSE newest + INTERVAL 2 DAY END AS last_modified
      FROM stored
      UNION ALL
      SELECT concat('sia-pa/provenance/', dir, '/part.provenance.json'), cast(300 AS bigint), md5(dir), newest
      FROM stored WHERE uf <> 'UE'
      UNION ALL
      SELECT concat('sia-pa/', dir, '/part.parquet.skipped'), cast(0 AS bigint), md5(dir), newest
      FROM stored WHERE uf = 'UE'
    """,
    "documents_text": """
      SELECT uf, ano, mes, concat('sia-pa/provenance/', dir, '/part.provenance.json') AS key,
             CASE uf
               WHEN 'UA' THEN concat('{"generatedAt":"2012-01-01","output":{"sha256":"', md5(dir), md5(dir),
                 '","fingerprint":"v1:', cast(n AS varchar(20)), ':AA:BB"},"source":{"bytes":5,"sha256":"', md5(dir), md5(dir), '"}}')
               WHEN 'UB' THEN concat('{"generatedAt":"2012-01-01","output":{"sha256":"', md5(dir), md5(dir),
                 '","fingerprint":"v0:1:A:B"},"pipeline":{"decoder":"d@1"},"source":{"bytes":0,"sha256":"', md5(dir), md5(dir), '"}}')
               WHEN 'UC' THEN '{"generatedAt":7,"output":{"fingerprint":5},"source":null,"sources":[]}'
               WHEN 'UD' THEN CASE WHEN mes < 7 THEN '{"output":' ELSE '{"output":null}' END
             END AS text
      FROM stored WHERE uf <> 'UE'
    """,
    # Order lines as microdata of (unit, year, month).
    "lines": """
      SELECT *, concat('U', l_returnflag) AS uf, cast(year(l_shipdate) AS int) AS ano,
             cast(month(l_shipdate) AS int) AS mes
      FROM lineitem
    """,
    # The same microdata as published before: the newest month was missing, late lines of the
    # revision window had not arrived, and some quantities were corrected since.
    "published_lines": """
      SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
             CASE WHEN l_returnflag = 'N' AND year(l_shipdate) = 1999 AND l_linenumber = 1
                  THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
             l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate, uf, ano, mes
      FROM lines
      WHERE l_shipdate < (SELECT date_trunc('month', max(l_shipdate)) FROM lineitem)
        AND NOT (l_returnflag = 'R' AND l_linenumber > 5 AND
                 l_shipdate >= (SELECT date_trunc('month', max(l_shipdate)) - INTERVAL 11 MONTH FROM lineitem))
    """,
    # Births, deaths, admissions, notifications and establishments with the documented columns.
    "births": """
      SELECT uf, ano, mes, cast(o_orderkey AS varchar(20)) AS NUMERODN,
             CASE WHEN o_totalprice > 150000 THEN NULL ELSE cast(floor(o_totalprice / 30) AS bigint) END AS PESO,
             CASE WHEN o_orderstatus = 'O' THEN NULL ELSE 22 + o_custkey % 22 END AS SEMAGESTAC,
             CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '2' ELSE '9' END AS PARTO,
             CASE WHEN ano >= 2008 THEN o_custkey % 12 END AS CONSPRENAT,
             CASE WHEN ano < 2008 THEN cast(1 + o_orderkey % 5 AS varchar(1)) END AS CONSULTAS,
             cast(1 + o_custkey % 5 AS varchar(1)) AS RACACORMAE,
             CASE WHEN ano < 2008 THEN cast(1 + o_custkey % 6 AS varchar(1)) END AS ESCMAE,
             CASE WHEN ano >= 2008 THEN cast(o_custkey % 6 AS varchar(1)) END AS ESCMAE2010
      FROM order_rows
    """,
    "deaths": """
      SELECT uf, ano, CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '2' END AS TIPOBITO,
             concat(substr('ABCDEFGHIJ', cast(1 + o_custkey % 10 AS int), 1), lpad(cast(o_orderkey % 100 AS varchar(2)), 2, '0'),
                    cast(o_custkey % 10 AS varchar(1))) AS CAUSABAS,
             lpad(cast((o_orderkey * 37) % 7000 AS varchar(4)), 4, '0') AS IDADE
      FROM order_rows
    """,
    "admissions": """
      SELECT uf, ano, mes, l_orderkey, lpad(cast(l_partkey AS varchar(10)), 10, '0') AS PROC_REA,
             CASE WHEN l_returnflag = 'R' AND l_linenumber > 4 THEN '1' ELSE '0' END AS MORTE,
             cast(round(l_extendedprice * 100) AS bigint) AS VAL_TOT,
             cast(l_linenumber AS varchar(1)) AS COD_IDADE, l_suppkey % 100 AS IDADE
      FROM lines
    """,
    "notifications": """
      SELECT event_type AS ID_AGRAVO, concat(cast(year(ts) AS varchar(4)), lpad(cast(cast(floor((dayofyear(ts) + 6) / 7) AS int) AS varchar(2)), 2, '0')) AS SEM_PRI,
             CASE WHEN value > 10 THEN '1' ELSE '2' END AS CLASSI_FIN
      FROM events
    """,
    "snapshots": """
      SELECT uf, ano, mes, lpad(cast(l_suppkey AS varchar(7)), 7, '0') AS CNES,
             concat(cast(ano AS varchar(4)), lpad(cast(mes AS varchar(2)), 2, '0')) AS COMPETEN,
             concat('Unit ', cast(l_suppkey AS varchar(10))) AS NO_FANTASI,
             lpad(cast(l_suppkey % 9 AS varchar(2)), 2, '0') AS TP_UNID,
             concat('12', lpad(cast(l_suppkey % 40 AS varchar(4)), 4, '0')) AS CODUFMUN,
             count(*) AS QTLEIT01, CASE WHEN min(l_linenumber) > 1 THEN NULL ELSE max(l_linenumber) END AS QTLEIT02
      FROM lines GROUP BY uf, ano, mes, l_suppkey
    """,
    "municipalities": """
      SELECT concat('12', lpad(cast(s_suppkey % 40 AS varchar(4)), 4, '0'), cast(s_suppkey % 40 % 10 AS varchar(1))) AS code,
             max(s_name) AS municipality
      FROM supplier GROUP BY s_suppkey % 40
    """,
}

_NEEDS = {
    "listing": ["order_rows"],
    "known": ["order_rows"],
    "state": ["known"],
    "staged": ["order_rows"],
    "headers": ["listing"],
    "cache": ["listing"],
    "stored": ["order_rows"],
    "objects": ["stored"],
    "documents_text": ["stored"],
    "published_lines": ["lines"],
    "births": ["order_rows"],
    "deaths": ["order_rows"],
    "admissions": ["lines"],
    "snapshots": ["lines"],
}


def with_tables(names: list[str], extra: dict[str, str] | None = None) -> str:
    """A ``WITH`` clause that defines the derived tables and what they build on."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for need in _NEEDS.get(name, []):
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    parts = [f"{n} AS ({CTES[n]})" for n in ordered] + [f"{n} AS ({q})" for n, q in (extra or {}).items()]
    return "WITH " + ", ".join(parts)


_SCHEMAS: dict[str, object] = {}


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table whose schema is inferred once per path."""
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, or one derived from them."""
    apply_settings(spark)
    if name in TABLES:
        return read_parquet(spark, f"{sf_dir}/{name}.parquet")
    for given in ("orders", "lineitem", "events", "supplier"):
        read_parquet(spark, f"{sf_dir}/{given}.parquet").createOrReplaceTempView(given)
    df = spark.sql(f"{with_tables([name])} SELECT * FROM {name}")
    for c in ("mtime", "newest", "last_modified"):
        if dict(df.dtypes).get(c) == "timestamp_ntz":
            df = df.withColumn(c, F.col(c).cast("timestamp"))
    return df
