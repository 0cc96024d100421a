"""Small helpers shared by the tests."""

from datetime import datetime

from pyspark.sql import functions as F

SOURCE_DIR = "/dissemin/publicos/SIASUS/200801_/Dados"


def ts(text):
    return datetime.fromisoformat(text)


def rows(df, *columns):
    """Rows as sorted tuples of the given columns."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))


def value(spark, column):
    """A constant column's value."""
    return spark.range(1).select(column.alias("v")).first()["v"]


def column_of(spark, values, ddl, make):
    """``make(col)`` over a list of single values, in order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {ddl}")
    return [r["v"] for r in df.select("i", make(F.col("x")).alias("v")).orderBy("i").collect()]


def listing(spark, items):
    data = [(n, s, ts(m) if m else None) for n, s, m in items]
    return spark.createDataFrame(data, "name string, size bigint, mtime timestamp")
