"""Logs of numbered runs, in which a run may be written again.

Each try of a run writes below a folder of its own, ``run=N/attempt=X``. The ledger beside the
log, one row per run, names the try that counts and is written last: it is the commit mark. A
replay with other rows, or none, takes the place of the first try as a whole, and what a stopped
try has left is never read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LEDGER = "attempt string, run int"


def _ledger(root: str) -> str:
    return f"{root.rstrip('/')}.runs"


def start_log(spark: SparkSession, root: str, schema: T.StructType | str) -> None:
    """An empty log and ledger, so that the first run can read them; nothing is added to existing ones."""
    columns = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    layout = T.StructType([*columns.fields, T.StructField("run", T.IntegerType()), T.StructField("attempt", T.StringType())])
    spark.createDataFrame([], layout).write.mode("append").partitionBy("run", "attempt").parquet(root)
    spark.createDataFrame([], _LEDGER).write.mode("append").partitionBy("run").parquet(_ledger(root))


def write_run(table: DataFrame, root: str, run: int) -> None:
    """Writes ``table`` as the content of ``run``; an earlier try of that run no longer counts."""
    spark, attempt = table.sparkSession, uuid.uuid4().hex[:12]
    marked = table.withColumn("run", F.lit(run)).withColumn("attempt", F.lit(attempt))
    marked.write.mode("append").partitionBy("run", "attempt").parquet(root)
    mark = spark.range(1).coalesce(1).select(F.lit(attempt).alias("attempt"), F.lit(run).alias("run"))
    (
        mark.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run")
        .parquet(_ledger(root))
    )


def read_runs(
    spark: SparkSession,
    root: str,
    schema: T.StructType | str | None = None,
    before_run: int | None = None,
    only_run: int | None = None,
) -> DataFrame:
    """Rows of the committed runs, with their ``run``.

    ``schema`` has the columns without ``run``; left out, it is read from the files, of which
    there must be one then. ``before_run`` leaves that run and later ones out, ``only_run`` all others.
    Runs and tries are partitions, so files of others are not opened.
    """
    if schema is None:
        found = spark.read.parquet(root).schema
        schema = T.StructType([f for f in found.fields if f.name not in ("run", "attempt")])
    columns = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    layout = T.StructType([*columns.fields, T.StructField("run", T.IntegerType()), T.StructField("attempt", T.StringType())])
    log = spark.read.schema(layout).parquet(root)
    marks = spark.read.schema(_LEDGER).parquet(_ledger(root))
    for wanted, bound in ((F.col("run") < F.lit(before_run), before_run), (F.col("run") == F.lit(only_run), only_run)):
        if bound is not None:
            log, marks = log.filter(wanted), marks.filter(wanted)
    return log.join(marks, ["run", "attempt"], "left_semi").select(*columns.names, "run")
