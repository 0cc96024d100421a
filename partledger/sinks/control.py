"""Writing control tables and documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from partledger.functions import names
from partledger.functions.times import iso_millis
from partledger.sinks.runs import read_runs, write_run
from partledger.spec import KEY


def append_state(merged: DataFrame, root: str, run: int) -> None:
    """Adds the entries of one run to the state log.

    Writing a run again replaces it, also by fewer entries or none.
    """
    write_run(merged.select("uf", "period", "size", "mtime"), root, run)


STATE_LOG = "uf string, period string, size bigint, mtime timestamp"


def latest_state(spark: SparkSession, root: str, before_run: int | None = None) -> DataFrame:
    """Newest entry per (uf, period) of the state log: ``uf, period, size, mtime``.

    ``before_run`` ignores that run and later ones. The newest entry is found by a
    partially aggregated maximum, not by sorting each key's history.
    """
    log = read_runs(spark, root, STATE_LOG, before_run)
    newest = log.groupBy("uf", "period").agg(
        F.max_by(F.struct("size", "mtime"), F.col("run")).alias("_e")
    )
    return newest.select("uf", "period", "_e.size", "_e.mtime")


def write_pending(pending: DataFrame, path: str) -> None:
    """Pending partitions as JSON lines, files nested, in report order."""
    variants = F.transform(
        "variants",
        lambda v: F.struct(
            iso_millis(v["mtime"]).alias("ftpMtime"),
            v["path"].alias("ftpPath"),
            v["size"].alias("ftpSize"),
            v["suffix"].alias("suffix"),
        ),
    )
    (
        pending.orderBy("uf", "ano", "mes")
        .select(
            iso_millis(F.col("mtime")).alias("ftpMtime"),
            F.col("size").alias("ftpSize"),
            F.col("mes").alias("month"),
            "reason",
            "uf",
            variants.alias("variants"),
            F.col("ano").alias("year"),
        )
        .write.mode("overwrite")
        .json(path)
    )


def pending_summary(pending: DataFrame, detected_at: Column) -> DataFrame:
    """One row: when detected, how many, and the newest pending period."""
    return pending.agg(
        detected_at.alias("detected_at"),
        F.count(F.lit(1)).alias("pending"),
        F.max("period").alias("latest_period"),
    )


def checked_documents(documents: DataFrame, dataset: str) -> DataFrame:
    """``ano, uf, mes, value`` to write; a key outside the data set's provenance stops the job.

    The check is part of the value, not a filter: a filter on keys would be pushed below the
    step that made them distinct, and run once for each row of the data instead of each document.
    """
    key = names.provenance_key(F.lit(dataset), F.col("ano"), F.col("uf"), F.col("mes"))
    # The text sink ends each record with a newline of its own.
    text = F.regexp_replace("text", r"\n\z", "")
    return documents.select(
        "ano",
        "uf",
        names.two_digits(F.col("mes")).alias("mes"),
        F.when(names.require_provenance_upload_key(key, dataset).isNotNull(), text).alias("value"),
    )


def write_documents(documents: DataFrame, root: str, dataset: str) -> None:
    """Provenance documents, one text file per partition below ``<dataset>/provenance/``.

    ``documents`` has ``KEY, text``. Every key is checked before anything is written.
    """
    (
        checked_documents(documents, dataset)
        .hint("rebalance", "ano", "uf", "mes")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ano", "uf", "mes")
        .text(f"{root.rstrip('/')}/{dataset}/provenance")
    )


def publishable_documents(outcomes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents that may be published, and the failures whose document must go."""
    return outcomes.filter(~F.col("drop_document")), outcomes.filter(F.col("kind") == "falhou").select(
        *KEY, "problem", "drop_document"
    )


def write_manifest(document: DataFrame, path: str) -> None:
    """The catalog document (one row) as a single text file."""
    document.coalesce(1).write.mode("overwrite").text(path)


def write_table(table: DataFrame, path: str) -> None:
    """A control table as Parquet, replacing the previous run's."""
    table.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def write_audit_report(problems: DataFrame, extra: DataFrame, summary: DataFrame, root: str) -> None:
    """Problems, partitions only in the published tree, and the one-row summary."""
    write_table(problems.orderBy("uf", "ano", "mes"), f"{root}/problems")
    write_table(extra.orderBy("uf", "ano", "mes"), f"{root}/only_in_published")
    write_table(summary, f"{root}/summary")


def observe_run(data: DataFrame, name: str = "archive_run") -> tuple[DataFrame, Observation]:
    """The data with row and partition counters attached; read them after the write."""
    seen = Observation(name)
    return data.observe(seen, F.count(F.lit(1)).alias("rows_emitted")), seen


def run_metrics(targets: DataFrame, written: DataFrame) -> DataFrame:
    """One row per run: targets, skipped, rows emitted, distinct units and years."""
    per_target = targets.select(*KEY).join(written.select(*KEY, "rows"), KEY, "left")
    return per_target.agg(
        F.count(F.lit(1)).alias("target_count"),
        F.count_if(F.col("rows").isNull()).alias("skipped"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_emitted"),
        F.array_join(F.array_sort(F.collect_set("uf")), ",").alias("ufs"),
        F.array_join(
            F.transform(F.array_sort(F.collect_set("ano")), lambda y: y.cast("string")), ","
        ).alias("years"),
    )
