"""Writing partitions of microdata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from partledger.functions.names import two_digits
from partledger.session import store
from partledger.spec import KEY, ROW_GROUP_ROWS, SIA_PA, DatasetSpec


def numbered_partitions(data: DataFrame, partition_cols: Sequence[str]) -> tuple[DataFrame, int]:
    """``_of_<column>, _slot`` of each partition of ``data``, stored, and how many there are.

    Slots are numbers that hash into shuffle partitions of their own, so that no two partitions
    share one. Only the partition columns are read.
    """
    spark = data.sparkSession
    keys = data.select(*[F.col(c).alias(f"_of_{c}") for c in partition_cols]).distinct()
    keys = store(keys, "partitions")
    count = keys.count()
    # The partitions in order, and for each place the first number whose hash falls on it.
    place = F.row_number().over(Window.orderBy(*keys.columns)) - 1
    # Of n ln(n) random numbers about one place in n is missed; thrice as many miss none in practice.
    tries = 3 * count * (count.bit_length() + 3)
    slots = (
        spark.range(tries)
        .select(F.col("id").cast("int").alias("_slot"), F.pmod(F.hash(F.col("id").cast("int")), F.lit(max(count, 1))).alias("_place"))
        .groupBy("_place")
        .agg(F.min("_slot").alias("_slot"))
    )
    return store(keys.withColumn("_place", place).join(slots, "_place", "left").drop("_place"), "partition-slots"), count


def arrange_partitions(
    data: DataFrame, partition_cols: Sequence[str], sort_cols: Sequence[str]
) -> DataFrame:
    """Rows brought together by partition and sorted inside, ready to write.

    Each partition has a shuffle partition of its own: one that fits in the advisory size ends up
    in one file, whatever its neighbours, and the rebalance hint lets adaptive execution cut a hot
    one into several sorted files of that size instead of sending it to one task. All other columns
    break ties, so the order within a file does not depend on the run; NULLs sort last.
    """
    ties = [
        c
        for c in data.columns
        if c not in partition_cols and c not in sort_cols
    ]
    order = [F.col(c) for c in partition_cols]
    order += [F.col(f"`{c}`").asc_nulls_last() for c in (*sort_cols, *ties)]
    slots, count = numbered_partitions(data, partition_cols)
    if count < 2:
        return data.hint("rebalance", *partition_cols).sortWithinPartitions(*order)
    same = F.lit(True)
    for c in partition_cols:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    # Rows whose partition was not seen the first time, as after a limit, stay without a slot.
    placed = data.join(F.broadcast(slots), same, "left").select(*data.columns, "_slot")
    return placed.hint("rebalance", count, "_slot").sortWithinPartitions(*order).drop("_slot")


def write_partitions(
    data: DataFrame,
    root: str,
    spec: DatasetSpec = SIA_PA,
    sort_cols: Sequence[str] | None = None,
    mode: str = "overwrite",
) -> None:
    """Sorted, ZSTD-compressed Parquet in ``ano=/uf=/mes=`` directories, 100,000-row groups.

    Overwriting replaces only the partitions present in ``data``.
    """
    cols = list(spec.partition_cols)
    if "mes" in cols:
        data = data.withColumn("mes", two_digits(F.col("mes")))
    arranged = arrange_partitions(data, cols, list(sort_cols or spec.sort_cols))
    (
        arranged.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .option("parquet.block.row.count.limit", ROW_GROUP_ROWS)
        .partitionBy(*cols)
        .parquet(root)
    )


def skip_existing(targets: DataFrame, existing: DataFrame, status: DataFrame | None = None) -> DataFrame:
    """Targets still to write: neither present with data nor marked as skipped.

    ``existing`` has ``KEY, bytes``; ``status`` has ``KEY, status``.
    """
    todo = targets.join(existing.filter(F.col("bytes") > 0).select(*KEY), KEY, "left_anti")
    if status is not None:
        todo = todo.join(status.filter(F.col("status") == "skipped").select(*KEY), KEY, "left_anti")
    return todo


def write_lineage_then_data(
    records: DataFrame,
    data: DataFrame,
    lineage_root: str,
    data_root: str,
    spec: DatasetSpec = SIA_PA,
) -> DataFrame:
    """Lineage first, then the data it describes; returns the status of each target.

    Targets whose record could not be built (``record_text`` NULL) are ``failed`` and those
    without a row ``empty``: neither gets a record or data, so both stay pending. The others
    are ``written``. A failure between the two writes leaves records without data, never data
    without a record, and a rerun redoes both. Records are kept apart by unit and month, so
    one unit's run leaves the others' alone.
    """
    built = records.filter(F.col("record_text").isNotNull()).select(*KEY, "record_text")
    # One small row per target; the data itself is only written once it is known.
    filled = store(data.join(built.select(*KEY), KEY, "left_semi").select(*KEY).distinct(), "filled")
    ready = built.join(filled, KEY, "left_semi")
    (
        ready.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ano", "mes", "uf")
        .parquet(lineage_root)
    )
    write_partitions(data.join(filled, KEY, "left_semi"), data_root, spec)
    seen = filled.withColumn("_filled", F.lit(True))
    status = (
        F.when(F.col("record_text").isNull(), F.lit("failed"))
        .when(F.col("_filled"), F.lit("written"))
        .otherwise(F.lit("empty"))
    )
    return records.join(seen, KEY, "left").select(*KEY, status.alias("status"))


def quarantine_rejected(
    data: DataFrame,
    rejected: DataFrame,
    rejected_root: str,
    spec: DatasetSpec = SIA_PA,
    sort_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Writes the rejected partitions apart and returns the rows that may be published.

    Only rejected partitions are rewritten; the rest is never copied here.
    """
    keys = rejected.select(*KEY).distinct()
    write_partitions(data.join(keys, KEY, "left_semi"), rejected_root, spec, sort_cols)
    return data.join(keys, KEY, "left_anti")


def divert_unchanged(data: DataFrame, outcomes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of changed partitions, and a marker per unchanged one.

    Unchanged partitions are already published, so they are not copied anywhere.
    """
    changed = outcomes.filter(F.col("outcome") == "changed").select(*KEY)
    markers = outcomes.filter(F.col("outcome") == "unchanged").select(
        *KEY, F.lit("unchanged").alias("status"), "fingerprint", "published_at"
    )
    return data.join(changed, KEY, "left_semi"), markers
