"""Structured Streaming versions of the recurring jobs.

State is a keyed table, not operator state: the source may rewrite any past period, so no
watermark is safe. Every batch is keyed by its id; a replayed batch takes the place of its first
try as a whole (see :mod:`partledger.sinks.runs`) and reads only earlier runs. Read the logs with
``read_runs``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from partledger.operators import delta, fingerprint, listing
from partledger.sinks.control import append_state, latest_state
from partledger.sinks.runs import read_runs, start_log, write_run
from partledger.spec import SIA_PA, DatasetSpec


def _start(stream: DataFrame, handle, checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def seed_state(state: DataFrame, state_root: str) -> None:
    """Starts a state log (run -1) from a known state."""
    append_state(state, state_root, -1)


def listing_batch(
    spark: SparkSession,
    state_root: str,
    pending_root: str,
    spec: DatasetSpec = SIA_PA,
    window_months: int = 0,
    legacy_since: datetime | None = None,
) -> Callable[[DataFrame, int], None]:
    """What :func:`stream_listings` does with one batch and its number."""

    def handle(batch: DataFrame, run: int) -> None:
        newest = batch.groupBy("name").agg(
            F.max_by(F.struct("size", "mtime"), F.coalesce("mtime", F.timestamp_seconds(F.lit(0)))).alias("e")
        )
        files = newest.select("name", "e.size", "e.mtime")
        known = latest_state(spark, state_root, before_run=run)
        pending = delta.select_pending(
            listing.group_listing(files, spec), known, window_months, legacy_since
        )
        reported = pending.drop("variants")
        write_run(reported, pending_root, run)
        # The stored result is read back: the state must record exactly what was reported.
        append_state(read_runs(spark, pending_root, reported.schema, only_run=run), state_root, run)

    return handle


def stream_listings(
    spark: SparkSession,
    snapshots: DataFrame,
    state_root: str,
    pending_root: str,
    checkpoint: str,
    spec: DatasetSpec = SIA_PA,
    window_months: int = 0,
    legacy_since: datetime | None = None,
) -> StreamingQuery:
    """Turns arriving listing files into pending partitions and an updated state.

    ``snapshots`` streams ``name, size, mtime``. A batch may hold several snapshots of one
    file; the latest mtime wins. Late revisions of old periods update their entry.
    """
    return _start(snapshots, listing_batch(spark, state_root, pending_root, spec, window_months, legacy_since), checkpoint)


def stream_republications(
    spark: SparkSession,
    arrivals: DataFrame,
    by: list[str],
    prints_root: str,
    checkpoint: str,
) -> StreamingQuery:
    """Fingerprints arriving partitions and records which really changed.

    Each batch must hold whole partitions (one re-export); where a batch limit may cut them, use
    :func:`stream_reexports`. ``prints_root`` collects ``by, rows, fingerprint, changed`` per run.
    """
    schema = f"{_columns(arrivals, by)}, rows bigint, fingerprint string, changed boolean"

    def handle(batch: DataFrame, run: int) -> None:
        current = fingerprint.content_fingerprint(batch, by)
        history = read_runs(spark, prints_root, schema, before_run=run)
        last = history.groupBy(*by).agg(F.max_by("fingerprint", "run").alias("_last"))
        out = current.join(last, by, "left").withColumn(
            "changed", ~F.col("fingerprint").eqNullSafe(F.col("_last"))
        )
        write_run(out.drop("_last"), prints_root, run)

    start_log(spark, prints_root, schema)
    return _start(arrivals, handle, checkpoint)


def _columns(df: DataFrame, names: Sequence[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in names)


def reexport_batch(
    spark: SparkSession,
    arrivals: DataFrame,
    by: list[str],
    declared: DataFrame,
    parts_root: str,
    prints_root: str,
    export: str = "export",
    payload: Sequence[str] | None = None,
) -> Callable[[DataFrame, int], None]:
    """What :func:`stream_reexports` does with one batch and its number."""
    keys = [*by, export]
    hashed = list(payload) if payload is not None else [c for c in arrivals.columns if c != export]
    parts_schema = f"{_columns(arrivals, keys)}, {fingerprint.PARTS}"
    schema = f"{_columns(arrivals, keys)}, rows bigint, fingerprint string, changed boolean"
    expected = declared.select(*keys, F.col("rows").alias("_declared"))
    start_log(spark, parts_root, parts_schema)
    start_log(spark, prints_root, schema)

    def handle(batch: DataFrame, run: int) -> None:
        write_run(fingerprint.fingerprint_parts(batch, keys, fingerprint.row_payload(batch, hashed)), parts_root, run)
        here = read_runs(spark, parts_root, parts_schema, only_run=run).select(*keys)
        seen = read_runs(spark, parts_root, parts_schema, before_run=run + 1).join(here, keys, "left_semi")
        whole = fingerprint.finish_parts(fingerprint.merge_parts(seen, keys), keys).join(expected, keys)
        done = whole.filter(F.col("rows") == F.col("_declared")).drop("_declared")
        history = read_runs(spark, prints_root, schema, before_run=run)
        last = history.groupBy(*by).agg(F.max_by("fingerprint", F.struct("run", export)).alias("_last"))
        # Exports of one partition that end in the same batch follow one another.
        earlier = F.lag("fingerprint").over(Window.partitionBy(*by).orderBy(export))
        out = done.withColumn("_earlier", earlier).join(last, by, "left")
        before = F.coalesce(F.col("_earlier"), F.col("_last"))
        write_run(
            out.withColumn("changed", ~F.col("fingerprint").eqNullSafe(before)).drop("_earlier", "_last"), prints_root, run
        )

    return handle


def stream_reexports(
    spark: SparkSession,
    arrivals: DataFrame,
    by: list[str],
    declared: DataFrame,
    parts_root: str,
    prints_root: str,
    checkpoint: str,
    export: str = "export",
    payload: Sequence[str] | None = None,
) -> StreamingQuery:
    """Fingerprints re-exported partitions that may be spread over any number of batches.

    Rows carry the ``export`` they belong to, and ``declared`` says how many rows an export has for
    each partition (``by, export, rows``), as file headers do. Every batch adds the parts of its
    rows' fingerprints to ``parts_root``, one row per partition of the batch. Once the merged count
    is the declared one, the partition is reported to ``prints_root``, once: ``by, export, rows,
    fingerprint, changed``, compared with the report before it. ``payload`` names the columns to
    hash; by default all but ``export``. NULL keys never meet a declaration.
    """
    handle = reexport_batch(spark, arrivals, by, declared, parts_root, prints_root, export, payload)
    return _start(arrivals, handle, checkpoint)


def open_reexports(
    spark: SparkSession, declared: DataFrame, by: list[str], parts_root: str, export: str = "export"
) -> DataFrame:
    """Declared partitions whose rows have not all come, or too many: ``by, export, declared, arrived``."""
    keys = [*by, export]
    arrived = read_runs(spark, parts_root, f"{_columns(declared, keys)}, {fingerprint.PARTS}").groupBy(*keys).agg(F.sum("rows").alias("arrived"))
    both = declared.select(*keys, F.col("rows").alias("declared")).join(arrived, keys, "left").na.fill(0, ["arrived"])
    return both.filter(F.col("arrived") != F.col("declared"))


def stream_partition_counts(
    spark: SparkSession, arrivals: DataFrame, by: list[str], counts_root: str, checkpoint: str
) -> StreamingQuery:
    """Row counts per partition and batch, written idempotently; sum over committed runs for totals."""

    def handle(batch: DataFrame, run: int) -> None:
        write_run(batch.groupBy(*by).agg(F.count(F.lit(1)).alias("rows")), counts_root, run)

    return _start(arrivals, handle, checkpoint)
