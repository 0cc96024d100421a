"""What changed at the source since the recorded state."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partledger.functions import names, rules
from partledger.spec import ALTERED, KEY, NEW, WINDOW


def delta_reasons(
    groups: DataFrame, state: DataFrame, legacy_since: datetime | None = None
) -> DataFrame:
    """Groups with ``reason`` (new, altered or NULL) against ``state(uf, period, size, mtime)``."""
    known = state.select(
        "uf",
        "period",
        F.col("size").alias("_known_size"),
        F.col("mtime").alias("_known_mtime"),
        F.lit(True).alias("_known"),
    )
    with_period = groups.withColumn("period", names.period(F.col("ano"), F.col("mes")))
    changed = rules.has_changed(
        F.col("_known_size"), F.col("_known_mtime"), F.col("size"), F.col("mtime")
    )
    if legacy_since is not None:
        changed = changed | rules.legacy_rescan(
            F.col("_known_mtime"), F.col("mtime"), F.lit(legacy_since)
        )
    reason = F.when(F.col("_known").isNull(), F.lit(NEW)).when(changed, F.lit(ALTERED))
    return (
        with_period.join(known, ["uf", "period"], "left")
        .withColumn("reason", reason)
        .drop("_known", "_known_size", "_known_mtime")
    )


def select_pending(
    groups: DataFrame,
    state: DataFrame,
    window_months: int = 0,
    legacy_since: datetime | None = None,
) -> DataFrame:
    """Pending partitions with their reason.

    With a window, any delta re-opens the newest ``window_months`` periods of the
    listing as a whole; without a delta nothing is pending.
    """
    marked = delta_reasons(groups, state, legacy_since)
    if window_months <= 0:
        return marked.filter(F.col("reason").isNotNull())
    index = names.month_index(F.col("ano"), F.col("mes"))
    any_delta = F.max(F.col("reason").isNotNull())
    start = marked.agg(
        F.when(any_delta, F.max(index) - (window_months - 1)).alias("start")
    ).scalar()
    return marked.filter(F.col("reason").isNotNull() | (index >= start)).withColumn(
        "reason", F.coalesce("reason", F.lit(WINDOW))
    )


def sort_pending(pending: DataFrame) -> DataFrame:
    return pending.orderBy("uf", "ano", "mes")


def reason_counts(pending: DataFrame) -> DataFrame:
    return pending.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def newest_period(periods: DataFrame, column: str = "period") -> DataFrame:
    """One row with the greatest period, NULL when there is none."""
    return periods.agg(F.max(column).alias("newest"))


def release_period(published: DataFrame, previous: Column, column: str = "period") -> DataFrame:
    """Newest period among published partitions, only when later than ``previous``.

    ``previous`` NULL means the state was empty before the run.
    """
    newest = F.col("_newest")
    return (
        published.agg(F.max(column).alias("_newest"))
        .withColumn("_previous", previous)
        .select(
            F.when(F.col("_previous").isNull() | (newest > F.col("_previous")), newest).alias(
                "release"
            )
        )
    )


def mark_processed(
    pending: DataFrame, archived: DataFrame, verified: DataFrame | None = None
) -> DataFrame:
    """Pending partitions with ``outcome``: merged, not-archived or not-verified.

    ``archived`` holds the keys that have an artifact. Verification is only
    required when ``verified`` is given; a partition skipped by the archive then
    stays pending.
    """
    has_artifact = archived.select(*KEY).distinct().withColumn("_archived", F.lit(True))
    out = pending.join(has_artifact, KEY, "left")
    outcome = F.when(F.col("_archived").isNull(), F.lit("not-archived"))
    if verified is not None:
        out = out.join(
            verified.select(*KEY).distinct().withColumn("_verified", F.lit(True)), KEY, "left"
        )
        outcome = outcome.when(F.col("_verified").isNull(), F.lit("not-verified"))
    return out.withColumn("outcome", outcome.otherwise(F.lit("merged"))).drop(
        "_archived", "_verified"
    )


def upsert_state(state: DataFrame, merged: DataFrame) -> DataFrame:
    """State after a run: entries of ``merged`` replace those with the same key.

    Both have ``uf, period, size, mtime`` and one row per key, so one full join decides.
    """
    old, new = F.struct("size", "mtime").alias("_old"), F.struct("size", "mtime").alias("_new")
    both = state.select("uf", "period", old).join(
        merged.select("uf", "period", new), ["uf", "period"], "full"
    )
    entry = F.coalesce("_new", "_old")
    return both.select(
        "uf", "period", entry["size"].alias("size"), entry["mtime"].alias("mtime")
    )


def archived_status(status: DataFrame) -> DataFrame:
    """Keys that count as archived: data written, skipped for good, or proved unchanged."""
    return status.filter(F.col("status").isin("written", "skipped", "unchanged")).select(*KEY)


def state_vs_published(state: DataFrame, published: DataFrame) -> DataFrame:
    """Keys known to only one side. ``published`` has ``uf, ano, mes``."""
    there = published.select(
        "uf", names.period(F.col("ano"), F.col("mes")).alias("period")
    ).distinct()
    left = state.select("uf", "period", F.lit(True).alias("_s"))
    both = left.join(there.withColumn("_p", F.lit(True)), ["uf", "period"], "full")
    side = F.when(F.col("_p").isNull(), F.lit("state")).when(F.col("_s").isNull(), F.lit("published"))
    return both.withColumn("only_in", side).filter(side.isNotNull()).select("uf", "period", "only_in")
