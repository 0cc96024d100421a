"""Orders of targets and bounded reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHRONOLOGICAL, NEWEST_FIRST = "chronological", "newest-first"


def sort_targets(targets: DataFrame, order: str = CHRONOLOGICAL) -> DataFrame:
    """Year, unit, month; or newest period first, then unit."""
    if order == NEWEST_FIRST:
        return targets.orderBy(F.desc("ano"), F.desc("mes"), "uf")
    if order == CHRONOLOGICAL:
        return targets.orderBy("ano", "uf", "mes")
    raise ValueError(f"invalid order: {order!r}")


def sort_partitions(partitions: DataFrame) -> DataFrame:
    return partitions.orderBy("ano", "uf", "mes")


def sort_unchanged(unchanged: DataFrame) -> DataFrame:
    return unchanged.orderBy("uf", "ano", "mes")


def report_top_n(rows: DataFrame, order: list[Column | str], limit: int = 50) -> DataFrame:
    """The first ``limit`` rows for a report, each with ``more``: how many are left out.

    Each task keeps its own best ``limit`` rows, so the input is never sorted as a whole.
    """
    total = rows.agg(F.count(F.lit(1))).scalar()
    return rows.orderBy(*order).limit(limit).withColumn(
        "more", F.greatest(total - F.lit(limit), F.lit(0)).cast("bigint")
    )
