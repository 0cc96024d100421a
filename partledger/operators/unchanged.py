"""Dropping partitions whose content equals what is already published."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partledger.functions import names, rules
from partledger.operators.delta import release_period
from partledger.spec import KEY


def published_fingerprints(documents: DataFrame) -> DataFrame:
    """``uf, ano, mes, published_fingerprint, published_at`` from document texts."""
    return documents.select(
        *KEY,
        rules.published_fingerprint(F.col("text")).alias("published_fingerprint"),
        rules.published_at(F.col("text")).alias("published_at"),
    )


def skip_unchanged(verified: DataFrame, local: DataFrame, published: DataFrame) -> DataFrame:
    """Verified partitions that have data, as ``changed`` or ``unchanged``.

    A verified partition without local data is dropped; one without a published
    fingerprint is changed.
    """
    out = (
        verified.select(*KEY)
        .join(local.select(*KEY, "rows", "fingerprint"), KEY, "inner")
        .join(published.select(*KEY, "published_fingerprint", "published_at"), KEY, "left")
    )
    same = rules.is_unchanged(F.col("fingerprint"), F.col("published_fingerprint"))
    return out.withColumn(
        "outcome", F.when(same, F.lit("unchanged")).otherwise(F.lit("changed"))
    ).withColumn("published_at", F.when(same, F.col("published_at")))


def unchanged_summary(outcomes: DataFrame) -> DataFrame:
    """One row: unchanged, changed, and those without a published fingerprint."""
    return outcomes.agg(
        F.count_if(F.col("outcome") == "unchanged").alias("unchanged"),
        F.count_if(F.col("outcome") == "changed").alias("changed"),
        F.count_if(F.col("published_fingerprint").isNull()).alias("without_fingerprint"),
    )


def release_of_run(outcomes: DataFrame, previous_newest: Column) -> DataFrame:
    """Release decided by what was published and changed, not by what was pending."""
    changed = outcomes.filter(F.col("outcome") == "changed").select(
        names.period(F.col("ano"), F.col("mes")).alias("period")
    )
    return release_period(changed, previous_newest)
