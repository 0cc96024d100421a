"""Reconciliation of row counts between sources, staged and published data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partledger.functions import rules
from partledger.operators.listing import sum_or_null, parse_listing
from partledger.spec import KEY, OK, SIA_PA, DatasetSpec


def partition_row_counts(data: DataFrame) -> DataFrame:
    """Rows per partition. Only partition columns are read, so Parquet footers suffice."""
    return data.groupBy(*KEY).agg(F.count(F.lit(1)).alias("rows"))


def verify_partitions(pending: DataFrame, local: DataFrame, headers: DataFrame) -> DataFrame:
    """Pending partitions with local rows, summed source records and their status.

    ``pending`` carries ``variants``; ``headers`` has ``path, records`` (NULL when
    the header could not be read). One unreadable header makes the sum unknown.
    """
    files = pending.select(*KEY, F.explode("variants").alias("_v")).select(*KEY, "_v.path")
    sums = sum_or_null(files.join(headers, "path", "left"), "records", KEY)
    out = (
        pending.select(*KEY)
        .join(local.select(*KEY, "rows"), KEY, "left")
        .join(sums, KEY, "left")
    )
    source = F.when(F.col("rows").isNotNull(), F.col("records"))
    return out.select(
        *KEY,
        "rows",
        source.alias("source_rows"),
        rules.classify_counts(F.col("rows"), source).alias("status"),
    )


def split_verified(verification: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Approved and rejected partitions."""
    return (
        verification.filter(F.col("status") == OK),
        verification.filter(F.col("status") != OK),
    )


def audit_partitions(
    listing: DataFrame, headers: DataFrame, published: DataFrame, spec: DatasetSpec = SIA_PA
) -> DataFrame:
    """Every partition known to the source or to the published tree.

    ``scope`` is ``listed`` (then ``status`` compares counts) or ``published-only``.
    Published years the source no longer lists are not looked at.
    """
    files = parse_listing(listing, spec).select(*KEY, "name")
    counted = files.join(headers.select("name", "records"), "name", "left")
    sums = sum_or_null(counted, "records", KEY).withColumn("_listed", F.lit(True))
    years = sums.select("ano").distinct()
    there = published.select(*KEY, "rows").join(years, "ano", "left_semi")
    both = sums.join(there, KEY, "full")
    listed = F.col("_listed").isNotNull()
    return both.select(
        *KEY,
        "rows",
        F.col("records").alias("source_rows"),
        F.when(listed, rules.classify_counts(F.col("rows"), F.col("records"))).alias("status"),
        F.when(listed, F.lit("listed")).otherwise(F.lit("published-only")).alias("scope"),
    )


def audit_problems(audit: DataFrame) -> DataFrame:
    return audit.filter((F.col("scope") == "listed") & (F.col("status") != OK))


def only_in_published(audit: DataFrame) -> DataFrame:
    return audit.filter(F.col("scope") == "published-only").select(*KEY, "rows")


def audit_summary(audit: DataFrame) -> DataFrame:
    """One row: partitions checked, problems, published only, and their sum as divergent."""
    checked = F.count_if(F.col("scope") == "listed")
    problems = F.count_if((F.col("scope") == "listed") & (F.col("status") != OK))
    extra = F.count_if(F.col("scope") == "published-only")
    return audit.agg(
        checked.alias("checked"),
        problems.alias("problems"),
        extra.alias("only_in_published"),
        (problems + extra).alias("divergent"),
    )


def check_record_count(outputs: DataFrame, headers: DataFrame, by: list[str]) -> DataFrame:
    """Published rows against summed source headers: ``problem`` NULL, unreadable or mismatch.

    ``outputs`` has ``by + rows``; ``headers`` has ``by + records``, one row per file.
    """
    sums = sum_or_null(headers.select(*by, "records"), "records", by)
    problem = F.when(F.col("records").isNull(), F.lit("unreadable-header")).when(
        F.col("records") != F.col("rows"), F.lit("mismatch")
    )
    return outputs.join(sums, by, "left").withColumn("problem", problem)
