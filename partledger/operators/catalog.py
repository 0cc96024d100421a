"""Catalog of what is published, and coverage against what is expected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partledger.functions import names
from partledger.spec import KEY, UFS


def summarize_manifest(partitions: DataFrame) -> DataFrame:
    """Per dataset: bytes, partitions, and the sorted distinct periods, units and years.

    ``partitions`` has ``dataset, uf, ano, mes, bytes``. The arrays hold calendar months,
    two-letter units and years, so their length is bounded whatever the volume.
    """
    period = names.period(F.col("ano"), F.col("mes"))
    return partitions.groupBy("dataset").agg(
        F.sum("bytes").alias("bytes"),
        F.array_sort(F.collect_set(period)).alias("competencias"),
        F.count(F.lit(1)).alias("partitions"),
        F.array_sort(F.collect_set("uf")).alias("ufs"),
        F.array_sort(F.collect_set("ano")).alias("years"),
    )


def manifest_document(manifest: DataFrame, generated_at: Column) -> DataFrame:
    """The catalog as one JSON document: a map from dataset to its summary, sorted."""
    summary = F.struct("bytes", "competencias", "partitions", "ufs", "years")
    entries = F.array_sort(F.collect_list(F.struct(F.col("dataset"), summary.alias("summary"))))
    return manifest.agg(F.map_from_entries(entries).alias("datasets")).select(
        F.to_json(F.struct("datasets", generated_at.alias("generatedAt"))).alias("value")
    )


def manifest_partitions(
    manifest: DataFrame,
    dataset: str,
    ufs: list[str] | None = None,
    since: str | None = None,
    prefix: str | None = None,
) -> DataFrame:
    """Partitions the catalog announces for a dataset, with their paths.

    The period predicate applies to the catalog, before any file is opened.
    """
    rows = manifest.filter(F.col("dataset") == dataset).select(
        F.explode("competencias").alias("period"), "ufs"
    )
    if since is not None:
        rows = rows.filter(F.col("period") >= since)
    if prefix is not None:
        rows = rows.filter(F.col("period").startswith(prefix))
    rows = rows.select("period", F.explode("ufs").alias("uf"))
    if ufs is not None:
        rows = rows.filter(F.col("uf").isin(list(ufs)))
    ano = F.substring("period", 1, 4).cast("int")
    mes = F.substring("period", 6, 2).cast("int")
    return rows.select(
        "uf",
        ano.alias("ano"),
        mes.alias("mes"),
        names.parquet_key(F.lit(dataset), ano, F.col("uf"), mes).alias("path"),
    )


def manifest_regressions(new: DataFrame, published: DataFrame) -> DataFrame:
    """Datasets that the new catalog covers with fewer partitions than the published one."""
    before = published.select("dataset", F.col("partitions").alias("published_partitions"))
    after = new.select("dataset", "partitions")
    return before.join(after, "dataset", "left").filter(
        F.coalesce("partitions", F.lit(0)) < F.col("published_partitions")
    )


def guard_manifest(new: DataFrame, published: DataFrame) -> DataFrame:
    """The new catalog, or a failure when it lost partitions."""
    lost = manifest_regressions(new, published).agg(F.count(F.lit(1))).scalar()
    refused = F.raise_error(F.lit("the new catalog covers fewer partitions than the published one"))
    return new.filter(F.when(lost == 0, F.lit(True)).otherwise(refused))


def expected_partitions(years: DataFrame, ufs: tuple[str, ...] = UFS) -> DataFrame:
    """Every unit and month of each year in ``years(ano)``."""
    units = F.array(*[F.lit(u) for u in ufs])
    months = F.array(*[F.lit(m) for m in range(1, 13)])
    return (
        years.select("ano")
        .distinct()
        .select("ano", F.explode(units).alias("uf"))
        .select("uf", "ano", F.explode(months).alias("mes"))
    )


def coverage_gaps(published: DataFrame, ufs: tuple[str, ...] = UFS) -> DataFrame:
    """Missing (uf, ano, mes) cells within the published years."""
    return expected_partitions(published, ufs).join(
        published.select(*KEY).distinct(), KEY, "left_anti"
    )


def coverage_by_year(published: DataFrame, ufs: tuple[str, ...] = UFS) -> DataFrame:
    """Published and expected partitions per year and their ratio."""
    expected = len(ufs) * 12
    known = published.select(*KEY).distinct().filter(F.col("uf").isin(list(ufs)))
    return (
        known.groupBy("ano")
        .agg(F.count(F.lit(1)).alias("published"))
        .withColumn("expected", F.lit(expected))
        .withColumn("coverage", F.col("published") / F.col("expected"))
    )
