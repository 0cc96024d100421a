"""Source listings: grouping by partition and choice of the files to read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partledger.functions import names, times
from partledger.spec import KEY, SIA_PA, VARIANTS, DatasetSpec


def parse_listing(listing: DataFrame, spec: DatasetSpec = SIA_PA) -> DataFrame:
    """Listing rows that are source files, with ``uf, ano, mes, variant``."""
    parsed = listing.withColumn("_p", names.parse_source_name(F.col("name"), spec))
    return parsed.filter(F.col("_p").isNotNull()).select("*", "_p.*").drop("_p")


def group_listing(listing: DataFrame, spec: DatasetSpec = SIA_PA) -> DataFrame:
    """One row per partition: total size, newest known time and the ordered files.

    Canonical file and variants are all included. Repeated entries add to the size but are
    collapsed map-side in the array, which therefore holds distinct names only.
    """
    files = parse_listing(listing, spec).withColumn("mtime", times.known_mtime(F.col("mtime")))
    variant = F.struct(
        F.col("variant").alias("suffix"),
        "name",
        F.concat(F.lit(spec.source_dir + "/"), "name").alias("path"),
        "size",
        "mtime",
    )
    return files.groupBy(*KEY).agg(
        F.sum("size").alias("size"),
        F.max("mtime").alias("mtime"),
        F.array_sort(F.collect_set(variant)).alias("variants"),
    )


def archived_files(
    variants: Column, uf: Column, ano: Column, mes: Column, spec: DatasetSpec = SIA_PA
) -> Column:
    """The files the archive reads, out of a group's files: the canonical one if it is
    there, else the variants in order. Names must match exactly, case included."""
    canonical = names.source_file_name(spec, uf, ano, mes, F.lit(""))
    stem = names.source_base_name(spec, uf, ano, mes)
    letters = F.array(*[F.lit(v) for v in VARIANTS])
    alone = F.filter(variants, lambda v: v["name"] == canonical)
    split = F.filter(
        variants,
        lambda v: F.array_contains(letters, v["suffix"])
        & (v["name"] == F.concat(stem, v["suffix"], F.lit("." + spec.extension))),
    )
    return F.when(F.size(alone) > 0, alone).otherwise(split)


def resolve_partition_files(groups: DataFrame, spec: DatasetSpec = SIA_PA) -> DataFrame:
    """One row per file to read, with its 0-based ``position`` in the concatenation."""
    chosen = archived_files(F.col("variants"), F.col("uf"), F.col("ano"), F.col("mes"), spec)
    return groups.select(*KEY, F.posexplode(chosen).alias("position", "_f")).select(
        *KEY, "position", "_f.*"
    )


def missing_variant(suffixes: Column) -> Column:
    """First letter missing from a run of variants that must start at ``a``; NULL if none."""
    expected = F.slice(F.array(*[F.lit(v) for v in VARIANTS]), F.lit(1), F.size(suffixes))
    gaps = F.filter(
        F.arrays_zip(expected.alias("want"), suffixes.alias("got")),
        lambda z: ~z["want"].eqNullSafe(z["got"]),
    )
    return F.when(F.size(suffixes) > 0, F.try_element_at(gaps, F.lit(1))["want"])


def variant_contiguity(groups: DataFrame, spec: DatasetSpec = SIA_PA) -> DataFrame:
    """``gap`` (first missing letter) and ``lone_variant`` per partition without canonical file.

    Zero-byte files count as missing.
    """
    present = F.filter(F.col("variants"), lambda v: v["size"] > 0)
    chosen = archived_files(present, F.col("uf"), F.col("ano"), F.col("mes"), spec)
    suffixes = F.transform(chosen, lambda v: v["suffix"])
    split = F.coalesce(F.try_element_at(suffixes, F.lit(1)) != "", F.lit(False))
    return groups.select(
        *KEY,
        F.array_join(suffixes, "").alias("suffixes"),
        F.when(split, missing_variant(suffixes)).alias("gap"),
        (split & (F.size(suffixes) == 1)).alias("lone_variant"),
    )


def sum_or_null(files: DataFrame, count_col: str, by: list[str]) -> DataFrame:
    """Sum per group that is NULL as soon as one member is NULL."""
    total = F.when(F.count(F.lit(1)) == F.count(count_col), F.sum(count_col))
    return files.groupBy(*by).agg(total.alias(count_col))


def target_grid(spark, ufs: list[str], years: list[int], months: list[int]) -> DataFrame:
    """Every (uf, ano, mes) of a run, expanded from the three lists."""
    if any(m < 1 or m > 12 for m in months):
        raise ValueError(f"months must lie between 1 and 12: {months}")
    grid = spark.range(1).select(
        F.explode(F.array(*[F.lit(u) for u in sorted(set(ufs))])).alias("uf")
    )
    grid = grid.select("uf", F.explode(F.array(*[F.lit(y) for y in sorted(set(years))])).alias("ano"))
    return grid.select(
        "uf", "ano", F.explode(F.array(*[F.lit(m) for m in sorted(set(months))])).alias("mes")
    )


def parse_years(text: str) -> list[int]:
    """``2008-2010,2015`` as a list of years."""
    years: set[int] = set()
    for chunk in text.split(","):
        first, _, last = chunk.strip().partition("-")
        try:
            years.update(range(int(first), int(last or first) + 1))
        except ValueError:
            raise ValueError(f"invalid years: {text!r}") from None
    return sorted(years)


def select_period_listing(
    grid: DataFrame,
    ufs: list[str] | None = None,
    years: list[int] | None = None,
    months: list[int] | None = None,
) -> DataFrame:
    """Keep the partitions of the given units, years and months (None = all)."""
    for column, wanted in (("uf", ufs), ("ano", years), ("mes", months)):
        if wanted is not None:
            grid = grid.filter(F.col(column).isin(list(wanted)))
    return grid
