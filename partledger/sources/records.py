"""Reading microdata: decoded records and the archived tables."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partledger.session import store
from partledger.sources.listings import scan_local_tree
from partledger.spec import KEY


def scan_records(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """Newline-delimited JSON records with an explicit schema, read in parallel splits.

    Malformed lines fail the read instead of becoming NULL rows.
    """
    return spark.read.schema(schema).option("mode", "FAILFAST").json(paths)


def concat_variants(parts: Sequence[DataFrame]) -> DataFrame:
    """Union by name of the disjoint pieces of a split partition, missing columns NULL."""
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part, allowMissingColumns=True)
    return first


def _typed_key(df: DataFrame) -> DataFrame:
    """Partition columns as the control tables have them."""
    for c, t in (("uf", "string"), ("ano", "int"), ("mes", "int")):
        if c in df.columns:
            df = df.withColumn(c, F.col(c).cast(t))
    return df


def scan_dataset(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """All partitions of ``root/ano=…/uf=…/mes=…``; columns united by name.

    Only data directories and files are looked at, so documents kept beside the data or
    in ``provenance/`` do not disturb partition discovery. Without ``schema`` the
    footers are merged; give one to skip that pass on large trees.
    """
    reader = spark.read.option("basePath", root).option("pathGlobFilter", "*.parquet")
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", "true")
    return _typed_key(reader.parquet(f"{root.rstrip('/')}/ano=*"))


def scan_partition(
    spark: SparkSession, root: str, ano: int, uf: str, mes: int, columns: Sequence[str] | None = None
) -> DataFrame:
    """One partition, projected; no other directory is listed."""
    path = f"{root.rstrip('/')}/ano={ano}/uf={uf}/mes={mes:02d}"
    df = spark.read.option("basePath", root).option("pathGlobFilter", "*.parquet").parquet(path)
    df = _typed_key(df)
    return df.select(*columns) if columns is not None else df


def widest_type(types: Sequence[T.DataType]) -> T.DataType:
    """Common type of a column across vintages: the numeric widening, else string."""
    distinct = {t.simpleString(): t for t in types}
    if len(distinct) == 1:
        return next(iter(distinct.values()))
    kinds = list(distinct.values())
    if all(isinstance(t, T.IntegralType) for t in kinds):
        return T.LongType()
    if all(isinstance(t, (T.IntegralType, T.FloatType, T.DoubleType)) for t in kinds):
        return T.DoubleType()
    return T.StringType()


def drifting_columns(schemas: Sequence[T.StructType]) -> dict[str, list[str]]:
    """Columns whose type differs between schemas, with the types seen."""
    seen: dict[str, list[str]] = {}
    for schema in schemas:
        for f in schema.fields:
            kinds = seen.setdefault(f.name, [])
            if f.dataType.simpleString() not in kinds:
                kinds.append(f.dataType.simpleString())
    return {c: kinds for c, kinds in seen.items() if len(kinds) > 1}


def union_by_name(vintages: Sequence[DataFrame]) -> DataFrame:
    """Vintages with drifting columns as one table: widest types, missing columns NULL."""
    types: dict[str, list[T.DataType]] = {}
    for v in vintages:
        for f in v.schema.fields:
            types.setdefault(f.name, []).append(f.dataType)
    target = {c: widest_type(ts) for c, ts in types.items()}
    cast = [
        v.select(*[F.col(f"`{c}`").cast(target[c]).alias(c) for c in v.columns]) for v in vintages
    ]
    return concat_variants(cast)


def yearly_vintages(spark: SparkSession, root: str) -> list[str]:
    """One directory pattern per archived year; only as many values as there are years."""
    years = scan_local_tree(spark, root).select("ano").distinct().collect()
    return [f"ano={y}" for y in sorted(r.ano for r in years)]


def scan_union_by_name(
    spark: SparkSession, root: str, vintage_globs: Sequence[str] | None = None
) -> DataFrame:
    """The whole tree when column types differ between vintages.

    Each glob names directories that share one schema (by default each year). Every vintage
    is read with its own schema, cast to the widest types and united, so pruning and
    pushdown still reach each scan.
    """
    base = root.rstrip("/")

    def vintage(glob: str) -> DataFrame:
        reader = spark.read.option("basePath", root).option("pathGlobFilter", "*.parquet")
        return _typed_key(reader.option("mergeSchema", "true").parquet(f"{base}/{glob}"))

    globs = yearly_vintages(spark, root) if vintage_globs is None else vintage_globs
    return union_by_name([vintage(g) for g in globs])


def prune_partitions(data: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of the partitions that ``keys`` (``KEY``, stored) names.

    The units and months among the keys become constant predicates on partition columns, so
    other directories are not opened however large the join's sides are thought to be; the
    semi join then keeps the exact pairs. Only as many values as there are units and months
    reach the driver.
    """
    wanted = keys.select(*KEY).distinct()
    seen = wanted.agg(F.collect_set("uf").alias("ufs"), F.collect_set(F.col("ano") * 100 + F.col("mes")).alias("months")).first()
    near = data.filter(F.col("uf").isin(sorted(seen["ufs"])) & (F.col("ano") * 100 + F.col("mes")).isin(sorted(seen["months"])))
    return near.join(wanted, KEY, "left_semi")


def scan_from_manifest(data: DataFrame, announced: DataFrame) -> DataFrame:
    """Archived rows of the partitions a catalog announces; see :func:`prune_partitions`."""
    return prune_partitions(data, store(announced.select(*KEY).distinct(), "announced"))


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def footer_row_counts(spark: SparkSession, root: str, by: Sequence[str] = KEY) -> DataFrame:
    """Rows per partition from Parquet footers: the count is pushed into the scan, so work grows
    with the number of row groups and no page is read. ``by`` names partition columns."""
    listed = [x for x in spark.conf.get("spark.sql.sources.useV1SourceList").split(",") if x != "parquet"]
    # The reader that takes aggregates is chosen when the files are loaded.
    with _setting(spark, "spark.sql.sources.useV1SourceList", ",".join(listed)):
        reader = spark.read.option("basePath", root).option("pathGlobFilter", "*.parquet")
        files = reader.parquet(f"{root.rstrip('/')}/*=*")
    counts = files.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))
    return _typed_key(counts)


def schema_groups(spark: SparkSession, root: str, files: DataFrame) -> list[tuple[T.StructType, DataFrame]]:
    """The tree's partitions by the schema they were written with: one scan per schema.

    ``files`` is the table of published files; its schemas, not footers, decide, so a change
    inside a year is seen and nothing is merged. One path per partition reaches the driver.
    """
    per_schema = (
        files.select("ddl", F.regexp_replace("name", "/[^/]+\\z", "").alias("dir"))
        .groupBy("ddl")
        .agg(F.array_sort(F.collect_set("dir")).alias("dirs"))
        .orderBy("ddl")
        .collect()
    )
    groups = []
    for row in per_schema:
        schema = T.StructType.fromJson(json.loads(row["ddl"]))
        reader = spark.read.option("basePath", root).option("pathGlobFilter", "*.parquet").schema(schema)
        groups.append((schema, _typed_key(reader.parquet(*[f"{root.rstrip('/')}/{d}" for d in row["dirs"]]))))
    return groups


def scan_published(spark: SparkSession, root: str, files: DataFrame) -> DataFrame:
    """The whole tree as one table, columns united by name and widened to the types they need,
    whatever partition or file their types change at."""
    return union_by_name([data for _, data in schema_groups(spark, root, files)])
