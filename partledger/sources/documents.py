"""Control documents: pending list, state, verification results, provenance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partledger.functions import names, times
from partledger.sources.listings import _integer, _require, _string, whole_documents
from partledger.spec import KEY


def parse_pending(documents: DataFrame, dataset: str, column: str = "value") -> DataFrame:
    """Targets of one dataset: ``uf, ano, mes``.

    No ``pending`` means none. A malformed entry fails even when it is of another dataset:
    skipping it would silently archive less than was asked for.
    """
    body = F.try_parse_json(F.col(column))
    docs = documents.select(body.alias("_b")).filter(
        _require(F.col("_b").isNotNull(), F.lit("invalid pending list: not JSON"))
    )
    docs = docs.filter(
        _require(
            F.schema_of_variant("_b").rlike("^(OBJECT|ARRAY)"),
            F.lit("invalid pending list: root is not an object"),
        )
    )
    listed = F.try_variant_get(F.col("_b"), "$.pending", "variant")
    docs = docs.select(listed.alias("_l")).filter(
        F.col("_l").isNotNull() & ~F.coalesce(F.is_variant_null("_l"), F.lit(True))
    )
    docs = docs.filter(
        _require(
            F.schema_of_variant("_l").startswith("ARRAY"),
            F.lit("invalid pending list: `pending` is not a list"),
        )
    )
    items = docs.select(F.posexplode(F.try_variant_get(F.col("_l"), "$", "array<variant>")).alias("i", "o"))
    o = F.col("o")
    month = F.try_variant_get(o, "$.month", "bigint")
    valid = (
        _string(o, "dataset")
        & _string(o, "uf")
        & (F.try_variant_get(o, "$.uf", "string") != "")
        & _integer(o, "year")
        & _integer(o, "month")
        & month.between(1, 12)
    )
    message = F.concat(F.lit("invalid pending list: entry "), F.col("i"), F.lit(" malformed"))
    return (
        items.filter(_require(valid, message))
        .filter(F.try_variant_get(o, "$.dataset", "string") == dataset)
        .select(
            F.try_variant_get(o, "$.uf", "string").alias("uf"),
            F.try_variant_get(o, "$.year", "int").alias("ano"),
            month.cast("int").alias("mes"),
        )
    )


STATE_DOCUMENT = (
    "lastRun string, processed map<string,map<string,struct<sourceMtime:string,sourceSize:bigint>>>,"
    " schemaVersion int"
)


def parse_state(documents: DataFrame, column: str = "value") -> DataFrame:
    """State documents as rows: ``uf, period, size, mtime`` (NULL = time unknown)."""
    body = F.from_json(F.col(column), STATE_DOCUMENT, {"mode": "FAILFAST"})
    per_unit = documents.select(F.explode(body["processed"]).alias("uf", "_periods"))
    rows = per_unit.select("uf", F.explode("_periods").alias("period", "_entry"))
    return rows.select(
        "uf",
        "period",
        F.col("_entry.sourceSize").alias("size"),
        times.known_mtime(times.parse_iso(F.col("_entry.sourceMtime"))).alias("mtime"),
    )


def state_document(state: DataFrame, last_run) -> DataFrame:
    """State rows as one document; the reverse of :func:`parse_state`. Unknown times become
    the epoch. The document is small by nature: one entry per unit and month."""
    entry = F.struct(
        F.coalesce(times.iso_millis(F.col("mtime")), F.lit("1970-01-01T00:00:00.000Z")).alias("sourceMtime"),
        F.col("size").alias("sourceSize"),
    )
    per_unit = state.groupBy("uf").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("period", entry.alias("e"))))).alias("_m")
    )
    packed = per_unit.agg(F.map_from_entries(F.collect_list(F.struct("uf", "_m"))).alias("processed"))
    return packed.select(
        F.to_json(F.struct(last_run.alias("lastRun"), "processed", F.lit(1).alias("schemaVersion"))).alias("value")
    )


def parse_verified(documents: DataFrame, column: str = "value") -> DataFrame:
    """Distinct approved partitions of verification documents: ``uf, ano, mes, key``."""
    body = F.try_parse_json(F.col(column))
    docs = documents.select(body.alias("_b")).filter(
        _require(F.col("_b").isNotNull(), F.lit("invalid verification: not JSON"))
    )
    approved = F.try_variant_get(F.col("_b"), "$.verified", "variant")
    docs = docs.select(approved.alias("_v")).filter(
        _require(
            F.schema_of_variant("_v").startswith("ARRAY"),
            F.lit("invalid verification: `verified` is not a list"),
        )
    )
    items = docs.select(F.explode(F.try_variant_get(F.col("_v"), "$", "array<variant>")).alias("o"))
    o = F.col("o")
    rows = items.select(
        F.try_variant_get(o, "$.uf", "string").alias("uf"),
        F.try_variant_get(o, "$.year", "int").alias("ano"),
        F.try_variant_get(o, "$.month", "int").alias("mes"),
    ).distinct()
    return rows.withColumn("key", names.partition_key(F.col("uf"), F.col("ano"), F.col("mes")))


def scan_provenance(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """Published provenance documents: ``key, uf, ano, mes, text``; text is not interpreted."""
    docs = whole_documents(spark, f"{root.rstrip('/')}/{dataset}/provenance/ano=*/uf=*/mes=*")
    pattern = r"/ano=([0-9]{4})/uf=([A-Z]{2})/mes=([0-9]{2})/[^/]+\z"
    rows = docs.filter(F.col("path").rlike(pattern)).select(
        F.regexp_extract("path", pattern, 2).alias("uf"),
        F.regexp_extract("path", pattern, 1).cast("int").alias("ano"),
        F.regexp_extract("path", pattern, 3).cast("int").alias("mes"),
        F.col("value").alias("text"),
    )
    key = names.provenance_key(F.lit(dataset), F.col("ano"), F.col("uf"), F.col("mes"))
    return rows.select(key.alias("key"), *KEY, "text")
