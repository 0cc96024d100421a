"""Listings of source files and of stored objects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partledger.functions import names, times


def _require(valid: Column, message: Column) -> Column:
    """A filter condition that is true, or fails the job; filters are never pruned away."""
    return F.when(F.coalesce(valid, F.lit(False)), F.lit(True)).otherwise(F.raise_error(message))


def whole_documents(spark: SparkSession, paths) -> DataFrame:
    """One row per file: ``path, value`` (the whole text)."""
    return spark.read.text(paths, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), "value"
    )


def _integer(item: Column, field: str) -> Column:
    kind = F.schema_of_variant(F.try_variant_get(item, f"$.{field}", "variant"))
    return F.coalesce(kind.rlike(r"^(BIGINT|DECIMAL\(\d+,0\))$"), F.lit(False))


def _string(item: Column, field: str) -> Column:
    kind = F.schema_of_variant(F.try_variant_get(item, f"$.{field}", "variant"))
    return F.coalesce(kind == "STRING", F.lit(False))


def parse_object_listing(documents: DataFrame, column: str = "value") -> DataFrame:
    """Objects of storage listing pages (``Contents`` arrays): ``key, size, etag, last_modified``.

    Empty text or a page without ``Contents`` has no objects; text that is not JSON, a
    ``Contents`` that is no array, or any malformed object fails the read.
    """
    text = F.trim(F.col(column))
    body = F.try_parse_json(text)
    contents = F.try_variant_get(body, "$.Contents", "variant")
    pages = documents.filter(text != "").select(body.alias("_b"), contents.alias("_c"))
    pages = pages.filter(_require(F.col("_b").isNotNull(), F.lit("invalid object listing: not JSON")))
    pages = pages.filter(F.col("_c").isNotNull()).filter(
        _require(
            F.schema_of_variant("_c").startswith("ARRAY"),
            F.lit("invalid object listing: `Contents` is not a list"),
        )
    )
    items = pages.select(F.posexplode(F.try_variant_get(F.col("_c"), "$", "array<variant>")).alias("i", "o"))
    o = F.col("o")
    modified = times.parse_iso(F.try_variant_get(o, "$.LastModified", "string"))
    valid = (
        _string(o, "Key")
        & _string(o, "ETag")
        & _integer(o, "Size")
        & _string(o, "LastModified")
        & modified.isNotNull()
    )
    message = F.concat(F.lit("invalid object listing: object "), F.col("i"), F.lit(" malformed"))
    return items.filter(_require(valid, message)).select(
        F.try_variant_get(o, "$.Key", "string").alias("key"),
        F.try_variant_get(o, "$.Size", "bigint").alias("size"),
        F.replace(F.try_variant_get(o, "$.ETag", "string"), F.lit('"'), F.lit("")).alias("etag"),
        modified.alias("last_modified"),
    )


def parse_object_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Data partitions of a text listing (``date time size key``): ``dataset, uf, ano, mes, bytes``.

    Short lines, unreadable sizes and keys of anything but partition data are skipped;
    a key may hold blanks.
    """
    parts = F.split(F.trim(F.regexp_replace(F.col(column), r"^\s+|\s+\z", "")), r"\s+")
    size = F.try_element_at(parts, F.lit(3)).try_cast("double")
    key = F.array_join(F.slice(parts, F.lit(4), F.greatest(F.size(parts) - 3, F.lit(0))), " ")
    rows = lines.filter((F.size(parts) >= 4) & size.isNotNull()).select(
        names.parse_partition_key(key).alias("_p"), size.cast("bigint").alias("bytes")
    )
    return rows.filter(F.col("_p.kind") == "parquet").select(
        "_p.dataset", "_p.uf", "_p.ano", "_p.mes", "bytes"
    )


def scan_local_tree(spark: SparkSession, root: str) -> DataFrame:
    """Data files below ``root/<dataset>/ano=…``: ``dataset, uf, ano, mes, bytes, files``.

    Directory metadata only: the content column is pruned, no file is opened. Several files
    of one partition are added up.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(root)
        .select("path", "length")
    )
    pattern = r"/([^/]+)/ano=([0-9]{4})/uf=([A-Z]{2})/mes=([0-9]{2})/[^/]+\.parquet\z"
    return (
        files.filter(F.col("path").rlike(pattern))
        .groupBy(
            F.regexp_extract("path", pattern, 1).alias("dataset"),
            F.regexp_extract("path", pattern, 3).alias("uf"),
            F.regexp_extract("path", pattern, 2).cast("int").alias("ano"),
            F.regexp_extract("path", pattern, 4).cast("int").alias("mes"),
        )
        .agg(F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files"))
    )


def parse_listing_documents(documents: DataFrame, column: str = "value") -> DataFrame:
    """Saved source listings (arrays of ``{name, size, mtime}``): ``name, size, mtime``.

    A NULL time means unknown. Text that is no JSON array, or any malformed item, fails.
    """
    body = F.try_parse_json(F.col(column))
    docs = documents.select(body.alias("_b")).filter(
        _require(F.col("_b").isNotNull(), F.lit("invalid source listing: not JSON"))
    )
    docs = docs.filter(
        _require(
            F.schema_of_variant("_b").startswith("ARRAY"), F.lit("invalid source listing: not a list")
        )
    )
    items = docs.select(F.posexplode(F.try_variant_get(F.col("_b"), "$", "array<variant>")).alias("i", "o"))
    o = F.col("o")
    size = F.try_variant_get(o, "$.size", "bigint")
    mtime = times.parse_iso(F.try_variant_get(o, "$.mtime", "string"))
    no_time = F.coalesce(F.is_variant_null(F.try_variant_get(o, "$.mtime", "variant")), F.lit(False))
    valid = (
        _string(o, "name")
        & _integer(o, "size")
        & (size >= 0)
        & (no_time | (_string(o, "mtime") & mtime.isNotNull()))
    )
    message = F.concat(F.lit("invalid source listing: item "), F.col("i"), F.lit(" malformed"))
    return items.filter(_require(valid, message)).select(
        F.try_variant_get(o, "$.name", "string").alias("name"),
        size.alias("size"),
        times.known_mtime(mtime).alias("mtime"),
    )


def scan_source_files(spark: SparkSession, directory: str, suffix: str = "dbc") -> DataFrame:
    """Cached raw source files: ``name, bytes, mtime, sha256, header``.

    One file is hashed per task; the format limits a file to 2 GiB.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*.{suffix}")
        .load(directory)
    )
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.length("content").cast("bigint").alias("bytes"),
        times.iso_millis(F.col("modificationTime")).alias("mtime"),
        F.sha2("content", 256).alias("sha256"),
        F.substring("content", 1, 12).alias("header"),
    )
