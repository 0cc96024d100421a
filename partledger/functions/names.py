"""Source file names, storage keys and partition labels as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from partledger.spec import PARQUET_FILE, PROVENANCE_FILE, VARIANTS, DatasetSpec

PARTITION_TYPE = "struct<uf:string,ano:int,mes:int,variant:string>"


def two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def period(year: Column, month: Column) -> Column:
    """Year-month as ``YYYY-MM``; such strings order chronologically."""
    return F.concat(year.cast("string"), F.lit("-"), two_digits(month))


def month_index(year: Column, month: Column) -> Column:
    return year * 12 + month - 1


def partition_key(uf: Column, year: Column, month: Column) -> Column:
    """``UF|YYYY-MM``, the key of verification results."""
    return F.concat(uf, F.lit("|"), period(year, month))


def partition_label(uf: Column, year: Column, month: Column) -> Column:
    return F.concat(uf, F.lit(" "), period(year, month))


def parse_source_name(name: Column, spec: DatasetSpec, ignore_case: bool = True) -> Column:
    """Split a source file name into ``struct(uf, ano, mes, variant)``; NULL when it is not one.

    Matching ignores case; the unit comes out in upper case and the variant in
    lower case. Two-digit years belong to the 2000s. Yearly datasets have no month.
    """
    pattern = ("(?i)" if ignore_case else "") + spec.name_pattern

    def group(field: str) -> Column | None:
        if field not in spec.name_fields:
            return None
        return F.regexp_extract(name, pattern, spec.name_fields.index(field) + 1)

    place = group("uf") if "uf" in spec.name_fields else group("agravo")
    short, full = group("yy"), group("yyyy")
    year = F.lit(2000) + short.try_cast("int") if short is not None else full.try_cast("int")
    month = group("mm")
    month = month.try_cast("int") if month is not None else F.lit(None).cast("int")
    variant = group("variant")
    parts = F.struct(
        F.upper(place).alias("uf"),
        year.cast("int").alias("ano"),
        month.alias("mes"),
        (F.lower(variant) if variant is not None else F.lit("")).alias("variant"),
    )
    valid = name.rlike(pattern)
    if "mm" in spec.name_fields:
        valid = valid & month.between(1, 12)
    return F.when(valid, parts)


def source_base_name(spec: DatasetSpec, uf: Column, year: Column, month: Column) -> Column:
    """Common stem of the canonical file and its variants, e.g. ``PASP2403``."""
    return F.concat(F.lit(spec.prefix), uf, two_digits(F.pmod(year, F.lit(100))), two_digits(month))


def source_file_name(
    spec: DatasetSpec, uf: Column, year: Column, month: Column, suffix: Column
) -> Column:
    stem = source_base_name(spec, uf, year, month)
    return F.concat(stem, suffix, F.lit("." + spec.extension))


def candidate_names(spec: DatasetSpec, uf: Column, year: Column, month: Column) -> Column:
    """Every name that may belong to a partition: the canonical one, then a to z."""
    suffixes = F.array(*[F.lit(s) for s in ("", *VARIANTS)])
    return F.transform(suffixes, lambda s: source_file_name(spec, uf, year, month, s))


def partition_path(year: Column, uf: Column, month: Column) -> Column:
    return F.concat(
        F.lit("ano="), year.cast("string"), F.lit("/uf="), uf, F.lit("/mes="), two_digits(month)
    )


def parquet_key(dataset: Column, year: Column, uf: Column, month: Column) -> Column:
    return F.concat(
        dataset, F.lit("/"), partition_path(year, uf, month), F.lit("/" + PARQUET_FILE)
    )


def provenance_key(dataset: Column, year: Column, uf: Column, month: Column) -> Column:
    return F.concat(
        dataset,
        F.lit("/provenance/"),
        partition_path(year, uf, month),
        F.lit("/" + PROVENANCE_FILE),
    )


# One pattern per kind of object, so the kind can never disagree with the directory.
_PARTITION_DIR = r"ano=([0-9]{4})/uf=([A-Z]{2})/mes=([0-9]{2})/"
_PARQUET_KEY = rf"^([^/\n\r]+)/{_PARTITION_DIR}part\.parquet\z"
_PROVENANCE_KEY = rf"^([^/\n\r]+)/provenance/{_PARTITION_DIR}part\.provenance\.json\z"


def parse_partition_key(key: Column, dataset: str | None = None) -> Column:
    """``struct(dataset, ano, uf, mes, kind)`` of a storage key, or NULL for any other key."""

    def parts(pattern: str, kind: str) -> Column:
        found = F.struct(
            F.regexp_extract(key, pattern, 1).alias("dataset"),
            F.regexp_extract(key, pattern, 2).try_cast("int").alias("ano"),
            F.regexp_extract(key, pattern, 3).alias("uf"),
            F.regexp_extract(key, pattern, 4).try_cast("int").alias("mes"),
            F.lit(kind).alias("kind"),
        )
        matches = key.rlike(pattern)
        if dataset is not None:
            matches = matches & key.startswith(dataset + "/")
        return F.when(matches, found)

    return F.coalesce(parts(_PARQUET_KEY, "parquet"), parts(_PROVENANCE_KEY, "provenance"))


def is_provenance_upload_key(key: Column, dataset: str) -> Column:
    """True only for a provenance document of ``dataset`` in its canonical place."""
    p = parse_partition_key(key, dataset)
    rebuilt = provenance_key(F.lit(dataset), p["ano"], p["uf"], p["mes"])
    return F.coalesce((p["kind"] == "provenance") & (rebuilt == key), F.lit(False))


def require_provenance_upload_key(key: Column, dataset: str) -> Column:
    """The key itself, or a failure that stops the write."""
    refused = F.raise_error(
        F.concat(F.lit("upload refused: "), F.coalesce(key, F.lit("NULL")), F.lit(f" outside {dataset}/provenance/"))
    )
    return F.when(is_provenance_upload_key(key, dataset), key).otherwise(refused)
