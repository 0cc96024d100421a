"""Decision rules over control-table columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from partledger.functions.digests import is_sha256
from partledger.spec import (
    CURRENT,
    DIVERGENT,
    EMPTY_SHA256,
    FINGERPRINT_VERSION,
    LEGACY,
    NO_PARQUET,
    OK,
    SOURCE_UNREADABLE,
    UNREADABLE,
)


def _false(value: Column) -> Column:
    return F.coalesce(value, F.lit(False))


def has_changed(known_size: Column, known_mtime: Column, size: Column, mtime: Column) -> Column:
    """Size always decides; times only when both sides know theirs (NULL = unknown)."""
    return (
        F.when(known_size != size, F.lit(True))
        .when(known_mtime.isNull() | mtime.isNull(), F.lit(False))
        .otherwise(known_mtime != mtime)
    )


def legacy_rescan(known_mtime: Column, mtime: Column, since: Column) -> Column:
    """State entry without a time whose source was touched at or after ``since``."""
    return _false(known_mtime.isNull() & (mtime >= since))


def classify_counts(rows: Column, source_rows: Column) -> Column:
    return (
        F.when(rows.isNull(), F.lit(NO_PARQUET))
        .when(source_rows.isNull(), F.lit(SOURCE_UNREADABLE))
        .when(rows == source_rows, F.lit(OK))
        .otherwise(F.lit(DIVERGENT))
    )


def _is_string(value: Column) -> Column:
    return _false(F.schema_of_variant(value) == "STRING")


def _text_at(body: Column, path: str) -> Column:
    """String at ``path``; NULL when absent or of another JSON type."""
    found = F.try_variant_get(body, path, "variant")
    return F.when(_is_string(found), F.try_variant_get(body, path, "string"))


def is_json_object(body: Column) -> Column:
    return _false(F.schema_of_variant(body).startswith("OBJECT"))


def is_legacy_source(body: Column) -> Column:
    """Whether ``source`` of a provenance body is of the withdrawn format.

    JSON ``null`` is the current form of a split partition; a missing key, zero
    bytes, or an implausible hash is the withdrawn form.
    """
    source = F.try_variant_get(body, "$.source", "variant")
    sha = _text_at(body, "$.source.sha256")
    size = F.try_variant_get(body, "$.source.bytes", "variant")
    zero = _false(
        F.schema_of_variant(size).rlike("^(BIGINT|DECIMAL.*|DOUBLE)$")
        & (F.try_variant_get(body, "$.source.bytes", "double") == 0)
    )
    bad_hash = sha.isNull() | ~sha.rlike(r"^[0-9a-f]{64}\z") | (sha == EMPTY_SHA256)
    return (
        F.when(source.isNull(), F.lit(True))
        .when(F.is_variant_null(source), F.lit(False))
        .otherwise(zero | bad_hash)
    )


def classify_provenance(text: Column) -> Column:
    """Unreadable, legacy or current, from the text of a published document."""
    body = F.try_parse_json(text)
    return (
        F.when(~is_json_object(body), F.lit(UNREADABLE))
        .when(is_legacy_source(body), F.lit(LEGACY))
        .otherwise(F.lit(CURRENT))
    )


def previous_provenance(text: Column) -> Column:
    """What a replaced document still says about who produced the data."""
    body = F.try_parse_json(text)
    kind = F.schema_of_variant(F.try_variant_get(body, "$.pipeline", "variant"))
    # Read from the text, because a parsed object no longer knows the order of its keys.
    kept = F.when(
        kind.startswith("OBJECT"),
        F.from_json(F.get_json_object(text, "$.pipeline"), "map<string,string>"),
    )
    return F.struct(
        _text_at(body, "$.generatedAt").alias("generatedAt"),
        _text_at(body, "$.output.sha256").alias("outputSha256"),
        kept.alias("pipeline"),
    )


def assess_kept(text: Column, parquet_sha: Column) -> Column:
    """``struct(problem, legacy)`` of a document kept without a sources record."""
    body = F.try_parse_json(text)
    sha = _text_at(body, "$.output.sha256")
    problem = (
        F.when(body.isNull(), F.lit("not-json"))
        .when(sha.isNull(), F.lit("no-output-sha"))
        .when(~sha.eqNullSafe(parquet_sha), F.lit("other-parquet"))
    )
    return F.struct(
        problem.alias("problem"),
        F.when(problem.isNull(), is_legacy_source(body)).alias("legacy"),
    )


def published_fingerprint(text: Column) -> Column:
    """Fingerprint stated by a published document, NULL when absent or of another version."""
    found = _text_at(F.try_parse_json(text), "$.output.fingerprint")
    return F.when(found.startswith(FINGERPRINT_VERSION + ":"), found)


def published_at(text: Column) -> Column:
    return _text_at(F.try_parse_json(text), "$.generatedAt")


def is_unchanged(local: Column, published: Column) -> Column:
    """Equal fingerprints; nothing published counts as changed."""
    return _false(local == published)


def source_problem(found_size: Column, listed: Column, sha: Column, mtime: Column) -> Column:
    """First reason why a cached source cannot be described, or NULL."""
    return (
        F.when(found_size.isNull(), F.lit("unreadable"))
        .when(found_size != listed, F.lit("size-changed"))
        .when(~is_sha256(sha), F.lit("bad-sha256"))
        .when(F.coalesce(mtime, F.lit("")) == "", F.lit("no-mtime"))
    )


def size_mismatch(expected: Column, actual: Column) -> Column:
    """``struct(expected, actual)`` when the sizes differ, else NULL."""
    return F.when(
        ~expected.eqNullSafe(actual), F.struct(expected.alias("expected"), actual.alias("actual"))
    )


def old_enough(mtime: Column, published: Column, hours: int) -> Column:
    """Source touched at least ``hours`` before publication; the limit itself passes."""
    return mtime <= published - F.make_dt_interval(hours=F.lit(hours))
