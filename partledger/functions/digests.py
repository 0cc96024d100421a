"""Hashes of rows and of file contents, built from JVM-side functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from partledger.spec import EMPTY_SHA256, MULTIPART_BYTES


def swap_bytes(v: Column) -> Column:
    """Reverse the byte order of a 64-bit integer with shifts and masks."""
    odd = F.lit(0x00FF00FF00FF00FF)
    v = F.shiftleft(v.bitwiseAND(odd), 8).bitwiseOR(
        F.shiftrightunsigned(v, 8).bitwiseAND(odd)
    )
    pair = F.lit(0x0000FFFF0000FFFF)
    v = F.shiftleft(v.bitwiseAND(pair), 16).bitwiseOR(
        F.shiftrightunsigned(v, 16).bitwiseAND(pair)
    )
    return F.shiftleft(v, 32).bitwiseOR(F.shiftrightunsigned(v, 32))


def hex_word(digest: Column, start: int) -> Column:
    """Sixteen hex digits of ``digest`` from ``start`` (1-based) as a signed 64-bit integer."""
    return F.conv(F.substring(digest, start, 16), 16, -10).cast("bigint")


_LIMB = 0xFFFFF


def limbs(v: Column) -> list[Column]:
    """An unsigned 64-bit value in three pieces: 20, 20 and 24 bits, lowest first.

    Plain 64-bit sums of the pieces stay exact for 2^39 rows per group.
    """
    low, middle = F.lit(_LIMB).cast("bigint"), F.shiftrightunsigned(v, 20)
    return [v.bitwiseAND(low), middle.bitwiseAND(low), F.shiftrightunsigned(v, 40)]


def limb_sum_hex(low: Column, middle: Column, high: Column) -> Column:
    """Upper-case hex, without leading zeros, of the number whose limb sums are given."""
    middle = middle + F.shiftright(low, 20)
    high = high + F.shiftright(middle, 20)
    tail = [F.lpad(F.hex(v.bitwiseAND(F.lit(_LIMB).cast("bigint"))), 5, "0") for v in (middle, low)]
    text = F.ltrim(F.concat(F.hex(high), *tail), F.lit("0"))
    return F.when(text == "", F.lit("0")).otherwise(text)


def header_record_count(header: Column) -> Column:
    """Record count in a source file header: unsigned 32-bit little-endian at byte 4."""
    four = F.hex(F.substring(header, 5, 4))
    swapped = F.concat(*[F.substring(four, i, 2) for i in (7, 5, 3, 1)])
    return F.when(F.length(header) >= 8, F.conv(swapped, 16, 10).cast("bigint"))


def is_sha256(text: Column) -> Column:
    """A plausible content hash: 64 lower-case hex digits and not the hash of nothing."""
    return F.coalesce(
        text.rlike(r"^[0-9a-f]{64}\z") & (text != F.lit(EMPTY_SHA256)), F.lit(False)
    )


def _parts_digest(content: Column, part_bytes: int) -> tuple[Column, Column]:
    """Number of parts of ``part_bytes``, and MD5 of the parts' MD5s."""
    parts = F.ceil(F.length(content) / F.lit(part_bytes))
    pieces = F.transform(
        F.sequence(F.lit(1), F.greatest(parts, F.lit(1))),
        lambda i: F.md5(F.substring(content, ((i - 1) * part_bytes + 1).cast("int"), F.lit(part_bytes).cast("int"))),
    )
    return parts, F.md5(F.unhex(F.array_join(pieces, "")))


def multipart_tag(content: Column, part_bytes: int = MULTIPART_BYTES) -> Column:
    parts, digest = _parts_digest(content, part_bytes)
    return F.concat(digest, F.lit("-"), parts.cast("string"))


def object_tag(content: Column, part_bytes: int = MULTIPART_BYTES) -> Column:
    """The tag a store gives an object sent whole up to ``part_bytes``, and in parts beyond."""
    return F.when(F.length(content) <= part_bytes, F.md5(content)).otherwise(multipart_tag(content, part_bytes))


def etag_matches(etag: Column, content: Column, part_bytes: int = MULTIPART_BYTES) -> Column:
    """Whether ``content`` is the object carrying this storage tag.

    A plain tag is the MD5 of the object. A tag with ``-N`` is the MD5 of the
    concatenated MD5s of N parts of ``part_bytes``; anything else never matches.
    """
    clean = F.replace(etag, F.lit('"'), F.lit(""))
    shape = r"^([0-9a-f]{32})(?:-([0-9]+))?\z"
    digest = F.regexp_extract(clean, shape, 1)
    parts_text = F.regexp_extract(clean, shape, 2)
    parts, whole = _parts_digest(content, part_bytes)
    multipart = whole == digest
    matches = (
        F.when(~clean.rlike(shape), F.lit(False))
        .when(parts_text == "", F.md5(content) == digest)
        .when(parts != parts_text.try_cast("bigint"), F.lit(False))
        .otherwise(multipart)
    )
    return F.coalesce(matches, F.lit(False))
