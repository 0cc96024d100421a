"""Modification times and revision windows as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "1970-01-01T00:00:00Z"

_DOS = r"(?i)^([0-9]{2})-([0-9]{2})-([0-9]{2})\s+([0-9]{2}):([0-9]{2})(AM|PM)\z"


def known_mtime(value: Column) -> Column:
    """Timestamp, with the epoch marker of "unknown" turned into NULL."""
    return F.when(value != F.timestamp_seconds(F.lit(0)), value)


def parse_iso(text: Column) -> Column:
    """ISO-8601 text as a timestamp in UTC; NULL when unreadable."""
    return F.try_to_timestamp(text)


def is_unknown_mtime(value: Column) -> Column:
    return known_mtime(value).isNull()


def iso_millis(ts: Column) -> Column:
    """``2026-09-17T17:27:00.000Z``, the form used inside documents."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def parse_dos_mtime(raw: Column) -> Column:
    """``MM-DD-YY hh:mmAM`` directory times, taken as UTC; NULL for impossible dates.

    The hour is reduced modulo 12 before the half of the day is added, so the
    24-hour values some servers print with a suffix are accepted as well.
    """
    text = F.trim(F.regexp_replace(raw, r"^\s+|\s+\z", ""))

    def number(i: int) -> Column:
        return F.regexp_extract(text, _DOS, i).try_cast("int")

    afternoon = F.upper(F.regexp_extract(text, _DOS, 6)) == "PM"
    hour = F.pmod(number(4), F.lit(12)) + F.when(afternoon, 12).otherwise(0)
    made = F.try_make_timestamp(
        F.lit(2000) + number(3), number(1), number(2), hour, number(5), F.lit(0).cast("decimal(8,6)")
    )
    return F.when(text.rlike(_DOS), made)


def window_start(latest: Column, months: int) -> Column:
    """First period of the ``months``-long window that ends at ``latest`` (``YYYY-MM``)."""
    if months <= 0:
        return F.lit(None).cast("string")
    index = (
        F.substring(latest, 1, 4).try_cast("int") * 12
        + F.substring(latest, 6, 2).try_cast("int")
        - 1
        - (months - 1)
    )
    start = F.concat(
        F.floor(index / 12).cast("string"),
        F.lit("-"),
        F.lpad((F.pmod(index, F.lit(12)) + 1).cast("string"), 2, "0"),
    )
    bad = F.raise_error(F.concat(F.lit("invalid period: "), latest))
    return F.when(latest.isNull(), F.lit(None)).when(
        latest.rlike(r"^[0-9]{4}-[0-9]{2}\z"), start
    ).otherwise(bad)


def in_window(period: Column, start: Column) -> Column:
    return F.coalesce(period >= start, F.lit(False))
