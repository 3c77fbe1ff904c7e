"""Columns over response headers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MOST = (1 << 63) - 1


def header(headers: Column, name: str) -> Column:
    return F.coalesce(F.get(F.map_values(F.map_filter(headers, lambda k, v: F.lower(k) == name.lower())), F.lit(0)), F.lit(""))


def essence(content_type: Column) -> Column:
    return F.lower(F.trim(F.split_part(content_type, F.lit(";"), F.lit(1))))


def retry_after(value: Column, now: Column, default: int = 300) -> Column:
    """Seconds to wait: a number or a date, never under the default; the default if it is neither."""
    value = F.trim(F.coalesce(value, F.lit("")))
    number = value.try_cast("long")
    date = F.try_to_timestamp(F.regexp_replace(value, r"^[A-Za-z]+,\s*", ""), F.lit("dd MMM yyyy HH:mm:ss z"))
    wait = F.floor(F.unix_micros(date) / 1e6 - now) + 1
    return F.coalesce(F.when(number.isNotNull(), F.greatest(F.lit(default), number)), F.when(date.isNotNull(), F.greatest(F.lit(default), wait)), F.lit(default)).cast("long")


def content_length(length: Column, transfer_encoding: Column) -> Column:
    n = F.when(length.rlike("^[0-9]+$"), length.try_cast("long"))
    return F.when((F.coalesce(transfer_encoding, F.lit("")) == "") & (n > 0), n)


def probe_range(content_range: Column) -> Column:
    """N of ``bytes 0-0/N``."""
    n = F.regexp_extract(content_range, r"(?i)^bytes 0-0/([0-9]+)$", 1).try_cast("long")
    return F.when(n > 0, n)


def resume_range(content_range: Column, offset: Column) -> Column:
    """Total of a ``bytes a-b/t`` that goes on at offset; null if it does not."""
    part = lambda k: F.regexp_extract(content_range, r"(?i)^bytes ([0-9]+)-([0-9]+)/([0-9]+)$", k).try_cast("long")
    first, last, total = part(1), part(2), part(3)
    return F.when((first == offset) & (offset <= last) & (last < total), total)


def strong_etag(etag: Column) -> Column:
    return F.coalesce(etag.rlike('^".*"$') & ~F.startswith(etag, F.lit("W/")), F.lit(False))
