"""Date/time helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zoned_wall_time(ts, zone: str) -> Column:
    """Wall-clock time in ``zone`` of a zone-less timestamp read as UTC.

    Mirrors ``DATETIME(literal, zone)``: the literal names a UTC instant and
    the result is that instant's local time in ``zone`` (timestamp_ntz).
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), c.cast("timestamp_ntz"))


def month_of(ts) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.month(c).cast("bigint")


def iso_datetime(ts) -> Column:
    """ISO-8601 text of a zone-less timestamp, micro-seconds only when non-zero."""
    c = F.col(ts) if isinstance(ts, str) else ts
    base = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(c, "SSSSSS")
    return F.when(c.isNull(), F.lit(None).cast("string")).when(
        micros == F.lit("000000"), base).otherwise(F.concat(base, F.lit("."), micros))


def iso_instant(ts) -> Column:
    """ISO-8601 text of an instant (timestamp with zone), in UTC with ``+00:00``.

    Rendered independently of the session time zone: the instant is shifted
    so that its UTC wall clock is printed, then the offset is appended (the
    form Python's ``isoformat`` gives for an aware UTC datetime).
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(
        F.concat(iso_datetime(F.to_utc_timestamp(c, F.current_timezone()).cast("timestamp_ntz")),
                 F.lit("+00:00")))
