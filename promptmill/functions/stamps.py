"""ISO-8601 time stamps, whatever the session's time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_stamp(at: Column) -> Column:
    """UTC with its offset written out, and six digits of a second where there are any."""
    utc = F.to_utc_timestamp(at, F.current_timezone())
    fraction = F.when(F.pmod(F.unix_micros(at), F.lit(1_000_000)) != 0, F.date_format(utc, ".SSSSSS")).otherwise("")
    return F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("+00:00"))


def parse_iso(text: Column) -> Column:
    """The time of a date or stamp with any offset; one without is in UTC. Null for what is no such text."""
    trimmed = F.trim(text)
    whole_day = trimmed.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$")
    zoned = trimmed.rlike(r"[0-9](?:[Zz]|[+-][0-9]{2}:?[0-9]{2})$")
    stamped = trimmed.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}")
    complete = F.when(whole_day, F.concat(trimmed, F.lit("T00:00:00Z"))).when(stamped & zoned, F.upper(trimmed))
    return complete.when(stamped, F.concat(trimmed, F.lit("Z"))).try_cast("timestamp")
