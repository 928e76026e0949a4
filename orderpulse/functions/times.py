"""Time expressions. Text forms assume the session time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_utc(ts: Column, suffix: str = "Z") -> Column:
    """ISO-8601 text; the fraction is left out when it is zero."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    has_fraction = F.unix_micros(ts) % 1_000_000 != 0
    return F.concat(F.when(has_fraction, micros).otherwise(whole), F.lit(suffix))


def parse_iso(text: Column) -> Column:
    """ISO-8601 or SQL timestamp text; null when it is neither."""
    return F.try_to_timestamp(text)


def window_bounds(window: Column) -> list[Column]:
    """First instant in, and first instant after, a window."""
    return [window["start"].alias("window_start"), window["end"].alias("window_end")]


def window_id(start: Column) -> Column:
    """Stable key of a window."""
    return F.concat(F.lit("window-"), F.unix_seconds(start).cast("string"))
