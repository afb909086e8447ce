"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# FIXED VALUE — the feed's timestamp layout, e.g. 2026-03-25T21:23:49Z.
ISO_Z_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def parse_iso_z(c: Column) -> Column:
    """Parse the fixed ``...Z`` layout as UTC wall-clock; NULL on anything else."""
    return F.try_to_timestamp(c, F.lit(ISO_Z_FORMAT)).cast("timestamp_ntz")


def date_key(d: Column) -> Column:
    """Smart date key yyyymmdd as an integer."""
    return F.date_format(d, "yyyyMMdd").cast("int")


def iso_weekday(d: Column) -> Column:
    """Monday = 1 .. Sunday = 7."""
    return F.weekday(d) + 1
