"""Dates as records carry them. Pure Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_iso(value: Column) -> Column:
    """An ISO date or date-time, with or without Z; null if it is none."""
    return F.try_to_timestamp(F.regexp_replace(F.trim(value), "Z$", "+00:00"))


def xsd_datetime(value: Column) -> Column:
    """An XSD dateTime: midnight for bare dates, +00:00 for Z; null for what is no date."""
    text = F.trim(value)
    full = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(text, F.lit("T00:00:00"))).when(
        text.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}"), F.regexp_replace(F.replace(text, F.lit(" "), F.lit("T")), "Z$", "+00:00")
    )
    return F.when(F.try_to_timestamp(full).isNotNull(), full)


def epoch_date(seconds: Column) -> Column:
    """The UTC day of an epoch second; years beyond 9999 have their digits and no sign, as years before them."""
    return F.ltrim(F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd"), F.lit("+"))


def display_date(value: Column) -> Column:
    return F.substring(F.split_part(value, F.lit("T"), F.lit(1)), 1, 10)


def folder_date(name: Column) -> Column:
    """The day in a run folder's name, <yyyy-MM-dd_HH-mm-ss>_<id>; null if it has none."""
    return F.try_to_date(F.regexp_extract(name, r"^(\d{4}-\d{2}-\d{2})_\d{2}-\d{2}-\d{2}_", 1), "yyyy-MM-dd")
