"""Instants as text. The session time zone is UTC (see ``get_session``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text forms of an instant.
ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss'+00:00'"
PLAIN = "yyyy-MM-dd HH:mm:ss"


def epoch_to_iso(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), ISO_UTC)


def epoch_to_date(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd")


def compact_time(iso: Column) -> Column:
    """ISO text to plain text, leaving anything else in it as it is."""
    spaced = F.replace(iso, F.lit("T"), F.lit(" "))
    return F.replace(spaced, F.lit("+00:00"), F.lit(""))


def time_text(at: Column) -> Column:
    """A timestamp in the same plain form."""
    return F.date_format(at, PLAIN)
