"""Place names and time zones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts for a missing part and for a position not in the dimension.
UNKNOWN_PART = "Unknown"
UNKNOWN_PLACE = "Unknown Location"


def place_name(city: Column, town: Column, country: Column) -> Column:
    """``city, country``; an empty city counts as missing, an empty country does not."""
    local = F.coalesce(F.nullif(city, F.lit("")), F.nullif(town, F.lit("")), F.lit(UNKNOWN_PART))
    return F.concat_ws(", ", local, F.coalesce(country, F.lit(UNKNOWN_PART)))


def repair_timezone(tz: Column) -> Column:
    """Undo a byte-string rendering such as ``b'Europe/Paris'``."""
    return F.regexp_replace(tz, r"^b'(.*)'$", "$1")
