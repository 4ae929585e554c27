"""Column expressions. All are built-in Spark expressions; none is a Python UDF."""

from skylarder.functions.encoding import fingerprint, json_record
from skylarder.functions.meals import clean_steps, minutes_text, prep_time, wide_pairs
from skylarder.functions.numeric import format_size, round_half_even, round_to_int
from skylarder.functions.paths import layer_of, snapshot_name, snapshot_time
from skylarder.functions.places import place_name, repair_timezone
from skylarder.functions.times import compact_time, epoch_to_date, epoch_to_iso, time_text
from skylarder.functions.weather import fallback_advice, temperature_category

__all__ = [
    "clean_steps",
    "compact_time",
    "epoch_to_date",
    "epoch_to_iso",
    "fallback_advice",
    "fingerprint",
    "format_size",
    "json_record",
    "layer_of",
    "minutes_text",
    "place_name",
    "prep_time",
    "repair_timezone",
    "round_half_even",
    "round_to_int",
    "snapshot_name",
    "snapshot_time",
    "temperature_category",
    "time_text",
    "wide_pairs",
]
