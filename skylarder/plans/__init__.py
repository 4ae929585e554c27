"""Composed jobs, each a function from DataFrames to a DataFrame."""

from skylarder.plans.index import index_docs, with_doc_id
from skylarder.plans.meals import add_metadata, explode_meals, format_meals, land_meals
from skylarder.plans.merge import recommend, recommend_history
from skylarder.plans.run import Lake, run_once
from skylarder.plans.weather import format_weather, normalise_weather, temperature_series

__all__ = [
    "Lake",
    "add_metadata",
    "explode_meals",
    "format_meals",
    "format_weather",
    "index_docs",
    "land_meals",
    "normalise_weather",
    "recommend",
    "recommend_history",
    "run_once",
    "temperature_series",
    "with_doc_id",
]
