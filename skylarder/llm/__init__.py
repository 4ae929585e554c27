"""Operators of a training-data pipeline, with their queries; nothing else in the package needs them."""

from skylarder.llm.oracles import ORACLES
from skylarder.llm.queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
