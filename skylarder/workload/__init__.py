"""The operators as queries over the given tables, with SQL that states each result."""

from skylarder.workload.oracles import ORACLES
from skylarder.workload.queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
