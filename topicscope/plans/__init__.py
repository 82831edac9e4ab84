"""Query plans: the registered queries and their SQL oracles."""

from .oracle import ORACLE_SQL
from .queries import QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
