"""The operators as queries over the given tables, with their expected results in SQL."""

from .oracle import ORACLE
from .queries import QUERIES

__all__ = ["ORACLE", "QUERIES"]
