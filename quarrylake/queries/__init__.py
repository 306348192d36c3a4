"""Every operator as a query over the given tables, next to the SQL it must agree with."""

from quarrylake.queries import files, history, rows, runs, tables  # noqa: F401
from quarrylake.queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
