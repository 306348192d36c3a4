"""Hashed keys. Every key is text, so an unknown member fits beside it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The parts of a key, and the text that stands for null in one.
SEPARATOR = "|"
NULL_TEXT = "~"
UNKNOWN_KEY = "-1"


def hashed(*parts: Column) -> Column:
    """SHA-256 of the parts' text; null parts are marked, not skipped."""
    return F.sha2(
        F.concat_ws(SEPARATOR, *[F.coalesce(p.cast("string"), F.lit(NULL_TEXT)) for p in parts]), 256
    )
