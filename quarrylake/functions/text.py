"""Text clean-up as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The spellings of each country seen in the sources.
COUNTRY_SPELLINGS = {
    "ES": ["ES", "Spain", "esp"],
    "FR": ["FR", "France", "fra"],
    "SE": ["SE", "Sweden", "SWE"],
    "PT": ["PT", "Portugal", "prt"],
}

# The marks the sources use.
REDACTED = "REDACTED"
NO_NAME = "unknown"
RIDE_FILE = r"rides_([^_/]+)_[^/]*$"


def canonical(value: Column, spellings: Mapping[str, Sequence[str]]) -> Column:
    """The code whose spellings contain `value`; null when none does."""
    return F.coalesce(*[F.when(value.isin(list(known)), F.lit(code)) for code, known in spellings.items()])


def country_code(value: Column) -> Column:
    return canonical(value, COUNTRY_SPELLINGS)


def empty_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def email_address(value: Column) -> Column:
    return F.lower(F.trim(value))


def person_name(value: Column) -> Column:
    """Trimmed and title-cased; the placeholder name, in any case or padding, is null."""
    clean = F.trim(value)
    return F.initcap(F.when(F.lower(clean) != NO_NAME, clean))


def is_value(value: Column, wanted: str) -> Column:
    """True or False, never null: a missing status is not the wanted one."""
    return F.coalesce(value == F.lit(wanted), F.lit(False))


def city_of_file(path: Column) -> Column:
    """City id held in a ride file's name, null when the name has another form."""
    return empty_to_null(F.regexp_extract(path, RIDE_FILE, 1))


def unescaped(text: Column) -> Column:
    """Percent escapes undone; text that holds none, or broken ones, is left alone."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def path_key(path: Column, key: str) -> Column:
    """Value of the `key=value` folder in a file path; of several, the one nearest the file."""
    return empty_to_null(unescaped(F.regexp_extract(path, rf"^.*/{key}=([^/]+)/", 1)))
