"""Column expressions of the event model."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Seconds, up to six digits of a second, and a zone offset or Z.
TIMESTAMP_PATTERN = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX"


def instant(text: Column) -> Column:
    """The moment that a text with an offset names; null if it is not of that form."""
    return F.try_to_timestamp(text, F.lit(TIMESTAMP_PATTERN))


def is_blank(value: Column) -> Column:
    return value.isNull() | (value == "")


def has_suffix(value: Column, suffix: str) -> Column:
    return F.endswith(F.lower(value), F.lit(suffix))


def lookup(values: Mapping[str, str], key: Column) -> Column:
    """The value of a literal map; null for a key that it does not have."""
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair))[key]


def first_of(condition: Column, *choices: Column) -> Column:
    """The first choice that is not null, where the condition holds."""
    return F.when(condition, F.coalesce(*choices))
