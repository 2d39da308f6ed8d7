"""From normalised events to accepted and rejected rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import has_suffix, lookup
from ..functions.contracts import CATEGORIES
from .copies import tag_copies
from .rules import classify, split

KEY = ("event_date", "event_id")
#: What makes two copies of an event differ: its text and moment, but not the file it came from.
BUSINESS = ("event_type", "created_at", "event_timestamp", "repo_name", "actor_login", "org_login", "payload_action", "pr_number", "issue_number", "issue_labels")
REASON = "rejection_reason"


def tag(frame: DataFrame, day: date | str) -> DataFrame:
    """Every row with its outcome in rejection_reason; null is accepted. Invalid copies never compete."""
    valid, invalid = split(classify(frame, day))
    return invalid.unionByName(tag_copies(valid, KEY, BUSINESS, "source_file"))


def dimensions(accepted: DataFrame) -> DataFrame:
    return accepted.drop("corrupt_record").withColumns(
        {
            "event_date": F.to_date("event_timestamp"),
            "event_hour": F.hour("event_timestamp"),
            "is_bot": has_suffix(F.col("actor_login"), "[bot]"),
            "event_category": lookup(CATEGORIES, F.col("event_type")),
        }
    )


def outcomes(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean and rejected rows of a tagged frame; persist it first, both read it."""
    accepted, rejected = split(tagged)
    return dimensions(accepted), rejected


def transform(frame: DataFrame, day: date | str) -> tuple[DataFrame, DataFrame]:
    return outcomes(tag(frame, day))
