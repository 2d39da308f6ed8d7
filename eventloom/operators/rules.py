"""Ordered rules: each row gets the reason of the first rule that it breaks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import instant, is_blank
from ..functions.contracts import CATEGORIES

Rule = tuple[str, Column]


def first_reason(rules: Sequence[Rule]) -> Column:
    """One CASE: the reason of the first rule whose predicate is true, else null."""
    reason = F
    for name, broken in rules:
        reason = reason.when(broken, F.lit(name))
    return reason.otherwise(F.lit(None).cast("string")) if rules else F.lit(None).cast("string")


def event_rules(day: date | str) -> list[Rule]:
    return [
        ("corrupt_json", F.col("corrupt_record").isNotNull()),
        ("missing_event_id", is_blank(F.col("event_id"))),
        ("missing_event_type", is_blank(F.col("event_type"))),
        ("missing_repo_name", is_blank(F.col("repo_name"))),
        ("missing_actor_login", is_blank(F.col("actor_login"))),
        ("invalid_timestamp", F.col("event_timestamp").isNull()),
        ("unsupported_event_type", ~F.col("event_type").isin(*CATEGORIES)),
        ("outside_date", F.to_date("event_timestamp") != F.lit(str(day)).cast("date")),
    ]


def classify(frame: DataFrame, day: date | str, reason: str = "rejection_reason") -> DataFrame:
    """Trim the keys (spaces only), parse the timestamp and add the reason, in one projection each."""
    keys = ("event_id", "event_type", "repo_name", "actor_login")
    parsed = frame.withColumns({k: F.trim(k) for k in keys} | {"event_timestamp": instant(F.col("created_at"))})
    return parsed.withColumn(reason, first_reason(event_rules(day)))


def split(frame: DataFrame, reason: str = "rejection_reason") -> tuple[DataFrame, DataFrame]:
    """Accepted rows without the reason, and rejected rows with it."""
    return frame.filter(F.col(reason).isNull()).drop(reason), frame.filter(F.col(reason).isNotNull())
