"""Raw hourly archives: discovery, scan and normalisation."""

from __future__ import annotations

from datetime import date
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import first_of
from ..functions.contracts import RAW_SCHEMA


def archives(raw_root: str | Path, day: date | str) -> list[str]:
    """The day's hourly files, in order; an error if there is none."""
    found = sorted(str(p) for p in Path(raw_root).glob(f"{day}-*.json.gz"))
    if not found:
        raise FileNotFoundError(f"no archive of {day} in {raw_root}")
    return found


def scan(spark: SparkSession, paths: list[str], schema: str = RAW_SCHEMA) -> DataFrame:
    """JSON Lines under a fixed schema; what cannot be parsed is kept in _corrupt_record."""
    return spark.read.schema(schema).options(mode="PERMISSIVE", multiLine=False, columnNameOfCorruptRecord="_corrupt_record").json(paths)


def normalise(raw: DataFrame, day: date | str) -> DataFrame:
    """One flat row for each raw row, with its file and the requested day."""
    number = first_of(F.col("type") == "PullRequestEvent", F.col("payload.pull_request.number"), F.col("payload.number"))
    return raw.select(
        F.col("id").alias("event_id"),
        F.col("type").alias("event_type"),
        "created_at",
        F.col("repo.name").alias("repo_name"),
        F.col("actor.login").alias("actor_login"),
        F.col("org.login").alias("org_login"),
        F.col("payload.action").alias("payload_action"),
        number.alias("pr_number"),
        F.col("payload.issue.number").alias("issue_number"),
        F.col("payload.issue.labels.name").alias("issue_labels"),
        F.col("_corrupt_record").alias("corrupt_record"),
        F.input_file_name().alias("source_file"),
        F.lit(str(day)).cast("date").alias("event_date"),
    )


def ingest(spark: SparkSession, raw_root: str | Path, day: date | str) -> DataFrame:
    """Publish or persist all columns before anything is decided from them: a scan of fewer columns
    parses less of a line, and may then not see that it is corrupt."""
    return normalise(scan(spark, archives(raw_root, day)), day)
