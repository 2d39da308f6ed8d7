"""Counts, rankings and profiles."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.contracts import REASONS


def count_by(frame: DataFrame, *dimensions: str, day: str = "event_date", name: str = "event_count") -> DataFrame:
    """Rows of each day and further dimensions; no rows in, no rows out."""
    return frame.groupBy(day, *dimensions).agg(F.count(F.lit(1)).alias(name))


def top_n(frame: DataFrame, entity: str, n: int = 10, day: str = "event_date", name: str = "event_count") -> DataFrame:
    """The n entities of each day with the most rows, ranked by count and then by name.

    The filter stands directly on the row number, so each task keeps n rows of a day before the exchange.
    """
    if n < 1:
        raise ValueError("a ranking needs at least one place")
    order = Window.partitionBy(day).orderBy(F.desc(name), F.asc(entity))
    return count_by(frame, entity, day=day, name=name).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def reason_counts(rejected: DataFrame, day: date | str, reasons: tuple[str, ...] = REASONS) -> DataFrame:
    """Rejected rows by the processing day and reason; an error for rows of another day or domain.

    The rows are read once: their counts, as many as there are reasons or there is an error, are judged and returned.
    """
    types = dict(rejected.dtypes)
    if types.get("event_date") != "date" or types.get("rejection_reason") != "string":
        raise ValueError("rejected rows need a date event_date and a string rejection_reason")
    counted = count_by(rejected, "rejection_reason")
    found = counted.limit(len(reasons) + 1).collect()
    if len(found) > len(reasons) or any(str(r.event_date) != str(day) or r.rejection_reason not in reasons for r in found):
        raise ValueError("rejected rows have another day or an unknown reason")
    return rejected.sparkSession.createDataFrame(found, counted.schema)


def daily_metrics(clean: DataFrame, n: int = 10) -> dict[str, DataFrame]:
    return {
        "event_counts": count_by(clean, "event_type", "event_hour", "is_bot"),
        "daily_volume": count_by(clean),
        "top_repositories": top_n(clean, "repo_name", n),
        "top_actors": top_n(clean, "actor_login", n),
    }


def null_counts(frame: DataFrame, *columns: str) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns]


def total(column: str, alias: str) -> Column:
    """A sum that is zero for no rows."""
    return F.coalesce(F.sum(column), F.lit(0)).alias(alias)


def repeated_grain(frame: DataFrame, *grain: str) -> DataFrame:
    return frame.groupBy(*grain).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def row_json(frame: DataFrame) -> DataFrame:
    """Each row as one JSON object, nulls included, in the column `value`."""
    return frame.select(F.to_json(F.struct(*(F.col(f"`{c}`") for c in frame.columns)), {"ignoreNullFields": "false"}).alias("value"))


def bounded_bytes(frame: DataFrame, most_rows: int) -> DataFrame:
    """Rows and bytes of the rows' JSON; an error above the bound, found without a full count."""
    if frame.limit(most_rows + 1).count() > most_rows:
        raise ValueError(f"more than {most_rows} rows")
    return row_json(frame).agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.octet_length("value")), F.lit(0)).cast("bigint").alias("bytes"))
