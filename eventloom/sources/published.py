"""Frames to and from a store of published days.

Writing is one job for all days of a frame, partitioned by day; the days' folders are then renamed into
their publications one by one. Reading is one scan over the files of all wanted days, whose day
comes from the path, so that a filter on the day prunes files. Digests are computed by tasks, in
blocks: the driver sees names, sizes and digests only.
"""

from __future__ import annotations

import hashlib
import os
import shutil
import uuid
from collections.abc import Callable, Iterable
from contextlib import contextmanager
from datetime import date
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.store import SUCCESS, Published, Store, StoreError, iso_day
from .footers import rows_in

NO_DAY = "__HIVE_DEFAULT_PARTITION__"
#: Files that one task digests.
FILES_A_TASK = 4


def physical(frame: DataFrame) -> dict[str, str]:
    return dict(frame.dtypes)


def digested(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    for batch in batches:
        sums = []
        for path in batch.column(0).to_pylist():
            with open(path, "rb") as file:
                sums.append(hashlib.file_digest(file, "sha256").hexdigest())
        yield pa.record_batch([batch.column(0), pa.array(sums, pa.string())], names=["path", "sha256"])


def task_digests(spark: SparkSession) -> Callable[[list[Path]], dict[Path, str]]:
    """SHA-256 of files by tasks, on the file system that driver and executors share."""

    def run(paths: list[Path]) -> dict[Path, str]:
        if not paths:
            return {}
        names = [(str(p.absolute()),) for p in paths]
        frame = spark.createDataFrame(spark.sparkContext.parallelize(names, -(-len(names) // FILES_A_TASK)), "path string")
        found = {r.path: r.sha256 for r in frame.mapInArrow(digested, "path string, sha256 string").collect()}
        return {p: found[name] for p, (name,) in zip(paths, names, strict=True)}

    return run


def store(spark: SparkSession, root: str | Path) -> Store:
    return Store(root, task_digests(spark))


@contextmanager
def staged(frame: DataFrame, root: str | Path):
    """The days of a frame as folders, written by one job beside the days they will be published to."""
    if physical(frame).get("event_date") != "date":
        raise ValueError("event_date must be a date")
    folder = Path(root) / f"_written-{uuid.uuid4().hex}"
    try:
        # Rows of a day are brought together, and a large day is split again, before files are written.
        frame.hint("rebalance", "event_date").write.partitionBy("event_date").parquet(str(folder))
        yield {p.name.partition("=")[2]: p for p in sorted(folder.glob("event_date=*"))}
    finally:
        shutil.rmtree(folder, ignore_errors=True)


def adopted(folder: Path, schema: dict[str, str]) -> Callable[[Path], tuple[int, dict[str, str]]]:
    """A writer that moves a folder's files instead of writing them."""

    def write(stage: Path) -> tuple[int, dict[str, str]]:
        os.rename(folder, stage)
        (stage / SUCCESS).touch()
        return rows_in(str(p) for p in stage.glob("*.parquet")), schema

    return write


def columns_but_day(frame: DataFrame) -> dict[str, str]:
    return {c: t for c, t in physical(frame).items() if c != "event_date"}


def write_day(frame: DataFrame, root: str | Path, day: date | str, fault: Callable[[str], None] | None = None) -> dict:
    """Publish the rows of one day; a frame without rows publishes an empty day."""
    today, schema = iso_day(day), columns_but_day(frame)
    spark = frame.sparkSession
    with staged(frame, root) as days:
        if set(days) - {today}:
            raise ValueError("rows of another day")
        if today in days:
            return store(spark, root).publish(today, adopted(days[today], schema), fault)

        def write_nothing(stage: Path) -> tuple[int, dict[str, str]]:
            spark.createDataFrame([], frame.drop("event_date").schema).coalesce(1).write.parquet(str(stage))
            return 0, schema

        return store(spark, root).publish(today, write_nothing, fault)


def write_days(frame: DataFrame, root: str | Path) -> list[str]:
    """Publish each day that a frame has, from one pass over it; an empty frame changes nothing."""
    with staged(frame, root) as days:
        if NO_DAY in days:
            raise ValueError("rows without a day")
        for day, folder in days.items():
            store(frame.sparkSession, root).publish(day, adopted(folder, columns_but_day(frame)))
        return list(days)


def scan(spark: SparkSession, root: str | Path, found: dict[str, Published]) -> DataFrame:
    """One frame over published files; event_date comes from their paths."""
    schemas = {tuple(sorted(p.manifest["schema"].items())) for p in found.values()}
    if len(schemas) != 1:
        raise StoreError("the days have different schemas")
    options = {"basePath": str(Path(root).absolute()), "recursiveFileLookup": "false", "ignoreMissingFiles": "false", "ignoreCorruptFiles": "false"}
    files = [str(Path(f).absolute()) for p in found.values() for f in p.files]
    frame = spark.read.options(**options).parquet(*files).withColumn("event_date", F.col("event_date").cast("date"))
    if columns_but_day(frame) != dict(next(iter(schemas))):
        raise StoreError("the schema of the files is not the manifest's")
    return frame


def read_day(spark: SparkSession, root: str | Path, day: date | str) -> DataFrame:
    """A frame over the files of the day's current generation."""
    today = iso_day(day)
    return scan(spark, root, {today: store(spark, root).resolve(today)})


def read_days(spark: SparkSession, root: str | Path) -> DataFrame:
    """All published days."""
    found = store(spark, root).resolve_all()
    if not found:
        raise StoreError("no day is published")
    return scan(spark, root, found)
