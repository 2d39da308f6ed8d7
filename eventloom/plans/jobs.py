"""The three stages of a day: ingest, transform, aggregate."""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date
from pathlib import Path

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ..operators.daily import outcomes, tag
from ..operators.metrics import daily_metrics, reason_counts
from ..sources.events import ingest
from ..sources.published import read_day, write_day
from .policy import ShufflePolicy

STAGES = ("ingest", "transform", "aggregate")


@contextmanager
def held(frame: DataFrame) -> Iterator[DataFrame]:
    """Persist on the executors' disks while in use."""
    kept = frame.persist(StorageLevel.DISK_ONLY)
    try:
        yield kept
    finally:
        kept.unpersist()


class Jobs:
    """Runs stages of a day; every stage begins from what the one before has published."""

    def __init__(self, spark: SparkSession, raw_root: str | Path, output_root: str | Path, top: int = 10, policy: ShufflePolicy | None = None):
        if top < 1:
            raise ValueError("a ranking needs at least one place")
        self.spark, self.raw, self.out, self.top = spark, Path(raw_root), Path(output_root), top
        self.policy = policy or ShufflePolicy(spark)

    def run(self, stage: str, day: date | str, from_stage: str = "ingest") -> dict[str, int]:
        """Rows of each dataset that was published."""
        if stage not in (*STAGES, "pipeline") or from_stage not in STAGES:
            raise ValueError(f"unknown stage {stage} or {from_stage}")
        rows: dict[str, int] = {}
        for name in STAGES[STAGES.index(from_stage) :] if stage == "pipeline" else (stage,):
            settings = self.policy.apply(name, day, self.raw, self.out)
            print("StageSettings " + json.dumps(settings.record(), sort_keys=True), flush=True)
            rows |= getattr(self, name)(day)
        return rows

    def _write(self, name: str, frame: DataFrame, day: date | str) -> dict[str, int]:
        return {name: write_day(frame, self.out / name, day)["rows"]}

    def ingest(self, day: date | str) -> dict[str, int]:
        return self._write("ingested", ingest(self.spark, self.raw, day), day)

    def transform(self, day: date | str) -> dict[str, int]:
        with held(tag(read_day(self.spark, self.out / "ingested", day), day)) as tagged:
            clean, rejected = outcomes(tagged)
            return self._write("clean", clean, day) | self._write("rejected", rejected, day)

    def aggregate(self, day: date | str) -> dict[str, int]:
        # Both inputs are resolved, and the rejected rows checked, before anything is published.
        reasons = reason_counts(read_day(self.spark, self.out / "rejected", day), day)
        rows: dict[str, int] = {}
        with held(read_day(self.spark, self.out / "clean", day)) as clean:
            for name, frame in daily_metrics(clean, self.top).items():
                rows |= self._write(name, frame, day)
        return rows | self._write("rejection_counts", reasons, day)
