"""The three ways to find copies against each other, on synthetic wide events.

Every round runs all variants at each number of shuffle partitions, in an order that turns around from
round to round; the first round warms up and is not counted. All variants must give the same bag of rows.
"""

from __future__ import annotations

import time
from statistics import median

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.compare import same_rows
from ..operators.copies import tag_copies, tag_copies_hashed, tag_copies_skewed
from .catalog import wide_rows
from .policy import SHUFFLE

VARIANTS = {"windows": tag_copies, "skewed": tag_copies_skewed, "hashed": tag_copies_hashed}
KEY, BUSINESS = ("event_id",), ("wide", "actor")


def events(spark: SparkSession, rows: int, width: int) -> DataFrame:
    """Three in a hundred share an id with others; of every third such group the actors differ."""
    return wide_rows(spark, rows, width).withColumns({"wide": F.repeat(F.sha2("event_id", 256), F.lit(width)), "actor": F.when((F.col("n") % 300 < 3) & (F.col("n") % 3 == 0), "other").otherwise("same")}).drop("checksum")


def measure(spark: SparkSession, rows: int = 150_000, width: int = 32, runs: int = 3, partitions: tuple[int, ...] = (2, 8)) -> dict:
    """Median seconds of each variant by number of shuffle partitions, and whether all gave the same rows."""
    source = events(spark, rows, width)
    frames = {name: tag(source, KEY, BUSINESS, "n") for name, tag in VARIANTS.items()}
    first, *others = frames.values()
    seconds: dict[str, dict[str, list[float]]] = {str(p): {name: [] for name in VARIANTS} for p in partitions}
    before = spark.conf.get(SHUFFLE)
    try:
        for run in range(runs + 1):
            for p in partitions:
                spark.conf.set(SHUFFLE, str(p))
                for name in list(VARIANTS)[:: 1 if run % 2 else -1]:
                    began = time.perf_counter()
                    VARIANTS[name](source, KEY, BUSINESS, "n").write.format("noop").mode("overwrite").save()
                    if run:
                        seconds[str(p)][name].append(time.perf_counter() - began)
    finally:
        spark.conf.set(SHUFFLE, before)
    return {
        "rows": rows,
        "seconds": {p: {name: round(median(found), 3) for name, found in by.items()} for p, by in seconds.items()},
        "same_rows": all(same_rows(first, other) for other in others),
    }
