"""Equality of frames as bags of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows, as often as they are missing on the other side, with `side` left or right: one shuffle of counts."""
    columns = sorted(left.columns)
    named = [F.col(f"`{c}`").alias(f"c_{i}") for i, c in enumerate(columns)]
    both = left.select(*named, F.lit(1).alias("n")).union(right.select(*named, F.lit(-1).alias("n")))
    surplus = both.groupBy(*(f"c_{i}" for i in range(len(columns)))).agg(F.sum("n").alias("n")).filter("n <> 0")
    repeated = surplus.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.abs("n"))))
    return repeated.select(*(F.col(f"c_{i}").alias(c) for i, c in enumerate(columns)), F.when(F.col("n") > 0, "left").otherwise("right").alias("side"))


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    """Whether both have the same columns, types and rows with their repetitions."""
    if sorted(left.dtypes) != sorted(right.dtypes):
        return False
    return differences(left, right).isEmpty()


def fingerprint(frame: DataFrame) -> DataFrame:
    """One row: the number of rows and a sum over row digests that does not depend on their order."""
    digest = F.sha2(F.to_json(F.struct(*sorted(frame.columns)), {"ignoreNullFields": "false"}), 256)
    part = lambda k: F.conv(F.substring(digest, 1 + 15 * k, 15), 16, 10).cast("decimal(20,0)")
    return frame.agg(F.count(F.lit(1)).alias("rows"), *(F.sum(part(k)).cast("string").alias(f"digest_{k}") for k in range(4)))
