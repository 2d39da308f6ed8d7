"""Helpers shared by the operators: reading tables, cutting lineage, small joins."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Separators of words: space and U+0009 to U+000D.
SPACES = r"[\x20\x09-\x0D]+"

#: A side of a join is broadcast only up to this many rows; every caller's rows are at most 1 KB.
BROADCAST_ROWS = 20_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it.

    Where none is set, a local session gets a temporary one of its own; on a cluster that would
    scatter the tables over the executors' disks, so there it is an error.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="eventloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: Lists of the folders written since, for each `cleanup` under way.
_watched: list[list[str]] = []


def materialize(frame: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: the lineage ends here.

    The table survives the loss of any executor, and what follows reads it instead of
    computing its input again. It stays until a `cleanup` around the call ends.
    """
    spark = frame.sparkSession
    path = f"{shared_dir(spark)}/eventloom/{label}-{uuid.uuid4().hex}"
    for made in _watched:
        made.append(path)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of whatever file system its path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def cleanup(spark: SparkSession) -> Iterator[list[str]]:
    """Delete the tables that were written inside, when it ends. What is taken off the list stays."""
    made: list[str] = []
    _watched.append(made)
    try:
        yield made
    finally:
        _watched.remove(made)
        for path in made:
            delete(spark, path)


def slices(batch: pa.RecordBatch, column: int, rows: int = 512, size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Parts of an Arrow batch with few rows and bytes of text each, one row at least: what is
    made of them in Python stays small however large a batch is."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        stop = max(at + 1, min(at + rows, int(np.searchsorted(ends, before + size, "right"))))
        yield batch.slice(at, stop - at)
        at = stop


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it many times in `body`, also inside lambdas."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Words of a text, in order; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def join_small(rows: DataFrame, small: DataFrame, keys: list[str], salt_by: Column) -> DataFrame:
    """Null-safe left join to a materialized table that has one row for each key.

    The table is broadcast if it has BROADCAST_ROWS rows or fewer. Beyond that both sides are
    dealt out by key and salt, so that a key with a third of all rows is split over 32 tasks.
    """
    renamed = small.select(*(F.col(k).alias(f"__k_{k}") for k in keys), *(c for c in small.columns if c not in keys))
    if small.count() <= BROADCAST_ROWS:
        on = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys]
        return rows.join(F.broadcast(renamed), on, "left").drop(*(f"__k_{k}" for k in keys))
    salted = renamed.withColumn("__k_salt", F.explode(F.sequence(F.lit(0), F.lit(31))))
    on = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys] + [F.col("__salt") == F.col("__k_salt")]
    return (
        rows.withColumn("__salt", F.pmod(F.xxhash64(salt_by), F.lit(32)).cast("int"))
        .join(salted, on, "left")
        .drop("__salt", "__k_salt", *(f"__k_{k}" for k in keys))
    )
