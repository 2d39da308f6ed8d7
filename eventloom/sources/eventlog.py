"""Summaries of Spark's own event logs, as a DataFrame query over their JSON Lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SCHEMA = """
  `Event` string, `Stage ID` bigint, `Stage IDs` array<bigint>, `Properties` map<string, string>, executionId bigint, physicalPlanDescription string,
  `Task Info` struct<`Launch Time`: bigint, `Finish Time`: bigint>,
  `Task Metrics` struct<`Executor CPU Time`: bigint, `Executor Run Time`: bigint,
    `Shuffle Read Metrics`: struct<`Remote Bytes Read`: bigint, `Local Bytes Read`: bigint>, `Shuffle Write Metrics`: struct<`Shuffle Bytes Written`: bigint>>
"""


def events(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.schema(SCHEMA).json(paths).withColumn("file", F.input_file_name())


def job_groups(log: DataFrame) -> DataFrame:
    """Tasks, time and shuffle of each job group; a stage that several groups share counts for each.

    Stage numbers begin anew in every application, so they are joined within their log file.
    """
    group = F.coalesce(F.try_element_at("Properties", F.lit("spark.jobGroup.id")), F.lit("ungrouped"))
    stages = log.filter("Event = 'SparkListenerJobStart'").select("file", F.explode("Stage IDs").alias("stage"), group.alias("job_group")).distinct()
    metric = F.col("Task Metrics")
    read = metric["Shuffle Read Metrics"]
    tasks = log.filter((F.col("Event") == "SparkListenerTaskEnd") & metric.isNotNull()).select(
        "file",
        F.col("Stage ID").alias("stage"),
        (F.col("Task Info.Finish Time") - F.col("Task Info.Launch Time")).alias("duration_ms"),
        metric["Executor CPU Time"].alias("cpu_ns"),
        metric["Executor Run Time"].alias("run_ms"),
        (F.coalesce(read["Remote Bytes Read"], F.lit(0)) + F.coalesce(read["Local Bytes Read"], F.lit(0))).alias("read_bytes"),
        F.coalesce(metric["Shuffle Write Metrics"]["Shuffle Bytes Written"], F.lit(0)).alias("write_bytes"),
    )
    named = tasks.join(stages, ["file", "stage"], "left").withColumn("job_group", F.coalesce("job_group", F.lit("ungrouped")))
    sums = [F.sum(c).alias(c) for c in ("cpu_ns", "run_ms", "read_bytes", "write_bytes")]
    most = [F.max(c).alias(f"max_task_{c}") for c in ("read_bytes", "write_bytes", "duration_ms", "cpu_ns")]
    return named.groupBy("job_group").agg(F.count(F.lit(1)).alias("tasks"), *sums, *most)


def final_plans(log: DataFrame) -> DataFrame:
    """The last adaptive plan of each execution."""
    updates = log.filter(F.col("Event").endswith("SparkListenerSQLAdaptiveExecutionUpdate"))
    last = F.row_number().over(Window.partitionBy("file", "executionId").orderBy(F.col("physicalPlanDescription").contains("isFinalPlan=true").desc()))
    return updates.withColumn("n", last).filter("n = 1").select("file", "executionId", F.col("physicalPlanDescription").alias("plan"))
