"""Folders for intermediate files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder name under the folder that all nodes share, or a temporary one where none is set."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    return f"{shared or tempfile.mkdtemp(prefix='eventloom-')}/{label}-{uuid.uuid4().hex}"


def local_path(folder: str) -> str:
    """A folder's path without the scheme of the local file system."""
    return folder.removeprefix("file://") if folder.startswith("file:///") else folder.removeprefix("file:")
