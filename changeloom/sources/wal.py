"""Decoded logs: files of MESSAGE rows, batch and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.model import MESSAGE


def read_messages(spark: SparkSession, path: str, starting_lsn: int = 0, file_format: str = "parquet") -> DataFrame:
    """Messages from a position on; relations before it stay, as they describe what follows. The filter reaches the scan."""
    return spark.read.schema(MESSAGE).format(file_format).load(path).where((F.col("wal_start") >= starting_lsn) | (F.col("msg") == "R"))


def stream_messages(spark: SparkSession, path: str, files_per_batch: int = 1, file_format: str = "parquet") -> DataFrame:
    """The same as a stream of files; files_per_batch bounds what is in flight."""
    return spark.readStream.schema(MESSAGE).format(file_format).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true").load(path)
