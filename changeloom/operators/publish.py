"""Batches of records on their way to a sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def record_bytes(key: Column, value: Column) -> Column:
    return F.coalesce(F.octet_length(key), F.lit(0)) + F.coalesce(F.octet_length(value), F.lit(0))


def chunked(records: DataFrame, by: Sequence[str], order: Sequence[str], size: int) -> DataFrame:
    """records with chunk, from 0, of at most size records in order within by; 0 or less makes one chunk."""
    if size <= 0:
        return records.withColumn("chunk", F.lit(0).cast("bigint"))
    return records.withColumn("chunk", F.floor((F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1) / size).cast("bigint"))


def summary(records: DataFrame, by: Sequence[str], size: Column, order: str, topic: str = "topic") -> DataFrame:
    """Of each batch: n, total_bytes, max_bytes and the topic of the first record that is as large as that."""
    return records.withColumn("_size", size).groupBy(*by).agg(F.count("*").alias("n"), F.sum("_size").cast("bigint").alias("total_bytes"), F.max("_size").cast("bigint").alias("max_bytes"), F.max_by(topic, F.struct("_size", -F.col(order))).alias("max_topic"))


def split_oversized(records: DataFrame, size: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Records that a broker takes, and those that are too large for it, with why: these are never tried again."""
    marked = records.withColumn("bytes", size)
    why = F.concat(F.lit("record of "), F.col("bytes").cast("string"), F.lit(" bytes on topic "), F.col("topic"), F.lit(f" exceeds {most} bytes; raise the topic's max.message.bytes"))
    return marked.where(F.col("bytes") <= most), marked.where(F.col("bytes") > most).withColumn("error", why)
