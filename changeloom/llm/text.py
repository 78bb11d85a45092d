"""Column helpers shared by the operators: exact ASCII lower-casing, word arrays, plan checks and shared tables."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.functions.cells import let
from changeloom.llm.encoding import release
from changeloom.operators.scale import shared_path, stored

__all__ = ["ascii_lower", "hash128", "let", "shared_path", "ship", "small_batches", "small_side", "stored", "tidy"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Separators of words: space and the control characters tab to carriage return.
SPACES = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: Letters outside ASCII whose case mapping Unicode lower-casing would apply as well.
CASED_BEYOND_ASCII = r"[\P{ASCII}&&[\p{Lu}\p{Lt}\p{Nl}\p{So}]]"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. lower() is much faster than translate() and gives the same unless a cased letter lies
    beyond ASCII, so only such texts take the slow branch. Null stays null."""
    return F.when(text.rlike(CASED_BEYOND_ASCII), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def hash128(value: Column) -> list[Column]:
    """Two independent 64-bit hashes of a column, for keys where one would collide at 10^12 values."""
    return [F.xxhash64(value), F.xxhash64(F.lit(7), value)]


def small_side(df: DataFrame, max_rows: int) -> DataFrame:
    """df with a broadcast hint if it has at most max_rows rows, else as it is. df should be cheap to count."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


#: Spark's own number of rows in a batch for Python, and the one that texts take: 10,000 of them may be gigabytes.
ARROW_ROWS, SPARK_ROWS, TEXT_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "500"
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 2 << 20  # of a batch that Python returns; the JVM holds it outside its heap


def tidy(made: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """made, which returns its batches in parts of about BATCH_BYTES and gives freed memory back when it is through."""

    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in made(batches):
            step = max(1, batch.num_rows * BATCH_BYTES // max(1, batch.nbytes))
            for at in range(0, max(1, batch.num_rows), step):
                yield batch.slice(at, step)
        release()

    return through


def small_batches(spark: SparkSession, most: int = 8 << 20) -> None:
    """From now on a batch for Python has no more than about `most` bytes, where the session has a larger limit: rows of long
    arrays come in tens of megabytes otherwise, which the JVM holds outside its heap and Python once more."""
    now = spark.conf.get(ARROW_BYTES, None)
    if now is None or not now.isdigit() or int(now) > most:
        spark.conf.set(ARROW_BYTES, str(most))


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each Spark application, for tasks that run Python. Where the session
    has Spark's own number of rows in a batch for Python it becomes TEXT_ROWS."""
    import os
    import shutil

    import changeloom

    if spark.conf.get(ARROW_ROWS) == SPARK_ROWS:
        spark.conf.set(ARROW_ROWS, TEXT_ROWS)
    app = spark.sparkContext.applicationId
    if getattr(ship, "done", None) != app:
        root = os.path.dirname(os.path.dirname(os.path.abspath(changeloom.__file__)))
        packed = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="changeloom-code-"), "changeloom-code"), "zip", root, "changeloom")
        spark.sparkContext.addPyFile(packed)
        ship.done = app
