"""Running sums over an order of billions of rows, without one task that sees them all."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one where Spark is local."""
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not hasattr(shared_root, "own"):
        shared_root.own = "file://" + tempfile.mkdtemp(prefix="changeloom-")
    return shared_root.own


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the driver's JVM ends."""
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, computed once into the shared folder and read from there: cuts lineage and outlives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Whether Spark removes the shuffle files of a query as soon as that ends; else they stay until the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored_alone(df: DataFrame, name: str) -> DataFrame:
    """stored(), whose shuffle files go at once: in a long chain of tables the disk then holds those of one at a time."""
    conf = df.sparkSession.conf
    was = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return stored(df, name)
    finally:
        conf.unset(CLEANUP) if was is None else conf.set(CLEANUP, was)


def all_equal(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """Every pair is equal, null to null."""
    return functools.reduce(Column.__and__, [a.eqNullSafe(b) for a, b in pairs])


def joined(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """An equi-join on keys in which null equals null; the keys of left stay. right may come from the same table."""
    other = right.select(*[F.col(k).alias(f"_key_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = all_equal([(F.col(k), F.col(f"_key_{k}")) for k in keys])
    return left.join(other, same, how).drop(*[f"_key_{k}" for k in keys])


def running_sum(df: DataFrame, value: Column, name: str, by: Sequence[str], order: str, width: int = 100_000) -> DataFrame:
    """df with the column name: the sum of value up to each row, by the integer column order, within by.

    Rows are summed in stretches of width of the order; only a row for each stretch meets in the window that adds up
    what lies before it. Rows that tie in the order get the sum with all of them. A null in by is a value like any other:
    keys are compared as one struct, in which null equals null, and rows are dealt out once for the window and the join.
    """
    keys = ["_by", "_stretch"]
    marked = df.withColumns({"_by": F.struct(*by) if by else F.struct(F.lit(0)), "_stretch": F.floor(F.col(order) / width), "_value": value})
    sums = marked.groupBy(*keys).agg(F.sum("_value").alias("_sum"))
    before = Window.partitionBy("_by").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(*keys, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    within = F.sum("_value").over(Window.partitionBy(*keys).orderBy(order).rangeBetween(Window.unboundedPreceding, 0))
    rows = marked.withColumn("_within", within)
    return rows.join(bases, keys).withColumn(name, F.col("_within") + F.col("_base")).drop("_by", "_value", "_stretch", "_within", "_base")


def in_ranges(df: DataFrame, order: Sequence[str], place: str) -> DataFrame:
    """df, stored by ranges of an order, with the column place: the number of a row's range (shifted left by 33 bits) and
    its place there, from 0. Rows that tie are told apart by a hash of the whole row, and equal rows by where they came
    from, so a value in most of the rows is dealt out over ranges like any other. Null comes last."""
    rest = [F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind and "void" not in kind]
    rows = df.withColumn("_tie_hash", F.xxhash64(*rest) if rest else F.lit(0)).withColumn("_tie", F.monotonically_increasing_id())
    keys = [*[F.col(f"`{c}`").asc_nulls_last() for c in order], F.col("_tie_hash").asc(), F.col("_tie").asc()]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie_hash", "_tie")
    return stored(ranged.withColumn(place, F.monotonically_increasing_id()), "ranges")


def numbered(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """df with the column name: each row's number in the order of some columns of any types, from 1. Null comes last.

    Rows are dealt out by in_ranges(); a row for each range then tells how many come before it, so no task sees all rows.
    Which of equal rows gets which number makes no difference.
    """
    place = f"_{name}_place"
    rows, part = in_ranges(df, order, place), F.shiftright(F.col(place), 33)
    sizes = rows.groupBy(part.alias("_range")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    sizes = F.broadcast(sizes.select("_range", F.coalesce(before, F.lit(0)).alias("_before")))  # a row for each range
    within = F.col(place).bitwiseAND(F.lit((1 << 33) - 1))
    rows = rows.join(sizes, part == F.col("_range"))
    return rows.withColumn(name, (F.col("_before") + within + 1).cast("long")).drop("_range", "_before", place)
