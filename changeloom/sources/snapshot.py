"""Initial snapshots of tables as change events."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, BinaryType, DataType, StructField

from changeloom.functions.names import quoted_name, schema_of, table_of
from changeloom.functions.pgtypes import normalised
from changeloom.model import COLUMN
from changeloom.operators.scale import numbered

#: Type numbers of the database for Spark's types; text for others.
TYPE_OIDS = {"boolean": 16, "binary": 17, "bigint": 20, "smallint": 21, "int": 23, "string": 25, "float": 700, "double": 701, "date": 1082, "timestamp_ntz": 1114, "timestamp": 1184}


def type_oid(kind: DataType) -> int:
    name = kind.simpleString()
    return 1700 if name.startswith("decimal") else TYPE_OIDS.get(name, 25)


def existing(names: DataFrame, catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of qualified names (name) those that the catalog (schema, table, kind) has as table or partitioned table (r,
    p), and those that it hasn't, which a snapshot skips."""
    parts = names.select("name", schema_of(F.col("name")).alias("schema"), table_of(F.col("name")).alias("table"))
    there = catalog.where(F.col("kind").isin("r", "p")).select("schema", "table")
    return parts.join(there, ["schema", "table"], "left_semi"), parts.join(there, ["schema", "table"], "left_anti")


def primary_keys(indexes: DataFrame, attributes: DataFrame) -> DataFrame:
    """schema, table, pk: names of the key columns in the order of the index. indexes: schema, table, columns (numbers,
    array) and is_primary; attributes: schema, table, number, name."""
    places = indexes.where("is_primary").select("schema", "table", F.posexplode("columns").alias("place", "number"))
    named = places.join(attributes, ["schema", "table", "number"])
    return named.groupBy("schema", "table").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "name"))), lambda x: x["name"]).alias("pk"))


def snapshot(table: DataFrame, name: str, pk: Sequence[str] = (), as_of: datetime | None = None, typed: bool = False, oids: Mapping[str, int] | None = None) -> DataFrame:
    """A table's rows as events of envelopes(), op r, position 0, transaction 0, snapshot true, ordered by pk if there
    is one. as_of is the commit time of all rows, now without it. Values are text; typed adds to each the field value, a
    variant as pgtypes.normalised() has it. oids gives type numbers of columns whose Spark type doesn't tell them."""
    schema, _, short = name.rpartition(".") if "." in name else ("public", "", name)
    oid = lambda f: (oids or {}).get(f.name, type_oid(f.dataType))
    columns = F.array(*[F.struct(F.lit(f.name).alias("name"), F.lit(oid(f)).cast("bigint").alias("type_oid"), F.lit(f.name in pk).alias("is_key")) for f in table.schema]).cast(f"array<{COLUMN}>")

    def value(f: StructField) -> Column:
        own = F.col(f"`{f.name}`")
        native = normalised(own, f.dataType, oid(f))
        text = own if isinstance(f.dataType, AtomicType) and not isinstance(f.dataType, BinaryType) else native
        more = [native.cast("variant").alias("value")] if typed else []
        return F.struct(F.lit(f.name).alias("name"), F.lit(oid(f)).cast("bigint").alias("type_oid"), F.when(own.isNull(), "n").otherwise("t").alias("kind"), text.cast("string").alias("text"), F.lit(f.name in pk).alias("is_key"), *more)

    after = F.array(*[value(f) for f in table.schema])
    rows = table.orderBy(*pk) if pk else table
    return rows.select(
        F.lit("snapshot").alias("slot"), F.lit(0).cast("bigint").alias("tx_no"), F.lit(0).cast("bigint").alias("xid"), F.lit("r").alias("op"), F.lit(None).cast("bigint").alias("rel_id"),
        F.struct(F.lit(schema or "public").alias("schema"), F.lit(short).alias("table"), columns.alias("columns")).alias("rel"),
        F.when(F.lit(False), after).alias("before"), after.alias("after"),
        F.lit(0).cast("bigint").alias("event_lsn"), (F.lit(as_of) if as_of else F.current_timestamp()).cast("timestamp").alias("commit_ts"), F.lit(0).cast("bigint").alias("commit_lsn"),
        F.lit(0).alias("ordinal"), F.lit(True).alias("snapshot"),
    )


def snapshots(tables: Mapping[str, tuple[DataFrame, Sequence[str]]], as_of: datetime | None = None) -> DataFrame:
    """The snapshots of several tables (name -> rows, pk) as one; Spark runs their scans side by side."""
    parts = [snapshot(df, name, pk, as_of) for name, (df, pk) in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def pages(table: DataFrame, pk: Sequence[str], size: int) -> DataFrame:
    """table with page, from 0, of size rows in the order of a key of any columns and types; the last may have fewer.
    Without a key the order is that of a hash of the rows. Null comes after all values; rows that tie on the key stand in the
    order of their hash, so one key in most of the rows still makes pages, of several tasks."""
    return numbered(table, pk, "page").withColumn("page", F.floor((F.col("page") - 1) / size).cast("bigint"))


def page_bounds(paged: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Of pages(): page, first and last (structs of the key) and n rows of each. A reader that has lost its cursor fetches
    a page, or the rest from it on, by these."""
    key = F.struct(*[F.col(f"`{c}`") for c in pk])
    order = F.struct(*[x for c in pk for x in (F.col(f"`{c}`").isNull().alias(f"{c} null"), F.col(f"`{c}`"))])  # null last
    return paged.groupBy("page").agg(F.min_by(key, order).alias("first"), F.max_by(key, order).alias("last"), F.count("*").alias("n"))


def rest_from(table: DataFrame, pk: Sequence[str], after: Sequence[object]) -> DataFrame:
    """Rows whose key comes after a key, null last: what a snapshot that stopped there has still to read. Comparisons with
    the first column alone reach the scan."""
    later, same = F.lit(False), F.lit(True)
    for c, value in zip(pk, after, strict=True):
        own = F.col(f"`{c}`")
        if value is not None:
            later = later | (same & (own.isNull() | (own > F.lit(value))))
        same = same & own.eqNullSafe(F.lit(value))
    first = F.col(f"`{pk[0]}`")
    return table.where(later) if after[0] is None else table.where(first.isNull() | (first >= F.lit(after[0]))).where(later)


def read_table(spark: SparkSession, url: str, name: str, key: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 8, fetch_size: int = 10_000) -> DataFrame:
    """A table of a qualified name over JDBC, in parts by key where bounds are given. Needs the database's driver on the
    class path."""
    read = spark.read.format("jdbc").option("url", url).option("dbtable", quoted_name(name)).option("fetchsize", fetch_size)
    if key and bounds:
        read = read.option("partitionColumn", key).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", parts)
    return read.load()
