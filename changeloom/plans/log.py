"""A log made of the table events, for the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.model import CELL, RELATION

#: Position of the first event, and bytes of log for each.
LSN_BASE, LSN_STEP = 16_777_216, 64
EVENTS_PER_TX = 5


def event_changes(events: DataFrame) -> DataFrame:
    """The table events as changes: seq, lsn, txid, user_id, op, event_type, value, props, ts."""
    op = F.when(F.col("event_type") == "signup", "c").when(F.col("event_type") == "error", "d").otherwise("u")
    return events.select(
        F.col("event_id").alias("seq"), (F.lit(LSN_BASE) + F.col("event_id") * LSN_STEP).cast("bigint").alias("lsn"), F.floor(F.col("event_id") / EVENTS_PER_TX).cast("bigint").alias("txid"),
        "user_id", op.alias("op"), "event_type", "value", "props", "ts",
    )


def cell(text: Column) -> Column:
    """A cell that the log sent: text, or null."""
    return F.when(text.isNull(), F.struct(F.lit("n").alias("kind"), F.lit(None).cast("string").alias("text"))).otherwise(F.struct(F.lit("t").alias("kind"), text.alias("text")))


def unchanged_cell() -> Column:
    return F.struct(F.lit("u").alias("kind"), F.lit(None).cast("string").alias("text"))


def messages_from_events(events: DataFrame, slot: str = "events") -> DataFrame:
    """A whole log: a relation, and begin, five changes and commit for each transaction.

    Creations send all columns, updates leave props unsent, deletions send the key alone. The relation has another
    version from the first transaction whose number is 1000 on, with the column value renamed to amount.
    """
    rows = event_changes(events).withColumn("at", F.col("txid") * 8 + 8)
    some = lambda c: F.col(c).cast("string")
    key_only = F.array(cell(some("user_id")), *[cell(F.lit(None).cast("string")) for _ in range(3)])
    full = F.array(cell(some("user_id")), cell(F.col("event_type")), cell(some("value")), F.when(F.col("op") == "u", unchanged_cell()).otherwise(cell(F.col("props"))))
    none = F.lit(None)
    row = lambda seq, start, msg, xid=none, lsn=none, ts=none, rel_id=none, rel=none, before=none, after=none: [F.lit(slot).alias("slot"), seq.cast("bigint").alias("seq"), start.cast("bigint").alias("wal_start"), msg.alias("msg"), xid.cast("bigint").alias("xid"), lsn.cast("bigint").alias("lsn"), ts.cast("timestamp").alias("commit_ts"), rel_id.cast("bigint").alias("rel_id"), rel.cast(RELATION).alias("rel"), before.cast(f"array<{CELL}>").alias("before"), after.cast(f"array<{CELL}>").alias("after")]
    message = F.when(F.col("op") == "c", "I").when(F.col("op") == "u", "U").otherwise("D")
    changes = rows.select(*row(F.col("at") + 1 + F.col("seq") % EVENTS_PER_TX, F.col("lsn"), message, rel_id=F.lit(1), before=F.when(F.col("op") == "d", key_only), after=F.when(F.col("op") != "d", full)))
    txs = rows.groupBy("txid", "at").agg(F.min("lsn").alias("first"), F.max("lsn").alias("last"), F.max("ts").alias("ts"))
    begins = txs.select(*row(F.col("at"), F.col("first") - 1, F.lit("B"), F.col("txid"), F.col("last") + 8, F.col("ts")))
    commits = txs.select(*row(F.col("at") + 6, F.col("last") + 4, F.lit("C"), lsn=F.col("last") + 8, ts=F.col("ts")))
    columns = lambda value: F.array(*[F.struct(F.lit(n).alias("name"), F.lit(o).cast("bigint").alias("type_oid"), F.lit(k).alias("is_key")) for n, o, k in (("user_id", 20, True), ("event_type", 25, False), (value, 701, False), ("props", 114, False))])
    relation = lambda value: F.struct(F.lit("public").alias("schema"), F.lit("events").alias("table"), columns(value).alias("columns"))
    versions = events.sparkSession.range(1).select(F.explode(F.array(F.struct(F.lit(0).alias("seq"), relation("value").alias("rel")), F.struct(F.lit(1000 * 8 + 7).alias("seq"), relation("amount").alias("rel")))).alias("v"))
    relations = versions.select(*row(F.col("v.seq"), F.lit(0), F.lit("R"), rel_id=F.lit(1), rel=F.col("v.rel")))
    return relations.unionByName(begins).unionByName(changes).unionByName(commits)
