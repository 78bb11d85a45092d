"""Output records: change envelopes, transaction markers, heartbeats."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.functions.cells import image, json, key_values, typed_values
from changeloom.functions.lsn import commit_time, exact_time, lsn_text
from changeloom.functions.names import heartbeat_topic, topic


@dataclass(frozen=True)
class Output:
    """Where records come from and go to."""

    source: str = "cdc"
    database: str = "postgres"
    mode: str = "per_table"
    prefix: str = "cdc"
    single: str = ""
    unchanged: str = "omit"
    markers: bool = False
    #: Whose values are JSON values of their types: of none, of snapshots, or of all; other values are text.
    typed: str = "none"


def envelopes(events: DataFrame, out: Output = Output()) -> DataFrame:
    """The fields of ENVELOPE for each event, and slot, tx_no, ordinal, commit_lsn and topic beside them. Without a
    relation, schema and table are "unknown" and there is no key. Events may have a column snapshot (boolean)."""
    native = "value" in events.schema["after"].dataType.elementType.names
    if out.typed == "all" and not native:
        events, native = events.withColumns({side: typed_values(F.col(side)) for side in ("before", "after")}), True
    typed = native and out.typed != "none"
    schema, table = F.coalesce("rel.schema", F.lit("unknown")), F.coalesce("rel.table", F.lit("unknown"))
    snapshot = F.col("snapshot") if "snapshot" in events.columns else F.lit(False)
    return events.select(
        "slot", "tx_no", "ordinal", "commit_lsn",
        F.lit(out.source).alias("source"), F.lit(out.database).alias("database"), schema.alias("schema"), table.alias("table"), "op",
        F.col("xid").alias("txid"), lsn_text(F.col("event_lsn")).alias("lsn"), commit_time(F.col("commit_ts")).alias("commit_ts"), snapshot.alias("snapshot"),
        F.when(F.col("rel").isNotNull(), image(key_values(F.col("before"), F.col("after")), "sentinel", typed)).alias("key"),
        image(F.col("before"), out.unchanged, typed).alias("before"), image(F.col("after"), out.unchanged, typed).alias("after"),
        topic(F.lit(out.database), schema, table, out.mode, out.prefix, out.single).alias("topic"),
    )


def body(fields: Sequence[str]) -> Column:
    """The JSON of a record: all fields, nulls too, in order."""
    return json(F.struct(*fields))


def change_records(rows: DataFrame) -> DataFrame:
    """envelopes() as records in their order: topic, key, value."""
    from changeloom.model import ENVELOPE

    return rows.select("slot", "tx_no", "ordinal", "commit_lsn", "topic", json(F.col("key")).alias("key"), body(ENVELOPE).alias("value"))


def markers(rows: DataFrame, transactions: DataFrame, out: Output = Output()) -> DataFrame:
    """Begin and commit records around each transaction with events, on the topic of its first event, without a key.
    Both have the commit's position and time, and the number of events."""
    from changeloom.model import MARKER

    first = rows.groupBy("slot", "tx_no").agg(F.min_by("topic", "ordinal").alias("topic"), F.count("*").alias("event_count"))
    whole = transactions.join(first, ["slot", "tx_no"]).select("slot", "tx_no", "commit_lsn", "topic", "event_count", "xid", F.col("commit_ts").alias("at"), F.explode(F.array(F.struct(F.lit(0).cast("bigint").alias("ordinal"), F.lit("begin").alias("op")), F.struct((F.col("event_count") + 1).alias("ordinal"), F.lit("commit").alias("op")))).alias("m"))
    fields = whole.select("slot", "tx_no", F.col("m.ordinal").alias("ordinal"), "commit_lsn", "topic", F.lit(None).cast("string").alias("key"), F.lit(out.source).alias("source"), F.lit(out.database).alias("database"), F.col("m.op").alias("op"), F.col("xid").alias("txid"), lsn_text(F.col("commit_lsn")).alias("lsn"), commit_time(F.col("at")).alias("commit_ts"), "event_count")
    return fields.select("slot", "tx_no", "ordinal", "commit_lsn", "topic", "key", body(MARKER).alias("value"))


def heartbeats(spans: DataFrame, every: str, out: Output = Output()) -> DataFrame:
    """Heartbeat records at each interval of spans (start, end, lsn): timestamp and the last flushed position."""
    from changeloom.model import HEARTBEAT

    rows = spans.select("lsn", F.explode(F.sequence("start", "end", F.expr(f"interval {every}"))).alias("at"))
    rows = rows.select(F.lit(heartbeat_topic(out.prefix, out.single)).alias("topic"), F.lit(None).cast("string").alias("key"), F.lit(out.source).alias("source"), F.lit(out.database).alias("database"), exact_time(F.col("at")).alias("timestamp"), lsn_text(F.col("lsn")).alias("lsn"))
    return rows.select("topic", "key", body(HEARTBEAT).alias("value"), "timestamp", "lsn")


def ordered(records: DataFrame) -> DataFrame:
    """Records dealt to tasks by ranges of topic and log order, and in that order within each, ready to be written:
    one topic may take many tasks."""
    order = ("topic", "slot", "commit_lsn", "tx_no", "ordinal")
    return records.repartitionByRange(*order).sortWithinPartitions(*order)
