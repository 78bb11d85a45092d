"""A running pipeline: snapshot, messages and heartbeats to records in a sink, with durable progress."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changeloom.config import Settings
from changeloom.functions.cells import decoded
from changeloom.operators.assemble import with_relation
from changeloom.operators.envelope import Output, change_records, envelopes, heartbeats, markers, ordered
from changeloom.operators.metrics import Registry, listener, watched
from changeloom.operators.progress import Manager, SharedProgress
from changeloom.operators.scale import joined
from changeloom.sinks import KafkaSink, RetryingSink, Sink
from changeloom.streaming.snapshots import Tables, take
from changeloom.streaming.stretches import Stretches
from changeloom.streaming.transactions import stream_changes


def records_of(events: DataFrame, out: Output) -> DataFrame:
    """Change records of assembled events, with markers around each transaction where out asks for them, in order."""
    rows = envelopes(events, out)
    records = change_records(rows)
    if out.markers:
        whole = events.select("slot", "tx_no", "xid", "commit_ts", "commit_lsn").distinct()
        records = records.unionByName(markers(rows, whole, out))
    return ordered(records)


class OutsideChanges(RuntimeError):
    """The stream has changes that stand in no transaction."""


def confirm(progress: Manager | None, ended: DataFrame, force: bool) -> None:
    """Moves each slot's position on to the last of its transactions that ended, and flushes."""
    if progress is None:
        return
    for r in ended.groupBy("slot").agg(F.max("commit_lsn").alias("lsn")).collect():  # a row for each slot
        progress.confirm(r["lsn"], r["slot"] or "")
    progress.flush(force=force)


def write_outside(stray: DataFrame, sink: Sink, batch_id: int, outside: str) -> None:
    """Changes outside of transactions are an error, or go to a part of their own where outside is "quarantine"."""
    if not (n := stray.count()):
        return
    if outside != "quarantine":
        first = stray.orderBy("slot", "seq").first()
        raise OutsideChanges(f"{n} changes outside of transactions, the first at {first['event_lsn']} of slot {first['slot']}")
    value = F.to_json(F.struct("slot", "seq", "op", "rel_id", F.col("event_lsn").alias("position"), "before", "after"))
    sink.write(stray.select(F.lit("outside").alias("topic"), F.lit(None).cast("string").alias("key"), value.alias("value")), batch_id, "outside")


def run(messages: DataFrame, sink: Sink, checkpoint: str, out: Output = Output(), progress: Manager | None = None, max_tx_bytes: int = 64 << 20, once: bool = False, every: str = "1 second", outside: str = "fail", stretches: str | None = None, metrics: Registry | None = None) -> StreamingQuery:
    """Start the pipeline. A batch is written under its number, so a sink that replaces by number has it once however
    often it is tried; progress is confirmed only after the write, and batches run one after another, so a position
    is never ahead of what is durable. Each slot has its own, which every transaction moves on that ended, also one
    that has no changes or is too large to be published.

    Changes outside of transactions stop the query before anything of their batch is written or confirmed, or go to
    the part "outside" of the sink, as records of their position, where outside is "quarantine".

    Transactions are assembled by a state machine for each slot, in a task of its own. With stretches, a shared folder, each
    batch is assembled as a table instead, by as many tasks as it has stretches of positions, and the folder holds
    what is open between batches: for few slots with much traffic.

    With metrics, the state machine's rows count themselves, and a listener adds what each batch's progress says.
    """

    def publish(changes: DataFrame, batch_id: int) -> None:
        changes = changes.persist()
        try:
            write_outside(changes.where("outside"), sink, batch_id, outside)
            sink.write(records_of(changes.where("not outside and not commit").drop("outside", "commit"), out), batch_id)
            confirm(progress, changes.where("commit"), once)
        finally:
            changes.unpersist()

    def publish_stretches(part: DataFrame, batch_id: int) -> None:
        part = part.persist()
        try:
            ends = Stretches(part.sparkSession, stretches, max_tx_bytes)
            got, rows, state = ends.step(part, batch_id)
            stray = got.outside.select("slot", "seq").distinct()
            if stray.limit(1).count():
                known = joined(rows, stray, ["slot", "seq"], "left_semi")
                op = F.when(F.col("msg") == "I", "c").when(F.col("msg") == "U", "u").otherwise("d")
                write_outside(with_relation(known, rows).withColumns({side: decoded(F.col(side), F.col("rel.columns")) for side in ("before", "after")}).withColumns({"op": op, "event_lsn": F.col("wal_start")}), sink, batch_id, outside)
            sink.write(records_of(got.events, out), batch_id)
            ends.commit(batch_id, state)
            confirm(progress, got.transactions, once)
        finally:
            part.unpersist()

    changes = None if stretches else stream_changes(messages, max_tx_bytes)
    if metrics is not None:
        messages.sparkSession.streams.addListener(listener(metrics))
        changes = None if changes is None else watched(changes)
    started = messages.writeStream.foreachBatch(publish_stretches) if changes is None else changes.writeStream.foreachBatch(publish)
    writer = started.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def beat(spark: SparkSession, sink: Sink, checkpoint: str, every: float, out: Output, progress: Manager, metrics: Registry | None = None) -> StreamingQuery:
    """A heartbeat record each `every` seconds, with the last flushed position, whether or not anything else comes."""

    def publish(ticks: DataFrame, batch_id: int) -> None:
        at = F.lit(datetime.now(timezone.utc))
        spans = ticks.sparkSession.range(1).select(at.alias("start"), at.alias("end"), F.lit(progress.flushed).cast("bigint").alias("lsn"))
        sink.write(heartbeats(spans, "1 day", out).select("topic", "key", "value"), batch_id, "heartbeat")
        if metrics is not None:
            metrics.add("heartbeats_total")
            metrics.put("last_checkpoint_lsn", progress.flushed)

    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return ticks.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint).trigger(processingTime=f"{every} seconds").start()


def start(spark: SparkSession, settings: Settings, messages: DataFrame, checkpoint: str, tables: Tables | None = None, sink: Sink | None = None, once: bool = False, outside: str = "fail", metrics: Registry | None = None) -> list[StreamingQuery]:
    """A pipeline as the settings have it: sink, routing, progress, the initial snapshot where there is no progress yet,
    heartbeats. Without a sink records go to the brokers. tables holds the rows of the tables to snapshot, as
    snapshots.planned() finds them in a catalog, and up to max_parallel_tables of them are written at a time."""
    b, out = settings.redpanda, settings.output()
    if sink is None:
        sink = RetryingSink(KafkaSink(b.brokers, b.compression, b.required_acks, b.linger_ms, b.enable_idempotence, b.max_inflight, settings.tuning.producer_batch_max_bytes))
    progress = Manager(SharedProgress(spark, settings.checkpoint.file_path), settings.checkpoint.flush_interval)
    if settings.snapshot.mode == "initial" and progress.flushed == 0:
        wanted = {n: t for n, t in (tables or {}).items() if not settings.snapshot.tables or n in settings.snapshot.tables}
        take(wanted, sink, out, most=settings.snapshot.max_parallel_tables, metrics=metrics)
    queries = [run(messages, sink, f"{checkpoint}/log", out, progress, settings.runtime.max_tx_bytes, once, outside=outside, metrics=metrics)]
    if settings.replication.heartbeat_interval > 0 and not once:
        queries.append(beat(spark, sink, f"{checkpoint}/heartbeat", settings.replication.heartbeat_interval, out, progress, metrics))
    return queries


def keep_running(begin: Callable[[], StreamingQuery], attempts: int | None = None, first: float = 0.5, most: float = 30.0) -> int:
    """Run a query until it ends without an error, and begin it again from its checkpoint after each error, after a wait
    that doubles from first to most seconds; a run longer than most starts the waits anew. attempts of None never
    gives up. Returns how often it began again."""
    wait, again = first, 0
    while True:
        began = time.monotonic()
        try:
            begin().awaitTermination()
            return again
        except StreamingQueryException:
            if attempts is not None and again >= attempts:
                raise
            wait = first if time.monotonic() - began > most else wait
            time.sleep(wait)
            wait, again = min(most, 2 * wait), again + 1


def drain(queries: Sequence[StreamingQuery], progress: Manager | None = None) -> None:
    """Publish what has arrived, stop, and flush the progress."""
    queries[0].processAllAvailable()
    for q in queries:
        q.stop()
    if progress is not None:
        progress.flush(force=True)
