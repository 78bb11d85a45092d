"""The running pipeline: captures as streams, changes outside of transactions, retries, restarts, heartbeats, settings."""

import json
import struct
import time

import pytest
from pyspark.sql import functions as F

from changeloom import config
from changeloom.functions import pgtypes
from changeloom.model import MESSAGE
from changeloom.operators import assemble, envelope, metrics, mirror, progress, publish
from changeloom.sinks import FileSink, KafkaSink, MemorySink, RetryingSink, topics
from changeloom.sources import wal
from changeloom.sources.pgoutput import register
from changeloom.streaming import engine
from tests.test_log import AT, expected, found, one, random_log, rel

TEXT = lambda s: s.encode() + b"\0"
CELL = lambda s: b"t" + struct.pack(">I", len(s)) + s.encode()
RELATION = b"R" + struct.pack(">I", 1) + TEXT("public") + TEXT("users") + b"d" + struct.pack(">H", 1) + b"\1" + TEXT("id") + struct.pack(">Ii", 25, -1)


def capture(path, at, messages):
    with open(path, "wb") as f:
        for k, m in enumerate(messages):
            payload = b"w" + struct.pack(">QQq", at + k, at + k, 0) + m
            f.write(struct.pack(">I", len(payload)) + payload)


def transaction(xid, *ids):
    return [b"B" + struct.pack(">QqI", 100 * xid, 0, xid), *[b"I" + struct.pack(">I", 1) + b"N" + struct.pack(">H", 1) + CELL(x) for x in ids], b"C" + struct.pack(">BQQq", 0, 100 * xid, 100 * xid + 9, 0)]


def test_captures_as_a_stream_over_restarts(spark, tmp_path):
    register(spark)
    logs, sink = tmp_path / "log", FileSink(str(tmp_path / "out"))
    logs.mkdir()

    def go():
        query = engine.run(spark.readStream.format("wal_capture").load(str(logs)), sink, str(tmp_path / "cp"), once=True)
        query.awaitTermination(120)
        return [json.loads(r.value)["after"]["id"] for r in sink.read(spark).orderBy("commit_lsn", "ordinal").collect()]

    capture(logs / "b.wal", 1, [RELATION, *transaction(1, "1", "2")])
    assert go() == ["1", "2"]
    capture(logs / "c.wal", 20, transaction(2, "3")[:2])
    assert go() == ["1", "2"]  # its commit is yet to come
    capture(logs / "d.wal", 30, transaction(2, "3")[2:] + transaction(3, "4"))
    assert go() == ["1", "2", "3", "4"] == go()
    capture(logs / "a.wal", 1, [RELATION])
    capture(logs / "e.wal", 40, transaction(4, "5"))
    with pytest.raises(Exception, match="came late"):
        go()


def logged(spark, path, rows):
    spark.createDataFrame(rows, MESSAGE).coalesce(1).write.mode("append").parquet(str(path))
    return wal.stream_messages(spark, str(path), files_per_batch=1)


STRAY = [("s", 1, 1, "I", None, None, None, 1, None, None, [("t", "9"), ("n", None)]), ("s", 2, 2, "B", 7, 90, AT, None, None, None, None), ("s", 3, 3, "I", None, None, None, 1, None, None, [("t", "1"), ("n", None)]), ("s", 4, 4, "C", None, 90, AT, None, None, None, None)]
NAMED = [("s", 0, 0, "R", None, None, None, 1, rel("email"), None, None)]


def test_changes_outside_of_transactions(spark, tmp_path):
    stream = logged(spark, tmp_path / "log", NAMED + STRAY)
    sink, manager = FileSink(str(tmp_path / "out")), progress.Manager(progress.FileProgress(str(tmp_path / "p.json")))
    with pytest.raises(Exception, match="1 changes outside"):
        engine.run(stream, sink, str(tmp_path / "cp"), progress=manager, once=True).awaitTermination(120)
    assert manager.flushed == 0 and not (tmp_path / "out").exists()
    engine.run(stream, sink, str(tmp_path / "cp2"), progress=manager, once=True, outside="quarantine").awaitTermination(120)
    got = {r.topic: json.loads(r.value) for r in sink.read(spark).collect()}
    assert got["outside"]["position"] == 1 and got["cdc.postgres.public.users"]["after"] == {"id": "1", "email": None} and manager.flushed == 90


class Flaky:
    def __init__(self, sink, fails):
        self.sink, self.fails = sink, fails

    def write(self, records, batch_id=None, part=""):
        self.sink.write(records, batch_id, part)
        if self.fails:
            self.fails -= 1
            raise OSError("the broker is away")


def test_batches_written_again_are_there_once(spark, tmp_path):
    files = FileSink(str(tmp_path / "out"))
    sink = RetryingSink(Flaky(files, 2), first=0.01)
    records = spark.createDataFrame([("t", "k", "v"), ("u", None, "w")], "topic string, key string, value string")
    sink.write(records, 3)
    assert sorted(r.value for r in files.read(spark).collect()) == ["v", "w"] and (sink.retries, sink.failures) == (2, 0)
    assert sorted(r.topic for r in topics(records).collect()) == ["t", "u"]
    for kept in (RetryingSink(Flaky(files, 5), 3, 0.01), RetryingSink(Flaky(files, 5), None, 0.01, permanent=lambda e: "away" in str(e))):
        with pytest.raises(OSError, match="away"):
            kept.write(records, 4)
        assert kept.failures == 1
    small = FileSink(str(tmp_path / "small"), "json", max_message_bytes=3, records_per_file=1)
    small.write(spark.createDataFrame([("t", "k", "v"), ("t", "k", "a long value")], "topic string, key string, value string"), 0)
    assert [r.value for r in small.read(spark).collect()] == ["v"]
    assert "exceeds 3 bytes" in spark.read.json(str(tmp_path / "small/quarantine")).first().error
    memory = MemorySink("seen")
    memory.write(records, 0)
    memory.write(records, 1)
    memory.write(records, 1)
    assert spark.table("seen").count() == 4


def test_a_query_begins_again_after_errors(spark, tmp_path):
    stream = logged(spark, tmp_path / "log", NAMED + STRAY[1:])
    files, begun = FileSink(str(tmp_path / "out")), []
    sink = Flaky(files, 2)
    counter = metrics.listener()
    spark.streams.addListener(counter)

    def begin():
        begun.append(time.monotonic())
        return engine.run(stream, sink, str(tmp_path / "cp"), once=True)

    assert engine.keep_running(begin, first=0.05) == 2 and len(begun) == 3
    assert files.read(spark).count() == 1
    time.sleep(2)
    spark.streams.removeListener(counter)
    assert counter.reconnects == 2 and counter.failures == 2
    with pytest.raises(Exception, match="broker is away"):
        engine.keep_running(lambda: engine.run(stream, Flaky(files, 9), str(tmp_path / "cp2"), once=True), 1, 0.01)


def test_pipeline_of_settings(spark, tmp_path):
    stream = logged(spark, tmp_path / "log", NAMED + STRAY[1:])
    values = {"postgres": {"user": "u", "dbname": "shop"}, "snapshot": {"mode": "initial", "tables": ["users"]}, "checkpoint": {"file_path": str(tmp_path / "p.json"), "flush_interval": 60.0}, "topic": {"mode": "single", "single_topic_name": "all"}, "replication": {"heartbeat_interval": 1.0, "transaction_markers": True}}
    settings, sink = config.load(values, {}), FileSink(str(tmp_path / "out"))
    users = spark.createDataFrame([(5, "e@x"), (4, None)], "id int, email string")
    queries = engine.start(spark, settings, stream, str(tmp_path / "cp"), {"users": (users, ["id"]), "other": (users, [])}, sink)
    until = time.monotonic() + 60
    heartbeats = lambda: (tmp_path / "out").exists() and sink.read(spark).where("topic = 'cdc.__heartbeat'").count()
    while time.monotonic() < until and not heartbeats():
        time.sleep(0.5)
    engine.drain(queries)
    values_of = [json.loads(r.value) for r in sink.read(spark).where("topic = 'all'").collect()]
    assert sorted(v["op"] for v in values_of) == ["begin", "c", "commit", "r", "r"]
    assert sorted(v["key"]["id"] for v in values_of if v["op"] == "r") == [4, 5] and [v["key"] for v in values_of if v["op"] == "c"] == [{"id": "1"}]
    assert heartbeats() >= 1 and json.load(open(tmp_path / "p.json"))["lsn"] == 90
    again = engine.start(spark, settings, stream, str(tmp_path / "cp"), {"users": (users, ["id"])}, sink, once=True)
    again[0].awaitTermination(60)
    assert sink.read(spark).where("topic = 'all'").count() == 5


def test_settings_from_a_file(tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("postgres:\n  dsn: postgres://h/d\nreplication:\n  status_interval: 500ms\n  heartbeat_interval: 5m\nredpanda:\n  linger: 7ms\n  topic_auto_create:\n    partitions: 3\nmetrics:\n  enabled: false\n  listen_addr: ''\n")
    with pytest.raises(ValueError, match="status_interval is below a second"):
        config.load_file(str(path), {})
    got = config.load_file(str(path), {"CDC_REPLICATION__STATUS_INTERVAL": "2", "CDC_HEALTH__LISTEN_ADDR": ":1"})
    assert (got.replication.heartbeat_interval, got.redpanda.linger_ms, got.redpanda.partitions, got.health.listen_addr, got.logging.level) == (300.0, 7, 3, ":1", "info")
    assert got.postgres.jdbc_url() == "jdbc:postgresql://h/d"
    kafka = KafkaSink(["a:1", "b:2"], "zstd", "leader")
    assert kafka.options["kafka.bootstrap.servers"] == "a:1,b:2" and kafka.options["kafka.acks"] == "1" and kafka.options["kafka.max.in.flight.requests.per.connection"] == "1"
    with pytest.raises(ValueError, match="compression"):
        KafkaSink(["a:1"], "rar")


def test_many_relation_versions_and_null_slots(spark):
    rows = random_log(5, slots=("a", None))
    log = spark.createDataFrame(rows, MESSAGE)
    changes = log.where("msg in ('I', 'U', 'D')")
    plain = assemble.with_relation(changes, log)
    salted = assemble.with_relation(changes, log, max_broadcast=0, width=7)
    assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))
    named = lambda rows: [(("~" if r[0] is None else r[0]), *r[1:]) for r in rows]
    events = assemble.assemble(log, 400).events.withColumn("slot", F.coalesce("slot", F.lit("~")))
    assert found(events) == expected(named(rows), 400)
    acks = spark.createDataFrame([(None, 1, 5, True), (None, 2, 6, False), ("s", 1, 7, True)], "slot string, ord int, lsn int, acked boolean")
    assert sorted(map(str, progress.contiguous(acks).collect())) == ["Row(slot='s', lsn=7, n=1)", "Row(slot=None, lsn=5, n=1)"]


def test_published_tables(spark):
    rows = random_log(6)
    log = spark.createDataFrame(rows, MESSAGE)
    other = spark.createDataFrame([("public", "none")], "schema string, table string")
    users = spark.createDataFrame([("public", "users")], "schema string, table string")
    assert assemble.assemble(log, tables=other).events.count() == 0
    assert set(r.rel_id for r in assemble.assemble(log, tables=users).events.select("rel_id").distinct().collect()) == {1}


def test_records_keep_log_order_in_one_topic(spark):
    rows = [("all", "s", k // 5, k // 5, k % 5, str(k)) for k in range(500)]
    got = envelope.ordered(spark.createDataFrame(rows, "topic string, slot string, commit_lsn long, tx_no long, ordinal int, value string").repartition(9))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    parts = got.withColumn("part", F.spark_partition_id()).collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len({r.part for r in parts}) > 1
    order = [(r.part, (r.commit_lsn, r.ordinal)) for r in parts]
    assert order == sorted(order) and [k for _, k in order] == sorted(k for _, k in order)


@pytest.mark.parametrize(("value", "text"), [(0.0, "0"), (1.5, "1.5"), (-2.25, "-2.25"), (100000.0, "100000"), (1234567.0, "1.234567e+06"), (1e21, "1e+21"), (0.0001, "0.0001"), (0.00001, "1e-05"), (1.25e-120, "1.25e-120"), (123456.789, "123456.789"), (float("inf"), "Infinity")])
def test_float_bounds(spark, value, text):
    assert one(spark, pgtypes.float_text(F.lit(value))) == text


def test_values_of_either_kind(spark):
    from pyspark.sql.types import StringType

    assert one(spark, pgtypes.range_bound(F.lit('"a b"'), StringType())) == "a b"
    rows = [("s", 0, 0, "R", None, None, None, 1, ("public", "t", [("n", 23, True), ("f", 701, False), ("b", 16, False), ("j", 3802, False), ("x", 25, False), ("bad", 20, False)]), None, None), ("s", 1, 1, "B", 7, 90, AT, None, None, None, None)]
    cells = [("t", "42"), ("t", "NaN"), ("t", "t"), ("t", '{"a":[1]}'), ("u", None), ("t", "4x")]
    rows += [("s", 2, 2, "U", None, None, None, 1, None, None, cells), ("s", 3, 3, "C", None, 90, AT, None, None, None, None)]
    events = assemble.assemble(spark.createDataFrame(rows, MESSAGE)).events
    value = lambda **o: json.loads(envelope.change_records(envelope.envelopes(events, envelope.Output(**o))).first().value)
    assert value(typed="all", unchanged="sentinel")["after"] == {"n": 42, "f": "NaN", "b": True, "j": {"a": [1]}, "x": "__toast_unchanged", "bad": "4x"}
    assert value(typed="all")["key"] == {"n": 42} and value(typed="snapshot")["key"] == {"n": "42"}


def test_deleted_keys_and_moves(spark):
    rows = spark.createDataFrame([(1, 1, "c", None, 1), (2, 2, "u", 1, 2), (2, 3, "u", None, 3)], "id int, k int, op string, old int, ver int")
    moved = mirror.key_moves(rows, ["id"], ["old"])
    assert [(r.id, r.op, r.ver) for r in moved.collect()] == [(1, "d", 2)]
    every = rows.unionByName(moved).drop("k")
    assert [(r.id, r.ver) for r in mirror.latest(every, ["id"], ["ver"], F.col("op") == "d").collect()] == [(2, 3)]
    tied = spark.createDataFrame([(1, None, "x")], "id int, ver int, op string")
    assert mirror.latest(tied, ["id"], ["ver"], F.col("op") == "d").count() == 1


def test_flush_interval_and_queue_depth(tmp_path):
    manager = progress.Manager(progress.FileProgress(str(tmp_path / "p.json")), every=60)
    manager.confirm(5)
    assert manager.flush()
    manager.confirm(6)
    assert not manager.flush() and manager.flush(force=True) and manager.flushed == 6
    assert metrics.queue_depth({"sources": [{"endOffset": '{"behind_files":4}'}, {"endOffset": {"behind_files": 1}}, {"endOffset": "3"}]}) == 5
    assert metrics.readiness(None, 0x200, 0x100)["lag_bytes"] == 256 and metrics.readiness(None)["status"] == 503


def test_chunks(spark):
    rows = spark.createDataFrame([("t", k) for k in range(5)], "topic string, ord int")
    assert [r.chunk for r in publish.chunked(rows, ["topic"], ["ord"], 2).orderBy("ord").collect()] == [0, 0, 1, 1, 2]
    assert {r.chunk for r in publish.chunked(rows, ["topic"], ["ord"], 0).collect()} == {0}


def test_mirror_fields_with_defaults(spark):
    put = lambda after, op="c": json.dumps({"op": op, "txid": 7, "lsn": "0/1", "before": None, "after": after})
    records = spark.createDataFrame([(put({"id": "1", "n": "5"}),), (put({"id": "2", "n": "x"}),), (put({"n": "3"}),), ('{"op":"begin","txid":7}',), ('{"source":"cdc","timestamp":"t"}',)], "value string")
    got = mirror.from_records(records, {"id": "int", "n": "int", "name": "string"}, ["id"], {"n": 0, "name": ""})
    assert sorted((r.id, r.n, r.name, r.ver) for r in got.collect()) == [(1, 5, "", 7), (2, 0, "", 7)]


def test_windows_of_a_stream(spark, tmp_path):
    from datetime import timedelta

    from changeloom.streaming import windows

    def went(name, change, batches):
        place = tmp_path / name
        place.mkdir()
        stream = spark.readStream.schema("at timestamp, op string, k int").option("maxFilesPerTrigger", 1).parquet(str(place))
        for k, rows in enumerate(batches):
            spark.createDataFrame([(AT + timedelta(minutes=m), op, i) for m, op, i in rows], "at timestamp, op string, k int").coalesce(1).write.mode("append").parquet(str(place))
            query = change(stream).writeStream.format("parquet").option("path", str(place) + "-out").option("checkpointLocation", str(place) + "-cp").trigger(availableNow=True).start()
            query.awaitTermination(120)
        return spark.read.parquet(str(place) + "-out").collect()

    batches = [[(0, "c", 1), (10, "c", 2), (70, "u", 3)], [(200, "u", 4), (20, "c", 5)], [(400, "c", 6), (1, "c", 1)], [(900, "d", 7)]]
    hours = went("hours", lambda s: windows.changes_per_window(s, "at", ["op"], "1 hour", late="2 hours"), batches)
    assert sorted((r.window.start.hour, r.op, r.n) for r in hours)[:3] == [(15, "c", 3), (16, "u", 1), (18, "u", 1)]
    met = went("met", lambda s: windows.sessions(s, "at", ["op"], "30 minutes", late="2 hours"), batches)
    assert ("c", 3) in [(r.op, r.n) for r in met]
    once = went("once", lambda s: windows.once_each(s, "at", ["k"], "24 hours"), batches)
    assert sorted(r.k for r in once) == [1, 2, 3, 4, 5, 6, 7]


def test_names_for_sql():
    from changeloom.functions import names

    assert names.quoted_name('a"b.c.d') == '"a""b"."c.d"' and names.quoted_name("t") == '"public"."t"' and names.heartbeat_topic("", "all") == "all.__heartbeat"


def test_tables_over_jdbc_need_the_driver(spark):
    from changeloom.sources import snapshot

    with pytest.raises(Exception, match="driver"):
        snapshot.read_table(spark, "jdbc:postgresql://h/d", "users", "id", (0, 9))
