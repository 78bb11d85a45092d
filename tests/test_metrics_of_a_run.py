"""Metrics that the running pipeline makes, and snapshots side by side."""

import threading
import time

import pytest

from changeloom import config
from changeloom.model import MESSAGE
from changeloom.operators.envelope import Output
from changeloom.operators.metrics import Registry
from changeloom.sinks import FileSink
from changeloom.streaming import engine, snapshots
from tests.test_commits import message, transaction


def test_registry(spark):
    r = Registry()
    r.add("events_total", 2, op="c")
    r.add("events_total", op="c")
    r.put("queue_depth", 4)
    for x in (0.5, 3, 99):
        r.observe("seconds", x, (1, 4))
    lines = r.text().splitlines()
    assert 'cdc_events_total{op="c"} 3' in lines and "cdc_queue_depth 4" in lines and "cdc_seconds_count 3" in lines
    assert [x for x in lines if "bucket" in x] == ['cdc_seconds_bucket{le="+Inf"} 3', 'cdc_seconds_bucket{le="1"} 1', 'cdc_seconds_bucket{le="4"} 2']
    assert {(x.name, x.labels.get("le"), x.value) for x in r.table(spark).collect()} >= {("seconds_bucket", "4", 2.0), ("seconds_sum", None, 102.5)}


def test_what_a_run_counts(spark, tmp_path):
    """Two batches of a pipeline with a snapshot and heartbeats."""
    logs, metrics, sink = tmp_path / "log", Registry(), FileSink(str(tmp_path / "out"))
    put = lambda rows: spark.createDataFrame(rows, MESSAGE).coalesce(1).write.mode("append").parquet(str(logs))
    put([message("s", 0, "R"), *transaction("s", 1, 1, 100, [1, 1, 1]), *transaction("s", 10, 2, 200, [9000])])
    values = {"postgres": {"user": "u"}, "snapshot": {"mode": "initial", "max_parallel_tables": 2}, "checkpoint": {"file_path": str(tmp_path / "p.json"), "flush_interval": 0.1}, "replication": {"heartbeat_interval": 1.0}, "runtime": {"max_tx_bytes": 2000}}
    tables = {n: (spark.range(k).selectExpr("id", f"'{n}' name"), ["id"]) for n, k in (("one", 5), ("two", 7))}
    queries = engine.start(spark, config.load(values, {}), spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", 1).parquet(str(logs)), str(tmp_path / "cp"), tables, sink, metrics=metrics)
    try:
        queries[0].processAllAvailable()
        put([*transaction("s", 20, 3, 300, []), *transaction("s", 30, 4, 400, [1])])
        queries[0].processAllAvailable()
        until = time.monotonic() + 60
        while time.monotonic() < until and not (metrics.get("heartbeats_total") and metrics.get("transactions_total") == 3):
            time.sleep(0.3)
    finally:
        for q in queries:
            q.stop()
    assert (metrics.get("snapshot_rows_total", table="one"), metrics.get("snapshot_rows_total", table="two"), metrics.get("snapshot_duration_seconds_count")) == (5, 7, 2)
    assert (metrics.get("events_total", op="c"), metrics.get("events_total", op="d")) == (4, 0)
    assert (metrics.get("transactions_total"), metrics.get("oversized_transactions_total"), metrics.get("last_read_lsn")) == (3, 1, 400)
    assert metrics.get("transaction_bytes_bucket", le="1024") == 3 == metrics.get("transaction_bytes_count") and metrics.get("heartbeats_total") >= 1
    assert metrics.get("wal_messages_total") >= 13 and metrics.get("commit_lag_seconds") > 0


class Slow:
    """A sink whose third table fails while others are on their way, and which knows how many it writes at a time."""

    def __init__(self, fails=()):
        self.fails, self.now, self.most, self.done, self.begun = fails, 0, 0, [], []
        self.lock = threading.Lock()

    def write(self, records, batch_id=None, part=""):
        with self.lock:
            self.now += 1
            self.begun.append(part)
            self.most = max(self.most, self.now)
        try:
            if part in self.fails:
                time.sleep(2)
                raise OSError(f"{part} is broken")
            records.write.format("noop").mode("overwrite").save()
            self.done.append(part)
        finally:
            with self.lock:
                self.now -= 1


def slow_table(spark, seconds):
    return spark.range(4, numPartitions=4).selectExpr("id", f"java_method('java.lang.Thread', 'sleep', cast({seconds * 1000} as bigint)) s") if seconds else spark.range(4)


def test_a_failing_table_cancels_the_others(spark):
    tables = {n: (slow_table(spark, s), ["id"]) for n, s in (("a", 0), ("b", 60), ("c", 0), ("d", 0), ("e", 0))}
    sink, began = Slow({"snapshot-c"}), time.monotonic()
    with pytest.raises(OSError, match="snapshot-c"):
        snapshots.take(tables, sink, Output(), most=2)
    assert time.monotonic() - began < 45 and sink.most == 2 and "snapshot-b" not in sink.done and "snapshot-e" not in sink.begun
    calm = Slow()
    got = snapshots.take({n: (spark.range(k), ["id"]) for n, k in (("a", 3), ("b", 0), ("c", 9))}, calm, Output(), most=3)
    assert sorted(got)[0][:2] == ("a", 3) and [t.rows for t in got] == [3, 0, 9] and len(calm.done) == 3


def test_tables_of_a_catalog(spark):
    catalog = spark.createDataFrame([("public", "users", "r"), ("shop", "orders", "p"), ("public", "seen", "v")], "schema string, table string, kind string")
    indexes = spark.createDataFrame([("shop", "orders", [2, 1], True), ("shop", "orders", [3], False)], "schema string, table string, columns array<int>, is_primary boolean")
    attributes = spark.createDataFrame([("shop", "orders", 1, "line"), ("shop", "orders", 2, "id"), ("shop", "orders", 3, "at")], "schema string, table string, number int, name string")
    there, gone = snapshots.planned(["shop.orders", "users", "seen", "none.x"], catalog, indexes, attributes, lambda n: n)
    assert there == {"shop.orders": ("shop.orders", ["id", "line"]), "users": ("users", [])} and sorted(gone) == ["none.x", "seen"]


def test_settings_without_effect_are_named():
    with pytest.warns(UserWarning, match="runtime.queue_capacity is ignored"):
        got = config.load({"postgres": {"user": "u"}, "runtime": {"queue_capacity": 9}}, {})
    assert got.runtime.queue_capacity == 9
    sections = {f"{s}.{k}" for s in vars(got) for k in vars(getattr(got, s))}
    assert set(config.WITHOUT_EFFECT) <= sections
