"""Batches of files that are there whole or not at all, and progress of each slot."""

import json

import pytest
from pyspark.sql import functions as F

from changeloom.model import MESSAGE
from changeloom.operators import assemble, progress
from changeloom.sinks import FileSink
from changeloom.streaming import engine
from tests.test_log import AT, rel

RECORDS = "topic string, key string, value string"


def values(spark, sink, kind="records"):
    return sorted(r.value for r in sink.read(spark, kind).collect())


@pytest.mark.parametrize("file_format", ("parquet", "json"))
def test_a_crash_between_data_and_commit(spark, tmp_path, monkeypatch, file_format):
    sink = FileSink(str(tmp_path / "out"), file_format, max_message_bytes=30)
    assert values(spark, sink) == []
    one = spark.createDataFrame([("t", "k", "v1"), ("u", None, "v2"), ("t", "k", "x" * 99)], RECORDS)
    sink.write(one, 0)
    assert values(spark, sink) == ["v1", "v2"] and values(spark, sink, "quarantine") == ["x" * 99]
    reader = sink.read(spark)
    commit = sink.commit
    monkeypatch.setattr(sink, "commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    two = spark.createDataFrame([("t", "k", "v3"), ("w", "k", "v4")], RECORDS)
    for batch in (0, 1):  # a batch that is there, and a new one
        with pytest.raises(OSError):
            sink.write(two, batch)
        assert values(spark, sink) == ["v1", "v2"]
    monkeypatch.setattr(sink, "commit", commit)
    assert len(sink.clean(spark)) == 4 and values(spark, sink) == ["v1", "v2"]
    sink.write(two, 1)
    sink.write(two, 1)
    assert values(spark, sink) == ["v1", "v2", "v3", "v4"] and sorted(r.value for r in reader.collect()) == ["v1", "v2"]
    assert {(r.batch, r.topic) for r in sink.read(spark).collect()} == {(f"{0:012d}", "t"), (f"{0:012d}", "u"), (f"{1:012d}", "t"), (f"{1:012d}", "w")}
    sink.write(one.where("false"), 2)
    sink.write(one.where("key is null").withColumn("ordinal", F.lit(7)), 0)  # replaces, with a column more
    assert values(spark, sink) == ["v2", "v3", "v4"] and len(sink.clean(spark)) == 4  # two tries of 0, one of 1 with their quarantines
    assert values(spark, sink) == ["v2", "v3", "v4"]


def message(slot, seq, kind, xid=None, lsn=None, new=None):
    return (slot, seq, seq, kind, xid, lsn, AT if kind in "BC" else None, 1 if kind in "RI" else None, rel("email") if kind == "R" else None, None, new)


def transaction(slot, seq, xid, lsn, sizes):
    return [message(slot, seq, "B", xid, lsn), *[message(slot, seq + 1 + k, "I", new=[("t", "x" * n), ("n", None)]) for k, n in enumerate(sizes)], message(slot, seq + 1 + len(sizes), "C", lsn=lsn)]


def test_slots_go_on_at_their_own_speed(spark, tmp_path):
    """Two slots, one far ahead; batches in which all transactions are empty or too large move progress on, too."""
    logs, where = tmp_path / "log", str(tmp_path / "shared" / "progress.json")
    store = progress.SharedProgress(spark, where)
    assert store.load() == (0, None) and store.slots() == {}

    def go(rows):
        spark.createDataFrame(rows, MESSAGE).coalesce(1).write.mode("append").parquet(str(logs))
        manager = progress.Manager(progress.SharedProgress(spark, where))  # another driver
        stream = spark.readStream.schema(MESSAGE).parquet(str(logs))
        engine.run(stream, FileSink(str(tmp_path / "out")), str(tmp_path / "cp"), progress=manager, once=True, max_tx_bytes=500).awaitTermination(120)
        return progress.SharedProgress(spark, where).slots(), manager.flushed

    named = [message(s, 0, "R") for s in ("fast", "slow")]
    assert go(named + transaction("fast", 1, 1, 9000, [1]) + transaction("slow", 1, 1, 10, [1])) == ({"fast": 9000, "slow": 10}, 10)
    assert go(transaction("slow", 10, 2, 20, [])) == ({"fast": 9000, "slow": 20}, 20)
    assert go(transaction("slow", 20, 3, 30, [400, 400]) + transaction("fast", 20, 2, 9100, [])[:1]) == ({"fast": 9000, "slow": 30}, 30)
    assert go([message("fast", 30, "C", lsn=9100)]) == ({"fast": 9100, "slow": 30}, 30)
    assert sorted(json.loads(r.value)["lsn"] for r in FileSink(str(tmp_path / "out")).read(spark).collect()) == ["0/2", "0/2"]
    kept = json.loads(spark.read.text(where, wholetext=True).first().value)
    assert kept["lsn"] == 30 and kept["timestamp"]
    old = progress.FileProgress(str(tmp_path / "old.json"))
    (tmp_path / "old.json").write_text('{"lsn": 7, "timestamp": null}')
    manager = progress.Manager(old)
    manager.confirm(5, "fast")
    assert manager.flushed == 7 and manager.flush() and old.slots() == {"fast": 7}


def test_frontier(spark):
    rows = [message(s, 0, "R") for s in ("a", "b", None)]
    for k, sizes in enumerate(([1], [], [1, 2], [900], [1], [1])):
        for slot, base in (("a", 100), ("b", 5000), (None, 9)):
            rows += transaction(slot, 1 + 10 * k, k, base + k, sizes)
    got = assemble.assemble(spark.createDataFrame(rows, MESSAGE), 500).transactions
    numbers = {(r.slot, r.xid): r.tx_no for r in got.collect()}
    acked = [("a", k, True) for k in (0, 2, 5)] + [("b", k, k != 2) for k in (0, 2, 4, 5)] + [("b", 5, False)]
    acks = spark.createDataFrame([(s, numbers[s, k], ok) for s, k, ok in acked], "slot string, tx_no long, acked boolean")
    assert {tuple(r) for r in progress.frontier(got, acks).collect()} == {("a", 103, 4, 2), ("b", 5001, 2, 4), (None, 0, 0, 6)}
