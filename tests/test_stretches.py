"""Batches assembled as tables: random logs over restarts and retries, one slot over many tasks."""

import json
import random

import pytest

from changeloom.model import MESSAGE
from changeloom.operators import progress
from changeloom.operators.assemble import assemble
from changeloom.sinks import FileSink
from changeloom.streaming import engine
from changeloom.streaming.stretches import Stretches
from tests.test_commits import message, transaction
from tests.test_intervals import expected_any, half_log, stray
from tests.test_log import random_log

FOUND = ("slot", "xid", "ordinal", "seq", "op", "commit_lsn")


@pytest.mark.parametrize("seed", (1, 2))
def test_batches_give_what_the_whole_log_gives(spark, tmp_path, seed):
    """Cut anywhere, with batches that are tried twice, and a new object for each, as after a restart."""
    rows = random_log(seed, n=100, slots=("a", None))
    draw, got, outside, ended = random.Random(seed), [], [], []
    cuts = sorted(draw.sample(range(1, 100), 5))
    for k, (a, b) in enumerate(zip([0, *cuts], [*cuts, 100], strict=True)):
        table = spark.createDataFrame([r for r in rows if a <= r[1] < b], MESSAGE)
        for _ in range(1 + (k % 2)):
            ends = Stretches(spark, str(tmp_path / "state"), 400, width=10)
            done, _, state = ends.step(table, k)
            events = [tuple(r[c] for c in (*FOUND, "tx_no", "bytes")) for r in done.events.collect()]
        got += events
        outside += [(r.slot, r.seq) for r in done.outside.collect()]
        ended += [(r.slot, r.tx_no, r.commit_lsn, r.n_events) for r in done.transactions.collect()]
        ends.commit(k, state)
    named = lambda x: sorted(map(str, x))
    assert named(x[:6] for x in got) == named(expected_any(rows, 400)) and set(outside) == stray(rows)
    whole = assemble(spark.createDataFrame(rows, MESSAGE), 400)
    assert named(got) == named(tuple(r[c] for c in (*FOUND, "tx_no", "bytes")) for r in whole.events.collect())
    assert named(ended) == named((r.slot, r.tx_no, r.commit_lsn, r.n_events) for r in whole.transactions.collect())
    left = [n for n in ends.folder.names() if not n.startswith("after-")]
    assert len(left) <= 6


def test_a_transaction_over_many_batches_is_carried_once(spark, tmp_path):
    rows = half_log(300)
    ends, sizes = Stretches(spark, str(tmp_path / "state"), 0, width=20), []
    for k in range(10):
        done, _, state = ends.step(spark.createDataFrame([r for r in rows if r[1] // 60 == k], MESSAGE), k)
        n = done.events.count()
        ends.commit(k, state)
        sizes.append((n, sum(ends.rows([p]).count() for s in state["slots"] for p in s["places"])))
    assert sum(n for n, _ in sizes) == 300 + 39 * 5
    carried = [m for n, m in sizes if n == 0]
    assert len(carried) >= 3 and all(b - a == 60 for a, b in zip(carried, carried[1:], strict=False))
    big = [n for n, _ in sizes if n >= 300]
    assert len(big) == 1
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        done, _, _ = Stretches(spark, str(tmp_path / "one"), 0, width=20).step(spark.createDataFrame(rows, MESSAGE).repartition(6), 0)
        assert done.events.rdd.getNumPartitions() > 1  # one slot, more than one task
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_the_pipeline_by_stretches(spark, tmp_path):
    logs, sink = tmp_path / "log", FileSink(str(tmp_path / "out"))

    def go(rows, outside="fail"):
        if rows:
            spark.createDataFrame(rows, MESSAGE).coalesce(1).write.mode("append").parquet(str(logs))
        manager = progress.Manager(progress.SharedProgress(spark, str(tmp_path / "p.json")))
        query = engine.run(spark.readStream.schema(MESSAGE).parquet(str(logs)), sink, str(tmp_path / "cp"), progress=manager, once=True, max_tx_bytes=500, outside=outside, stretches=str(tmp_path / "ends"))
        query.awaitTermination(120)
        read = sink.read(spark).collect()
        return [json.loads(r.value)["lsn"] for r in read if r.topic != "outside"], [json.loads(r.value) for r in read if r.topic == "outside"], manager.saved

    one = transaction("s", 1, 1, 100, [1, 2])
    assert go([message("s", 0, "R"), *one[:2]]) == ([], [], {})
    assert go(one[2:] + transaction("s", 10, 2, 200, [900])) == (["0/2", "0/3"], [], {"s": 200})
    with pytest.raises(Exception, match="1 changes outside"):
        go([message("s", 20, "I", new=[("t", "7"), ("n", None)])])
    lsns, out, saved = go([], "quarantine")
    assert lsns == ["0/2", "0/3"] and saved == {"s": 200} and [(x["position"], x["op"]) for x in out] == [(20, "c")]
    assert go(transaction("s", 30, 3, 300, []), "quarantine")[2] == {"s": 300}
