"""Assembly of random logs, batch and streaming, against a plain state machine; captures; sinks; progress; settings."""

import json
import os
import random
import struct
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from changeloom import config
from changeloom.functions import cells, lsn, names, pgtypes
from changeloom.model import ENVELOPE, MESSAGE
from changeloom.operators import assemble, envelope, mirror, progress
from changeloom.sinks import FileSink
from changeloom.sources.pgoutput import register
from changeloom.streaming.engine import run
from changeloom.streaming.transactions import stream_events

AT = datetime(2026, 3, 17, 15, 0, tzinfo=timezone.utc)


def rel(name):
    return ("public", "users", [("id", 25, True), (name, 25, False)])


def random_log(seed, n=120, slots=("a", "b")):
    draw, rows = random.Random(seed), []
    for slot in slots:
        rows.append((slot, 0, 0, "R", None, None, None, 1, rel("email"), None, None))
        for seq in range(1, n):
            kind = draw.choices("BCIUDRT", (3, 3, 6, 4, 2, 1, 1))[0]
            row = [slot, seq, 1000 + seq, kind, None, None, None, None, None, None, None]
            if kind in "BC":
                row[5:7] = [5000 + seq, AT]
                if kind == "B":
                    row[4] = seq
            elif kind == "R":
                row[7:9] = [1, rel(f"email{seq}")]
            elif kind in "IUD":
                row[7] = draw.choice((1, 1, 1, 9))
                tuple_ = [("t", str(draw.randrange(9))), draw.choice((("t", "x" * draw.randrange(40)), ("n", None), ("u", None)))]
                row[9 if kind == "D" else 10] = tuple_
            rows.append(tuple(row))
    return rows


def expected(rows, most):
    """What a loop over the messages of each slot gives."""
    out = []
    for slot in {r[0] for r in rows}:
        state, relations = None, {}
        for _, seq, start, kind, xid, at, _, rel_id, relation, old, new in sorted(r for r in rows if r[0] == slot):
            if kind == "R":
                relations[rel_id] = relation
            elif kind == "B":
                state = (xid, [])
            elif kind == "C" and state:
                if sum(e[1] for e in state[1]) <= most:
                    out += [(slot, state[0], k, e[0], e[2], at) for k, e in enumerate(state[1], 1)]
                state = None
            elif kind in "IUD" and state:
                r, size = relations.get(rel_id), 64
                for k, (what, text) in enumerate((old or []) + (new or [])):
                    size += 32 + (len(f"col_{k}") if r is None else len(r[2][k][0]) + (len(text) if what == "t" else 0))
                state[1].append((seq, size, {"I": "c", "U": "u", "D": "d"}[kind]))
    return sorted(out)


def found(events):
    return sorted((r.slot, r.xid, r.ordinal, r.seq, r.op, r.commit_lsn) for r in events.select("slot", "xid", "ordinal", "seq", "op", "commit_lsn").collect())


@pytest.mark.parametrize("seed", (1, 2))
def test_assembly(spark, seed):
    rows = random_log(seed)
    assert found(assemble.assemble(spark.createDataFrame(rows, MESSAGE), 400).events) == expected(rows, 400)


def test_streaming_assembly_over_restarts(spark, tmp_path):
    rows = random_log(3)
    logs, n = tmp_path / "log", 0
    for at in range(0, 120, 31):  # transactions span batches and restarts
        part = [r for r in rows if at <= r[1] < at + 31]
        spark.createDataFrame(part, MESSAGE).coalesce(1).write.parquet(str(logs / f"{at:03d}"))
        stream = spark.readStream.schema(MESSAGE).option("recursiveFileLookup", "true").parquet(str(logs))
        query = stream_events(stream, 400).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination(120)
        n += 1
    got = spark.read.parquet(str(tmp_path / "out"))
    assert n > 2
    assert found(got) == expected(rows, 400)
    batch = assemble.assemble(spark.createDataFrame(rows, MESSAGE), 400).events
    same = ["slot", "seq", "before", "after", "event_lsn", "bytes"]
    assert sorted(map(str, got.select(*same).collect())) == sorted(map(str, batch.select(*same).collect()))


def test_pipeline_to_files_and_mirror(spark, tmp_path):
    put = lambda seq, kind, new=None, old=None: ("s", seq, seq, kind, None, None, None, 1, None, old, new)
    t = lambda *x: [("t", v) for v in x]
    rows = [("s", 0, 0, "R", None, None, None, 1, rel("email"), None, None), ("s", 1, 1, "B", 7, 90, AT, None, None, None, None), put(2, "I", t("1", "a@x")), put(3, "I", t("2", "b@x")), put(4, "I", t("3", "c@x")), ("s", 5, 5, "C", None, 90, AT, None, None, None, None)]
    rows += [("s", 6, 6, "B", 8, 95, AT, None, None, None, None), put(7, "U", t("2", "b2@x")), put(8, "D", None, t("3", "c@x")), ("s", 9, 9, "C", None, 95, AT, None, None, None, None)]
    spark.createDataFrame(rows, MESSAGE).coalesce(1).write.parquet(str(tmp_path / "log"))
    sink, store = FileSink(str(tmp_path / "out")), progress.FileProgress(str(tmp_path / "progress.json"))
    out = envelope.Output(database="shop", markers=True)
    query = run(spark.readStream.schema(MESSAGE).parquet(str(tmp_path / "log")), sink, str(tmp_path / "cp"), out, progress.Manager(store), once=True)
    assert query.awaitTermination(120)
    assert store.load()[0] == 95
    records = sink.read(spark)
    ops = [json.loads(r.value)["op"] for r in records.collect()]
    assert sorted(ops) == sorted(["begin", "c", "c", "c", "commit", "begin", "u", "d", "commit"])
    first = json.loads(records.where("key is not null").orderBy("commit_lsn", "ordinal").first().value)
    assert tuple(first) == ENVELOPE
    assert first["after"] == {"id": "1", "email": "a@x"} and first["before"] is None and first["lsn"] == "0/2" and first["commit_ts"] == "2026-03-17T15:00:00Z"
    changes = mirror.from_records(records, {"id": "int", "email": "string"}, ["id"])
    latest = mirror.latest(changes, ["id"], ["ver", "lsn"], F.col("op") == "d")
    assert sorted((r.id, r.email) for r in latest.collect()) == [(1, "a@x"), (2, "b2@x")]


def test_capture(spark, tmp_path):
    """Frames of the replication protocol, as a batch source."""
    text = lambda s: s.encode() + b"\0"
    cell = lambda s: b"t" + struct.pack(">I", len(s)) + s.encode()
    messages = [
        b"R" + struct.pack(">I", 1) + text("public") + text("users") + b"d" + struct.pack(">H", 2) + b"\1" + text("id") + struct.pack(">Ii", 25, -1) + b"\0" + text("email") + struct.pack(">Ii", 25, -1),
        b"B" + struct.pack(">QqI", 90, 0, 7), b"I" + struct.pack(">I", 1) + b"N" + struct.pack(">H", 2) + cell("1") + b"n",
        b"U" + struct.pack(">I", 1) + b"K" + struct.pack(">H", 1) + cell("1") + b"N" + struct.pack(">H", 2) + cell("2") + b"u", b"C" + struct.pack(">BQQq", 0, 90, 95, 0), b"M?",
    ]
    with open(tmp_path / "a.wal", "wb") as f:
        for k, m in enumerate(messages):
            payload = b"w" + struct.pack(">QQq", 10 * k, 10 * k, 0) + m
            f.write(struct.pack(">I", len(payload)) + payload)
        f.write(struct.pack(">I", 18) + b"k" + struct.pack(">Qqb", 1, 0, 0) + struct.pack(">I", 99) + b"w")
    register(spark)
    rows = spark.read.format("wal_capture").load(str(tmp_path))
    assert [r.msg for r in rows.orderBy("seq").collect()] == list("RBIUC")
    assert [r.msg for r in rows.where("wal_start >= 30").orderBy("seq").collect()] == list("UC")
    events = assemble.assemble(rows).events.orderBy("ordinal").collect()
    assert [(e.op, e.xid, [v.kind for v in e.after]) for e in events] == [("c", 7, ["t", "n"]), ("u", 7, ["t", "u"])]
    out = envelope.envelopes(assemble.assemble(rows).events).orderBy("ordinal").collect()
    assert out[1].key == {"id": "2"} and out[1].before == {"id": "1"} and out[1].after == {"id": "2"} and out[0].after == {"id": "1", "email": None}


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(("parts", "text"), [((0, 0, 0), "PT0S"), ((14, 3, 0), "P1Y2M3D"), ((0, 7, 0), "P7D"), ((0, 0, 14706000000), "PT4H5M6S"), ((0, 0, 6789000), "PT6.789S"), ((0, 0, -3600000000), "PT-1H"), ((14, 3, 14706789000), "P1Y2M3DT4H5M6.789S"), ((None, 0, 0), None)])
def test_intervals(spark, parts, text):
    assert one(spark, pgtypes.interval_text(*[F.lit(p).cast("bigint") for p in parts])) == text


def test_values(spark):
    assert one(spark, pgtypes.bits_text(F.lit(b"\xff\x00"), F.lit(12))) == "111111110000"
    ends = lambda *x: pgtypes.range_text(*[F.lit(v) for v in x])
    assert one(spark, ends("1", "10", "i", "e", False)) == "[1,10)"
    assert one(spark, ends(None, "5", "u", "e", False)) == "(,5)"
    assert one(spark, ends(None, None, None, None, True)) == "empty"
    assert one(spark, lsn.lsn_text(F.lit(0x16B6A30).cast("bigint"))) == "0/16B6A30"
    assert one(spark, lsn.lsn_number(F.lit("1/0"))) == 1 << 32
    assert one(spark, names.topic(F.lit("app"), F.lit("public"), F.lit("users"))) == "cdc.app.public.users"
    assert one(spark, cells.key_string(F.create_map(F.lit("b"), F.lit("2"), F.lit("a"), F.lit("1")))) == 'a="1"|b="2"'


def test_progress(spark, tmp_path):
    acks = spark.createDataFrame([("s", k, 10 * k, k != 3) for k in range(1, 6)], "slot string, ord int, lsn int, acked boolean")
    assert [tuple(r) for r in progress.contiguous(acks).collect()] == [("s", 20, 2)]
    store = progress.FileProgress(str(tmp_path / "p.json"))
    manager = progress.Manager(store)
    assert not manager.flush()
    for x in (0x100, 0x300, 0x200):
        manager.confirm(x)
    assert manager.flush() and store.load()[0] == 0x300 and not manager.flush()
    assert os.listdir(tmp_path) == ["p.json"]


def test_settings():
    got = config.load({"postgres": {"user": "u"}, "topic": {"prefix": "x"}}, {"CDC_TOPIC__PREFIX": "y", "CDC_REDPANDA__BROKERS": "a:1, b:2", "CDC_REPLICATION__TRANSACTION_MARKERS": "true"})
    assert got.topic.prefix == "y" and got.redpanda.brokers == ["a:1", "b:2"] and got.output().markers
    assert config.Source(host="h", dbname="d").jdbc_url() == "jdbc:postgresql://h:5432/d"
    with pytest.raises(ValueError, match="user.*mode.*positive"):
        config.load({"topic": {"mode": "odd"}, "tuning": {"producer_batch_max_records": 0}}, {})


def test_names_are_sorted_without_a_comparator(spark):
    """Columns of an image are put in order by Spark's own comparison: an expression for each pair of names costs the most of all."""
    from changeloom.functions import cells

    values = "array<struct<name:string,kind:string,text:string>>"
    rows = spark.createDataFrame([([("b", "t", "1"), ("a", "t", "2"), ("b", "t", "3")],), ([],), (None,)], f"v {values}").select(cells.image(F.col("v")).alias("m"))
    assert "array_sort" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert [r.m and list(r.m.items()) for r in rows.collect()] == [[("a", "2"), ("b", "3")], None, None]
