"""Capture files: indexes, parts within files, bounded streams over restarts, growing and removed files."""

import os
import random
import struct

import pytest

from changeloom.operators import metrics
from changeloom.sources import frames
from changeloom.sources.pgoutput import Capture, CaptureReader, CaptureStream, register
from tests.test_running import RELATION, transaction


def framed(at, message):
    payload = b"w" + struct.pack(">QQq", at, at, 0) + message
    return struct.pack(">I", len(payload)) + payload


KEEPALIVE = struct.pack(">I", 18) + b"k" + struct.pack(">Qqb", 1, 0, 0)


def log(n, first=0):
    """n transactions of one change each, with keepalives between: bytes of each frame."""
    out = [framed(0, RELATION)] if first == 0 else []
    for k in range(first, first + n):
        out += [framed(1000 * k + 100 * j, m) for j, m in enumerate(transaction(k + 1, str(k)))]
        if k % 3 == 0:
            out.append(KEEPALIVE)
    return out


def rows_of(reader, parts):
    return [r for p in parts for r in reader.read(p)]


@pytest.fixture
def folder(tmp_path):
    for name, first in (("a", 0), ("b", 40), ("c", 80)):
        (tmp_path / f"{name}.wal").write_bytes(b"".join(log(40, first)) + (framed(1, b"I")[:9] if name == "c" else b""))
    return tmp_path


def test_parts_make_up_files(folder, spark):
    """With and without an index, undivided or in parts, from any place: the same messages under the same numbers."""
    options = {"path": str(folder), "slot": "s"}
    whole = rows_of(Capture(options), CaptureReader(options).partitions())
    assert len(whole) == 361 and [r[1] for r in whole] == sorted(r[1] for r in whole)
    for every in (None, 7, 1000):
        if every:
            for f in folder.glob("*.idx"):
                f.unlink()
            assert frames.index_captures(spark, str(folder), every) == 3
            assert frames.index_captures(spark, str(folder), every) == 1  # c ends within a frame, so it may have grown
        for per_task in (1, 10, 50):
            parts = CaptureReader(options | {"framesPerTask": str(per_task)}).partitions()
            assert rows_of(Capture(options), parts) == whole
            assert len(parts) > 3 or per_task == 50 and every == 1000 or every == 1000
    system, path = frames.place(str(folder / "a.wal"))
    size = os.path.getsize(folder / "a.wal")
    every_place = [frames.Place(0, 0, 0)]
    for n in range(1, 140):
        got = frames.advanced(system, path, size, frames.Place(0, 0, 0), n)
        assert got == frames.advanced(system, path, size, every_place[-1], 1) and got.frame == min(n, 135)
        every_place.append(got)
    assert every_place[-1].at == size and every_place[-1].lsn == 39_200 + len(transaction(1, "0")[2])


def test_blocks_below_a_position_are_not_read(folder, spark):
    options = {"path": str(folder), "slot": "s", "startingLsn": "95000"}
    want = rows_of(Capture(options), CaptureReader(options).partitions())
    frames.index_captures(spark, str(folder), 10)
    reader = CaptureReader(options)
    parts = reader.partitions()
    # the first block of the first file has the relation; the second file isn't opened at all
    assert rows_of(reader, parts) == want and {os.path.basename(p.path) for p in parts} == {"a.wal", "c.wal"}
    assert sum(p.piece.end - p.piece.begin for p in parts) < 0.4 * sum(f.stat().st_size for f in folder.glob("*.wal"))
    assert [r[3] for r in want][0] == "R" and min(r[2] for r in want[1:]) == 95_000
    from pyspark.sql.datasource import GreaterThanOrEqual

    pushed = CaptureReader({"path": str(folder)})
    list(pushed.pushFilters([GreaterThanOrEqual(("wal_start",), 95_000)]))
    assert len(pushed.partitions()) == len(parts)
    register(spark)
    got = spark.read.format("wal_capture").load(str(folder)).where("wal_start >= 95000")
    assert sorted(r.wal_start for r in got.collect()) == sorted(r[2] for r in want if r[2] >= 95_000)


def stream(spark, folder, tmp_path, seen, progress, **options):
    """Reads all there is, trigger by trigger; seen gets (batch, tasks, numbers and positions)."""
    register(spark)

    def take(batch, number):
        rows = batch.select("seq", "wal_start", "msg").collect()
        seen.append((number, batch.rdd.getNumPartitions(), [(r.seq, r.msg) for r in rows]))

    read = spark.readStream.format("wal_capture").options(**{k: str(v) for k, v in options.items()}).load(str(folder))
    query = read.writeStream.foreachBatch(take).option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        query.processAllAvailable()
        progress += query.recentProgress
    finally:
        query.stop()


def test_bounded_triggers_over_restarts(folder, spark, tmp_path):
    """Triggers of 50 frames over files of 135, a restart in the middle of a file, files that go and files that grow."""
    source, logs = folder, tmp_path / "logs"
    logs.mkdir()
    whole = rows_of(Capture({"path": str(source), "slot": "s"}), CaptureReader({"path": str(source), "slot": "s"}).partitions())
    options, seen, progress = {"maxFramesPerTrigger": 50, "framesPerTask": 20, "positions": str(tmp_path / "pos")}, [], []
    (logs / "a.wal").write_bytes((source / "a.wal").read_bytes()[:3000])  # ends within a frame
    stream(spark, logs, tmp_path, seen, progress, **options)
    taken = sum(len(rows) for _, _, rows in seen)
    assert 0 < taken < 121 and all(tasks > 1 for _, tasks, rows in seen if len(rows) > 30)
    for name in "abc":
        (logs / f"{name}.wal").write_bytes((source / f"{name}.wal").read_bytes())
    stream(spark, logs, tmp_path, seen, progress, **options)
    assert [x for _, _, rows in seen for x in sorted(rows)] == [(r[1], r[3]) for r in whole]
    assert len(seen) >= 8 and max(len(rows) for _, _, rows in seen) <= 50
    depths = [metrics.queue_depth(p) for p in progress if p["numInputRows"]]
    assert max(depths) == 3 and depths[-1] == 1  # the last file ends within a frame
    assert metrics.last_read_lsn(progress[-1]) == 119_200 + len(transaction(1, "0")[2])
    (logs / "a.wal").unlink()
    (logs / "b.wal").unlink()
    (logs / "d.wal").write_bytes(b"".join(log(5, 120)))
    before = len(seen)
    stream(spark, logs, tmp_path, seen, progress, **options)
    assert [m for _, _, rows in seen[before:] for _, m in sorted(rows)] == list("BIC") * 5
    assert min(s for _, _, rows in seen[before:] for s, _ in rows) >> 32 == 3
    (logs / "b.wal").write_bytes(b"".join(log(1, 200)))
    with pytest.raises(Exception, match="came late"):
        stream(spark, logs, tmp_path, seen, progress, **options)


def test_a_random_walk_of_offsets(folder, tmp_path):
    """Readers that begin anew at any time, as Spark does it, give out every message once and in order."""
    draw = random.Random(4)
    options = {"path": str(folder), "slot": "s", "maxFramesPerTrigger": "23", "positions": str(tmp_path / "notes")}
    whole = rows_of(Capture(options), CaptureReader(options).partitions())
    reader, got = CaptureStream(options), []
    start = reader.initialOffset()
    for _ in range(200):
        end = reader.latestOffset()
        if (end["file"], end["at"]) == (start["file"], start["at"]):
            break
        parts = reader.partitions(start, end)
        if draw.random() < 0.3:  # lost after the plan: the same batch once more
            reader = CaptureStream(options)
            parts = reader.partitions(start, end)
        got += rows_of(reader, parts)
        start = end
        if draw.random() < 0.3:
            reader = CaptureStream(options)
    assert got == whole
    with pytest.raises(ValueError, match="positions"):
        CaptureStream({"path": str(folder), "maxFramesPerTrigger": "5"})
