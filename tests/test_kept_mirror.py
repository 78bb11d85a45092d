"""The kept mirror against a plain dictionary, over batches, repeats, compactions, crashes and readers of old versions."""

import random

import pytest
from pyspark.sql import functions as F

from changeloom.operators.commits import Conflict, Folder
from changeloom.operators.envelope import Output, change_records, envelopes
from changeloom.operators.kept_mirror import KeptMirror
from changeloom.sinks import MirrorSink
from changeloom.sources import snapshot

SCHEMA = "id long, part string, ver long, lsn long, op string, name string"
GONE = "op = 'd'"


def kept(spark, tmp_path, **more):
    return KeptMirror(spark, str(tmp_path / "mirror"), ["id", "part"], ["ver", "lsn"], "lsn", **{"buckets": 4} | more)


def held(rows):
    newest = {}
    for r in rows:
        if (r[0], r[1]) not in newest or r[2:4] > newest[r[0], r[1]][2:4]:
            newest[r[0], r[1]] = r
    return {k: r[5] for k, r in newest.items() if r[4] != "d"}


def there(mirror, **how):
    rows = mirror.read(**how).collect()
    found = {(r.id, r.part): r.name for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("most", (0, 10**6))
def test_batches_repeats_and_compactions(spark, tmp_path, most):
    draw = random.Random(most)
    rows = [(draw.choice((None, *range(25))), draw.choice((None, "a", "b")), k // 4, k, draw.choice("cuudr"), f"n{k}") for k in range(900)]
    mirror, batches = kept(spark, tmp_path, max_broadcast_rows=most), [rows[k : k + 100] for k in range(0, 900, 100)]
    table = lambda part: spark.createDataFrame(part, SCHEMA)
    for k, part in enumerate(batches):
        assert mirror.apply(table(part), k, GONE)
        assert there(mirror) == held(rows[: 100 * (k + 1)])
        if k == 2:
            mirror.compact(whole=False)
        if k in (4, 6):
            mirror.compact(frontier=None if k == 4 else 699)
            assert there(mirror) == held(rows[: 100 * (k + 1)])
    assert not mirror.apply(table(batches[3]), 3, GONE)  # a late repeat under its number
    assert mirror.apply(table(batches[1] + batches[6]), "again", GONE)  # and under another one
    assert there(mirror) == held(rows)
    some = [(3, "a"), (None, None), (None, "b"), (99, "a")]
    got = {(r.id, r.part): r.name for r in mirror.lookup(spark.createDataFrame(some, "id long, part string")).collect()}
    assert got == {k: v for k, v in held(rows).items() if k in some}
    last = mirror.history().orderBy(F.desc("version")).first()
    assert (last.batches, last.frontier, last.deltas) == (10, 699, 2)


def test_tombstones_outlive_what_they_delete(spark, tmp_path):
    rows = [(1, "a", 1, 1, "c", "x"), (1, "a", 2, 2, "d", None), (2, "a", 1, 3, "c", "y")]
    for frontier in (None, 3):
        mirror = kept(spark, tmp_path / str(frontier))
        mirror.apply(spark.createDataFrame(rows, SCHEMA), 0, GONE)
        mirror.compact(frontier=frontier)
        base = mirror.commits.load()[1]["base"]
        assert base["rows"] == (2 if frontier is None else 1)
        mirror.apply(spark.createDataFrame(rows[:1], SCHEMA), 1, GONE)  # repeats what came before the deletion
        assert there(mirror) == {(2, "a"): "y"}


def test_a_crash_before_the_commit_shows_nothing(spark, tmp_path, monkeypatch):
    mirror = kept(spark, tmp_path)
    with pytest.raises(ValueError):
        mirror.read()
    mirror.apply(spark.createDataFrame([(1, "a", 1, 1, "c", "x")], SCHEMA), 0, GONE)
    later = spark.createDataFrame([(1, "a", 2, 2, "u", "new"), (5, "a", 2, 3, "c", "y")], SCHEMA)
    commit = mirror.commits.commit
    monkeypatch.setattr(mirror.commits, "commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    for job in (lambda: mirror.apply(later, 1, GONE), mirror.compact):
        with pytest.raises(OSError):
            job()
        assert there(mirror) == {(1, "a"): "x"}
    monkeypatch.setattr(mirror.commits, "commit", commit)
    assert mirror.apply(later, 1, GONE) and there(mirror) == {(1, "a"): "new", (5, "a"): "y"}
    gone = mirror.vacuum(keep=2)
    assert len(gone) == 2 and there(mirror, version=1) == {(1, "a"): "x"} and there(mirror) == {(1, "a"): "new", (5, "a"): "y"}
    mirror.compact()
    mirror.vacuum()
    assert there(mirror) == {(1, "a"): "new", (5, "a"): "y"} and mirror.commits.versions() == [3]


def test_two_writers_conflict(spark, tmp_path):
    one, two = kept(spark, tmp_path), kept(spark, tmp_path)
    rows = spark.createDataFrame([(1, "a", 1, 1, "c", "x")], SCHEMA)
    version, state = two.commits.load()
    one.apply(rows, 0, GONE)
    with pytest.raises(Conflict):
        two.commits.commit(version + 1, state)
    folder = Folder(spark, str(tmp_path / "mirror"))
    folder.put("note", "a")
    folder.put("note", "é", replace=True)
    assert folder.read("note") == "é" and folder.read("none") is None and folder.names("nowhere") == []


def test_columns_that_come_later_and_empty_batches(spark, tmp_path):
    mirror = kept(spark, tmp_path)
    mirror.apply(spark.createDataFrame([], SCHEMA), 0, GONE)
    mirror.apply(spark.createDataFrame([(1, "a", 1, 1, "c", "x", 7)], SCHEMA + ", `odd.name` int"), 2, GONE)
    mirror.apply(spark.createDataFrame([(2, "a", 1, 2, "c", "y")], SCHEMA), 1, GONE)
    assert sorted((r.id, r["odd.name"]) for r in mirror.read().collect()) == [(1, 7), (2, None)]
    assert mirror.commits.load()[1]["done"] == 3 and mirror.commits.load()[1]["batches"] == []
    mirror.compact()
    assert mirror.compact() == mirror.commits.load()[0]
    mirror.apply(spark.createDataFrame([(None, None, 1, 5, "d", None)], SCHEMA), 3, GONE)
    assert there(mirror) == {(1, "a"): "x", (2, "a"): "y"}


def test_records_reach_the_mirror(spark, tmp_path):
    """Snapshot records and later changes through a sink; a batch that is tried again is there once."""
    out = Output(database="shop")
    rows = snapshot.snapshot(spark.createDataFrame([(1, "x"), (2, "y")], "id long, name string"), "users", ["id"])
    records = change_records(envelopes(rows, out))
    mirror = KeptMirror(spark, str(tmp_path / "users"), ["id"], ["ver", "lsn"])
    sink = MirrorSink(mirror, "cdc.shop.public.users", {"id": "bigint", "name": "string"})
    sink.write(records)
    change = '{"op":"%s","txid":%d,"lsn":"0/%X","before":{"id":"1"},"after":{"id":"%d","name":%s}}'
    later = [("cdc.shop.public.users", "k", change % ("u", 5, 20, 2, '"z"')), ("cdc.shop.public.users", "k", change % ("d", 6, 30, 9, "null")), ("other", "k", change % ("c", 7, 40, 8, '"o"')), ("cdc.shop.public.users", None, "{broken")]
    for _ in range(2):
        sink.write(spark.createDataFrame(later, "topic string, key string, value string"), 0)
    assert [(r.id, r.name) for r in mirror.read().orderBy("id").collect()] == [(2, "z")]
