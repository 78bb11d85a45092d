"""Initial snapshots of several tables at once, as Spark jobs side by side of which the first error cancels the others."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from changeloom.operators.envelope import Output, change_records, envelopes
from changeloom.operators.metrics import SNAPSHOT_SECONDS_BUCKETS, Registry
from changeloom.sinks import Sink
from changeloom.sources import snapshot

Tables = Mapping[str, tuple[DataFrame, Sequence[str]]]


class Taken(NamedTuple):
    """A table, how many rows of it are in the sink, and how long that took."""

    table: str
    rows: int
    seconds: float


def planned(names: Sequence[str], catalog: DataFrame, indexes: DataFrame, attributes: DataFrame, read: Callable[[str], DataFrame]) -> tuple[dict[str, tuple[DataFrame, Sequence[str]]], list[str]]:
    """What a database's catalog says of the tables that are wanted: those that are there, to be read by `read`, each with
    its primary key in the order of its index (none where it has none), and the names that are skipped."""
    wanted = catalog.sparkSession.createDataFrame([(n,) for n in names], "name string")
    there, gone = snapshot.existing(wanted, catalog)
    keyed = there.join(snapshot.primary_keys(indexes, attributes), ["schema", "table"], "left")
    keys = {r["name"]: list(r["pk"] or ()) for r in keyed.select("name", "pk").collect()}  # as many as names
    return {n: (read(n), keys[n]) for n in names if n in keys}, [r["name"] for r in gone.select("name").distinct().collect()]


def take(tables: Tables, sink: Sink, out: Output, as_of: datetime | None = None, most: int = 1, metrics: Registry | None = None) -> list[Taken]:
    """Writes the rows of tables (name -> rows, key columns) as records, up to `most` tables at a time.

    Each table is a job group of its own and a part of its own of the sink. The first error cancels the jobs of the others
    and is raised when they have ended; tables that haven't begun stay out. What had been committed before stays.
    """
    typed, stop, first = out.typed != "none", threading.Event(), []
    lock, groups = threading.Lock(), {n: f"snapshot-{n}-{uuid.uuid4().hex}" for n in tables}

    def one(name: str) -> Taken | None:
        rows, pk = tables[name]
        context = rows.sparkSession.sparkContext
        if stop.is_set():
            return None
        context.setJobGroup(groups[name], f"snapshot of {name}", True)
        began, seen = time.monotonic(), Observation()
        try:
            events = snapshot.snapshot(rows.observe(seen, F.count(F.lit(1)).alias("n")), name, pk, as_of, typed)
            sink.write(change_records(envelopes(events, out)), None, "" if len(tables) == 1 else f"snapshot-{name}")
        except Exception as e:
            with lock:
                if not stop.is_set():
                    first.append(e)
                stop.set()
            for other, group in groups.items():
                if other != name:
                    context.cancelJobGroup(group)
            return None
        return Taken(name, seen.get["n"], time.monotonic() - began)

    with ThreadPoolExecutor(max(1, most)) as pool:
        taken = [t for t in pool.map(one, tables) if t is not None]
    if metrics is not None:
        for t in taken:
            metrics.add("snapshot_rows_total", t.rows, table=t.table)
            metrics.observe("snapshot_duration_seconds", t.seconds, SNAPSHOT_SECONDS_BUCKETS)
    if first:
        raise first[0]
    return taken
