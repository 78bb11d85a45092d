"""Durable progress: how far every change has been acknowledged, and where that is kept."""

from __future__ import annotations

import json
import os
import tempfile
import time
from collections.abc import Sequence
from datetime import datetime, timezone
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeloom.operators.commits import Folder
from changeloom.operators.scale import joined, running_sum


def contiguous(acks: DataFrame, by: Sequence[str] = ("slot",), order: str = "ord", acked: str = "acked", lsn: str = "lsn") -> DataFrame:
    """For each of by, the position up to which all batches are acknowledged: by, lsn, n (batches up to there). A
    batch that isn't acknowledged, or never will be, stops it; nothing acknowledged from the start gives no row."""
    open_at = acks.where(~F.coalesce(F.col(acked), F.lit(False))).groupBy(*by).agg(F.min(order).alias("_stop"))
    rows = joined(acks, open_at, by, "left").where(F.col("_stop").isNull() | (F.col(order) < F.col("_stop")))
    return rows.groupBy(*by).agg(F.max(lsn).alias("lsn"), F.count("*").alias("n"))


def confirmed(confirms: DataFrame, by: Sequence[str], order: str, lsn: str = "lsn", width: int = 100_000) -> DataFrame:
    """confirms with pending, the highest position so far, and moved, whether the row raised it."""
    rows = confirms.withColumn("_stretch", F.floor(F.col(order) / width))
    keys = [*by, "_stretch"]
    tops = rows.groupBy(*keys).agg(F.max(lsn).alias("_top"))
    tops = tops.select(*keys, F.max("_top").over(Window.partitionBy(*by).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    inner = Window.partitionBy(*keys).orderBy(order)
    before = F.greatest(F.max(lsn).over(inner.rowsBetween(Window.unboundedPreceding, -1)), F.col("_before"))
    rows = joined(rows, tops, keys).withColumn("_prior", before)
    return rows.withColumn("pending", F.greatest("_prior", lsn)).withColumn("moved", F.col("_prior").isNull() | (F.col(lsn) > F.col("_prior"))).drop("_stretch", "_before", "_prior")


def to_flush(pending: DataFrame) -> DataFrame:
    """Rows (pending, flushed) whose pending position is beyond the flushed one."""
    return pending.where(F.col("pending") > F.coalesce(F.col("flushed"), F.lit(0)))


def standby_status(last_read: Column, confirmed_lsn: Column) -> Column:
    """What a reader reports: written up to last_read, flushed and applied up to what is confirmed, if anything is."""
    done = F.coalesce(F.nullif(confirmed_lsn, F.lit(0)), last_read)
    return F.struct(last_read.alias("write"), done.alias("flush"), done.alias("apply"))


def in_flight(log: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """log (event: start or done) with in_flight, batches begun and not yet done at each row."""
    return running_sum(log, F.when(F.col("event") == "start", 1).otherwise(-1), "in_flight", by, order)


def frontier(transactions: DataFrame, acks: DataFrame) -> DataFrame:
    """How far each slot's log is done with: slot, lsn, n (transactions up to there), open (transactions after it).

    transactions are those of assemble(); acks (slot, tx_no, acked) has those whose publication has ended, well or not.
    One without events, or too large to be published, needs no acknowledgement; any other that has none, or a
    failed one, stops its slot. Slots don't wait for each other. A slot whose first transaction is open has lsn 0.
    """
    known = joined(transactions, acks.groupBy("slot", "tx_no").agg(F.bool_and("acked").alias("acked")), ["slot", "tx_no"], "left")
    done = (F.col("n_events") == 0) | F.col("oversized") | F.coalesce(F.col("acked"), F.lit(False))
    first = known.where(~done).groupBy("slot").agg(F.min("tx_no").alias("_stop"))
    rows = joined(known, first, ["slot"], "left")
    before = F.col("_stop").isNull() | (F.col("tx_no") < F.col("_stop"))
    return rows.groupBy("slot").agg(F.coalesce(F.max(F.when(before, F.col("commit_lsn"))), F.lit(0)).alias("lsn"), F.count_if(before).alias("n"), F.count_if(~before).alias("open"))


Slots = dict[str, int]


class ProgressStore(Protocol):
    def load(self) -> tuple[int, str | None]: ...
    def slots(self) -> Slots: ...
    def save(self, slots: Slots, timestamp: str | None = None) -> None: ...


def least(slots: Slots) -> int:
    """What all slots have reached."""
    return min(slots.values(), default=0)


class JsonProgress:
    """Progress as JSON: lsn, which all slots have reached, timestamp, and slots with the position of each."""

    def text(self) -> str | None:
        raise NotImplementedError

    def got(self) -> dict:
        return json.loads(self.text() or "{}")

    def load(self) -> tuple[int, str | None]:
        got = self.got()
        return int(got.get("lsn", 0)), got.get("timestamp")

    def slots(self) -> Slots:
        got = self.got()
        return {k: int(v) for k, v in got.get("slots", {"": got["lsn"]} if got.get("lsn") else {}).items()}

    @staticmethod
    def made(slots: Slots, timestamp: str | None) -> str:
        return json.dumps({"lsn": least(slots), "timestamp": timestamp or datetime.now(timezone.utc).isoformat(), "slots": slots}, sort_keys=True)


class FileProgress(JsonProgress):
    """A file of this machine, replaced whole. A missing file is position 0."""

    def __init__(self, path: str):
        self.path = path

    def text(self) -> str | None:
        try:
            with open(self.path, encoding="utf-8") as f:
                return f.read()
        except FileNotFoundError:
            return None

    def save(self, slots: Slots, timestamp: str | None = None) -> None:
        folder = os.path.dirname(os.path.abspath(self.path))
        os.makedirs(folder, exist_ok=True)
        with tempfile.NamedTemporaryFile("w", dir=folder, delete=False, encoding="utf-8") as f:
            f.write(self.made(slots, timestamp))
            f.flush()
            os.fsync(f.fileno())
        os.replace(f.name, self.path)


class SharedProgress(JsonProgress):
    """A file of any file system that Spark reaches, replaced whole, so another driver goes on from it."""

    def __init__(self, spark: SparkSession, path: str):
        folder, _, self.name = path.rpartition("/")
        self.folder = Folder(spark, folder or ".")

    def text(self) -> str | None:
        return self.folder.read(self.name)

    def save(self, slots: Slots, timestamp: str | None = None) -> None:
        self.folder.put(self.name, self.made(slots, timestamp), replace=True)


class Manager:
    """Confirmed positions of each slot only rise, and only a rise is flushed, at most each `every` seconds unless forced."""

    def __init__(self, store: ProgressStore, every: float = 0.0):
        self.store, self.every, self.last = store, every, float("-inf")
        self.saved: Slots = store.slots()
        self.pending: Slots = dict(self.saved)

    @property
    def flushed(self) -> int:
        return least(self.saved)

    def confirm(self, lsn: int, slot: str = "") -> None:
        if slot and "" in self.pending:  # progress from before slots had names
            self.pending[slot] = self.pending.pop("")
        self.pending[slot] = max(self.pending.get(slot, 0), lsn)

    def flush(self, force: bool = False) -> bool:
        if self.pending == self.saved or not force and time.monotonic() - self.last < self.every:
            return False
        self.store.save(self.pending)
        self.saved, self.last = dict(self.pending), time.monotonic()
        return True
