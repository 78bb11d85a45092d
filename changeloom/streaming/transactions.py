"""Transactions from a stream of messages: the state machine of assemble(), kept for each slot between batches."""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from changeloom.functions.cells import decoded
from changeloom.model import CELL, CHANGE_MESSAGES, RELATION

#: The state store that such processors need.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
EVENT = "slot string, seq bigint, tx_no bigint, xid bigint, op string, rel_id bigint, rel string, before string, after string, event_lsn bigint, commit_us bigint, commit_lsn bigint, ordinal int, bytes bigint, outside boolean, commit boolean"


def cells_bytes(cells: str | None, columns: list[dict[str, Any]] | None) -> int:
    """What a tuple counts for: bytes of names and values, and 32 for each cell, as functions.cells.tuple_bytes()."""
    total = 0
    for k, cell in enumerate(json.loads(cells) if cells else []):
        name = f"col_{k}" if columns is None else columns[k]["name"] if k < len(columns) else ""
        text = cell.get("text") if columns is not None and cell["kind"] not in "nu" else None
        total += len(name.encode()) + len((text or "").encode()) + 32
    return total


class Assembler(StatefulProcessor):
    """Per slot: the open transaction, its changes so far, and the newest version of each relation. A begin discards
    what is open, a commit emits it, a transaction beyond max_tx_bytes is dropped. Each commit that ends a transaction comes
    out as a row of its own, also of one that is empty or dropped: with the sum of its bytes, and ordinal -1 if it was
    dropped, else the number of its changes. Changes outside of one come out at once, marked as such and without a
    transaction's fields."""

    def __init__(self, max_tx_bytes: int):
        self.most = max_tx_bytes

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", "tx_no bigint, xid bigint, commit_us bigint, n int, bytes bigint, inside boolean")
        self.changes = handle.getListState("changes", "seq bigint, op string, rel_id bigint, rel string, before string, after string, event_lsn bigint, bytes bigint")
        self.relations = handle.getMapState("relations", "rel_id bigint", "rel string")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        parts = [p for p in rows if len(p)]
        if not parts:
            return
        batch = pd.concat(parts).sort_values("seq", kind="stable")
        tx_no, xid, commit_us, n, size, inside = self.open.get() if self.open.exists() else (0, 0, 0, 0, 0, False)
        held: list[tuple] = []  # of the open transaction, not yet in the state
        out: list[tuple] = []
        known: dict[int, tuple[str | None, list | None]] = {}  # relations as this batch has seen them last

        def relation(rel_id: int) -> tuple[str | None, list | None]:
            if rel_id not in known:
                rel = self.relations.getValue((rel_id,))[0] if self.relations.containsKey((rel_id,)) else None
                known[rel_id] = (rel, json.loads(rel)["columns"] if rel else None)
            return known[rel_id]

        for m in batch.itertuples(index=False):
            if m.msg == "R":
                self.relations.updateValue((int(m.rel_id),), (m.rel,))
                known.pop(int(m.rel_id), None)
            elif m.msg == "B":
                self.changes.clear()
                held, tx_no, xid, commit_us, n, size, inside = [], tx_no + 1, int(m.xid), int(m.commit_us), 0, 0, True
            elif m.msg == "C" and inside:
                fits = self.most <= 0 or size <= self.most
                if fits:
                    before = [tuple(c) for c in self.changes.get()] if n > len(held) else []
                    for k, (seq, op, rel_id, rel, old, new, lsn, bytes_) in enumerate([*before, *held], 1):
                        out.append((key[0], seq, tx_no, xid, op, rel_id, rel, old, new, lsn, commit_us, int(m.lsn), k, bytes_, False, False))
                out.append((key[0], int(m.seq), tx_no, xid, None, None, None, None, None, int(m.wal_start), commit_us, int(m.lsn), n if fits else -1, size, False, True))
                self.changes.clear()
                held, n, size, inside = [], 0, 0, False
            elif m.msg in CHANGE_MESSAGES and inside:
                rel_id = int(m.rel_id)
                rel, columns = relation(rel_id)
                bytes_ = 64 + cells_bytes(m.before, columns) + cells_bytes(m.after, columns)
                size += bytes_
                if self.most <= 0 or size <= self.most:
                    held.append((int(m.seq), CHANGE_MESSAGES[m.msg], rel_id, rel, m.before, m.after, int(m.wal_start), bytes_))
                    n += 1
            elif m.msg in CHANGE_MESSAGES:
                out.append((key[0], int(m.seq), None, None, CHANGE_MESSAGES[m.msg], int(m.rel_id), relation(int(m.rel_id))[0], m.before, m.after, int(m.wal_start), None, None, None, None, True, False))
        if held:
            self.changes.appendList(held)
        self.open.update((tx_no, xid, commit_us, n, size, inside))
        if out:
            made = pd.DataFrame(out, columns=[c.split()[0] for c in EVENT.split(", ")])
            yield made.astype({c: "Int64" for c in ("tx_no", "xid", "rel_id", "commit_us", "commit_lsn", "bytes")} | {"ordinal": "Int32"})

    def close(self) -> None:
        pass


def stream_events(messages: DataFrame, max_tx_bytes: int = 64 << 20) -> DataFrame:
    """assemble().events of a stream of messages, in the batch in which their commit arrives."""
    return stream_changes(messages, max_tx_bytes).where("not outside and not commit").drop("outside", "commit")


def stream_changes(messages: DataFrame, max_tx_bytes: int = 64 << 20) -> DataFrame:
    """stream_events(), with outside true the changes that stand in no transaction, and with commit true a row for each
    transaction that ended: ordinal has its changes, -1 if it was too large. Messages of a slot must arrive
    in order from batch to batch; within a batch they are sorted, so what a trigger takes in of one slot should fit in
    a task's memory. The session needs STATE_STORE."""
    text = lambda c: F.when(F.col(c).isNotNull(), F.to_json(c)).alias(c)
    rows = messages.where(F.col("msg").isin("R", "B", "C", *CHANGE_MESSAGES)).select(
        "slot", "seq", "msg", "wal_start", F.coalesce("xid", F.lit(0)).alias("xid"), F.coalesce("lsn", F.lit(0)).alias("lsn"),
        F.coalesce(F.unix_micros("commit_ts"), F.lit(0)).alias("commit_us"), F.coalesce("rel_id", F.lit(0)).alias("rel_id"), text("rel"), text("before"), text("after"),
    )
    got = rows.groupBy("slot").transformWithStateInPandas(Assembler(max_tx_bytes), EVENT, "Append", "None")
    got = got.withColumns({"rel": F.from_json("rel", RELATION), "before": F.from_json("before", f"array<{CELL}>"), "after": F.from_json("after", f"array<{CELL}>"), "commit_ts": F.timestamp_micros("commit_us")})
    return got.withColumns({side: decoded(F.col(side), F.col("rel.columns")) for side in ("before", "after")}).drop("commit_us")
