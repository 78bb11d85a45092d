"""Transactions from a stream without a task for each slot: every batch is assembled as a table, by stretches of positions.

What one batch leaves for the next lies in the shared folder: the messages of transactions that are open, the newest version of
each relation, and how many begins and commits each slot has had. It is committed under the batch's number, so a batch
that is tried again finds what it found before.
"""

from __future__ import annotations

import json
import uuid
from typing import Any, NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.model import CHANGE_MESSAGES, MESSAGE
from changeloom.operators import assemble as batch
from changeloom.operators.assemble import Assembled
from changeloom.operators.commits import Folder
from changeloom.operators.scale import joined

SLOTS = "slot string, marks long, open long, places array<string>"


class Step(NamedTuple):
    """What a batch gives, and the state after it, which commit() makes the next batch's."""

    assembled: Assembled
    messages: DataFrame
    state: dict[str, Any]


class Stretches:
    """The open ends of a stream's slots between its batches, in a folder."""

    def __init__(self, spark: SparkSession, path: str, max_tx_bytes: int = 64 << 20, width: int = 100_000):
        self.spark, self.path, self.most, self.width = spark, path.rstrip("/"), max_tx_bytes, width
        self.folder = Folder(spark, self.path)

    def before(self, batch_id: int) -> dict[str, Any]:
        return json.loads(self.folder.read(f"after-{batch_id - 1:012d}.json") or "{}")

    def put(self, rows: DataFrame, name: str) -> str | None:
        """Stores rows; None if there are none."""
        place = f"{name}-{uuid.uuid4().hex}"
        rows.select(*[c.split()[0] for c in MESSAGE.split(", ")]).write.parquet(f"{self.path}/{place}")
        return place if self.rows([place]).limit(1).count() else None

    def rows(self, places: list[str]) -> DataFrame:
        if not places:
            return self.spark.createDataFrame([], MESSAGE)
        return self.spark.read.schema(MESSAGE).parquet(*[f"{self.path}/{p}" for p in places])

    def slots(self, state: dict[str, Any]) -> DataFrame:
        """A row for each slot: its marks so far, and where its open transaction begins and lies."""
        return self.spark.createDataFrame([(s["slot"], s["marks"], s["open"], s["places"]) for s in state.get("slots", [])], SLOTS)

    def step(self, messages: DataFrame, batch_id: int) -> Step:
        """Assembles a batch together with what is open from before it. Its tasks are those of the messages' stretches, so
        one slot takes many; the open messages and relations that are carried are read, never rewritten."""
        state = self.before(batch_id)
        slots = state.get("slots", [])
        places = sorted({p for s in slots if s["open"] is not None for p in s["places"]})
        held = self.rows(places)
        began = self.slots(state).where("open is not null").select("slot", "open")
        held = joined(held, F.broadcast(began), ["slot"]).where("seq >= open").drop("open")  # a place may hold other slots' ended ones
        named = self.rows([state["relations"]] if state.get("relations") else [])
        messages = messages.select(*named.columns)
        known = named.unionByName(held).unionByName(messages)
        got = batch.assemble(known, self.most, width=self.width)

        # tx_no goes on from the marks that earlier batches had; an open begin is among them and counted again
        base = F.broadcast(self.slots(state).select("slot", (F.col("marks") - F.when(F.col("open").isNull(), 0).otherwise(1)).alias("_base")))
        numbered = lambda df: joined(df, base, ["slot"], "left").withColumn("tx_no", F.col("tx_no") + F.coalesce("_base", F.lit(0))).select(*df.columns)
        assembled = Assembled(numbered(got.events), numbered(got.transactions), got.outside)
        return Step(assembled, messages, self.after(state, messages, named, batch_id))

    def after(self, state: dict[str, Any], messages: DataFrame, named: DataFrame, batch_id: int) -> dict[str, Any]:
        is_mark = F.col("msg").isin("B", "C")
        last = messages.where(is_mark | F.col("msg").isin(*CHANGE_MESSAGES)).groupBy("slot").agg(F.count_if(is_mark).alias("marks"), F.max_by(F.struct("msg", "seq"), F.when(is_mark, F.col("seq"))).alias("last"))
        old, new = {s["slot"]: s for s in state.get("slots", [])}, {}
        for r in last.collect():  # a row for each slot
            was = old.get(r["slot"], {"marks": 0, "open": None, "places": []})
            begun = r["marks"] > 0 and r["last"]["msg"] == "B"
            new[r["slot"]] = {"slot": r["slot"], "marks": was["marks"] + r["marks"], "open": r["last"]["seq"] if begun else None if r["marks"] else was["open"], "places": [] if r["marks"] else was["places"]}
        opened = [(s, x["open"]) for s, x in new.items() if x["open"] is not None]
        if opened:
            ends = F.broadcast(self.spark.createDataFrame(opened, "slot string, open long"))
            place = self.put(joined(messages.where(F.col("msg") != "R"), ends, ["slot"]).where("seq >= open"), f"open-{batch_id:012d}")
            for s, _ in opened:
                new[s]["places"] = [*new[s]["places"], *([place] if place else [])]
        versions = named.unionByName(messages).where("msg = 'R'")
        relations = state.get("relations")
        if messages.where("msg = 'R'").limit(1).count():
            newest = versions.groupBy("slot", "rel_id").agg(F.max_by(F.struct(*versions.columns), "seq").alias("r")).select("r.*")
            relations = self.put(newest, f"relations-{batch_id:012d}")
        return {"slots": [*{**old, **new}.values()], "relations": relations}

    def commit(self, batch_id: int, state: dict[str, Any]) -> None:
        """Makes a state what the next batch begins with, and removes what no batch that may be tried again needs."""
        self.folder.put(f"after-{batch_id:012d}.json", json.dumps(state), replace=True)
        kept = [state, self.before(batch_id)]
        used = {p for s in kept for x in s.get("slots", []) for p in x["places"]} | {s["relations"] for s in kept if s.get("relations")}
        for name in self.folder.names():
            if name.startswith(("open-", "relations-")) and name not in used or name.startswith("after-") and name < f"after-{batch_id - 1:012d}":
                self.folder.remove(name)
