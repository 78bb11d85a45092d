"""A mirror that is kept: deltas by batch, merged as they are read, and compacted by a job of its own."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.operators.scale import all_equal
from changeloom.operators.commits import Commits, Folder


class KeptMirror:
    """The newest row of each key, as a log-structured table in a shared folder.

    A batch of changes becomes a delta: the newest change of each of its keys, deletions as tombstones, in files by
    bucket of the key. A commit makes a delta visible, so a batch is there whole or not at all, and one that has been
    applied isn't applied again. Readers merge the base and the deltas of one commit by `order`, in which every column
    counts in turn; where deltas are small, rows of the base that no delta has a key of aren't shuffled. Null keys are
    keys like any other; changes that tie in order count as one, and one of them stays.

    compact() writes deltas, and the base if asked, as one; what it replaces stays for readers of older versions until
    vacuum(). With a frontier, a value of the column `position` up to which everything has been applied, later changes up
    to it are repeats and dropped, which lets tombstones up to it go; without one they stay, so that a repeat of what came
    before a deletion doesn't bring a row back.
    """

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], order: Sequence[str], position: str | None = None, buckets: int = 64, max_broadcast_rows: int = 200_000):
        self.spark, self.path, self.key, self.order, self.position = spark, path.rstrip("/"), list(key), list(order), position
        self.buckets, self.most = buckets, max_broadcast_rows
        self.commits, self.folder = Commits(spark, self.path), Folder(spark, self.path)

    # What is stored

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.key]), F.lit(self.buckets)).cast("int")

    def newest(self, rows: DataFrame) -> DataFrame:
        """One row for each key, the last by order. Tasks aggregate before they shuffle, so a busy key is no group."""
        whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
        return rows.groupBy(*[F.col(f"`{k}`").alias(f"_k{n}") for n, k in enumerate(self.key)]).agg(F.max_by(whole, F.struct(*[F.col(f"`{c}`") for c in self.order])).alias("_row")).select("_row.*")

    def written(self, rows: DataFrame, name: str) -> dict[str, Any]:
        """Stores rows as files by bucket; a new folder each time, so nothing that a commit names is ever written again."""
        place = f"{name}-{uuid.uuid4().hex}"
        by_bucket = rows.withColumn("_bucket", self.bucket()).hint("rebalance", "_bucket")  # splits large buckets over tasks
        by_bucket.write.partitionBy("_bucket").parquet(f"{self.path}/{place}")
        return {"place": place, "rows": self.spark.read.schema(rows.schema).parquet(f"{self.path}/{place}").count(), "schema": rows.schema.json()}

    def stored(self, parts: Sequence[dict[str, Any]]) -> DataFrame | None:
        """The rows of stored parts as they are, with their bucket; columns that only later parts have are null before."""
        from pyspark.sql.types import IntegerType, StructType

        out = None
        for p in parts:
            schema = StructType.fromJson(json.loads(p["schema"])).add("_bucket", IntegerType())
            one = self.spark.read.schema(schema).parquet(f"{self.path}/{p['place']}")
            out = one if out is None else out.unionByName(one, allowMissingColumns=True)
        return out

    # What a writer does

    @staticmethod
    def applied(state: dict[str, Any], batch: int | str) -> bool:
        return batch in state.get("batches", ()) or isinstance(batch, int) and batch < state.get("done", 0)

    def apply(self, changes: DataFrame, batch: int | str, deleted: Column | str) -> bool:
        """Adds a batch under its number (from 0) or name; False, and nothing done, if it has been added."""
        version, state = self.commits.load()
        if self.applied(state, batch):
            return False
        rows = changes.withColumn("_deleted", F.coalesce(F.expr(deleted) if isinstance(deleted, str) else deleted, F.lit(False)))
        if (frontier := state.get("frontier")) is not None:
            rows = rows.where(F.col(f"`{self.position}`") > frontier)
        delta = self.written(self.newest(rows), "delta")
        deltas = [*state.get("deltas", ()), delta] if delta["rows"] else state.get("deltas", [])
        batches, done = [*state.get("batches", ()), batch], state.get("done", 0)
        while done in batches:  # numbers without a gap are kept as one
            batches.remove(done)
            done += 1
        self.commits.commit(version + 1, state | {"deltas": deltas, "batches": batches, "done": done})
        return True

    def compact(self, whole: bool = True, frontier: int | None = None) -> int:
        """Writes the deltas as one, and with whole the base and the deltas as a new base. Returns the version."""
        version, state = self.commits.load()
        base, deltas = state.get("base"), state.get("deltas", [])
        frontier = max((f for f in (frontier, state.get("frontier")) if f is not None), default=None)
        if frontier is not None and self.position is None:
            raise ValueError("a frontier needs the column position")
        if not deltas and not (whole and base):
            return version
        if whole:
            rows = self.merged(base, deltas).drop("_bucket")
            if frontier is not None:
                rows = rows.where(~F.col("_deleted") | (F.col(f"`{self.position}`") > frontier))
            state = state | {"base": self.written(rows, "base"), "deltas": []}
        else:
            state = state | {"deltas": [self.written(self.newest(self.stored(deltas)).drop("_bucket"), "delta")]}
        return self.commits.commit(version + 1, state | {"frontier": frontier})

    def vacuum(self, keep: int = 1) -> list[str]:
        """Removes what none of the `keep` newest versions names, such as parts of failed writers and replaced ones; no
        writer may run meanwhile. Returns the names."""
        there = self.commits.versions()
        used = {p["place"] for v in there[-keep:] for s in [self.commits.load(v)[1]] for p in [*s.get("deltas", ()), *([s["base"]] if s.get("base") else [])]}
        gone = [n for n in self.folder.names() if n.startswith(("delta-", "base-")) and n not in used]
        for n in gone:
            self.folder.remove(n)
        for v in there[:-keep]:
            self.commits.folder.remove(f"{v:012d}.json")
        return gone

    # What a reader does

    def merged(self, base: dict[str, Any] | None, deltas: Sequence[dict[str, Any]], where: Column | None = None) -> DataFrame:
        """The newest row of each key, tombstones too. Rows of the base without a newer delta stay where they are if the
        deltas, by the counts in their commit, are few enough for every task."""
        pick = lambda df: df if where is None else df.where(where)
        if not deltas:
            return pick(self.stored([base]))
        changed = pick(self.stored(deltas))
        if base is None:
            return self.newest(changed)
        old = pick(self.stored([base]))
        if sum(d["rows"] for d in deltas) > self.most:
            return self.newest(old.unionByName(changed, allowMissingColumns=True))
        keys = F.broadcast(changed.select(*[F.col(f"`{k}`").alias(f"_k{n}") for n, k in enumerate(self.key)]).distinct())
        same = all_equal([(F.col(f"`{k}`"), F.col(f"_k{n}")) for n, k in enumerate(self.key)])
        met = self.newest(changed.unionByName(old.join(keys, same, "left_semi"), allowMissingColumns=True))
        return old.join(keys, same, "left_anti").unionByName(met, allowMissingColumns=True)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows that are there, without deletions, as of a version (the newest without one)."""
        state = self.commits.load(version)[1]
        if not state.get("base") and not state.get("deltas"):
            raise ValueError(f"{self.path} has no rows yet")
        return self.merged(state.get("base"), state.get("deltas", [])).where("not _deleted").drop("_deleted", "_bucket")

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows of some keys (columns named as the key): only files of their buckets are read."""
        asked = keys.select(*[F.col(f"`{k}`") for k in self.key]).distinct()
        buckets = [r[0] for r in asked.select(self.bucket()).distinct().collect()]  # as many as there are buckets
        state = self.commits.load()[1]
        rows = self.merged(state.get("base"), state.get("deltas", []), F.col("_bucket").isin(buckets))
        asked = asked.select(*[F.col(f"`{k}`").alias(f"_k{n}") for n, k in enumerate(self.key)])
        same = all_equal([(F.col(f"`{k}`"), F.col(f"_k{n}")) for n, k in enumerate(self.key)])
        return rows.join(asked, same, "left_semi").where("not _deleted").drop("_deleted", "_bucket")

    def history(self) -> DataFrame:
        """version, batches (so far), deltas, delta_rows, base_rows, frontier of each commit."""
        rows = []
        for v in self.commits.versions():
            s = self.commits.load(v)[1]
            rows.append((v, s.get("done", 0) + len(s.get("batches", ())), len(s.get("deltas", ())), sum(d["rows"] for d in s.get("deltas", ())), (s.get("base") or {}).get("rows", 0), s.get("frontier")))
        return self.spark.createDataFrame(rows, "version long, batches long, deltas long, delta_rows long, base_rows long, frontier long")
