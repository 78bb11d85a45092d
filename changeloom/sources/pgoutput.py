"""Captured replication streams as a Spark data source, "wal_capture".

A capture file holds frames: the length of a CopyData payload as big-endian uint32, then the payload. Payloads are
keepalives (k) or log data (w) with one message of the logical replication protocol, whose public format the decoder
follows. Files of a folder are read in the order of their names, each by a task of its own or by several.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, GreaterThanOrEqual, InputPartition

from changeloom.model import MESSAGE
from changeloom.sources.frames import Piece, Place, advanced, listed, messages, pieces, place, save

EPOCH = datetime(2000, 1, 1, tzinfo=timezone.utc)


def at(micros: int) -> datetime:
    return EPOCH + timedelta(microseconds=micros)


class Bytes:
    """A message, read from its front."""

    def __init__(self, data: bytes):
        self.data, self.place = data, 0

    def take(self, form: str) -> Any:
        out = struct.unpack_from(">" + form, self.data, self.place)
        self.place += struct.calcsize(">" + form)
        return out[0] if len(out) == 1 else out

    def text(self) -> str:
        end = self.data.index(b"\0", self.place)
        out = self.data[self.place : end].decode("utf-8", "replace")
        self.place = end + 1
        return out

    def tuple(self) -> list[tuple[str, str | None]]:
        cells = []
        for _ in range(self.take("H")):
            kind = chr(self.take("B"))
            text = None
            if kind in "tb":
                n = self.take("I")
                text = self.data[self.place : self.place + n].decode("utf-8", "replace")
                self.place += n
            cells.append((kind if kind in "nu" else "t", text))
        return cells


def decode(message: bytes) -> dict[str, Any] | None:
    """The fields of a MESSAGE that a protocol message sets; None for one that says nothing about rows."""
    kind, m = chr(message[0]), Bytes(message[1:])
    if kind == "B":
        lsn, ts, xid = m.take("QqI")
        return {"msg": kind, "lsn": lsn, "commit_ts": at(ts), "xid": xid}
    if kind == "C":
        _, lsn, _, ts = m.take("BQQq")
        return {"msg": kind, "lsn": lsn, "commit_ts": at(ts)}
    if kind == "R":
        rel_id, schema, table, _ = m.take("I"), m.text(), m.text(), m.take("B")
        columns = []
        for _ in range(m.take("H")):
            flags, name = m.take("B"), m.text()
            oid, _ = m.take("Ii")
            columns.append((name, oid, flags == 1))
        return {"msg": kind, "rel_id": rel_id, "rel": (schema, table, columns)}
    if kind in "IUD":
        out: dict[str, Any] = {"msg": kind, "rel_id": m.take("I")}
        while m.place < len(m.data):
            side = chr(m.take("B"))
            out["after" if side == "N" else "before"] = m.tuple()
        return out
    return {"msg": kind} if kind in "TYO" else None


class Part(InputPartition):
    """A piece of the file of a number."""

    def __init__(self, number: int, path: str, piece: Piece):
        self.number, self.path, self.piece = number, path, piece


FIELDS = ("wal_start", "msg", "xid", "lsn", "commit_ts", "rel_id", "rel", "before", "after")


class Capture:
    def __init__(self, options: dict[str, str]):
        self.folder, self.slot = options["path"], options.get("slot", "slot")
        self.start = int(options.get("startingLsn", "0"))
        self.per_task = int(options.get("framesPerTask", "0"))

    def parts(self, number: int, path: str, start: Place, end: int) -> list[Part]:
        return [Part(number, path, p) for p in pieces(place(self.folder)[0], path, start, end, self.per_task, self.start)]

    def read(self, partition: Part) -> Iterator[tuple]:
        for frame, position, message in messages(place(self.folder)[0], partition.path, partition.piece):
            got = decode(message)
            # Relations before the start still describe what follows.
            if got and (position >= self.start or got["msg"] == "R"):
                got["wal_start"] = position
                yield (self.slot, (partition.number << 32) + frame, *(got.get(f) for f in FIELDS))


class CaptureReader(Capture, DataSourceReader):
    def pushFilters(self, filters):  # noqa: N802
        """Positions below a pushed bound needn't be decoded into rows, nor blocks read that an index has below it; Spark
        filters again."""
        for f in filters:
            if isinstance(f, (GreaterThanOrEqual, EqualTo)) and f.attribute == ("wal_start",):
                self.start = max(self.start, int(f.value))
            yield f

    def partitions(self):
        return [p for k, (_, path, size) in enumerate(listed(self.folder)) for p in self.parts(k, path, Place(0, 0, 0), size)]


class CaptureStream(Capture, DataSourceStreamReader):
    """An offset is a file, its number among all that were ever read, the byte and frame in it up to where it has been given
    out, the end of the log data there (lsn), and the files and bytes that wait behind it.

    Files must appear in the order of their names; the last may grow. One that comes late, under a name before what has
    been given out, stops the stream. With the option positions, a folder that the driver can write to, what a trigger takes is
    bounded by maxFramesPerTrigger, and files that have been given out may be removed: the stream notes there what it plans,
    since Spark asks for the newest offset without telling the last one. Without it a trigger takes all there is, and
    a missing file stops the stream.
    """

    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        self.limit = int(options.get("maxFramesPerTrigger", "0")) or None
        self.notes = options.get("positions")
        if self.limit and not self.notes:
            raise ValueError("maxFramesPerTrigger needs the option positions, a folder that the driver can write to")
        self.given: dict[str, Any] | None = None
        self.seen: set[str] | None = None
        self.last: tuple[Any, Place] = (None, Place(0, 0, 0))  # what was found, so that a file is read again only if it grew

    def initialOffset(self):  # noqa: N802
        return {"file": "", "number": -1, "at": 0, "frame": 0, "lsn": 0, "behind_files": 0, "behind_bytes": 0}

    def noted(self) -> dict[str, Any] | None:
        system, root = place(self.notes)
        try:
            with system.open_input_stream(f"{root}/{self.slot}.json") as f:
                return json.loads(f.read())
        except FileNotFoundError:
            return None

    def note(self, end: dict[str, Any], names: list[str]) -> None:
        system, root = place(self.notes)
        system.create_dir(root, recursive=True)
        save(system, f"{root}/{self.slot}.json", json.dumps({"offset": end, "seen": [n for n in names if n <= end["file"]]}))

    def checked(self, found: list[tuple[str, str, int]], start: dict[str, Any]) -> None:
        """Of the files up to start only those may be there that have been read."""
        there = [n for n, _, _ in found if n <= start["file"]]
        if self.notes:
            if self.seen is None:
                got = self.noted()
                self.seen = set(got["seen"]) if got else set(there)
            if late := [n for n in there if n not in self.seen]:
                raise ValueError(f"files came late, after {start['file']} has been read: {late[:3]}")
        elif len(there) != start["number"] + 1:
            raise ValueError(f"{len(there)} files up to {start['file']} where {start['number'] + 1} have been read: files came late or are gone")

    def latestOffset(self):  # noqa: N802
        if self.given is None:
            got = self.noted() if self.notes else None
            self.given = got["offset"] if got else self.initialOffset()
        found, system, out, left = listed(self.folder), place(self.folder)[0], dict(self.given), self.limit
        if self.notes:
            self.checked(found, out)
        start = self.given if self.notes else self.initialOffset()
        number = start["number"]
        for name, path, size in found:
            if name < start["file"]:
                continue
            own = name == start["file"]
            number += not own
            if left == 0:
                break
            whole = self.limit is None and path != found[-1][1]  # nothing will come after its last frame
            begin = Place(start["at"], start["frame"], start["lsn"]) if own else Place(0, 0, out["lsn"])
            if not whole and self.last[0] != (path, size, begin, left):
                self.last = ((path, size, begin, left), advanced(system, path, size, begin, left))
            got = Place(size, 0, begin.lsn) if whole else self.last[1]
            if left is not None:
                left -= got.frame - begin.frame
            out |= {"file": name, "number": number, "at": got.at, "frame": got.frame, "lsn": max(out["lsn"], got.lsn)}
        rest = [(n, size - (out["at"] if n == out["file"] else 0)) for n, _, size in found if n >= out["file"]]
        return out | {"behind_files": sum(b > 0 for _, b in rest) if self.limit else 0, "behind_bytes": sum(b for _, b in rest) if self.limit else 0}

    def partitions(self, start, end):
        found = listed(self.folder)
        self.checked(found, start)
        out, number = [], start["number"]
        for name, path, size in found:
            if not start["file"] <= name <= end["file"]:
                continue
            own = name == start["file"]
            number += not own
            begin = Place(start["at"], start["frame"], 0) if own else Place(0, 0, 0)
            out += self.parts(number, path, begin, end["at"] if name == end["file"] else size)
        if self.notes:
            self.note(end, [n for n, _, _ in found])
            self.seen = (self.seen or set()) | {n for n, _, _ in found if n <= end["file"]}
        self.given = end
        return out

    def commit(self, end):
        self.committed = end


class WalCapture(DataSource):
    """Options: path (a folder), slot, startingLsn, framesPerTask (0: a task for each file); of streams maxFramesPerTrigger
    (0: all there is) and positions."""

    @classmethod
    def name(cls) -> str:
        return "wal_capture"

    def schema(self) -> str:
        return MESSAGE

    def reader(self, schema) -> CaptureReader:
        return CaptureReader(self.options)

    def streamReader(self, schema) -> CaptureStream:  # noqa: N802
        return CaptureStream(self.options)


def register(spark: SparkSession) -> None:
    """Makes the source known to a session, and lets filters reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WalCapture)
