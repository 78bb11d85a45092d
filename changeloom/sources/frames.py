"""Frames of capture files: where they begin, an index of them beside each file, and what of a file a task reads.

A frame is a length as big-endian uint32 and a payload; payloads of log data (w) have the position of their message in
front. Files are found and read by pyarrow, so a folder is a path or any URI that it opens.
"""

from __future__ import annotations

import io
import json
import os
import struct
import uuid
from collections.abc import Iterator
from typing import Any, BinaryIO, NamedTuple

from pyspark.sql import SparkSession

HEAD = 30  # bytes of a frame up to the kind of its message
SUFFIX, INDEX = ".wal", ".idx"


class Frame(NamedTuple):
    """Where a frame begins and ends; position and end of its log data (0 and 0 for others), and the message's kind."""

    byte: int
    end: int
    position: int
    done: int
    kind: bytes


class Block(NamedTuple):
    """Frames that follow one another: byte and number of the first, lowest position, highest end of log data, and whether
    a relation is among them, which describes what comes later whatever its position."""

    byte: int
    frame: int
    low: int
    high: int
    relations: bool


class Index(NamedTuple):
    """Blocks of the whole frames of a file up to the byte end, and their number."""

    end: int
    frames: int
    blocks: list[Block]


class Place(NamedTuple):
    """Up to where a file has been read: byte, frames before it, and the end of the last log data."""

    at: int
    frame: int
    lsn: int


def place(folder: str) -> tuple[Any, str]:
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if ":/" in folder else os.path.abspath(folder))


def listed(folder: str) -> list[tuple[str, str, int]]:
    """Name, path and size of the capture files of a folder, by name."""
    from pyarrow import fs

    system, root = place(folder)
    return sorted((f.base_name, f.path, f.size) for f in system.get_file_info(fs.FileSelector(root)) if f.is_file and f.path.endswith(SUFFIX))


def headers(file: BinaryIO, begin: int, size: int) -> Iterator[Frame]:
    """The whole frames from a byte on. Payloads are passed over; one that is cut off isn't there yet."""
    file.seek(begin)
    at = begin
    while len(head := file.read(HEAD)) >= 4:
        (n,) = struct.unpack_from(">I", head)
        end = at + 4 + n
        if end > size:
            return
        data = n >= 25 and head[4:5] == b"w"
        position = struct.unpack_from(">Q", head, 5)[0] if data else 0
        yield Frame(at, end, position, position + n - 25 if data else 0, head[29:30] if data and n > 25 else b"")
        file.seek(end)
        at = end


def opened(system: Any, path: str) -> BinaryIO:
    return io.BufferedReader(system.open_input_file(path), 1 << 20)


def indexed(file: BinaryIO, size: int, every: int) -> Index:
    blocks: list[Block] = []
    end = frames = 0
    for f in headers(file, 0, size):
        if frames % every == 0:
            blocks.append(Block(f.byte, frames, 1 << 63, 0, False))
        b = blocks[-1]
        data = bool(f.kind)
        blocks[-1] = b._replace(low=min(b.low, f.position) if data else b.low, high=max(b.high, f.done), relations=b.relations or f.kind == b"R")
        end, frames = f.end, frames + 1
    return Index(end, frames, blocks)


def saved_index(system: Any, path: str) -> Index | None:
    """The index beside a file, if there is one; it may cover only what the file held when it was made."""
    try:
        with system.open_input_stream(path + INDEX) as f:
            got = json.loads(f.read())
    except FileNotFoundError:
        return None
    return Index(got["end"], got["frames"], [Block(*b) for b in got["blocks"]])


def save(system: Any, path: str, text: str) -> None:
    made = f"{path}.{uuid.uuid4().hex}.tmp"
    with system.open_output_stream(made) as f:
        f.write(text.encode())
    system.move(made, path)


def index_captures(spark: SparkSession, folder: str, every: int = 10_000) -> int:
    """Writes an index beside each capture file that has none, or has grown since; a task for each file. Returns how many."""
    system = place(folder)[0]
    todo = [(path, size) for _, path, size in listed(folder) if (got := saved_index(system, path)) is None or got.end < size]
    if not todo:
        return 0

    def run(batches):
        import pyarrow as pa

        own = place(folder)[0]
        for batch in batches:
            for path, size in zip(batch.column("path").to_pylist(), batch.column("size").to_pylist(), strict=True):
                with opened(own, path) as f:
                    save(own, path + INDEX, json.dumps(indexed(f, size, every)._asdict()))
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    files = spark.createDataFrame(todo, "path string, size long").repartition(len(todo))
    return sum(r["n"] for r in files.mapInArrow(run, "n long").collect())


def advanced(system: Any, path: str, size: int, start: Place, limit: int | None) -> Place:
    """The place up to limit frames after start, or after the last whole frame. Blocks of an index are passed over at once;
    headers are read of what is left."""
    at, frame, lsn = start
    left = limit
    index = saved_index(system, path)
    if index and index.end <= size:
        stops = [(b.byte, b.frame) for b in index.blocks] + [(index.end, index.frames)]
        reach = [s for s in stops if s[0] > at and (limit is None or s[1] - start.frame <= limit)]
        if reach:
            lsn = max([lsn, *(b.high for b in index.blocks if start.at <= b.byte < reach[-1][0])])
            at, frame = reach[-1]
            left = None if limit is None else limit - (frame - start.frame)
    if left != 0 and at < size:
        with opened(system, path) as f:
            for h in headers(f, at, size):
                at, frame, lsn = h.end, frame + 1, max(lsn, h.done)
                if left is not None and (left := left - 1) == 0:
                    break
    return Place(at, frame, lsn)


class Piece(NamedTuple):
    """Bytes of a file, whole frames, and the number of the first."""

    begin: int
    frame: int
    end: int


def pieces(system: Any, path: str, start: Place, end: int, per_task: int, from_position: int = 0) -> list[Piece]:
    """What of a file from start to the byte end is to be read, in parts of about per_task frames (0: undivided). With an
    index parts end where blocks do, and blocks wholly before a position are left out, but for those with relations.
    Without one, headers are read to find parts."""
    index = saved_index(system, path)
    if index and index.end <= end and (per_task or from_position):
        inner = [b for b in index.blocks if b.byte > start.at]
        own = next((b for b in reversed(index.blocks) if b.byte <= start.at), None)
        first = Block(start.at, start.frame, own.low, own.high, own.relations) if own and start.at < index.end else None
        blocks = [*([first] if first else []), *inner]
        edges = [b.byte for b in blocks[1:]] + [index.end]
        out: list[Piece] = []
        for b, stop in zip(blocks, edges, strict=False):
            if b.high < from_position and not b.relations:
                continue
            if out and out[-1].end == b.byte and (not per_task or b.frame - out[-1].frame < per_task):
                out[-1] = out[-1]._replace(end=stop)
            else:
                out.append(Piece(b.byte, b.frame, stop))
        tail = start if start.at >= index.end else Place(index.end, index.frames, 0)
        return out + ([Piece(tail.at, tail.frame, end)] if tail.at < end else [])
    if not per_task or start.at >= end:
        return [Piece(start.at, start.frame, end)] if start.at < end else []
    cuts = [Piece(start.at, start.frame, end)]
    with opened(system, path) as f:
        for k, h in enumerate(headers(f, start.at, end)):
            if k and k % per_task == 0:
                cuts[-1] = cuts[-1]._replace(end=h.byte)
                cuts.append(Piece(h.byte, start.frame + k, end))
    return cuts


def messages(system: Any, path: str, piece: Piece) -> Iterator[tuple[int, int, bytes]]:
    """Number, position and message of the log data of a piece, one frame at a time."""
    with opened(system, path) as f:
        f.seek(piece.begin)
        at, number = piece.begin, piece.frame
        while at < piece.end and len(head := f.read(4)) == 4:
            (n,) = struct.unpack(">I", head)
            payload = f.read(n)
            if len(payload) < n:
                return
            if payload[:1] == b"w":
                yield number, struct.unpack_from(">Q", payload, 1)[0], payload[25:]
            at, number = at + 4 + n, number + 1
