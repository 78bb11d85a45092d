"""Token-ID output in binary files of patched frame-of-reference blocks, and their reader.

A file holds the ids of whole documents, one after another, in blocks of 1024 ids. Layout, little-endian:

    magic, 8 bytes
    blocks: minimum uint32, ids uint16, exceptions uint16, width uint8; the ids less the minimum packed at width
        bits, 64 of them in width words of 64 bits; places of the exceptions uint16 each; what lies above the low width bits of each, uint32
    index: start of each block uint64
    documents: id int64, null flag uint8, ids uint64
    footer: places of index and documents, blocks, documents and ids, uint64 each; magic, 8 bytes
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm import encoding
from changeloom.llm.text import shared_path, ship, stored, tidy
from changeloom.operators.scale import running_sum

MAGIC = b"CLTOKEN1"
BLOCK = 1024
HEAD = np.dtype([("low", "<u4"), ("n", "<u2"), ("odd", "<u2"), ("width", "u1")])
DOCUMENT = np.dtype([("id", "<i8"), ("null", "u1"), ("n", "<u8")])


def pack(rows: np.ndarray, width: int) -> np.ndarray:
    """The low width bits of each number, by rows, as bytes: 64 numbers to width words of 64 bits."""
    n = -(-rows.shape[1] // 64)
    padded = np.zeros((len(rows), 64 * n), np.uint64)
    padded[:, : rows.shape[1]] = rows & np.uint32((1 << width) - 1)
    lanes = np.ascontiguousarray(padded.reshape(-1, 64).T)
    words = np.zeros((width, lanes.shape[1]), "<u8")
    for j in range(64):
        word, shift = divmod(j * width, 64)
        words[word] |= lanes[j] << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= lanes[j] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T).view(np.uint8).reshape(len(rows), -1)


def packed_size(n: int, width: int) -> int:
    return -(-n // 64) * width * 8


def unpack(packed: np.ndarray, n: int, width: int) -> np.ndarray:
    words = np.ascontiguousarray(np.ascontiguousarray(packed).view("<u8").reshape(-1, width).T)
    lanes, mask = np.empty((64, words.shape[1]), np.uint32), np.uint64((1 << width) - 1)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        got = words[word] >> np.uint64(shift)
        if shift + width > 64:
            got = got | words[word + 1] << np.uint64(64 - shift)
        lanes[j] = got & mask
    return np.ascontiguousarray(lanes.T).reshape(len(packed), -1)[:, :n].copy()


def encode_file(ids: np.ndarray, documents: list[tuple[int | None, int]], share: float = 0.95) -> bytes:
    """The bytes of a file. A block's width is that of its share-quantile; larger numbers are exceptions."""
    full, blocks = len(ids) // BLOCK * BLOCK, []
    whole = ids[:full].reshape(-1, BLOCK)
    parts = [whole[k : k + 256] for k in range(0, len(whole), 256)]  # some at a time, as packing takes many times their size
    for part in [*parts, ids[full:].reshape(1, -1)] if full < len(ids) else parts:
        low = part.min(axis=1)
        rest = part - low[:, None]
        middle = np.partition(rest, k := min(part.shape[1] - 1, int(share * part.shape[1])), axis=1)[:, k]
        widths = np.ceil(np.log2(middle.astype(np.float64) + 1)).astype(int)
        made: list[bytes] = [b""] * len(part)
        for width in np.unique(widths):
            own = np.flatnonzero(widths == width)
            packed = pack(rest[own], int(width)) if width else np.zeros((len(own), 0), np.uint8)
            above = rest[own] >> np.uint32(width)
            for k, row in enumerate(own):
                at = np.flatnonzero(above[k])
                head = np.array((low[row], part.shape[1], len(at), width), HEAD).tobytes()
                made[row] = head + packed[k].tobytes() + at.astype("<u2").tobytes() + above[k][at].astype("<u4").tobytes()
        blocks += made
    starts = len(MAGIC) + np.cumsum([0, *map(len, blocks)]).astype("<u8")
    table = np.array([(i or 0, i is None, n) for i, n in documents], DOCUMENT)
    index = int(starts[-1])
    foot = np.array([index, index + 8 * len(blocks), len(blocks), len(table), len(ids)], "<u8").tobytes()
    return b"".join([MAGIC, *blocks, starts[:-1].tobytes(), table.tobytes(), foot, MAGIC])


def decode_file(data: bytes, blocks: slice | None = None) -> tuple[np.ndarray, np.ndarray]:
    """ids and documents of a file; only the given blocks where some are, found by the index."""
    if data[:8] != MAGIC or data[-8:] != MAGIC:
        raise ValueError("not a token file, or cut off")
    index, docs_at, n_blocks, n_docs, _ = (int(x) for x in np.frombuffer(data, "<u8", 5, len(data) - 48))
    starts = np.frombuffer(data, "<u8", n_blocks, index)[blocks or slice(None)]
    raw = np.frombuffer(data, np.uint8)
    if not len(starts):
        return np.zeros(0, np.uint32), np.frombuffer(data, DOCUMENT, n_docs, docs_at)
    heads = raw[starts.astype(np.int64)[:, None] + np.arange(HEAD.itemsize)].copy().view(HEAD)[:, 0]
    out: list[np.ndarray | None] = [None] * len(starts)
    for n, width in {(int(h["n"]), int(h["width"])) for h in heads}:
        own = np.flatnonzero((heads["n"] == n) & (heads["width"] == width))
        size = packed_size(n, width)
        at = starts[own].astype(np.int64) + HEAD.itemsize
        ids = unpack(raw[at[:, None] + np.arange(size)], n, width) if width else np.zeros((len(own), n), np.uint32)
        for k, row in enumerate(own):
            if odd := int(heads["odd"][row]):
                places = np.frombuffer(data, "<u2", odd, int(at[k]) + size)
                ids[k, places] |= np.frombuffer(data, "<u4", odd, int(at[k]) + size + 2 * odd) << np.uint32(width)
            out[row] = ids[k] + heads["low"][row]
    return np.concatenate(out), np.frombuffer(data, DOCUMENT, n_docs, docs_at)


#: Places for the files of one task in the order of all files.
FILES_OF_A_PART = 1 << 24


def write_tokens(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, path: str | None = None, file_ids: int = 2_000_000) -> DataFrame:
    """Encode all texts and write their ids to files of about file_ids ids in folder, in ascending order of ids (null
    first, then by text); returns the manifest: file, part, seq, n_documents, n_tokens, in order of (part, seq).

    A file is written under a name of its own attempt and counts only if the manifest, a table that Spark commits,
    names it: what a lost or repeated task leaves behind is never read. folder is any URI that pyarrow opens.

    A null or empty text is its end id alone. Rows that repeat an id are documents of their own, in a row. The format
    has 64-bit ids: others are cast, and text that is no whole number stops the job with Spark's error. Other columns
    are ignored; an empty table gives no files.
    """
    ship(docs.sparkSession)

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        own, where = encoding.encoder(path, 1 << 30), TaskContext.get()
        place, root = fs.FileSystem.from_uri(folder)
        end = np.array([end_id], "<u4").tobytes()
        ids: list[bytes] = []
        documents: list[tuple[int | None, int]] = []
        total = seq = 0

        def flush() -> pa.RecordBatch:
            name = f"part-{where.partitionId():06d}-{seq:05d}-{uuid.uuid4().hex[:12]}.tok"
            place.create_dir(root, recursive=True)
            with place.open_output_stream(f"{root}/{name}") as f:
                f.write(encode_file(np.frombuffer(b"".join(ids), "<u4"), documents))
            return pa.RecordBatch.from_pydict({"file": [name], "part": pa.array([where.partitionId()], pa.int64()), "seq": pa.array([seq], pa.int64()), "n_documents": pa.array([len(documents)], pa.int64()), "n_tokens": pa.array([total], pa.int64())})

        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                some = batch.slice(at, 200)
                for key, got in zip(some.column("id").to_pylist(), own.ids(some.column("text").to_pylist()), strict=True):
                    ids += (got, end)
                    n = len(got) // 4 + 1
                    documents.append((key, n))
                    total += n
                    if total >= file_ids:
                        yield flush()
                        ids, documents, total, seq = [], [], 0, seq + 1
        if documents:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.repartitionByRange("id").sortWithinPartitions("id", "text")
    return stored(rows.mapInArrow(tidy(written), "file string, part long, seq long, n_documents long, n_tokens long"), "token-manifest")


def read_tokens(manifest: DataFrame, folder: str, id_col: str = "doc_id") -> DataFrame:
    """Every document of the files that the manifest names: id_col, start (ids of all documents before it), n_tokens
    and ids_crc32, of the ids as little-endian uint32."""
    ship(manifest.sparkSession)
    numbered = manifest.withColumn("place", F.col("part") * FILES_OF_A_PART + F.col("seq"))
    files = running_sum(numbered, F.col("n_tokens"), "end", [], "place", 1000 * FILES_OF_A_PART)
    files = files.select("file", (F.col("end") - F.col("n_tokens")).alias("base"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        place, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist(), strict=True):
                with place.open_input_file(f"{root}/{name}") as f:
                    ids, table = decode_file(f.read())
                ends = np.cumsum(table["n"]).astype(np.int64)
                starts, raw = ends - table["n"].astype(np.int64), ids.astype("<u4").tobytes()
                sums = [zlib.crc32(memoryview(raw)[4 * s : 4 * e]) for s, e in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(table["id"], mask=table["null"] == 1), pa.array(base + starts), pa.array(table["n"].astype(np.int64)), pa.array(sums, pa.int64())], ["id", "start", "n_tokens", "ids_crc32"])

    dealt = files.repartition(max(1, manifest.count() // 4), "file")  # a number, else so few bytes go to one task
    return dealt.mapInArrow(tidy(documents), "id long, start long, n_tokens long, ids_crc32 long").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """write_tokens() into the shared folder, and read_tokens() from there."""
    folder = shared_path(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, folder, id_col, text_col, path=path), folder, id_col)
