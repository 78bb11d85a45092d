"""Document fingerprints by locally consistent parsing.

A text is parsed into phrases, those into phrases of phrases, and so on. Where a phrase begins depends on a few
symbols around that place only, found by deterministic coin tossing, so equal substrings get equal phrases inside,
wherever they stand. A fingerprint is a min-wise sketch of the set of phrase names, so its likeness to another
estimates which share of all phrases two texts have in common.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm.text import ship, stored, tidy

SLOTS = 64
#: Phrases below this level are a few characters long and common to all texts of a language.
LEAST_LEVEL = 2
EMPTY = 0xFFFF


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix of each number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def tossed(labels: np.ndarray, before: np.ndarray) -> np.ndarray:
    """One round of coin tossing: twice the lowest bit at which a label differs from the one before, plus that bit."""
    diff = labels ^ before
    low = np.bitwise_count((diff & (~diff + labels.dtype.type(1))) - labels.dtype.type(1)).astype(labels.dtype)
    return (low << labels.dtype.type(1) | ((labels >> low) & labels.dtype.type(1))).astype(np.uint8)


def shifted(x: np.ndarray, first: np.ndarray, fill: int) -> np.ndarray:
    """Each entry's predecessor in its text; fill before a text's first."""
    out = np.empty_like(x)
    out[1:] = x[:-1]
    out[first] = fill
    return out


def phrase_starts(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Places where phrases begin, of texts that begin at the places first; neighbours in a text differ."""
    top = symbols.dtype.type(~symbols.dtype.type(0))
    before = shifted(symbols, first, 0)
    before[first] = symbols[first] ^ top  # the first symbol of a text has a predecessor that differs
    labels = tossed(symbols, before)
    for _ in range(2):  # 128 -> 16 -> 8 values
        previous = shifted(labels, first, 0)
        previous[first] = labels[first] ^ np.uint8(255)
        labels = tossed(labels, previous)
    inner = np.zeros(len(symbols), bool)
    inner[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
    last = np.append(first[1:], len(symbols)) - 1
    inner[last] = False  # a text's last symbol ends a phrase, a phrase never begins there
    inner[np.minimum(first + 1, len(symbols) - 1)] = False
    inner[first] = True
    return np.flatnonzero(inner)


def names_of(symbols: np.ndarray, starts: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit name for each stretch from one start to the next, of its symbols in order."""
    sizes = np.diff(np.append(starts, len(symbols)))
    at = (np.arange(len(symbols)) - np.repeat(starts, sizes)).astype(np.uint64)
    parts = mixed(symbols.astype(np.uint64) + at * np.uint64(0x9E3779B97F4A7C15))
    return mixed(np.add.reduceat(parts, starts) + sizes.astype(np.uint64) + np.uint64(level * 0x51ED2701))


def collapsed(symbols: np.ndarray, first: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of one symbol made one symbol, which tells their length, so that neighbours differ; and where texts begin then."""
    new = np.ones(len(symbols), bool)
    new[1:] = symbols[1:] != symbols[:-1]
    new[first] = True
    if new.all():
        return symbols, first
    starts = np.flatnonzero(new)
    runs = np.diff(np.append(starts, len(symbols)))
    out = symbols[starts]
    if level == 0:  # code points have 21 bits; the run stands above, in 64 bits where one is too long for the rest of 32
        kind = np.uint32 if runs.max() <= 2048 else np.uint64
        out = out.astype(kind) | (runs - 1).astype(kind) << kind(21)
    else:
        out = np.where(runs > 1, mixed(out + runs.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), out)
    return out, np.searchsorted(starts, first)


def sketches(texts: list[str]) -> list[bytes]:
    """For each text the name of its root (8 bytes; of nothing, zeros) and SLOTS numbers of 16 bits."""
    with np.errstate(over="ignore"):
        out = np.full((len(texts), SLOTS), EMPTY, np.uint16)
        roots = np.zeros(len(texts), np.uint64)
        sizes = np.array([len(t) for t in texts])
        owner = np.flatnonzero(sizes > 0)
        if len(owner):
            symbols = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)
            first = np.concatenate([[0], np.cumsum(sizes[owner])[:-1]])
            found: list[tuple[np.ndarray, np.ndarray]] = []
            level = 0
            while len(owner):
                symbols, first = collapsed(symbols, first, level)
                starts = phrase_starts(symbols, first)
                level += 1
                names = names_of(symbols, starts, level)
                first = np.searchsorted(starts, first)
                counts = np.diff(np.append(first, len(names)))
                done = counts == 1
                if level >= LEAST_LEVEL:
                    found.append((names, np.repeat(owner, counts)))
                elif done.any():
                    found.append((names[first[done]], owner[done]))
                roots[owner[done]] = names[first[done]]
                keep = np.repeat(~done, counts)
                symbols, owner, counts = names[keep], owner[~done], counts[~done]
                first = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(int) if len(counts) else counts
            names, owners = (np.concatenate(x) for x in zip(*found, strict=True))
            drawn = mixed(names ^ np.uint64(0xA0761D6478BD642F))
            slot = owners * SLOTS + (drawn & np.uint64(SLOTS - 1)).astype(int)
            value = np.minimum(drawn >> np.uint64(48), np.uint64(EMPTY - 1)).astype(np.uint16)
            order = np.lexsort((value, slot))
            head = np.ones(len(order), bool)
            head[1:] = slot[order][1:] != slot[order][:-1]
            out.reshape(-1)[slot[order][head]] = value[order][head]
        return [r.tobytes() + row.tobytes() for r, row in zip(roots.astype(">u8"), out.astype(">u2"), strict=True)]


def likeness(a: bytes, b: bytes) -> float:
    """Share of the slots, of those that either sketch fills, in which two sketches agree; of two empty texts 1."""
    x, y = np.frombuffer(a, ">u2", SLOTS, 8), np.frombuffer(b, ">u2", SLOTS, 8)
    either = int(((x != EMPTY) | (y != EMPTY)).sum())
    return float(((x == y) & (x != EMPTY)).sum() / either) if either else 1.0


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch_chars: int = 1_000_000) -> DataFrame:
    """For each row of docs: id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the text with its last floor(n_chars / 4) code points replaced by the first as many (or all)
    of the next document's, in ascending order of ids; after the last document comes the first. Likenesses are of the
    text's fingerprint to the edited text's and to the next document's.

    A null text is empty; an empty text's fingerprint is zeros and empty slots. A single document is its own next.
    Rows that repeat an id follow each other by text; null ids come first. Texts move once, to ranges of ids; tasks
    stream them, and only the first and the last document of each range meet their neighbours in a second, small step.
    """
    spark = docs.sparkSession
    ship(spark)
    kind = docs.select(F.col(id_col).alias("id")).schema["id"].dataType.simpleString()
    made = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def finished(rows: list[tuple[str, bytes, str, bytes]]) -> list[tuple]:
        """rows: text and sketch, next text and sketch."""
        edits = [t[: len(t) - len(t) // 4] + n[: len(t) // 4] for t, _, n, _ in rows]
        return [
            (len(t), hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest(), own.hex(), edited.hex(), likeness(own, edited), likeness(own, follower))
            for (t, own, _, follower), e, edited in zip(rows, edits, sketches(edits), strict=True)
        ]

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        last: tuple | None = None

        def out(ids: list, parts: list, texts: list, first: list, rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            return pa.RecordBatch.from_arrays([pa.array(ids, id_type), pa.array(parts, pa.int64()), pa.array(texts, pa.string()), pa.array(first, pa.bool_()), *[pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()), strict=True)]], ["id", "part", "edge", "is_first", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

        for batch in batches:
            id_type = batch.column("id").type
            ids, texts, at = batch.column("id").to_pylist(), batch.column("text").to_pylist(), 0
            while at < len(ids):
                end, size = at, 0
                while end < len(ids) and (size < batch_chars or end == at):
                    size += len(texts[end])
                    end += 1
                some = list(zip(ids[at:end], texts[at:end], sketches(texts[at:end]), strict=True))
                if last is None:
                    yield out([some[0][0]], [part], [some[0][1]], [True], [(None,) * 6])
                else:
                    some.insert(0, last)
                if len(some) > 1:
                    rows = finished([(a[1], a[2], b[1], b[2]) for a, b in zip(some, some[1:], strict=False)])
                    yield out([a[0] for a in some[:-1]], [None] * len(rows), [None] * len(rows), [None] * len(rows), rows)
                last, at = some[-1], end
        if last is not None:
            yield out([last[0]], [part], [last[1]], [False], [(None,) * 6])

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.repartitionByRange("id").sortWithinPartitions("id", "text")
    got = stored(rows.mapInArrow(tidy(streamed), f"id {kind}, part long, edge string, is_first boolean, {made}"), "phrases")

    # Two rows for each range: its last document goes to the first one of the next range that has any.
    parts = sorted(r["part"] for r in got.where("is_first").select("part").collect())  # one number for each task
    follow = dict(zip(parts, [*parts[1:], *parts[:1]], strict=True))
    pairs = spark.createDataFrame(list(follow.items()), "part long, next_part long")
    firsts = got.where("is_first").select(F.col("part").alias("next_part"), F.col("edge").alias("next_text"))
    edges = got.where("is_first = false").select("id", "part", F.col("edge").alias("text")).join(pairs, "part").join(firsts, "next_part").select("id", "text", "next_text")

    def closed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                _, text, follower = (c[at].as_py() for c in batch.columns)
                rows = finished([(text, *sketches([text]), follower, *sketches([follower]))])
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(at, 1), *[pa.array(c) for c in zip(*rows, strict=True)]], ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    whole = got.where("part is null").drop("part", "edge", "is_first").unionByName(edges.mapInArrow(tidy(closed), f"id {kind}, {made}"))
    return whole.withColumnRenamed("id", id_col)
