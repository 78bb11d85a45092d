"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

Rows of the matrix are distinct sets of n-grams, columns are n-grams. Two rows link if 100 * overlap >= percent *
union. Multiplying whole columns would cost the square of each column's entries, so the product is bounded by size:

1. A row of n entries overlaps a similar one in at least ceil(t * n) of them, so similar rows share a column among
   their first n - ceil(t * n) + 1, in any order of the columns. The product starts with these leading columns only,
   and drops a pair whose count, plus all that can follow after the leading columns, falls short of the least overlap.
   Tasks first count their own columns, and those that are frequent in some task come last in the order, so that
   they rarely lead. A column that no task sees twice may still be in many rows of a large table, so the others come
   in the order of how surprising their words are, from counts of all words: n-grams of common words alone rarely lead.
2. The product is computed by blocks of columns. A column with more than `wide` entries would give too many pairs.
   Pairs of which one row leads with no wide column are complete without those columns. Rows that lead with one
   ("hot") are multiplied with each other again, in an order that is made for them alone.
3. Rows that still meet in wide columns form groups around a row of theirs, the hub. A member becomes bits, which of
   the hub's columns it has, and the few columns outside. Let o be the least overlap of a pair. Either the smaller
   count of bits is at least o: such pairs are multiplied in blocks of rows, bits by bits, unless both link with the
   hub. Or they share columns outside the hub, at least o less that count: these are multiplied as in 1, and their
   wide columns form groups of the same kind again, around hubs whose columns are added to the bits. What rows of a
   group have in common thus stops counting as a reason to compare them, and pairs that one component holds already
   aren't compared at all.
4. Pairs that these steps leave are held against each other by small bit maps of their sets, which bound the overlap
   from above, and only those that may still link by whole sets.

Every order of columns gives the same links; counts, thresholds and blocks only decide what they cost. N-grams are
named by 64-bit hashes, sets by 128 bits.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.llm import encoding
from changeloom.llm.components import components
from changeloom.llm.phrases import mixed
from changeloom.llm.text import ship, small_batches, small_side, tidy
from changeloom.operators.scale import stored_alone as stored

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTES = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTES[65:91] = _BYTES[97:123]  # A-Z count as a-z
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers: list[np.ndarray] = []


def powers(n: int) -> list[np.ndarray]:
    """_BASE to the power of 0, 1, 2, ..., and the same of its inverse, modulo 2^64."""
    if not _powers or len(_powers[0]) < n:
        n = max(n, 1 << 18)
        _powers[:] = [np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n - 1, b, np.uint64))]) for b in (_BASE, _INVERSE)]
    return _powers


WORD_SLOTS = 1 << 14  # of word counts


def slots(words: np.ndarray) -> np.ndarray:
    """The slot that a word is counted in."""
    return (words >> np.uint64(50)).astype(np.int64)


def surprise(counts: np.ndarray) -> np.ndarray:
    """For each slot, how many eighths of a bit a word of it tells, all words of a slot being counted as one."""
    total = max(1, int(counts.sum()))
    return np.round(8 * np.log2(total / np.maximum(counts, 1))).astype(np.int64)


def shingled(texts: list[str | None], width: int = 5, worth: np.ndarray | None = None) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """The sorted distinct hashes of each text's runs of width words; of fewer words, the hash of all of them. Beside
    them how surprising each is by the worth of words, 0 without one, and the hashes of all words."""
    data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b"\n".join(data) + b"\n", np.uint8)
    ends = np.cumsum([len(d) + 1 for d in data])
    with np.errstate(over="ignore"):
        space = _SPACE[raw]
        inside = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]])))
        starts, stops = inside[::2], inside[1::2]
        up, down = powers(len(raw) + 1)
        run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[raw] * up[: len(raw)])])
        words = mixed((run[stops] - run[starts]) * down[starts])
        bounds = np.searchsorted(starts, np.concatenate([[0], ends]))
        odd = [np.uint64((2 * k + 3) * _BASE % 2**64 | 1) for k in range(width)]
        n = max(0, len(words) - width + 1)
        grams = mixed(sum((words[k : k + n] * odd[k] for k in range(width)), np.zeros(n, np.uint64)))
        odds = None
        if worth is not None:
            each = worth[slots(words)]
            odds = sum((each[k : k + n] for k in range(width)), np.zeros(n, np.int64))
        out, rare = [], []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b - a >= width:
                if odds is None:
                    out.append(np.unique(grams[a : b - width + 1]))
                else:
                    g, at = np.unique(grams[a : b - width + 1], return_index=True)
                    out.append(g)
                    rare.append(odds[a + at])
            elif b > a:
                out.append(mixed((words[a:b] * np.array(odd[: b - a])).sum(keepdims=True) + np.uint64(b - a)))
            else:
                out.append(np.zeros(0, np.uint64))
            if len(rare) < len(out):
                rare.append(np.zeros(len(out[-1]), np.int64))
        return out, rare, words


def shingle_sets(texts: list[str | None], width: int = 5) -> list[np.ndarray]:
    return shingled(texts, width)[0]


def digest(grams: np.ndarray) -> tuple[int, int]:
    """Two 64-bit names of a set."""
    with np.errstate(over="ignore"):
        sums = [mixed(grams ^ np.uint64(seed)).sum(keepdims=True) + np.uint64(len(grams)) for seed in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
        return tuple(int(mixed(x).view(np.int64)[0]) for x in sums)


def leading(n: int | np.ndarray, percent: int) -> int | np.ndarray:
    """How many columns lead: n - ceil(percent / 100 * n) + 1."""
    return n - -(-n * percent // 100) + 1


def grouped(texts: list[str | None], width: int, worth: np.ndarray | None = None) -> Iterator[tuple[list[np.ndarray], list[np.ndarray], np.ndarray]]:
    """shingled() of many texts, some 200,000 characters at a time."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and size < 200_000:
            size += len(texts[end] or "")
            end += 1
        yield shingled(texts[at:end], width, worth)
        at = end


def set_batches(batches: Iterator[pa.RecordBatch], width: int, rows: int = 1000, counts: np.ndarray | None = None) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], list[tuple[int, int] | None]]]:
    """Batches of (id, text), some rows at a time, with the set and its names, None for an empty one. counts: words are
    added to these."""
    encoding.forget()
    for whole in batches:
        for at in range(0, whole.num_rows, rows):
            batch = whole.slice(at, rows)
            sets: list[np.ndarray] = []
            for own, _, words in grouped(batch.column("text").to_pylist(), width):
                sets += own
                if counts is not None:
                    counts += np.bincount(slots(words), minlength=len(counts))
            yield batch, sets, [digest(g) if len(g) else None for g in sets]


def lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(g) for g in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays).view(np.int64) if arrays else np.zeros(0, np.int64)))


def name_columns(names: list[tuple[int, int] | None]) -> list[pa.Array]:
    return [pa.array([None if x is None else x[k] for x in names], pa.int64()) for k in (0, 1)]


def whole_sets(docs: DataFrame, width: int) -> DataFrame:
    """docs (id, text) as (id, digest, check, n, grams); digest and check are the names of the set."""
    kind = docs.schema["id"].dataType.simpleString()

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets, names in set_batches(batches, width):
            yield pa.RecordBatch.from_arrays([batch.column("id"), *name_columns(names), pa.array([len(g) for g in sets], pa.int64()), lists(sets)], ["id", "digest", "check", "n", "grams"])

    return docs.mapInArrow(tidy(made), f"id {kind}, digest long, check long, n long, grams array<long>")


def bit_map(g: np.ndarray) -> bytes:
    """Which places of a ring the columns of a set take: of 64 places, or the power of two that is at least twice the set."""
    places = max(64, 1 << int(2 * len(g) - 1).bit_length())
    has = np.zeros(places, bool)
    has[(g & np.uint64(places - 1)).astype(np.int64)] = True
    return np.packbits(has).tobytes()


def folded(maps: np.ndarray, length: int) -> np.ndarray:
    """Rows of bits of larger rings as those of one of length bytes."""
    return np.bitwise_or.reduce(maps.reshape(len(maps), -1, length), axis=1)


def most_shared(a: list[bytes], b: list[bytes], n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """For pairs of sets by their bit maps and sizes, how many columns they share at most: a place that only one of them
    takes is of a column that the other lacks."""
    out = np.minimum(n_a, n_b)
    sizes = np.array([(len(x), len(y)) for x, y in zip(a, b, strict=True)]).reshape(-1, 2)
    for x, y in np.unique(sizes, axis=0):
        all_of = np.flatnonzero((sizes == (x, y)).all(axis=1))
        step = max(1, (4 << 20) // int(x + y))
        for at in range(0, len(all_of), step):
            use = all_of[at : at + step]
            p, q = (folded(np.frombuffer(b"".join([maps[k] for k in use]), np.uint8).reshape(len(use), -1), min(x, y)) for maps in (a, b))
            alone = [np.bitwise_count(u & ~v).sum(axis=1, dtype=np.int64) for u, v in ((p, q), (q, p))]
            out[use] = np.minimum(n_a[use] - alone[0], n_b[use] - alone[1])
    return out


def repeated_columns(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Columns that more than one of some rows hold, and how many hold them."""
    grams, uses = np.unique(np.concatenate(sets), return_counts=True)
    often = uses > 1
    return grams[often].view(np.int64), uses[often]


def surveyed(docs: DataFrame, width: int, chunk: int = 2_000_000) -> DataFrame:
    """docs (id, text) as rows (id, digest, check, n), and beside them rows (gram, uses), the n-grams that repeat among some
    `chunk` n-grams of one task, and rows (slot, uses), how often a task has words of a slot."""
    kind = docs.schema["id"].dataType.simpleString()

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[tuple[int, int] | None] = set()
        fields = ["id", "digest", "check", "n", "gram", "uses", "slot"]
        id_type, size = pa.null(), 0
        words = np.zeros(WORD_SLOTS, np.int64)

        def counted() -> pa.RecordBatch:
            grams, uses = repeated_columns(held)
            none = [pa.nulls(len(grams), t) for t in (id_type, pa.int64(), pa.int64(), pa.int64())]
            return pa.RecordBatch.from_arrays([*none, pa.array(grams), pa.array(uses), pa.nulls(len(grams), pa.int64())], fields)

        for batch, sets, names in set_batches(batches, width, counts=words):
            id_type = batch.column("id").type
            for name, g in zip(names, sets, strict=True):
                if len(g) and name not in seen:
                    seen.add(name)
                    held.append(g)
                    size += len(g)
            none = pa.nulls(batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), *name_columns(names), pa.array([len(g) for g in sets], pa.int64()), none, none, none], fields)
            if size >= chunk:
                yield counted()
                held, size = [], 0
                seen = set()
        if held:
            yield counted()
        if len(at := np.flatnonzero(words)):
            none = [pa.nulls(len(at), t) for t in (id_type, *[pa.int64()] * 4)]
            yield pa.RecordBatch.from_arrays([*none, pa.array(words[at]), pa.array(at)], fields)

    return docs.mapInArrow(tidy(made), f"id {kind}, digest long, check long, n long, gram long, uses long, slot long")


def led(g: np.ndarray, last: np.ndarray, k: int, odds: np.ndarray | None = None) -> np.ndarray:
    """The first k columns of a sorted row, where columns in last (sorted) come after all others, and with odds the most
    surprising ones first."""
    late = last[np.minimum(np.searchsorted(last, g), len(last) - 1)] == g if len(last) else np.zeros(len(g), bool)
    if odds is not None:
        return g[np.argsort((late.astype(np.int64) << 32) - odds, kind="stable")[:k]]
    return np.concatenate([g[~late], g[late]])[:k]


ENTRY = 24  # bytes: column, row, size of the row, whether it is tied to its group's hub
MARK = 0xFFFFFFFF  # the size in an entry that says that its column is wide
Entry = tuple[int, int, int, np.ndarray]  # row, size, tied, leading columns


def packed(column: np.ndarray, row: np.ndarray, n: np.ndarray, tied: np.ndarray) -> bytes:
    return column.tobytes() + row.tobytes() + n.tobytes() + tied.tobytes()


def unpacked(blocks: list[bytes]) -> list[np.ndarray]:
    """column, row, n, tied of all entries of some blocks."""
    counts = [len(x) // ENTRY for x in blocks]
    kinds = ((np.uint64, 0), (np.int64, 8), (np.uint32, 16), (np.uint32, 20))
    return [np.concatenate([np.zeros(0, t), *(np.frombuffer(x, t, k, at * k) for x, k in zip(blocks, counts, strict=True))]) for t, at in kinds]


def dealt(rows: Iterator[Entry], buckets: int, wide: int, most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Leading entries as blocks for each bucket of columns, some `most` entries at a time. Of a column with more than
    wide entries among these, the bucket gets a mark alone; the entries go to buckets below 0, one for each 1000 of
    them, so that no bucket gathers such a column."""

    def flush(held: list[Entry]) -> pa.RecordBatch:
        sizes = np.array([len(g) for *_, g in held])
        column = mixed(np.concatenate([g for *_, g in held]) ^ np.uint64(0x8BB84B93962EACC9))
        order = np.argsort(column)
        column = column[order]
        row, n, tied = (np.repeat(np.array([x[k] for x in held], t), sizes)[order] for k, t in ((0, np.int64), (1, np.uint32), (2, np.uint32)))
        first = np.flatnonzero(np.concatenate([[True], column[1:] != column[:-1]]))
        uses = np.diff(np.append(first, len(column)))
        crowd = np.repeat(uses > wide, uses)
        out: list[tuple[int, bytes]] = []
        for at in range(0, int(crowd.sum()), 1000):
            part = np.flatnonzero(crowd)[at : at + 1000]
            key = -1 - int(mixed(column[part[:1]] ^ row[part[:1]].view(np.uint64))[0] % np.uint64(1 << 30))
            out.append((key, packed(column[part], row[part], n[part], tied[part])))
        marks, use = column[first[uses > wide]], ~crowd
        none = np.zeros(len(marks), np.int64)
        column, row, n, tied = (np.concatenate(x) for x in ((column[use], marks), (row[use], none), (n[use], np.full(len(marks), MARK, np.uint32)), (tied[use], none.astype(np.uint32))))
        bucket = ((column >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for k in np.flatnonzero(np.diff(ends)):
            part = order[ends[k] : ends[k + 1]]
            out.append((int(k), packed(column[part], row[part], n[part], tied[part])))
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int64()), pa.array([x for _, x in out], pa.binary())], ["bucket", "block"])

    held: list[Entry] = []
    size = 0
    for x in rows:
        held.append(x)
        size += len(x[3])
        if size >= most:
            yield flush(held)
            held, size = [], 0
    if size:
        yield flush(held)


def pairs_of(column: np.ndarray, row: np.ndarray, n: np.ndarray, tied: np.ndarray, percent: int) -> np.ndarray:
    """a, b, n_a, n_b, shared of the pairs of rows that may link and share some of these columns (sorted)."""
    found = [np.zeros((4, 0), np.int64)]
    at, step = np.arange(len(column)), 0
    while len(at):
        step += 1
        at = at[: np.searchsorted(at, len(column) - step)]
        at = at[column[at] == column[at + step]]
        good = at[(100 * n[at] >= percent * n[at + step]) & (100 * n[at + step] >= percent * n[at]) & ~(tied[at] & tied[at + step])]
        found.append(np.stack([row[good], row[good + step], n[good], n[good + step]]))
    pairs = np.concatenate(found, axis=1)
    pairs = pairs[:, np.lexsort((pairs[1], pairs[0]))]
    head = np.flatnonzero(np.concatenate([[True], (pairs[:2, 1:] != pairs[:2, :-1]).any(axis=0)])) if pairs.shape[1] else np.zeros(0, int)
    return np.concatenate([pairs[:, head], np.diff(np.append(head, pairs.shape[1]))[None, :]])


def bucket_product(batches: Iterator[list[bytes]], passed: bool, wide: int, percent: int, most: int = 1_000_000, most_pairs: int = 300_000) -> Iterator[np.ndarray]:
    """A bucket's part of the product, in parts: a, b, n_a, n_b, shared of each pair of rows that share columns of up to
    wide entries; and, where shared is 0, rows a of wider columns b, with n_a 1 for rows tied to their hub. A pair may
    come in more than one part. passed: all columns are wide.

    Entries of wide columns leave as soon as `most` are held, and pairs as soon as columns give most_pairs of them, so
    memory is bounded by the bucket's narrow columns, of up to wide entries each. Columns all of whose rows are tied
    to one hub give nothing.
    """

    def crowd(row: np.ndarray, column: np.ndarray, tied: np.ndarray) -> np.ndarray:
        none = np.zeros(len(row), np.int64)
        return np.stack([row, column.view(np.int64), tied.astype(np.int64), none, none])

    marked = np.zeros(0, np.uint64)
    held: list[bytes] = []
    limit = most
    final = False
    while not final:
        if passed:
            blocks = next(batches, None)
            if final := blocks is None:
                return
            column, row, n, tied = unpacked(blocks)
            yield crowd(row, column, tied)
            continue
        while not final and sum(map(len, held)) < limit * ENTRY:
            blocks = next(batches, None)
            final = blocks is None
            held += blocks or []
        column, row, n, tied = unpacked(held)
        order = np.lexsort((n, row, column))
        column, row, n, tied = column[order], row[order], n[order], tied[order]
        new = np.concatenate([[True], (column[1:] != column[:-1]) | (row[1:] != row[:-1]) | (n[1:] != n[:-1])])[: len(column)]
        column, row, n, tied = column[new], row[new], n[new].astype(np.int64), tied[new] > 0
        first = np.flatnonzero(np.concatenate([[True], column[1:] != column[:-1]])[: len(column)])
        uses = np.diff(np.append(first, len(column)))
        if not len(first):
            continue
        over = (np.add.reduceat(n == MARK, first) > 0) | (uses > wide) | np.isin(column[first], marked)
        if over.any():
            out = np.repeat(over, uses) & (n != MARK)
            yield crowd(row[out], column[out], tied[out])
            marked = np.union1d(marked, column[first[over]])
        if not final:
            stay = np.repeat(~over, uses)
            held = [packed(column[stay], row[stay], n[stay].astype(np.uint32), tied[stay].astype(np.uint32))]
            limit = max(most, 2 * int(stay.sum()))
            continue
        light = (uses > 1) & ~over & ~np.minimum.reduceat(tied, first)
        part = np.cumsum(np.where(light, uses * (uses - 1) // 2, 0)) // most_pairs
        for k in np.unique(part[light]):
            use = np.repeat(light & (part == k), uses)
            yield pairs_of(column[use], row[use], n[use], tied[use], percent)


def may_link(n_a: Column, n_b: Column, shared: Column, percent: int) -> Column:
    """Whether a pair's overlap can reach its least value: what it shares in leading columns, plus all that follows."""
    after = lambda n: n - (n - F.ceil(n * percent / 100) + 1)
    return (100 + percent) * (shared + F.greatest(after(n_a), after(n_b))) >= percent * (n_a + n_b)


def multiplied(entries: DataFrame, wide: int, percent: int, bounded: bool = True) -> tuple[DataFrame, DataFrame]:
    """Of dealt() entries the pairs (a, b) that may link by columns of up to wide entries, and the entries (gram, row,
    tied) of wider columns. bounded: rows lead as whole sets do, so that a pair's count bounds its overlap."""

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches)
        passed = first.num_rows > 0 and first.column("bucket")[0].as_py() < 0
        blocks = (b.column("block").to_pylist() for b in chain([first], batches))
        for out in bucket_product(blocks, passed, wide, percent):
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["a", "b", "n_a", "n_b", "shared"])

    got = stored(entries.groupBy("bucket").applyInArrow(tidy(product), "a long, b long, n_a long, n_b long, shared long"), "product")
    pairs = got.where("shared > 0").groupBy("a", "b", "n_a", "n_b").agg(F.sum("shared").alias("shared"))
    if bounded:
        pairs = pairs.where(may_link(F.col("n_a"), F.col("n_b"), F.col("shared"), percent))
    return pairs.select("a", "b"), got.where("shared = 0").select(F.col("b").alias("gram"), F.col("a").alias("row"), F.col("n_a").alias("tied")).distinct()


def mapped(docs: DataFrame, width: int) -> DataFrame:
    """docs (id, text) as (id, digest, check, n, bits): whole_sets() with bit maps in place of sets."""
    kind = docs.schema["id"].dataType.simpleString()

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets, names in set_batches(batches, width):
            yield pa.RecordBatch.from_arrays([batch.column("id"), *name_columns(names), pa.array([len(g) for g in sets], pa.int64()), pa.array([bit_map(g) for g in sets], pa.binary())], ["id", "digest", "check", "n", "bits"])

    return docs.mapInArrow(tidy(made), f"id {kind}, digest long, check long, n long, bits binary")


def sifted(pairs: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b) of digests those whose bit maps don't rule a link out. Pairs of digests that two sets have stay."""

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            most = most_shared(batch.column("bits_a").to_pylist(), batch.column("bits_b").to_pylist(), n_a, n_b)
            yield batch.select(["a", "b"]).filter(pa.array((100 + percent) * most >= percent * (n_a + n_b)))

    of = lambda side: maps.select(F.col("digest").alias(side), F.col("n").alias(f"n_{side}"), F.col("bits").alias(f"bits_{side}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(tidy(sift), "a long, b long").distinct()


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b) of digests those that link, as links (a, b) of rows' ids, by exact intersection."""
    left = sets.select(F.col("digest").alias("a"), F.col("id").alias("id_a"), F.col("grams").alias("g_a"))
    right = sets.select(F.col("digest").alias("b"), F.col("id").alias("id_b"), F.col("grams").alias("g_b"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b")
    both = F.size(F.array_intersect("g_a", "g_b")).cast("long")
    return joined.where((100 + percent) * both >= percent * (F.size("g_a") + F.size("g_b")).cast("long")).select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))


def overlaps(rows: list[np.ndarray], others: list[np.ndarray], step: int = 8192) -> np.ndarray:
    """How many columns each row shares with each of others: the product of two blocks of rows, accumulated over
    blocks of the columns that both have."""
    flat = [np.concatenate([np.zeros(0, np.int64), *x]) for x in (rows, others)]
    owner = [np.repeat(np.arange(len(x)), [len(y) for y in x]) for x in (rows, others)]
    common = np.intersect1d(*flat)
    overlap = np.zeros((len(rows), len(others)), np.float32)
    order = [np.argsort(x, kind="stable") for x in flat]
    for at in range(0, len(common), step):
        block, parts = common[at : at + step], []
        for x, who, by, n in zip(flat, owner, order, (len(rows), len(others)), strict=True):
            low, high = np.searchsorted(x, [block[0]], sorter=by)[0], np.searchsorted(x, [block[-1]], "right", sorter=by)[0]
            use = by[low:high]
            place = np.searchsorted(block, x[use])
            hit = block[np.minimum(place, len(block) - 1)] == x[use]
            part = np.zeros((n, len(block)), np.float32)
            part[who[use][hit], place[hit]] = 1
            parts.append(part)
        overlap += parts[0] @ parts[1].T
    return overlap


def bit_overlaps(rows: list[bytes], others: list[bytes], step: int = 1024) -> np.ndarray:
    """How many bits each of rows shares with each of others, all of one length."""
    sides = [np.frombuffer(b"".join(x), np.uint8).reshape(len(x), -1) for x in (rows, others)]
    overlap = np.zeros((len(rows), len(others)), np.float32)
    for at in range(0, sides[0].shape[1], step):
        a, b = (np.unpackbits(x[:, at : at + step], axis=1).astype(np.float32) for x in sides)
        overlap += a @ b.T
    return overlap


def forest(a: list, b: list) -> list[tuple]:
    """A spanning forest of links (a, b)."""
    root: dict = {}

    def find(x):
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    out = []
    for x, y in zip(a, b, strict=True):
        p, q = find(x), find(y)
        if p != q:
            root[p] = q
            out.append((x, y))
    return out


MEMBER = "row long, grp long, digest long, id {kind}, n long, inside long, tied long, bits binary, outside array<long>, hub_id {kind}, linked boolean"


def arrays(column: pa.ListArray) -> list[np.ndarray]:
    return [x.values.to_numpy(zero_copy_only=False) for x in column]


def keyed(grp: int, grams: np.ndarray) -> np.ndarray:
    """The columns of a row of a group, sorted; equal n-grams of different groups are different columns."""
    with np.errstate(over="ignore"):
        return np.sort(mixed(grams.view(np.uint64) ^ mixed(np.array([grp], np.int64).view(np.uint64))))


def group_columns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int, int, np.ndarray]]:
    """row, n, inside, tied and columns of each member."""
    for batch in batches:
        fields = [batch.column(c).to_pylist() for c in ("row", "n", "inside", "tied", "grp")]
        for row, n, inside, tied, grp, grams in zip(*fields, arrays(batch.column("outside")), strict=True):
            yield row, n, inside, tied, keyed(grp, grams)


def repeated_in(members: DataFrame, chunk: int = 2_000_000) -> DataFrame:
    """(gram, uses) of surveyed() for the columns of members."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for *_, g in group_columns(batches):
            held.append(g)
            size += len(g)
            if size >= chunk:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in repeated_columns(held)], ["gram", "uses"])
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in repeated_columns(held)], ["gram", "uses"])

    return members.select("row", "grp", "n", "inside", "tied", "outside").mapInArrow(tidy(made), "gram long, uses long")


def led_entries(members: DataFrame, last: np.ndarray, buckets: int, wide: int, percent: int) -> DataFrame:
    """dealt() entries of members. Of the columns outside, similar rows of a group share at least 1, and at least what
    the least overlap has beyond all that is inside."""

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((row, n, tied, led(g, last, len(g) - max(1, -(-n * percent // 100) - inside) + 1)) for row, n, inside, tied, g in group_columns(batches) if len(g))
        yield from dealt((x for x in rows if len(x[3])), buckets, wide)

    return members.select("row", "grp", "n", "inside", "tied", "outside").mapInArrow(tidy(lead), "bucket long, block binary")


def regrouped(members: DataFrame, crowded: DataFrame, percent: int) -> DataFrame:
    """Members of the groups that the rows of crowded columns (gram, row, tied) form.

    Rows of a column that differ too much in size are in different groups: each is in its class of sizes and the next,
    and linked rows have at most one class between them. The hub of a column and class is the row that is in most of
    these. A member keeps as bits what it shares with the hubs so far. It is tied if it links with the hub, or the
    hub was tied before and so was the member: tied rows are of one component.
    """
    kind = members.schema["id"].dataType.simpleString()
    mixed_up = crowded.groupBy("gram").agg(F.min("tied").alias("least")).where("least = 0").select("gram")
    size_class = F.floor(F.log(F.col("n").cast("double")) / (math.log(100 / percent) * 1.0001 + 1e-9)).cast("long")
    met = crowded.join(mixed_up, "gram").join(members.select("row", "n"), "row").select("row", "gram", F.explode(F.array(size_class, size_class + 1)).alias("class"))
    degree = met.groupBy("row").agg(F.count("*").alias("degree"))
    hubs = met.join(degree, "row").groupBy("gram", "class").agg(F.max_by("row", F.struct("degree", "row")).alias("hub"))
    joins = stored(met.join(hubs, ["gram", "class"]).select("hub", "row").distinct(), "hubs")
    hub = members.select(F.col("row").alias("hub"), F.col("id").alias("hub_id"), F.col("n").alias("hub_n"), F.col("tied").alias("hub_tied"), F.col("bits").alias("hub_bits"), F.col("outside").alias("hub_outside"))
    own = members.select("row", "digest", "id", "n", "inside", "tied", "bits", "outside")

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                get = lambda c: batch.column(c).to_pylist()  # noqa: B023, E731
                bits, left, inside, linked, tied = [], [], [], [], []
                for n, was_inside, was_tied, was, hub_n, hub_tied, hub_bits, mine, its in zip(*map(get, ("n", "inside", "tied", "bits", "hub_n", "hub_tied", "hub_bits")), arrays(batch.column("outside")), arrays(batch.column("hub_outside")), strict=True):
                    has = np.isin(its, mine)
                    old = np.unpackbits(np.frombuffer(was, np.uint8) & np.frombuffer(hub_bits, np.uint8)).sum()
                    bits.append(was + np.packbits(has).tobytes())
                    left.append(mine[~np.isin(mine, its)])
                    inside.append(was_inside + int(has.sum()))
                    linked.append(bool((100 + percent) * (int(old) + int(has.sum())) >= percent * (n + hub_n)))
                    tied.append(int(linked[-1] or (was_tied and hub_tied)))
                hubs_, digests = np.array(get("hub"), np.int64), np.array(get("digest"), np.int64)
                with np.errstate(over="ignore"):
                    row = mixed(mixed(hubs_.view(np.uint64)) ^ digests.view(np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row), pa.array(hubs_), batch.column("digest"), batch.column("id"), batch.column("n"), pa.array(inside, pa.int64()), pa.array(tied, pa.int64()), pa.array(bits, pa.binary()), lists(left), batch.column("hub_id"), pa.array(linked)],
                    ["row", "grp", "digest", "id", "n", "inside", "tied", "bits", "outside", "hub_id", "linked"],
                )

    return stored(joins.join(own, "row").join(hub, "hub").mapInArrow(tidy(strip), MEMBER.format(kind=kind)), "members")


def block_products(members: DataFrame, percent: int, block: int) -> DataFrame:
    """Links (a, b) of ids between rows of a group whose bits may suffice for a link and that aren't both tied.

    Rows are compared by bits and the columns outside, never by whole sets. Rows that aren't tied are dealt into
    blocks of about `block`, all rows likewise, and each block of the first is multiplied with each of all. Rows whose
    bits or size rule out every partner in the group are left out.
    """
    kind = members.schema["id"].dataType.simpleString()
    close = members.where(F.col("inside") * 100 >= F.col("n") * percent)
    suffices = lambda inside, n, most, least: F.least(inside, most) * (100 + percent) >= (n + least) * percent
    free = F.col("tied") == 0
    group = close.groupBy("grp").agg(F.max("inside").alias("most"), F.min("n").alias("least"), F.max(F.when(free, F.col("inside"))).alias("most_free"), F.min(F.when(free, F.col("n"))).alias("least_free")).where("most_free is not null")
    rows = close.join(group, "grp").withColumn("other", free & suffices(F.col("inside"), F.col("n"), F.col("most"), F.col("least")))
    rows = rows.where(F.col("other") | suffices(F.col("inside"), F.col("n"), F.col("most_free"), F.col("least_free")))
    rows = stored(rows.select("grp", "row", "id", "n", "other", "bits", "outside"), "close")
    if rows.where("other").isEmpty():
        return rows.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)
    blocks = rows.groupBy("grp").agg(F.ceil(F.count("*") / block).alias("blocks"), F.ceil(F.count_if("other") / block).alias("others"), F.count("*").alias("k")).where("others > 0 and k > 1").drop("k")
    rows = rows.join(blocks, "grp")
    own = lambda n: F.pmod(F.xxhash64("row"), F.col(n))
    numbers = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    keep = ("grp", "id", "n", "bits", "outside")
    first = rows.where("other").select(*keep, own("others").alias("at"), F.explode(numbers("blocks")).alias("col"), F.lit(True).alias("other"))
    whole = rows.select(*keep, F.explode(numbers("others")).alias("at"), own("blocks").alias("col"), F.lit(False).alias("other"))

    def multiply(table: pa.Table) -> pa.Table:
        side = table.column("other").to_numpy()
        ids, bits, n = table.column("id").to_pylist(), table.column("bits").to_pylist(), table.column("n").to_numpy()
        outside = arrays(table.column("outside").combine_chunks())
        at = [np.flatnonzero(side), np.flatnonzero(~side)]
        links: list[tuple] = []
        if len(at[0]) and len(at[1]):
            both = overlaps(*[[outside[k] for k in x] for x in at]) + bit_overlaps(*[[bits[k] for k in x] for x in at])
            x, y = np.nonzero((100 + percent) * both >= percent * (n[at[0]][:, None] + n[at[1]][None, :]))
            links = forest([ids[at[0][k]] for k in x], [ids[at[1][k]] for k in y])
        kinds = table.schema.field("id").type
        return pa.table({"a": pa.array([a for a, _ in links], kinds), "b": pa.array([b for _, b in links], kinds)})

    return stored(first.unionByName(whole).groupBy("grp", "at", "col").applyInArrow(multiply, f"a {kind}, b {kind}"), "block-links")


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, wide: int = 64, block: int = 256, max_frequent: int = 300_000, max_broadcast: int = 500_000, bucket_entries: int = 250_000) -> DataFrame:
    """One row for each row of docs: id_col, n_shingles (size of its set), component_id (the smallest id that links
    reach, its own included), and copy_of (the smallest id with the same set).

    Words are runs of characters other than ASCII white space, A-Z lower-cased; a set holds the distinct runs of width
    words of the whole text, or all words as one where there are fewer. A null, empty or blank text has an empty set
    and links with nothing: it is its own component. Rows of a null id take no part and have no component. Rows that
    repeat an id are one node of the graph. Other columns are ignored.
    """
    ship(docs.sparkSession)
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    survey = stored(surveyed(source, width), "survey")
    rows = survey.where("uses is null").select("id", "digest", "check", "n")
    usable = rows.where("digest is not null and id is not null")
    classes = stored(usable.groupBy("digest", "check").agg(F.min("id").alias("copy_of"), F.first("n").alias("n")), "classes")

    def most_used(uses: DataFrame) -> np.ndarray:
        """Columns that come last. The order is free, so those beyond the bound may stay where their hash puts them. Of
        a column that is just wide tasks may see an eighth of the uses repeat."""
        often = uses.groupBy("gram").agg(F.sum("uses").alias("uses")).where(F.col("uses") > wide // 8).orderBy(F.desc("uses"), "gram").limit(max_frequent)
        return np.sort(often.select("gram").toArrow().column("gram").to_numpy().view(np.uint64))

    def buckets_of(entries: Column, of: DataFrame) -> int:
        return max(12, int(of.agg(F.sum(entries)).first()[0] or 0) // bucket_entries)

    first = most_used(survey.where("gram is not null").select("gram", "uses"))
    counts = np.zeros(WORD_SLOTS, np.int64)
    for slot, uses in survey.where("slot is not null").groupBy("slot").agg(F.sum("uses").alias("uses")).collect():
        counts[slot] = uses
    worth = surprise(counts)
    n_first = buckets_of(F.col("n") - F.ceil(F.col("n") * percent / 100) + 1, classes)

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def entries() -> Iterator[Entry]:
            encoding.forget()
            seen: set[tuple[int, int]] = set()
            for batch in batches:
                keys, at = batch.column("id").is_valid().to_pylist(), 0
                for sets, rare, _ in grouped(batch.column("text").to_pylist(), width, worth):
                    for key, g, odds in zip(keys[at : at + len(sets)], sets, rare, strict=True):
                        if key and len(g) and (name := digest(g)) not in seen:
                            seen.add(name)
                            yield name[0], len(g), 0, led(g, first, leading(len(g), percent), odds)
                    at += len(sets)

        yield from dealt(entries(), n_first, wide)

    pairs, heavy = multiplied(source.mapInArrow(tidy(lead), "bucket long, block binary"), wide, percent)
    found = [stored(pairs, "pairs")]
    hot = stored(heavy.select(F.col("row").alias("digest")).distinct(), "hot")

    def sets_of(names: DataFrame, made_by: Callable[[DataFrame, int], DataFrame] = whole_sets) -> DataFrame:
        """(id, digest, n, grams), or as made_by has it, of the first document of each set."""
        keys = stored(classes.join(names, "digest", "left_semi").select(F.col("copy_of").alias("id"), "digest", "check"), "chosen")
        made = made_by(source.join(small_side(keys.select("id").distinct(), max_broadcast), "id"), width)
        return made.where("digest is not null").join(small_side(keys, max_broadcast), ["id", "digest", "check"]).dropDuplicates(["digest", "check"]).drop("check")

    none = F.lit(0).cast("long")
    members = stored(sets_of(hot).select(F.col("digest").alias("row"), none.alias("grp"), "digest", "id", "n", none.alias("inside"), none.alias("tied"), F.lit(b"").alias("bits"), F.col("grams").alias("outside"), F.lit(None).cast(kind).alias("hub_id"), F.lit(False).alias("linked")), "hot-sets")
    links = [source.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)]
    level = 0
    while True:  # each round takes the columns of its hubs off, crowded ones among them, so it ends
        last = most_used(repeated_in(members))
        n_buckets = buckets_of(F.greatest(none, F.size("outside") - F.greatest(none + 1, F.ceil(F.col("n") * percent / 100) - F.col("inside")) + 1), members)
        more, crowded = multiplied(led_entries(members, last, n_buckets, wide, percent), wide, percent, level == 0)
        if level:
            of = lambda side: members.select(F.col("row").alias(side), F.col("digest").alias(f"digest_{side}"))  # noqa: B023, E731
            more = more.join(of("a"), "a").join(of("b"), "b").select(F.col("digest_a").alias("a"), F.col("digest_b").alias("b"))
        found.append(stored(more, "pairs"))
        crowded = stored(crowded, "crowded")
        if crowded.isEmpty():
            break
        members, level = regrouped(members, crowded, percent), level + 1
        links.append(members.where("linked").select(F.col("id").alias("a"), F.col("hub_id").alias("b")))
        links.append(block_products(members, percent, block))

    links = functools.reduce(DataFrame.unionByName, links)
    pairs = stored(functools.reduce(DataFrame.unionByName, found).distinct(), "pairs")
    maps = stored(sets_of(pairs.select(F.explode(F.array("a", "b")).alias("digest")).distinct(), mapped), "maps")
    pairs = stored(sifted(pairs, maps, percent), "pairs")
    ends = pairs.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(pairs.select(F.col("b").alias("x"), F.col("a").alias("y")))
    popular = ends.groupBy("x").agg(F.count("*").alias("degree"))
    best = ends.join(popular.withColumnsRenamed({"x": "y"}), "y").groupBy("x").agg(F.max_by("y", F.struct("degree", "y")).alias("y"))
    one = best.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    sets = stored(sets_of(ends.select(F.col("x").alias("digest")).distinct()), "sets")

    links = stored(verified(one, sets, percent).unionByName(links), "links-1")
    label = components(links)
    labels = stored(sets.select("digest", "id").join(label.withColumnRenamed("node", "id"), "id", "left").select("digest", F.coalesce("component", "id").alias("label")), "labels")
    of = lambda side: labels.select(F.col("digest").alias(side), F.col("label").alias(f"label_{side}"))
    rest = pairs.join(of("a"), "a").join(of("b"), "b").where("label_a <> label_b").select("a", "b").distinct()
    final = components(links.unionByName(verified(rest, sets, percent)))

    whole = classes.join(final.withColumnRenamed("node", "copy_of"), "copy_of", "left").select("digest", "check", "copy_of", F.coalesce("component", "copy_of").alias("component"))
    out = rows.join(whole, ["digest", "check"], "left")
    own = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id"), F.when(F.col("id").isNotNull(), F.coalesce("copy_of", "id")).alias("copy_of"))
