"""Ranked lexical search: a forward index in blocks of documents, pruned by the most that a block can score."""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator, Sequence
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeloom.llm.text import ascii_lower, ship, stored, tidy

#: Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower case.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The same over UTF-8: what a byte becomes. Bytes of characters beyond ASCII are no ASCII bytes, so they stay.
FOLD = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)).lower()
INDEX = "block long, doc_id long, n long, terms array<int>, counts array<int>"
Batches = Iterator[pa.RecordBatch]


def text_terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


class Queries(NamedTuple):
    """A set of queries: the ids of their items, their terms (number of the term for each use, all queries in a row), where
    a query's begin, and the terms' numbers. All have terms."""

    items: list[Any]
    uses: np.ndarray
    starts: np.ndarray
    vocabulary: dict[bytes, int]

    def weighted(self, weights: np.ndarray) -> np.ndarray:
        return weights[self.uses]

    def some(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the uses of some of the queries, and where each of these begins among them."""
        ends = np.append(self.starts[1:], len(self.uses))
        sizes = ends[which] - self.starts[which]
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        return np.arange(sizes.sum()) - np.repeat(starts - self.starts[which], sizes), starts


def numbered(rows: Sequence[tuple[Any, str | None]]) -> Queries:
    items, uses, starts, vocabulary = [], [], [], {}
    for item, text in rows:
        if found := text_terms(text):
            items.append(item)
            starts.append(len(uses))
            uses += [vocabulary.setdefault(t, len(vocabulary)) for t in found]
    return Queries(items, np.array(uses, np.int64), np.array(starts, np.int64), vocabulary)


def forward_index(docs: DataFrame, vocabulary: dict[bytes, int], block_docs: int) -> DataFrame:
    """INDEX rows of docs (doc_id, text) that have terms: their number of terms, and of those in the vocabulary how often
    each is used. A block is a run of block_docs documents as the table stores them."""

    def indexed(batches: Batches) -> Batches:
        from pyspark import TaskContext

        block, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            rows: dict[str, list] = {"block": [], "doc_id": [], "n": [], "terms": [], "counts": []}
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = text_terms(text)
                if not found:
                    continue
                used: dict[int, int] = {}
                for t in map(vocabulary.get, found):
                    if t is not None:
                        used[t] = used.get(t, 0) + 1
                if held == block_docs:
                    block, held = block + 1, 0
                held += 1
                for k, v in zip(rows, (block, doc, len(found), list(used), list(used.values())), strict=True):
                    rows[k].append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), kinds, strict=True)], list(rows))

    return stored(docs.mapInArrow(tidy(indexed), INDEX), "forward-index")


def statistics(index: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with terms, all their terms, and for each term of the vocabulary the documents that hold it. A task
    sends a row for each term that it met."""

    def summed(batches: Batches) -> Batches:
        held, n, total = np.zeros(n_terms, np.int64), 0, 0
        for batch in batches:
            held += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=n_terms)
            n, total = n + batch.num_rows, total + (pc.sum(batch.column("n")).as_py() or 0)
        full = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-2, -1], full]), pa.int64()), pa.array(np.concatenate([[n, total], held[full]]), pa.int64())], ["term", "n"])

    got = {r["term"]: r["s"] for r in index.select("n", "terms").mapInArrow(summed, "term long, n long").groupBy("term").agg(F.sum("n").alias("s")).collect()}  # the vocabulary at most
    return got.get(-2, 0), got.get(-1, 0), np.array([got.get(t, 0) for t in range(n_terms)], np.int64)


class Block(NamedTuple):
    """Documents of one block that follow one another: ids (null at the end of an order), and the postings: document, term and
    impact, which a query's weight multiplies."""

    number: int
    ids: list[int | None]
    doc: np.ndarray
    term: np.ndarray
    impact: np.ndarray

    def maxima(self) -> tuple[np.ndarray, np.ndarray]:
        """The terms of the block and the largest impact of each."""
        order = np.lexsort((self.impact, self.term))
        last = np.flatnonzero(np.append(np.diff(self.term[order]) != 0, True)) if len(order) else order
        return self.term[order][last], self.impact[order][last]


class Corpus(NamedTuple):
    """What an impact needs of all documents."""

    n: int
    total: int

    def impacts(self, counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        m = 25 + (75 * sizes * self.n) // self.total
        return (1_000_000_000 * counts) // (1000 * counts + 8 * m)

    def weights(self, holders: np.ndarray) -> np.ndarray:
        return np.array([math.floor(1000 * math.log((2 * self.n + 2) / (2 * int(df) + 1))) for df in holders], np.int64)


def blocks(batches: Batches, corpus: Corpus) -> Iterator[Block]:
    """Blocks from INDEX rows, one at a time. A block that a task has only part of is one of its own there."""

    def made(number: int, parts: list[pa.RecordBatch]) -> Block:
        rows = pa.Table.from_batches(parts).combine_chunks()
        lists = rows.column("terms").combine_chunks()
        per = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        counts = rows.column("counts").combine_chunks().flatten().to_numpy().astype(np.int64)
        sizes = np.repeat(rows.column("n").to_numpy().astype(np.int64), per)
        return Block(number, rows.column("doc_id").to_pylist(), np.repeat(np.arange(len(per)), per), lists.flatten().to_numpy().astype(np.int64), corpus.impacts(counts, sizes))

    number, parts = -1, []
    for batch in batches:
        if not batch.num_rows:
            continue
        of = batch.column("block").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
        for a, b in zip(edges, edges[1:], strict=False):
            if parts and of[a] != number:
                yield made(number, parts)
                parts = []
            number = int(of[a])
            parts.append(batch.slice(a, b - a))
    if parts:
        yield made(number, parts)


def block_maxima(index: DataFrame, corpus: Corpus) -> DataFrame:
    """A row for each block: block, terms and tops, the largest impact of each term."""

    def reduced(batches: Batches) -> Batches:
        for b in blocks(batches, corpus):
            terms, tops = b.maxima()
            yield pa.RecordBatch.from_pydict({"block": pa.array([b.number], pa.int64()), "terms": pa.array([terms], pa.list_(pa.int32())), "tops": pa.array([tops], pa.list_(pa.int64()))})

    return stored(index.mapInArrow(tidy(reduced), "block long, terms array<int>, tops array<long>"), "block-maxima")


def bounds(terms: np.ndarray, tops: np.ndarray, queries: Queries, weights: np.ndarray, n_terms: int) -> np.ndarray:
    """The most that a document of a block can score, for each query."""
    dense = np.zeros(n_terms, np.int64)
    dense[terms] = tops
    return np.add.reduceat(dense[queries.uses] * queries.weighted(weights), queries.starts)


class Best:
    """The k best of each query that a task has met: higher scores first, then smaller ids, null last."""

    def __init__(self, k: int, least: np.ndarray):
        self.k, self.least, self.heaps = k, least.copy(), [[] for _ in least]

    def offer(self, query: int, score: int, id_: int | None) -> None:
        heap, entry = self.heaps[query], (score, id_ is not None, -(id_ or 0))
        if len(heap) < self.k:
            heapq.heappush(heap, entry)
        elif entry > heap[0]:
            heapq.heapreplace(heap, entry)
        if len(heap) == self.k:
            self.least[query] = max(self.least[query], heap[0][0])

    def rows(self, name: str, value: str) -> pa.RecordBatch:
        found = [(q, -i if there else None, s) for q, heap in enumerate(self.heaps) for s, there, i in heap]
        q, i, s = zip(*found, strict=True) if found else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(i, pa.int64()), pa.array(s, pa.int64())], ["q", name, value])


def best_of(rows: DataFrame, made: Callable[[Batches], Batches], name: str, value: str, k: int) -> DataFrame:
    """The k first rows of each query, of the k that each task has: q, name, value and rank."""
    got = rows.mapInArrow(tidy(made), f"q long, {name} long, {value} long")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.col(value).desc(), F.col(name).asc_nulls_last()))
    return got.withColumn("rank", rank).where(F.col("rank") <= k)


def ranked(index: DataFrame, queries: Queries, weights: np.ndarray, corpus: Corpus, k: int, least: np.ndarray) -> DataFrame:
    """The k best documents of each query with at least its score in least: q, doc_id, score, rank. A block is scored
    for the queries whose bound reaches the threshold there: least, or what the task's own k-th best has by then."""
    n_terms = len(queries.vocabulary)

    def scored(batches: Batches) -> Batches:
        best, weighted = Best(k, np.maximum(least, 1)), queries.weighted(weights)
        for b in blocks(batches, corpus):
            terms, tops = b.maxima()
            which = np.flatnonzero(bounds(terms, tops, queries, weights, n_terms) >= best.least)
            if not len(which):
                continue
            places, starts = queries.some(which)
            dense = np.zeros((len(b.ids), n_terms), np.int64)
            dense[b.doc, b.term] = b.impact
            scores = np.add.reduceat(dense[:, queries.uses[places]] * weighted[places], starts, axis=1)
            for d, j in zip(*np.nonzero(scores >= best.least[which]), strict=True):
                if scores[d, j] >= best.least[which[j]]:
                    best.offer(int(which[j]), int(scores[d, j]), b.ids[d])
        yield best.rows("doc_id", "score")

    return best_of(index, scored, "doc_id", "score", k)


def promising(maxima: DataFrame, queries: Queries, weights: np.ndarray, k: int, least: np.ndarray) -> DataFrame:
    """The k blocks with the highest bounds of each query, none below its threshold: q, block, bound, rank."""
    n_terms = len(queries.vocabulary)

    def bounded(batches: Batches) -> Batches:
        best = Best(k, np.maximum(least, 1))
        for batch in batches:
            for block, terms, tops in zip(batch.column("block").to_pylist(), batch.column("terms"), batch.column("tops"), strict=True):
                most = bounds(terms.values.to_numpy(), tops.values.to_numpy(), queries, weights, n_terms)
                for q in np.flatnonzero(most >= best.least):
                    best.offer(int(q), int(most[q]), block)
        yield best.rows("block", "bound")

    return best_of(maxima, bounded, "block", "bound", k)


def search_set(docs: DataFrame, queries: Queries, k: int, block_docs: int, waves: Sequence[int]) -> DataFrame:
    """search() of one set of queries: q, doc_id, score, rank."""
    spark = docs.sparkSession
    empty = spark.createDataFrame([], "q long, doc_id long, score long, rank int")
    if not queries.items:
        return empty
    index = forward_index(docs, queries.vocabulary, block_docs)
    n, total, holders = statistics(index, len(queries.vocabulary))
    if not n:
        return empty
    corpus = Corpus(n, total)
    weights, least = corpus.weights(holders), np.zeros(len(queries.items), np.int64)
    maxima = block_maxima(index, corpus)
    for size in waves:
        seeds = promising(maxima, queries, weights, size, least).select("block").distinct()  # queries x size rows
        there = index.join(F.broadcast(seeds), "block", "left_semi")
        for r in ranked(there, queries, weights, corpus, k, least).where(F.col("rank") == k).collect():  # queries rows
            least[r["q"]] = max(least[r["q"]], r["score"])
    return ranked(index, queries, weights, corpus, k, least)


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", block_docs: int = 64, waves: Sequence[int] = (4, 32), queries_at_once: int = 1024, uses_at_once: int = 200_000) -> DataFrame:
    """For each row of items the k documents with the highest scores above 0: item_id_col, rank (from 1), doc_id, score.

    A term's weight is floor(1000 ln((2N+2)/(2df+1))), a document's impact of it (10^9 tf) div (1000 tf + 8m), with m
    = 25 + (75 n N) div L; N documents have terms, L in all, n this one. A score sums weight times impact over the
    item's terms, repeats included, in 64-bit integers. Equal scores go by ascending id, null last.

    Queries are taken in sets of about queries_at_once rows and uses_at_once terms, which bounds what the driver and
    each task hold of them. Of a set's terms a forward index is stored once, in blocks of block_docs documents as they
    stand in the table, with the largest impact of each term in a block. Blocks are sorted by each query's bound on
    them; the first of each wave are scored and raise the query's threshold, the k-th best score so far, and then
    what is left is scored as far as a bound reaches it. The last pass reads the index once and shuffles k rows for each query
    and task. Block sizes and waves decide what that costs, never what it finds.

    Ids of documents are 64-bit integers. Rows that repeat an id are documents of their own, as are items. Documents
    and items without terms (null, empty) match nothing; no documents or items give no rows. Other columns don't matter.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    asked = stored(items.select(F.col(item_id_col).alias("item"), F.col(item_text_col).alias("text")).withColumn("uses", term_count(F.col("text"))).where("uses > 0"), "queries")
    size = asked.agg(F.count("*").alias("n"), F.sum("uses").alias("uses")).first()
    n_sets = max(1, -(-size["n"] // queries_at_once), -(-(size["uses"] or 0) // uses_at_once))
    asked = asked.withColumn("set", F.pmod(F.xxhash64("item", "text"), F.lit(n_sets)))
    kind, out = asked.schema["item"].dataType, None
    for s in range(n_sets):
        queries = numbered([(r["item"], r["text"]) for r in asked.where(F.col("set") == s).orderBy("item", "text").collect()])
        names = docs.sparkSession.createDataFrame(list(enumerate(queries.items)), f"q long, item {kind.simpleString()}")
        found = search_set(rows, queries, k, block_docs, waves).join(F.broadcast(names), "q")
        found = found.select(F.col("item").alias(item_id_col), "rank", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    return out


def term_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(ascii_lower(text), F.lit(TERM)), F.lit(0)).cast("long")
