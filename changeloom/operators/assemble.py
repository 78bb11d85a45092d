"""Transactions from an ordered stream of decoded messages."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeloom.functions.cells import change_bytes, decoded, logged_bytes
from changeloom.model import CHANGE_MESSAGES
from changeloom.operators.scale import joined, running_sum, stored


class Assembled(NamedTuple):
    """events: a row for each change of a kept transaction. transactions: a row for each committed one, kept or too
    large, empty ones too. outside: changes that stand in no transaction, which are an error of the stream."""

    events: DataFrame
    transactions: DataFrame
    outside: DataFrame


def relevant(messages: DataFrame, tables: DataFrame | None = None) -> DataFrame:
    """Messages that count: truncate, type, origin and unknown ones go. With tables (schema, table), changes of other
    relations go as well, as a publication has it."""
    kept = messages.where(F.col("msg").isin("R", "B", "C", *CHANGE_MESSAGES))
    if tables is None:
        return kept
    named = kept.where("msg = 'R'").select("slot", "rel_id", F.col("rel.schema").alias("schema"), F.col("rel.table").alias("table"))
    wanted = named.join(tables.select("schema", "table").distinct(), ["schema", "table"], "left_semi").select("slot", "rel_id").distinct()
    by_relation = F.col("msg").isin("R", *CHANGE_MESSAGES)
    return kept.where(~by_relation).unionByName(joined(kept.where(by_relation), wanted, ["slot", "rel_id"], "left_semi"))


def relations(messages: DataFrame) -> DataFrame:
    """Versions of each relation: slot, rel_id, rel, since and until, the positions between which it is the newest."""
    newer = Window.partitionBy("slot", "rel_id").orderBy("seq")
    return messages.where("msg = 'R'").select("slot", "rel_id", "rel", F.col("seq").alias("since"), F.lead("seq").over(newer).alias("until"))


def with_relation(changes: DataFrame, messages: DataFrame, max_broadcast: int = 20_000, width: int = 10_000_000) -> DataFrame:
    """As-of join: changes with rel, the newest version of their relation before them; null where there is none.

    Up to max_broadcast versions go to every task. More are joined by slot, relation and stretch of width positions,
    each version standing in every stretch that it spans, so that a busy relation is no group of its own.
    """
    # Other names throughout: both sides may come from one table.
    versions = relations(messages).toDF("_slot", "_rel_id", "_rel", "_since", "_until")
    on = F.col("slot").eqNullSafe(F.col("_slot")) & (F.col("rel_id") == F.col("_rel_id")) & (F.col("seq") >= F.col("_since")) & (F.col("_until").isNull() | (F.col("seq") < F.col("_until")))
    changes = changes.drop("rel")
    if versions.limit(max_broadcast + 1).count() <= max_broadcast:
        both = changes.join(F.broadcast(versions), on, "left")
    else:
        ends = changes.groupBy(F.col("slot").alias("_end_slot")).agg(F.max("seq").alias("_end"))
        spans = versions.join(ends, F.col("_slot").eqNullSafe(F.col("_end_slot"))).where("_since <= _end")
        last = F.floor(F.coalesce("_until", "_end") / width)
        spans = spans.select(*versions.columns, F.explode(F.sequence(F.floor(F.col("_since") / width), last)).alias("_stretch"))
        both = changes.join(spans, on & (F.floor(F.col("seq") / width) == F.col("_stretch")), "left").drop("_stretch")
    return both.withColumn("rel", F.col("_rel")).drop("_slot", "_rel_id", "_rel", "_since", "_until")


class Parts(NamedTuple):
    """Of the messages between two marks (begins and commits), and from one mark on: `stretches` has a row for each part and
    stretch of positions that it has messages in, `whole` a row for each part. Both are numbers only, and stored."""

    stretches: DataFrame
    whole: DataFrame
    changes: DataFrame


def parts_of(kept: DataFrame, width: int) -> Parts:
    """A part has the number of marks of its slot up to it, tx_no, so each begins with its mark, but for what comes before
    the first. Sizes are taken beside the tuples; what is dealt out by stretches and summed is a row of numbers."""
    is_change, is_begin, is_commit = F.col("msg").isin(*CHANGE_MESSAGES), F.col("msg") == "B", F.col("msg") == "C"
    rows = with_relation(kept.where("msg <> 'R'"), kept)
    sized = F.when(is_change, logged_bytes(F.col("before"), F.col("after"), F.col("rel.columns")))
    rows = rows.select("slot", "seq", "msg", "xid", "lsn", "commit_ts", "rel_id", "wal_start", sized.alias("bytes"))
    rows = running_sum(rows, F.when(is_change, 0).otherwise(1), "tx_no", ["slot"], "seq")
    stretches = stored(rows.groupBy("slot", "tx_no", F.floor(F.col("seq") / width).alias("stretch")).agg(
        F.max(F.when(is_begin, F.col("xid"))).alias("xid"), F.max(F.when(~is_change, F.col("commit_ts"))).alias("ts"), F.max(F.when(~is_change, F.col("lsn"))).alias("lsn"),
        F.count_if(is_begin).alias("begins"), F.count_if(is_commit).alias("commits"), F.count_if(is_change).alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.min("seq").alias("first"), F.max("seq").alias("last"), F.max(F.when(~is_change, F.col("seq"))).alias("mark"),
    ), "parts")
    most = [F.max(c).alias(c) for c in ("xid", "ts", "lsn", "mark")]
    whole = stretches.groupBy("slot", "tx_no").agg(*most, F.sum("begins").alias("begins"), F.sum("commits").alias("commits"), F.sum("n").alias("n_events"), F.sum("bytes").alias("n_bytes"))
    return Parts(stretches, whole, rows.where(is_change))


def outside_of(changes: DataFrame, spans: DataFrame, width: int) -> DataFrame:
    """Of rows by slot and seq those that no span (slot, stretch, first, last) has; spans go to every task."""
    other = F.broadcast(spans.select(F.col("slot").alias("_slot"), F.col("stretch").alias("_stretch"), "first", "last"))
    on = F.col("slot").eqNullSafe(F.col("_slot")) & (F.floor(F.col("seq") / width) == F.col("_stretch")) & F.col("seq").between(F.col("first"), F.col("last"))
    return changes.join(other, on, "left_anti")


def events_of(kept: DataFrame, parts: Parts, transactions: DataFrame, width: int, max_broadcast: int) -> DataFrame:
    """The changes of transactions that aren't too large, decoded.

    Changes are dealt out once, by stretches of positions, together with a row for each mark that tells what begins
    there; a stretch that begins within a part is told which, and how many of its changes come before. So a
    transaction is never gathered in one place, and needs no exchange of its own. What is too large is left out
    before that where it stands in no more than max_broadcast parts of stretches, and in any case after it.
    """
    fields = F.struct(F.col("tx_no").alias("tx_no"), F.col("xid").alias("xid"), F.col("begin_ts").alias("ts"), F.col("commit_lsn").alias("lsn"))
    named = transactions.where("not oversized").select("slot", "tx_no", fields.alias("tx"))
    marks = joined(parts.whole.where("mark is not null").select("slot", "tx_no", F.col("mark").alias("seq")), named, ["slot", "tx_no"], "left").select("slot", "seq", "tx", F.lit(True).alias("is_mark"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("slot", "tx_no").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inner = parts.stretches.withColumn("before_n", before).where("begins + commits = 0")  # its mark stands in a stretch before
    carried = joined(inner.select("slot", "tx_no", "stretch", "before_n"), named, ["slot", "tx_no"]).select(F.struct("slot").alias("_by"), F.col("stretch").alias("_stretch"), F.struct("tx", F.col("before_n").alias("n")).alias("carried"))

    is_change = F.col("msg").isin(*CHANGE_MESSAGES)
    changes = kept.where(is_change).select("slot", "seq", "msg", "rel_id", "wal_start", "before", "after")
    large = joined(parts.stretches, transactions.where("oversized").select("slot", "tx_no"), ["slot", "tx_no"], "left_semi")
    if 0 < large.limit(max_broadcast + 1).count() <= max_broadcast:
        changes = outside_of(changes, large, width)
    rows = changes.unionByName(marks, allowMissingColumns=True).withColumns({"_by": F.struct("slot"), "_stretch": F.floor(F.col("seq") / width), "is_mark": F.coalesce("is_mark", F.lit(False))})
    upto = Window.partitionBy("_by", "_stretch").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_n", F.count_if(~F.col("is_mark")).over(upto))
    rows = rows.withColumn("_last", F.last(F.when(F.col("is_mark"), F.struct("tx", F.col("_n").alias("n"))), ignorenulls=True).over(upto))
    rows = rows.where("not is_mark").join(carried, ["_by", "_stretch"], "left")
    tx = F.when(F.col("_last").isNotNull(), F.col("_last.tx")).otherwise(F.col("carried.tx"))
    ordinal = F.when(F.col("_last").isNotNull(), F.col("_n") - F.col("_last.n")).otherwise(F.col("_n") + F.col("carried.n"))
    rows = with_relation(rows.withColumns({"tx": tx, "ordinal": ordinal.cast("int")}).where("tx is not null"), kept)
    rows = rows.withColumns({side: decoded(F.col(side), F.col("rel.columns")) for side in ("before", "after")})
    op = F.lit(None).cast("string")
    for msg, name in CHANGE_MESSAGES.items():
        op = F.when(F.col("msg") == msg, name).otherwise(op)
    return rows.select(
        "slot", "seq", F.col("tx.tx_no").alias("tx_no"), F.col("tx.xid").alias("xid"), op.alias("op"), "rel_id", "rel", "before", "after", F.col("wal_start").alias("event_lsn"),
        F.col("tx.ts").alias("commit_ts"), F.col("tx.lsn").alias("commit_lsn"), "ordinal", change_bytes(F.col("before"), F.col("after")).alias("bytes"),
    )


def assemble(messages: DataFrame, max_tx_bytes: int = 64 << 20, tables: DataFrame | None = None, width: int = 100_000, max_broadcast: int = 100_000) -> Assembled:
    """Transactions of each slot, in order. A begin discards an open transaction, a commit without a begin counts for
    nothing. A transaction of more than max_tx_bytes is dropped whole; 0 or less allows all. With tables (schema,
    table) only their changes count. A null slot is a slot like any other.

    events: slot, seq, tx_no, xid, op, rel_id, rel, before, after (decoded), event_lsn (the message's own), commit_ts (of
    the begin), commit_lsn, ordinal (from 1 in its transaction), bytes. transactions: slot, tx_no, xid, begin_ts,
    commit_ts, commit_lsn, n_events, n_bytes, oversized. An empty transaction commits with no events.

    tx_no counts the begins and commits of a slot up to a message. A begin's part is a transaction if the next part
    starts with a commit. The log is read once for its parts, which are stored, and once for the events; width, in
    positions, decides how rows are dealt out, never what is found.
    """
    kept = relevant(messages, tables)
    parts = parts_of(kept, width)
    commits = parts.whole.where("commits > 0").select("slot", (F.col("tx_no") - F.col("commits")).alias("tx_no"), F.col("ts").alias("commit_ts"), F.col("lsn").alias("commit_lsn"))
    begins = parts.whole.where("begins > 0")
    transactions = joined(begins.select("slot", "tx_no", "xid", F.col("ts").alias("begin_ts"), "n_events", "n_bytes"), commits, ["slot", "tx_no"])
    large = (F.col("n_bytes") > max_tx_bytes) if max_tx_bytes > 0 else F.lit(False)
    transactions = transactions.select("slot", "tx_no", "xid", "begin_ts", "commit_ts", "commit_lsn", "n_events", "n_bytes", large.alias("oversized"))
    outside = joined(parts.changes, begins.select("slot", "tx_no"), ["slot", "tx_no"], "left_anti").select("slot", "seq", "wal_start", "msg", "rel_id")
    return Assembled(events_of(kept, parts, transactions, width, max_broadcast), transactions, outside)
