"""Counters, histograms and gauges as aggregates, and a streaming query's state."""

from __future__ import annotations

import ast
import json
import threading
import time
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TX_BYTES_BUCKETS = tuple(1024 * 4**i for i in range(10))
SNAPSHOT_SECONDS_BUCKETS = tuple(2**i for i in range(15))


def counted(rows: DataFrame, by: Sequence[str], name: str = "n") -> DataFrame:
    return rows.groupBy(*by).agg(F.count("*").alias(name))


def histogram(rows: DataFrame, value: Column, bounds: Sequence[int]) -> DataFrame:
    """Cumulative counts: le (a bound as text, +Inf last), n (values of at most le). One pass: a count for each bound."""
    names = [*map(str, bounds), "+Inf"]
    sums = rows.agg(*[F.count_if(value <= b).alias(str(b)) for b in bounds], F.count(value).alias("+Inf"))
    return sums.select(F.explode(F.array(*[F.struct(F.lit(n).alias("le"), F.col(f"`{n}`").alias("n")) for n in names])).alias("x")).select("x.le", "x.n")


def gauges(transactions: DataFrame, now: Column) -> DataFrame:
    """transactions_total, oversized_total, last_read_lsn of what isn't too large, and commit_lag_micros, which is 0
    where it would be negative."""
    kept = ~F.col("oversized")
    lag = F.greatest(F.lit(0), F.unix_micros(now) - F.max(F.unix_micros(F.col("commit_ts").cast("timestamp"))))
    return transactions.agg(F.count_if(kept).alias("transactions_total"), F.count_if("oversized").alias("oversized_total"), F.max(F.when(kept, F.col("commit_lsn"))).alias("last_read_lsn"), lag.alias("commit_lag_micros"))


def log_counters(messages: DataFrame) -> DataFrame:
    """wal_messages_total, and relation_cache: relations of which a version is known."""
    return messages.agg(F.count("*").alias("wal_messages_total"), F.count_distinct(F.when(F.col("msg") == "R", F.struct("slot", "rel_id"))).alias("relation_cache"))


def lag_bytes(read: Column, done: Column) -> Column:
    """Bytes of log not yet done; never negative."""
    return F.greatest(F.lit(0), read - done)


def readiness(query: Any, read_lsn: int = 0, checkpoint_lsn: int = 0) -> dict[str, Any]:
    """What a probe would show of a streaming query. It is ready while it runs without an exception."""
    ready = bool(query is not None and query.isActive and query.exception() is None)
    return {"ready": ready, "status": 200 if ready else 503, "last_read_lsn": read_lsn, "last_checkpoint_lsn": checkpoint_lsn, "lag_bytes": max(0, read_lsn - checkpoint_lsn), "progress": query.lastProgress if query is not None else None}


def offset(text: Any) -> dict[str, Any]:
    """An offset out of a query's progress: a dict, or its text as Spark or PySpark prints it; others are empty."""
    if isinstance(text, str):
        try:
            text = json.loads(text)
        except ValueError:
            text = ast.literal_eval(text) if text.startswith("{") else None
    return text if isinstance(text, dict) else {}


def behind(progress: Mapping[str, Any], what: str) -> int:
    """Of a query's progress: what its capture sources say of what waits behind the offset that they gave out."""
    return sum(offset(source.get("endOffset")).get(what, 0) for source in progress.get("sources") or [])


def queue_depth(progress: Mapping[str, Any]) -> int:
    """Capture files that a bounded stream hasn't given out, or not to their end."""
    return behind(progress, "behind_files")


def last_read_lsn(progress: Mapping[str, Any]) -> int:
    """The end of the log data that capture sources have given out: a message's position and its length."""
    return behind(progress, "lsn")


class Registry:
    """Counters, gauges and histograms by name and labels, of one process; shown as text or as a table."""

    def __init__(self, prefix: str = "cdc"):
        self.prefix, self.lock = prefix, threading.Lock()
        self.values: dict[tuple[str, tuple[tuple[str, str], ...]], float] = {}

    def key(self, name: str, labels: Mapping[str, str]) -> tuple[str, tuple[tuple[str, str], ...]]:
        return name, tuple(sorted(labels.items()))

    def add(self, name: str, by: float = 1, **labels: str) -> None:
        with self.lock:
            key = self.key(name, labels)
            self.values[key] = self.values.get(key, 0) + by

    def put(self, name: str, value: float, **labels: str) -> None:
        with self.lock:
            self.values[self.key(name, labels)] = value

    def get(self, name: str, **labels: str) -> float:
        return self.values.get(self.key(name, labels), 0)

    def observe(self, name: str, value: float, bounds: Sequence[int]) -> None:
        """One value of a histogram with cumulative buckets."""
        for b in [*[b for b in bounds if value <= b], "+Inf"]:
            self.add(f"{name}_bucket", 1, le=str(b))
        self.add(f"{name}_sum", value)
        self.add(f"{name}_count")

    def text(self) -> str:
        """A line for each value: name{label="..."} value."""
        with self.lock:
            found = sorted(self.values.items())
        shown = lambda labels: "{" + ",".join(f'{k}="{v}"' for k, v in labels) + "}" if labels else ""
        return "".join(f"{self.prefix}_{name}{shown(labels)} {value:g}\n" for (name, labels), value in found)

    def table(self, spark: SparkSession) -> DataFrame:
        with self.lock:
            found = sorted(self.values.items())
        return spark.createDataFrame([(name, dict(labels), float(value)) for (name, labels), value in found], "name string, labels map<string,string>, value double")


WATCHED = "changeloom"


def watched(changes: DataFrame) -> DataFrame:
    """Rows of stream_changes() that count themselves on their way: changes by operation, transactions that are kept and too
    large, and the kept ones' bytes by bucket. A listener finds the counts in each batch's progress."""
    kept, large = F.col("commit") & (F.col("ordinal") >= 0), F.col("commit") & (F.col("ordinal") < 0)
    change = ~F.col("commit") & ~F.col("outside")
    return changes.observe(
        WATCHED, *[F.count_if(change & (F.col("op") == op)).alias(f"events_{op}") for op in "cud"], F.count_if(kept).alias("transactions"), F.count_if(large).alias("oversized"),
        F.coalesce(F.sum(F.when(kept, F.col("bytes"))), F.lit(0)).alias("bytes"), *[F.count_if(kept & (F.col("bytes") <= b)).alias(f"le_{b}") for b in TX_BYTES_BUCKETS],
        F.coalesce(F.max(F.when(F.col("commit"), F.col("commit_lsn"))), F.lit(0)).alias("lsn"), F.max(F.when(F.col("commit"), F.unix_micros("commit_ts"))).alias("commit_us"),
    )


def listener(registry: Registry | None = None, run_id: str | None = None) -> Any:
    """A StreamingQueryListener that counts starts, batches, rows and the time that batches take; with a registry also
    what watched() rows say of themselves and what capture sources say of what waits. run_id bounds it to one query."""
    from pyspark.sql.streaming.listener import StreamingQueryListener

    class Counter(StreamingQueryListener):
        def __init__(self) -> None:
            self.starts = self.batches = self.rows = self.failures = 0
            self.batch_ms = 0

        @property
        def reconnects(self) -> int:
            return max(0, self.starts - 1)

        def onQueryStarted(self, event: Any) -> None:  # noqa: N802
            self.starts += 1
            if registry is not None and self.starts > 1:
                registry.add("reconnects_total")

        def onQueryProgress(self, event: Any) -> None:  # noqa: N802
            p = event.progress
            self.batches += 1
            self.rows += p.numInputRows
            self.batch_ms += p.batchDuration
            if registry is not None and (run_id is None or str(p.runId) == run_id):
                self.take(p)

        def take(self, p: Any) -> None:
            sources = {"sources": [{"endOffset": s.endOffset} for s in p.sources]}
            registry.add("wal_messages_total", p.numInputRows)
            registry.put("queue_depth", queue_depth(sources))
            if queue_depth(sources):  # more was there than the trigger took in, for as long as it ran
                registry.add("backpressure_seconds", p.batchDuration / 1000)
            if (got := p.observedMetrics.get(WATCHED)) is None:
                return
            for op in "cud":
                registry.add("events_total", got[f"events_{op}"], op=op)
            registry.add("transactions_total", got["transactions"])
            registry.add("oversized_transactions_total", got["oversized"])
            for b in TX_BYTES_BUCKETS:
                registry.add("transaction_bytes_bucket", got[f"le_{b}"], le=str(b))
            registry.add("transaction_bytes_bucket", got["transactions"], le="+Inf")
            registry.add("transaction_bytes_sum", got["bytes"])
            registry.add("transaction_bytes_count", got["transactions"])
            if got["lsn"]:
                registry.put("last_read_lsn", max(got["lsn"], registry.get("last_read_lsn")))
                registry.put("commit_lag_seconds", max(0.0, time.time() - (got["commit_us"] or 0) / 1e6))

        def onQueryIdle(self, event: Any) -> None:  # noqa: N802
            pass

        def onQueryTerminated(self, event: Any) -> None:  # noqa: N802
            self.failures += event.exception is not None

    return Counter()
