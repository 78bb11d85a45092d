"""Where records go: files by topic, a memory table, or Kafka."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from typing import Any, Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from changeloom.operators.commits import Folder
from changeloom.operators.kept_mirror import KeptMirror
from changeloom.operators.mirror import from_records
from changeloom.operators.publish import record_bytes, split_oversized
from changeloom.operators.scale import shared_path

COMPRESSIONS = ("none", "snappy", "lz4", "zstd", "gzip")
ACKS = {"all": "all", "leader": "1", "none": "0"}


class Sink(Protocol):
    def write(self, records: DataFrame, batch_id: int | None = None, part: str = "") -> None: ...


def batch_name(batch_id: int | None, part: str) -> str:
    """What a batch is called: its number, after the name of its part where that isn't the log."""
    return "-".join(x for x in (part, "snapshot" if batch_id is None and not part else "" if batch_id is None else f"{batch_id:012d}") if x)


class FileSink:
    """Parquet or JSON files by batch, try and topic, and a commit for each batch that names the try that counts.

    A try writes a folder of its own; then the commit is moved into place at once. So readers, who go by commits, see a
    batch whole or not at all, writing it again replaces it, and what a lost writer left is never seen. Records beyond
    max_message_bytes are in the folder quarantine instead, under the same commit.
    """

    def __init__(self, path: str, file_format: str = "parquet", max_message_bytes: int = 0, records_per_file: int = 0):
        self.path, self.format, self.most, self.per_file = path.rstrip("/"), file_format, max_message_bytes, records_per_file

    def folder(self, spark: Any) -> Folder:
        return Folder(spark, self.path)

    def save(self, records: DataFrame, kind: str, name: str, attempt: str, by_topic: bool) -> dict[str, Any]:
        place = f"{kind}/batch={name}/try={attempt}"
        writer = records.write.format(self.format)
        writer = writer.partitionBy("topic") if by_topic else writer
        if self.per_file > 0:
            writer = writer.option("maxRecordsPerFile", self.per_file)
        writer.save(f"{self.path}/{place}")
        there = self.folder(records.sparkSession).names(place)
        return {"place": place, "schema": records.schema.json(), "empty": not any(not n.startswith(("_", ".")) for n in there)}

    def write(self, records: DataFrame, batch_id: int | None = None, part: str = "") -> None:
        name, attempt, made = batch_name(batch_id, part), uuid.uuid4().hex, {}
        if self.most > 0:
            records, large = split_oversized(records, record_bytes(F.col("key"), F.col("value")), self.most)
            made["quarantine"] = self.save(large, "quarantine", name, attempt, False)
        made["records"] = self.save(records, "records", name, attempt, True)
        self.commit(records.sparkSession, name, made)

    def commit(self, spark: Any, name: str, made: dict[str, Any]) -> None:
        self.folder(spark).put(f"_batches/{name}.json", json.dumps(made, sort_keys=True), replace=True)

    def committed(self, spark: Any) -> dict[str, dict[str, Any]]:
        folder = self.folder(spark)
        return {n.removesuffix(".json"): json.loads(folder.read(f"_batches/{n}")) for n in folder.names("_batches") if n.endswith(".json")}

    def read(self, spark: Any, kind: str = "records") -> DataFrame:
        """All records of the batches that are committed now, with their batch and topic; later ones don't show up in it."""
        parts = [x for made in self.committed(spark).values() if (x := made.get(kind)) and not x["empty"]]
        if not parts:
            return spark.createDataFrame([], "key string, value string, batch string, topic string")
        by_schema: dict[str, list[str]] = {}
        for p in parts:
            by_schema.setdefault(p["schema"], []).append(f"{self.path}/{p['place']}")
        out = None
        for text, places in by_schema.items():  # few: snapshots, the log, heartbeats
            schema = StructType.fromJson(json.loads(text)).add("batch", StringType()).add("try", StringType())
            one = spark.read.schema(schema).format(self.format).option("basePath", f"{self.path}/{kind}").load(places).drop("try")
            out = one if out is None else out.unionByName(one, allowMissingColumns=True)
        return out

    def clean(self, spark: Any) -> list[str]:
        """Removes the tries that no commit names; no writer may run meanwhile. Returns their folders."""
        folder, used = self.folder(spark), {x["place"] for made in self.committed(spark).values() for x in made.values()}
        tries = [f"{kind}/{b}/{t}" for kind in ("records", "quarantine") for b in folder.names(kind) if b.startswith("batch=") for t in folder.names(f"{kind}/{b}") if t.startswith("try=")]
        gone = [t for t in tries if t not in used]
        for t in gone:
            folder.remove(t)
        return gone


class MemorySink:
    """All batches as a temporary view, for tests and looking around; their rows lie in the shared folder."""

    def __init__(self, name: str):
        self.name, self.path = name, None

    def write(self, records: DataFrame, batch_id: int | None = None, part: str = "") -> None:
        spark = records.sparkSession
        self.path = self.path or shared_path(spark, self.name)
        records.select("topic", "key", "value").write.mode("overwrite").parquet(f"{self.path}/batch={batch_name(batch_id, part)}")
        spark.read.schema("topic string, key string, value string").option("recursiveFileLookup", "true").parquet(self.path).createOrReplaceTempView(self.name)


class RetryingSink:
    """Tries a write again after a wait that doubles from first to most seconds; attempts of None never gives up. What
    `permanent` calls so is not tried again. Counts retries and failures."""

    def __init__(self, sink: Sink, attempts: int | None = None, first: float = 0.2, most: float = 10.0, permanent: Callable[[Exception], bool] = lambda e: False):
        self.sink, self.attempts, self.first, self.most, self.permanent = sink, attempts, first, most, permanent
        self.retries = self.failures = 0

    def write(self, records: DataFrame, batch_id: int | None = None, part: str = "") -> None:
        wait, tried = self.first, 0
        while True:
            try:
                return self.sink.write(records, batch_id, part)
            except Exception as e:
                tried += 1
                if self.permanent(e) or self.attempts is not None and tried >= self.attempts:
                    self.failures += 1
                    raise
                self.retries += 1
                time.sleep(wait)
                wait = min(self.most, 2 * wait)


class MirrorSink:
    """Change records straight into a kept mirror of one table: fields (name -> type) of those on its topic, deletions as
    such. A batch that is written again is there once."""

    def __init__(self, mirror: KeptMirror, topic: str, fields: dict[str, str], defaults: dict[str, object] | None = None):
        self.mirror, self.topic, self.fields, self.defaults = mirror, topic, fields, defaults

    def write(self, records: DataFrame, batch_id: int | None = None, part: str = "") -> None:
        rows = from_records(records.where(F.col("topic") == self.topic), self.fields, self.mirror.key, self.defaults)
        self.mirror.apply(rows, batch_id if batch_id is not None and not part else batch_name(batch_id, part), F.col("op") == "d")


class KafkaSink:
    """Spark's Kafka writer; needs its connector on the class path. Spark retries tasks, so records may repeat."""

    def __init__(self, brokers: list[str], compression: str = "snappy", acks: str = "all", linger_ms: int = 5, idempotent: bool = True, in_flight: int = 5, batch_bytes: int = 16 << 20):
        if compression not in COMPRESSIONS:
            raise ValueError(f"compression is {compression!r}; it is one of {', '.join(COMPRESSIONS)}")
        self.options = {
            "kafka.bootstrap.servers": ",".join(brokers), "kafka.compression.type": compression, "kafka.acks": ACKS[acks], "kafka.linger.ms": str(linger_ms),
            "kafka.enable.idempotence": str(idempotent).lower(), "kafka.max.in.flight.requests.per.connection": str(1 if idempotent else in_flight), "kafka.batch.size": str(batch_bytes),
        }

    def write(self, records: DataFrame, batch_id: int | None = None, part: str = "") -> None:
        records.selectExpr("topic", "cast(key as binary) key", "cast(value as binary) value").write.format("kafka").options(**self.options).save()


def topics(records: DataFrame) -> DataFrame:
    """The topics that records need, for whoever creates them."""
    return records.select("topic").distinct()
