"""Settings of a pipeline: defaults, environment, and a check that reports every problem at once."""

from __future__ import annotations

import json
import os
import re
import warnings
from collections.abc import Mapping
from dataclasses import dataclass, field, fields, is_dataclass
from typing import Any

from changeloom.functions.names import topic_problems
from changeloom.operators.envelope import Output
from changeloom.sinks import ACKS, COMPRESSIONS


@dataclass
class Source:
    dsn: str = ""
    host: str = "localhost"
    port: int = 5432
    user: str = ""
    password: str = ""
    dbname: str = ""

    def jdbc_url(self) -> str:
        """The DSN where there is one, else host, port and name."""
        if self.dsn:
            return self.dsn if self.dsn.startswith("jdbc:") else "jdbc:" + self.dsn.replace("postgres://", "postgresql://", 1)
        return f"jdbc:postgresql://{self.host}:{self.port}/{self.dbname}"


@dataclass
class Replication:
    slot_name: str = "cdc_slot"
    publication_name: str = "cdc_pub"
    create_slot_if_missing: bool = True
    status_interval: float = 10.0  # times in seconds
    temporary_slot: bool = False
    heartbeat_interval: float = 0.0
    transaction_markers: bool = False


@dataclass
class Snapshot:
    mode: str = "never"
    fetch_size: int = 10_000
    tables: list[str] = field(default_factory=list)
    max_parallel_tables: int = 1


@dataclass
class Broker:
    brokers: list[str] = field(default_factory=lambda: ["localhost:9092"])
    compression: str = "snappy"
    linger_ms: int = 5
    max_inflight: int = 5
    required_acks: str = "all"
    enable_idempotence: bool = True
    partitions: int = 0
    replication_factor: int = 0
    max_message_bytes: int = 0


@dataclass
class Topic:
    mode: str = "per_table"
    prefix: str = "cdc"
    single_topic_name: str = ""
    toast_strategy: str = "omit"


@dataclass
class Checkpoint:
    backend: str = "file"
    file_path: str = "/var/lib/cdc/checkpoint.json"
    flush_interval: float = 5.0


@dataclass
class Runtime:
    queue_capacity: int = 4096
    max_tx_bytes: int = 64 << 20
    shutdown_timeout: float = 30.0
    checkpoint_limit: int = 1


@dataclass
class Tuning:
    producer_batch_max_bytes: int = 16 << 20
    producer_batch_max_records: int = 1000


@dataclass
class Logging:
    level: str = "info"


@dataclass
class Metrics:
    enabled: bool = True
    listen_addr: str = ":9090"
    path: str = "/metrics"
    namespace: str = "cdc"
    subsystem: str = ""


@dataclass
class Health:
    listen_addr: str = ":8080"


@dataclass
class Settings:
    postgres: Source = field(default_factory=Source)
    replication: Replication = field(default_factory=Replication)
    snapshot: Snapshot = field(default_factory=Snapshot)
    redpanda: Broker = field(default_factory=Broker)
    topic: Topic = field(default_factory=Topic)
    checkpoint: Checkpoint = field(default_factory=Checkpoint)
    runtime: Runtime = field(default_factory=Runtime)
    logging: Logging = field(default_factory=Logging)
    metrics: Metrics = field(default_factory=Metrics)
    health: Health = field(default_factory=Health)
    tuning: Tuning = field(default_factory=Tuning)

    def output(self) -> Output:
        return Output(database=self.postgres.dbname or "postgres", mode=self.topic.mode, prefix=self.topic.prefix, single=self.topic.single_topic_name, unchanged=self.topic.toast_strategy or "omit", markers=self.replication.transaction_markers, typed="snapshot")

    def problems(self) -> list[str]:
        found = []

        def need(ok: bool, what: str) -> None:
            if not ok:
                found.append(what)

        p, r, s, b, t, c, u, n = self.postgres, self.replication, self.snapshot, self.redpanda, self.topic, self.checkpoint, self.runtime, self.tuning
        need(bool(p.dsn or p.user), "postgres needs a dsn or a user")
        need(bool(r.slot_name), "replication.slot_name is empty")
        need(bool(r.publication_name), "replication.publication_name is empty")
        need(r.status_interval >= 1, "replication.status_interval is below a second")
        need(r.heartbeat_interval >= 0, "replication.heartbeat_interval is negative")
        need(s.mode in ("never", "initial"), "snapshot.mode is never or initial")
        need(s.fetch_size > 0, "snapshot.fetch_size must be positive")
        need(s.max_parallel_tables > 0, "snapshot.max_parallel_tables must be positive")
        need(bool(b.brokers), "redpanda.brokers is empty")
        need(b.required_acks in ACKS, f"redpanda.required_acks is one of {', '.join(ACKS)}")
        need(b.compression in COMPRESSIONS, f"redpanda.compression is one of {', '.join(COMPRESSIONS)}")
        need(b.max_inflight > 0, "redpanda.max_inflight must be positive")
        need(0 <= b.max_message_bytes <= 1 << 30, "redpanda.max_message_bytes lies between 0 and 1 GiB")
        found += topic_problems(t.mode, t.prefix, t.single_topic_name)
        need(t.toast_strategy in ("", "omit", "sentinel"), "topic.toast_strategy is omit or sentinel")
        need(c.backend == "file", "checkpoint.backend is file")
        need(bool(c.file_path), "checkpoint.file_path is empty")
        need(c.flush_interval > 0, "checkpoint.flush_interval must be positive")
        for name in ("queue_capacity", "max_tx_bytes", "shutdown_timeout", "checkpoint_limit"):
            need(getattr(u, name) > 0, f"runtime.{name} must be positive")
        need(512 <= n.producer_batch_max_bytes <= 1 << 30, "tuning.producer_batch_max_bytes lies between 512 and 1 GiB")
        need(n.producer_batch_max_records > 0, "tuning.producer_batch_max_records must be positive")
        need(bool(self.metrics.listen_addr) or not self.metrics.enabled, "metrics.listen_addr is empty")
        need(bool(self.health.listen_addr), "health.listen_addr is empty")
        return found


def converted(value: Any, like: Any) -> Any:
    if not isinstance(value, str):
        return value
    if isinstance(like, bool):
        return value.strip().lower() in ("1", "t", "true", "yes")
    if isinstance(like, list):
        return [x.strip() for x in value.split(",") if x.strip()]
    return type(like)(value)


#: Keys that are read and checked, so that settings of other runners load, but that change nothing: Spark's triggers, checkpoints
#: and sinks take the place of queues, positions in flight, a client's status messages and creation of topics and slots.
WITHOUT_EFFECT = (
    "replication.status_interval", "replication.create_slot_if_missing", "replication.temporary_slot", "redpanda.partitions", "redpanda.replication_factor", "redpanda.max_message_bytes",
    "runtime.queue_capacity", "runtime.shutdown_timeout", "runtime.checkpoint_limit", "tuning.producer_batch_max_records",
)


def load(values: Mapping[str, Mapping[str, Any]] | None = None, environ: Mapping[str, str] | None = None, prefix: str = "CDC_") -> Settings:
    """Defaults, then values by section and key, then variables PREFIX + SECTION__KEY, which win. Raises one
    ValueError with every problem, and warns of each key that is set and changes nothing."""
    out = Settings()
    environ = os.environ if environ is None else environ
    for part in fields(out):
        section = getattr(out, part.name)
        assert is_dataclass(section)
        given = (values or {}).get(part.name, {})
        for key in fields(section):
            value = environ.get(f"{prefix}{part.name}__{key.name}".upper(), given.get(key.name))
            if value is not None:
                setattr(section, key.name, converted(value, getattr(section, key.name)))
                if f"{part.name}.{key.name}" in WITHOUT_EFFECT:
                    warnings.warn(f"{part.name}.{key.name} is ignored", stacklevel=2)
    if problems := out.problems():
        raise ValueError("; ".join(problems))
    return out


def load_file(path: str, environ: Mapping[str, str] | None = None, prefix: str = "CDC_") -> Settings:
    """load() of a YAML or JSON file of sections. Times may be numbers of seconds or texts like 500ms, 10s and 5m; the
    broker's topic_auto_create may be a section of its own."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    try:
        import yaml

        values = yaml.safe_load(text) or {}
    except ImportError:
        values = json.loads(text)
    units = {"ms": 1e-3, "s": 1.0, "m": 60.0, "h": 3600.0}

    def seconds(value: Any) -> Any:
        found = re.fullmatch(r"([0-9.]+)(ms|s|m|h)", value) if isinstance(value, str) else None
        return float(found[1]) * units[found[2]] if found else value

    sections = {}
    for name, section in values.items():
        flat = {k: seconds(v) for k, v in (section or {}).items() if k != "topic_auto_create"} | dict((section or {}).get("topic_auto_create") or {})
        if "linger" in flat:
            flat["linger_ms"] = int(flat.pop("linger") * 1000)
        sections[name] = flat
    return load(sections, environ, prefix)
