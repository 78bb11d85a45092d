"""Names of tables, topics and connections."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def schema_of(name: Column) -> Column:
    """The schema of a qualified name: what stands before its first point, public without one."""
    return F.when(F.instr(name, ".") > 0, F.substring_index(name, ".", 1)).otherwise("public")


def table_of(name: Column) -> Column:
    at = F.instr(name, ".")
    return F.when(at > 0, F.substring(name, at + 1, F.length(name))).otherwise(name)


def topic_problems(mode: str, prefix: str, single: str) -> list[str]:
    if mode not in ("per_table", "single"):
        return [f"topic.mode is {mode!r}; it is per_table or single"]
    if mode == "per_table" and not prefix:
        return ["topic.prefix is needed for topics by table"]
    if mode == "single" and not single:
        return ["topic.single_topic_name is needed for a single topic"]
    return []


def topic(database: Column, schema: Column, table: Column, mode: str = "per_table", prefix: str = "cdc", single: str = "") -> Column:
    """prefix.database.schema.table, or the single topic."""
    if problems := topic_problems(mode, prefix, single):
        raise ValueError("; ".join(problems))
    if mode == "single":
        return F.lit(single)
    part = lambda c: F.coalesce(c, F.lit(""))
    return F.concat(F.lit(prefix + "."), part(database), F.lit("."), part(schema), F.lit("."), part(table))


def heartbeat_topic(prefix: str, single: str = "") -> str:
    return f"{prefix or single}.__heartbeat"


def quoted(name: str) -> str:
    """An identifier for SQL."""
    return '"' + name.replace("\x00", "").replace('"', '""') + '"'


def quoted_name(name: str) -> str:
    """A qualified name for SQL; the schema is public without one."""
    schema, _, table = name.partition(".") if "." in name else ("public", "", name)
    return f"{quoted(schema)}.{quoted(table)}"
