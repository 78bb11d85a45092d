"""The latest state of every row, and its comparison with the source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(changes: DataFrame, key: Sequence[str], order: Sequence[str], deleted: Column) -> DataFrame:
    """The newest change of each key, without keys whose newest change is a deletion. Every column of order counts in
    turn, so changes of one transaction don't tie. Aggregates before the shuffle, so a busy key is no group of its own."""
    whole, place = F.struct(*[F.col(f"`{c}`") for c in changes.columns]), F.struct(*order)
    newest = changes.withColumn("_deleted", deleted).groupBy(*[F.col(k).alias(f"_{k}") for k in key]).agg(F.max_by(whole, place).alias("_row"), F.max_by("_deleted", place).alias("_gone"))
    return newest.where("not _gone").select("_row.*")


def from_records(records: DataFrame, fields: dict[str, str], key: Sequence[str] = (), defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Mirror rows of change records (value): fields (name -> type) of the after image, of before where a row was
    deleted, with op, ver (the transaction) and lsn. Markers and heartbeats are no changes. A field that
    is missing or not of its type is null, or what defaults has for it; rows without a value in key go."""
    from changeloom.functions.lsn import lsn_number

    kept = [c for c in ("ordinal",) if c in records.columns]
    rows = records.select(F.try_parse_json("value").alias("v"), *kept)  # each record is parsed once
    text = lambda path: F.try_variant_get("v", f"$.{path}", "string")
    rows = rows.select(text("op").alias("op"), text("txid").cast("bigint").alias("ver"), lsn_number(text("lsn")).alias("lsn"), F.when(text("op") == "d", F.try_variant_get("v", "$.before", "variant")).otherwise(F.try_variant_get("v", "$.after", "variant")).alias("image"), *kept)
    rows = rows.where(F.col("op").isin("c", "r", "u", "d"))

    def field(name: str, kind: str) -> Column:
        own = F.try_variant_get("image", f"$['{name}']", "string").try_cast(kind)
        return F.coalesce(own, F.lit(defaults[name]).cast(kind)) if name in (defaults or {}) else own

    out = rows.select(*[field(n, t).alias(n) for n, t in fields.items()], "op", "ver", "lsn", *kept)
    return out.dropna(subset=list(key)) if key else out


def key_moves(changes: DataFrame, key: Sequence[str], before_key: Sequence[str]) -> DataFrame:
    """A deletion of the old key for each update that changed it: the columns of key, and the rest of changes."""
    moved = changes.where("op = 'u'").where(F.concat_ws("", *[F.when(F.col(b).isNotNull() & ~F.col(b).eqNullSafe(F.col(k)), "x") for b, k in zip(before_key, key, strict=True)]) != "")
    return moved.withColumns({k: F.col(b) for b, k in zip(before_key, key, strict=True)}).withColumn("op", F.lit("d"))


def parity(source: DataFrame, mirror: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Keys at which source and mirror differ, nulls included: key, and difference: missing, extra or changed."""
    m = mirror.select(*[F.col(k).alias(f"_{k}") for k in key], *[F.col(c).alias(f"_{c}") for c in columns], F.lit(True).alias("_there"))
    s = source.select(*key, *columns, F.lit(True).alias("_here"))
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]
    both = s.join(m, on, "full_outer")
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    kind = F.when(F.col("_there").isNull(), "missing").when(F.col("_here").isNull(), "extra").when(~same, "changed")
    return both.select(*[F.coalesce(k, f"_{k}").alias(k) for k in key], kind.alias("difference")).where("difference is not null")


def difference(source: DataFrame, mirror: DataFrame) -> DataFrame:
    """Rows that only one of two tables has, as often as it has them more: side, and the columns."""
    return source.exceptAll(mirror).withColumn("side", F.lit("source")).unionByName(mirror.exceptAll(source).withColumn("side", F.lit("mirror")))


def unpublished(records: DataFrame, published: DataFrame, key: Sequence[str]) -> DataFrame:
    """Records whose key hasn't been published, each once."""
    return records.dropDuplicates(list(key)).join(published.select(*key), list(key), "left_anti")
