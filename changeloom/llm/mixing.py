"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeloom.llm.text import WORD, small_side, stored


def word_count(text: Column) -> Column:
    """Words of a text between ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = (3, 1, 2), total: tuple[int, int] = (3, 2), max_epochs: int = 2) -> DataFrame:
    """sizes (source, source_size, n) with the column target.

    Sources share total[0] / total[1] of all sizes by weight; the weights repeat in code-point order of source, null
    last. A target stops at max_epochs times its source's size, and the excess goes to the others by weight. The
    clamped sources are those with the smallest cap for their weight, so one running sum in that order finds the
    fixed point of the usual repeated clamping: a source is clamped if sharing what those before it leave would
    still lift it above its cap. One row for each source is all that meets in a window here.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    ranked = sizes.withColumn("weight", F.get(F.array(*[F.lit(w) for w in weights]), (F.row_number().over(order) - 1) % len(weights)).cast("long"))
    everything = Window.partitionBy()
    ratio = (F.col("source_size") * max_epochs).cast("double") / F.col("weight")
    before = Window.orderBy("ratio", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    cap = F.col("source_size") * max_epochs
    left = (F.col("all_size") * total[0] / F.lit(total[1]).cast("double")) - F.coalesce(F.col("cap_before"), F.lit(0))
    rest = F.col("all_weight") - F.coalesce(F.col("weight_before"), F.lit(0))
    clamped = ranked.withColumn("ratio", ratio).withColumns({
        "all_size": F.sum("source_size").over(everything), "all_weight": F.sum("weight").over(everything),
        "cap_before": F.sum(cap).over(before), "weight_before": F.sum("weight").over(before),
    })
    clamped = clamped.withColumn("clamped", (left * F.col("weight") / rest) >= cap.cast("double"))
    summed = clamped.withColumns({
        "cap_sum": F.coalesce(F.sum(F.when(F.col("clamped"), cap)).over(everything), F.lit(0)),
        "open_weight": F.sum(F.when(~F.col("clamped"), F.col("weight"))).over(everything),
    })
    share = (F.col("all_size") * total[0] / F.lit(total[1]).cast("double") - F.col("cap_sum")) * F.col("weight") / F.col("open_weight")
    return summed.select("source", "source_size", "n", F.when(F.col("clamped"), cap.cast("double")).otherwise(share).alias("target"))


def seeded(id_col: Column, seed: str) -> Column:
    """A number from 0 to 2^60 - 1 for an id, equal wherever and whenever it is computed."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(id_col.cast("string"), F.lit("")))), 1, 15), 16, 10).cast("long")


NEW = ("size", "source_size", "target", "copies")


def drawn(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: Sequence[int], total: tuple[int, int], max_epochs: int, seed: str, group_rows: int, max_broadcast_sources: int) -> DataFrame:
    """For each row of docs: row, a struct of its columns, whatever their names, and NEW."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    id_, source = F.col("row")[id_col], F.col("row")[source_col]
    rows = rows.withColumn("size", word_count(F.col("row")[text_col]))
    by_source = rows.groupBy(source.alias("source")).agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    plan = targets(stored(by_source, "source-sizes"), weights, total, max_epochs).withColumnRenamed("source", "plan_source")
    rows = rows.join(small_side(plan, max_broadcast_sources), source.eqNullSafe(F.col("plan_source")), "left")
    rows = rows.withColumns({"draw": seeded(id_, seed), "rate": F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)})
    rows = rows.withColumn("group", F.col("draw") % F.ceil(F.col("n") / group_rows))
    at = F.row_number().over(Window.partitionBy("plan_source", "group").orderBy("size", "draw", id_, F.xxhash64(F.col("row")[text_col])))
    part = F.col("rate") - F.floor("rate")
    start = (seeded(F.concat(F.coalesce("plan_source", F.lit("")), F.lit("/"), F.col("group").cast("string")), seed) % 1_000_000) / F.lit(1e6)
    rows = rows.withColumns({"at": at, "part": part, "start": start})
    more = F.floor(F.col("at") * F.col("part") + F.col("start")) - F.floor((F.col("at") - 1) * F.col("part") + F.col("start"))
    return rows.withColumn("copies", (F.floor("rate") + more).cast("long")).select("row", *NEW)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[int] = (3, 1, 2), total: tuple[int, int] = (3, 2), max_epochs: int = 2, seed: str = "mix-1", group_rows: int = 50_000, max_broadcast_sources: int = 100_000) -> DataFrame:
    """docs with size, source_size, target and copies, how often the mix repeats each document.

    Every document of a source is taken floor(target / source_size) times, and a seeded choice of them once more for
    the fraction that is left. The choice is systematic: documents stand by size in groups, and one is taken each
    time the running fraction passes a whole number, so what a group takes differs from its share by about one
    document. A large source is dealt out over seeded groups of about group_rows documents; none meets in one task.

    Null and empty texts have size 0 and follow the same rule; a source of size 0 takes no copies. A null source is
    a source of its own. Rows that repeat an id are documents of their own, in order of their texts' hashes, so reruns
    repeat the same texts; only rows equal in id and text may stand for each other. An empty table gives no rows. Columns of docs that clash with the new
    ones are replaced; all others stay, whatever their names. repeated() keeps all.
    """
    rows = drawn(docs, id_col, text_col, source_col, weights, total, max_epochs, seed, group_rows, max_broadcast_sources)
    return rows.select(*[F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in NEW], *NEW)


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[int] = (3, 1, 2), total: tuple[int, int] = (3, 2), max_epochs: int = 2, seed: str = "mix-1", group_rows: int = 50_000, max_broadcast_sources: int = 100_000) -> DataFrame:
    """The rows of docs, each as often as its copies in mix() say, with all columns of docs and no others."""
    rows = drawn(docs, id_col, text_col, source_col, weights, total, max_epochs, seed, group_rows, max_broadcast_sources)
    return rows.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("row.*")
