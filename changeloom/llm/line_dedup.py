"""Line dedup: drop lines that several documents share, except where they stand first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm.text import ascii_lower, hash128

#: Characters stripped from both ends of a line before it is compared.
STRIP = " \t\n\v\f\r"


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """One row for each row of docs: id_col, text (the kept lines), n_lines (before), n_dropped.

    A line's key is the line stripped of ASCII white space, A-Z lower-cased. Keys of at least min_chars code points
    that occur under two or more ids lose their lines everywhere but under the smallest id.

    A null or empty text is one empty line. A null id takes no part: its lines stay and count for no key. Rows that
    repeat an id count as one document; rows equal in id and text lose the same lines. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("version", F.xxhash64("text"))
    lines = rows.select("id", "version", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    key = F.btrim("line", F.lit(STRIP))
    lines = lines.where(F.col("id").isNotNull() & (F.length(key) >= min_chars))
    h1, h2 = hash128(ascii_lower(key))
    lines = lines.select("id", "version", "pos", h1.alias("h1"), h2.alias("h2"))

    shared = lines.groupBy("h1", "h2").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    shared = shared.where("first < last").select("h1", "h2", "first")
    drops = lines.join(shared, ["h1", "h2"]).where("id <> first")
    drops = drops.groupBy("id", "version").agg(F.collect_set("pos").alias("drop"))

    # The text moves once; the hash table is built of the drop lists alone.
    joined = rows.join(drops.hint("shuffle_hash"), ["id", "version"], "left")
    parts = F.split("text", "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("drop"))
    text = F.when(F.col("drop").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(F.array(F.struct(parts.alias("p"), kept.alias("k"))), lambda x: F.transform(x["k"], lambda i: F.get(x["p"], i)))[0], "\n")
    )
    return joined.select(
        F.col("id").alias(id_col), text.alias("text"), F.size(parts).cast("long").alias("n_lines"),
        F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"),
    )
