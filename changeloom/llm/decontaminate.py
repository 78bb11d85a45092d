"""Benchmark decontamination: find windows of test items in training texts, and remove spans or documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.llm.text import ascii_lower, let, small_side, stored
from changeloom.operators.scale import joined

#: Words are runs of ASCII letters and digits and of all characters beyond ASCII.
GRAM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def gram_words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(GRAM_WORD), F.lit(0))


def window_hashes(hashes: Column, n: int) -> Column:
    """64-bit hashes of all n-grams of an array of word hashes, by doubling: a gram of 2k is two grams of k, and the
    last step joins two overlapping ones. Takes log2(n) passes, whatever n is."""

    def grown(grams: Column, width: int) -> Column:
        if width == n:
            return grams
        step = min(width, n - width)
        return let(grams, lambda g: grown(F.zip_with(F.slice(g, F.lit(1), F.greatest(F.size(g) - step, F.lit(0))), F.slice(g, F.lit(step + 1), F.size(g)), lambda a, b: F.xxhash64(a, b)), width + step))

    return grown(hashes, 1)


def benchmark_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", n: int = 13) -> DataFrame:
    """Distinct windows of the items: hash, width, gram (the words, by spaces) and items (sorted ids as strings). An
    item of fewer than n words, but not none, is one window. A null text has none."""
    rows = items.select(F.col(id_col).cast("string").alias("item"), gram_words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    rows = rows.withColumn("width", F.least(F.size("w"), F.lit(n)))
    grams = F.transform(F.sequence(F.lit(1), F.size("w") - F.col("width") + 1), lambda i: F.slice("w", i, F.col("width")))
    rows = rows.select("item", "width", F.explode(grams).alias("words"))
    by_width = None
    for width in sorted(r["width"] for r in rows.select("width").distinct().collect()):  # n values at most
        one = rows.where(F.col("width") == width).withColumn("hash", window_hashes(F.transform("words", lambda x: F.xxhash64(x)), width)[0])
        by_width = one if by_width is None else by_width.unionByName(one)
    if by_width is None:
        by_width = rows.withColumn("hash", F.lit(0).cast("long"))
    return by_width.groupBy("hash", "width", F.array_join("words", " ").alias("gram")).agg(F.sort_array(F.collect_set("item")).alias("items"))


def near_windows(docs: DataFrame, windows: DataFrame, widths: list[int], max_broadcast: int) -> DataFrame:
    """Places of the n-grams of docs (id, version, text) whose hash is a window's: id, version, cands (at, width). All
    that is exploded, and shuffled where there are more than max_broadcast windows, are numbers: never a text."""
    keys = windows.select("hash", "width").distinct()
    places = lambda grams, width: F.transform(grams, lambda h, i: F.struct(h.alias("hash"), i.alias("at"), F.lit(width).alias("width")))
    every = lambda w: F.concat(*[places(window_hashes(F.transform(w, lambda x: F.xxhash64(x)), width), width) for width in widths])
    grams = docs.select("id", "version", F.explode(let(gram_words(F.col("text")), every)).alias("g")).select("id", "version", "g.*")
    met = grams.join(small_side(stored(keys, "window-hashes"), max_broadcast), ["hash", "width"])
    return met.groupBy("id", "version").agg(F.collect_set(F.struct("at", "width")).alias("cands"))


def contamination(docs: DataFrame, windows: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), max_broadcast_windows: int = 200_000, max_broadcast_hashes: int = 5_000_000) -> DataFrame:
    """Word counts and verified hits for each document: id_col, text_version (a hash of the text), the columns keep,
    n_words, n_hit, items (sorted ids as strings), spans (first word from 0, and width, of each window found).

    All n-grams of a text are hashed in one pass and held against the hash set of the windows; those in it become
    words again and are joined with the windows by those words. Up to max_broadcast_windows hashes stand in the plan; up to
    max_broadcast_hashes (of 16 bytes) are broadcast; beyond that hashes are shuffled. In the last two cases texts are read
    twice, first for the places and then for the words at these.

    A null or empty text has no words and no hits. Rows equal in id, text and keep give one row. No windows: no hits.
    """
    some = windows.select("hash", "width").distinct().limit(max_broadcast_windows + 1).collect()
    listed = len(some) <= max_broadcast_windows
    widths = {w: [r["hash"] for r in some if r["width"] == w] for w in sorted({r["width"] for r in some})}
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("version"), F.col(text_col).alias("text"), *[F.col(c).alias(f"keep_{c}") for c in keep])
    whole = ["id", "version", *[f"keep_{c}" for c in keep]]
    gram = lambda w, x: F.struct(x["at"].alias("at"), x["width"].alias("width"), F.array_join(F.slice(w, x["at"] + 1, x["width"]), " ").alias("gram"))

    def listed_places(w: Column) -> Column:
        out = [F.array().cast("array<struct<at:int,width:int>>")]
        for width, hashes in widths.items():
            grams = window_hashes(F.transform(w, lambda x: F.xxhash64(x)), width)
            at = F.filter(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("at"))), lambda x: x["h"].isin(hashes))
            out.append(F.transform(at, lambda x: F.struct(x["at"].alias("at"), F.lit(width).alias("width"))))
        return F.concat(*out)

    if listed:
        found = lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.transform(listed_places(w), lambda x: gram(w, x)).alias("hits"))
    else:
        near = stored(near_windows(rows, windows, sorted(r["width"] for r in windows.select("width").distinct().collect()), max_broadcast_hashes), "near-windows")
        rows = joined(rows, small_side(near, max_broadcast_hashes // 50), ["id", "version"], "left")
        found = lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.transform("cands", lambda x: gram(w, x)).alias("hits"))
    rows = rows.select(*whole, let(gram_words(F.col("text")), found).alias("got"))
    rows = rows.select(*whole, F.col("got.n_words").alias("n_words"), F.explode_outer("got.hits").alias("hit"))
    rows = rows.select(*whole, "n_words", F.col("hit.at").alias("at"), F.col("hit.width").alias("width"), F.col("hit.gram").alias("gram"))
    side = windows.select("width", "gram", "items")
    hits = rows.join(F.broadcast(side) if listed else side, ["width", "gram"], "left")
    hits = hits.groupBy(*whole).agg(
        F.first("n_words").alias("n_words"),
        F.collect_set(F.when(F.col("items").isNotNull(), F.struct("at", "width"))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )
    spans = F.array_sort("spans")
    covered = F.aggregate(
        spans, F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, x: F.struct(F.greatest(a["end"], x["at"] + x["width"]).alias("end"), (a["n"] + F.greatest(F.lit(0), x["at"] + x["width"] - F.greatest(a["end"], x["at"]))).alias("n")),
    )["n"]
    return hits.select(F.col("id").alias(id_col), F.col("version").alias("text_version"), *[F.col(f"keep_{c}").alias(c) for c in keep], "n_words", covered.alias("n_hit"), F.sort_array("items").alias("items"), spans.alias("spans"))


def is_contaminated(n_hit: Column, n_words: Column, share: int = 20) -> Column:
    """At least one hit word, and at least one word in share of all."""
    return (n_hit > 0) & (n_hit * share >= n_words)


def same_document(docs: DataFrame, id_col: str, text_col: str) -> Column:
    """A row of docs has _id, null or not, and the text of _version."""
    return docs[id_col].eqNullSafe(F.col("_id")) & (F.xxhash64(docs[text_col]) == F.col("_version"))


def remove_documents(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without those that are contaminated by found, the rows of contamination(). Of rows that repeat an id, or
    have none, those with a contaminated text go."""
    bad = found.where(is_contaminated(F.col("n_hit"), F.col("n_words"))).select(F.col(id_col).alias("_id"), F.col("text_version").alias("_version")).distinct()
    return docs.join(bad, same_document(docs, id_col, text_col), "left_anti")


def remove_spans(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the words of found spans cut out of their texts; what stands between words stays. Rows that repeat
    an id, or have none, lose what was found in their own text."""
    spans = found.where("n_hit > 0").select(F.col(id_col).alias("_id"), F.col("text_version").alias("_version"), F.col("spans").alias("found_spans")).dropDuplicates(["_id", "_version"])
    parts = F.regexp_extract_all(text_col, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), F.lit(0))

    def cut(p: Column) -> Column:
        lead = F.when(p[0].rlike(r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"), 1).otherwise(0)
        word = lambda i: F.floor((i - lead) / 2)
        gone = lambda i: F.exists("found_spans", lambda s: ((i - lead) % 2 == 0) & (word(i) >= s["at"]) & (word(i) < s["at"] + s["width"]))
        return F.array_join(F.filter(p, lambda x, i: ~gone(i)), "")

    joined = docs.join(spans.hint("shuffle_hash"), same_document(docs, id_col, text_col), "left")
    text = F.when(F.col("found_spans").isNull(), F.col(text_col)).otherwise(let(parts, cut))
    return joined.withColumn(text_col, text).select(*docs.columns)
