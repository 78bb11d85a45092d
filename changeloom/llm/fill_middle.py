"""Fill-in-the-middle: cut texts at seeded unit borders and move the middle to the end, by relations of units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A unit is a line with its end.
LINES = r"[^\n]*\n|[^\n]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: 128 bits that name what a cut depends on: the id, null or not, and the text.
KEY = ("_id", "_text")
NEW = ("n", "form", "prefix_chars", "middle_chars", "output")


def draws(id_: Column) -> list[Column]:
    """Four numbers of 32 bits for an id: the first groups of the sha256 of `7:` and the id as text (nothing for null)."""
    digest = F.sha2(F.concat(F.lit("7:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def requests(docs: DataFrame, unit: str) -> DataFrame:
    """Of docs (KEY, id, text): KEY, n (units of the text), first and second, the numbers of units before the two cuts; each key once."""
    h = draws(F.col("id"))
    rows = docs.select(*KEY, F.regexp_count("text", F.lit(unit)).cast("long").alias("n"), h[0].alias("h1"), h[1].alias("h2"))
    a, b = F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)
    return rows.select(*KEY, "n", F.least(a, b).alias("first"), F.greatest(a, b).alias("second")).distinct()


def unit_ends(docs: DataFrame, unit: str) -> DataFrame:
    """KEY, ordinal (from 1) and end, the code points of a text up to and with that unit. Lengths alone are shuffled, once
    for each unit however often a row repeats; one text's units meet in one window, never its lines."""
    matches = F.regexp_extract_all("text", F.lit(unit), F.lit(0))
    units = docs.select(*KEY, F.posexplode(F.transform(matches, lambda x: F.char_length(x))).alias("at", "chars"))
    units = units.groupBy(*KEY, "at").agg(F.first("chars").alias("chars"))
    upto = Window.partitionBy(*KEY).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    return units.select(*KEY, (F.col("at") + 1).cast("long").alias("ordinal"), F.sum("chars").over(upto).cast("int").alias("end"))


def cut_offsets(docs: DataFrame, unit: str) -> DataFrame:
    """KEY, n, and the code points before the two cuts, a and b: the ends of the units that the requests ask for."""
    met = requests(docs, unit).join(unit_ends(docs, unit), list(KEY), "left").where("ordinal is null or ordinal = 1 or ordinal = first or ordinal = second")
    at = lambda cut: F.coalesce(F.max(F.when(F.col("ordinal") == F.col(cut), F.col("end"))), F.lit(0))
    return met.groupBy(*KEY).agg(F.first("n").alias("n"), at("first").alias("a"), at("second").alias("b"))


def rearrange(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = LINES, rate: int = 100, spm_rate: int = 50) -> DataFrame:
    """docs with n (units), form, prefix_chars, middle_chars and output.

    The matches of unit, from left to right, are a text's units and make up the text. Two seeded cuts between units,
    both may be at one place, part it into prefix, middle and suffix. Form is psm (`<P>` prefix `<S>` suffix `<M>`
    middle), spm (`<S>` suffix `<P>` prefix `<M>` middle) for spm_rate in 100 of the rest, or plain, the text as it is,
    for all but rate in 100, for empty texts and for those that hold one of the three tags.

    Units are rows: their lengths are summed up in a window over each text, the cut requests are joined to them, the
    offsets come back as a row for each document, and the text is cut there. A null text is an empty one. Rows that
    repeat an id and a text get the same output, others of that id their own; a null id seeds as no digits. Columns of
    docs that clash with the new ones are replaced, all others stay. An empty table gives no rows.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    id_, text, a, b = F.col("row")[id_col], F.coalesce(F.col("row")[text_col], F.lit("")), F.col("a"), F.col("b")
    rows = rows.withColumns({KEY[0]: F.xxhash64(id_), KEY[1]: F.xxhash64(text)})
    offsets = cut_offsets(rows.select(*KEY, id_.alias("id"), text.alias("text")), unit)
    rows, h = rows.join(offsets, list(KEY)), draws(id_)
    tagged = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    plain = (text == "") | tagged | (h[2] % 100 >= rate)
    rows = rows.withColumn("form", F.when(plain, "plain").when(h[3] % 100 < spm_rate, "spm").otherwise("psm"))
    prefix, middle = F.substring(text, F.lit(1), a), F.substring(text, a + 1, b - a)
    suffix = F.substring(text, b + 1, F.char_length(text))
    output = F.when(F.col("form") == "plain", text).when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)).otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    chars = lambda x: F.when(F.col("form") != "plain", x.cast("long"))
    return rows.select(*[F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in NEW], F.col("n").alias("n"), "form", chars(a).alias("prefix_chars"), chars(b - a).alias("middle_chars"), output.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text that rearrange() made an output of a form from: no text with a tag is ever rearranged, so the tags stand
    once each."""
    psm = F.split(F.substring(output, F.lit(len(PREFIX) + 1), F.char_length(output)), f"{SUFFIX}|{MIDDLE}", -1)
    spm = F.split(F.substring(output, F.lit(len(SUFFIX) + 1), F.char_length(output)), f"{PREFIX}|{MIDDLE}", -1)
    return F.when(form == "plain", output).when(form == "psm", F.concat(psm[0], psm[2], psm[1])).otherwise(F.concat(spm[1], spm[2], spm[0]))
