"""Language identification by compression: the dictionary of a text's own language makes it smallest."""

from __future__ import annotations

import math

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeloom.llm.text import ship, small_side, stored

UNDETERMINED = "und"
#: Bytes that compress to next to nothing before each chunk: without them short chunks are stored as they are, whatever
#: the dictionary.
FILLER = b"\0" * 64
NEW = ("held_out", "lang_pred", "score", "margin", "rejected")


def remainder(id_: Column) -> Column:
    """crc32 of an id as text, modulo 5: documents with 0 are held out."""
    return F.crc32(id_.cast("string")) % 5


def letters(text: Column) -> Column:
    """What is compressed of a text: letters with their marks, in lower case, a space for each run of others."""
    return F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}]+", " "), F.lit(" "))


class Model:
    """Languages in the order of their number of documents, and a raw-content dictionary for each."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = 5, chunk: int = 4096):
        self.dictionaries, self.level, self.chunk = dictionaries, level, chunk
        self.own: dict[str, zstandard.ZstdCompressor] | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"own": None}

    def compressors(self) -> dict[str, zstandard.ZstdCompressor]:
        if self.own is None:
            self.own = {}
            for lang, data in self.dictionaries.items():
                # Matches from three bytes on; frames without magic number, sizes, checksum: each byte counts.
                how = zstandard.ZstdCompressionParameters.from_level(self.level, source_size=self.chunk, dict_size=len(data), min_match=3, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0)
                known = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                known.precompute_compress(compression_params=how)
                self.own[lang] = zstandard.ZstdCompressor(compression_params=how, dict_data=known)
        return self.own

    def sizes(self, data: bytes) -> dict[str, int]:
        """Compressed bytes of a whole text by language: of its chunks, each with the dictionary afresh, so that what a
        long text repeats of itself doesn't outweigh its language."""
        parts = [FILLER + data[k : k + self.chunk] for k in range(0, len(data), self.chunk)]
        return {lang: sum(len(c.compress(p)) for p in parts) for lang, c in self.compressors().items()}

    def judge(self, text: str) -> tuple[str, float, float]:
        """(language, score, margin) of letters(): the smallest size wins, of equal ones the language with more documents.
        margin is how much smaller it is than the next, as a share of that; score weighs all differences by the square
        root of the size, from 1/languages where all are equal to 1."""
        sizes = self.sizes(text.encode("utf-8", "surrogatepass"))
        best, *others = sorted(sizes, key=sizes.__getitem__)  # stable: ties in the model's order
        apart = [sizes[x] - sizes[best] for x in others]
        return best, 1 / (1 + sum(math.exp(-2 * d / math.sqrt(sizes[best])) for d in apart)), apart[0] / (sizes[best] + apart[0]) if apart else 1.0


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_pieces: int = 128, piece_chars: int = 512, max_total_pieces: int = 65_536) -> Model:
    """A dictionary for each language of docs, from rows with a language whose remainder() isn't 0.

    A dictionary is made of at most max_pieces pieces of piece_chars characters, taken at hashed places of documents
    with the smallest hashed ids, each different piece once. All dictionaries together have at most max_total_pieces
    pieces (64 MB or so of text; more languages than that are an error), which bounds what goes to the driver and to
    each task. Documents are counted by language first, and a share of them by hash that is about four times what
    is needed competes in the end, so a language with most of the rows fills no task. Rows without id, language or
    letters teach nothing.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}") & (remainder(F.col(id_col)) != 0))
    rows = rows.select(F.col(lang_col).cast("string").alias("lang"), F.xxhash64(F.col(id_col)).alias("h"), F.col(text_col).alias("text"))
    counts = stored(rows.groupBy("lang").agg(F.count("*").alias("n")), "language-counts")
    n_langs = counts.count()
    if n_langs > max_total_pieces:
        raise ValueError(f"{n_langs} languages; at most {max_total_pieces} can have a dictionary")
    pieces = max(1, min(max_pieces, max_total_pieces // max(1, n_langs)))
    chance = F.pmod("h", F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = rows.join(small_side(counts, 100_000), "lang").where(chance < 4.0 * pieces / F.col("n"))
    place = F.pmod(F.xxhash64("h"), F.greatest(F.lit(1), F.char_length("text") - piece_chars + 1)).cast("int") + 1
    rows = rows.select("lang", "n", "h", letters(F.substring(F.col("text"), place, F.lit(piece_chars))).alias("piece")).where(F.trim("piece") != "")
    rows = rows.groupBy("lang", "piece").agg(F.min("h").alias("h"), F.max("n").alias("n"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("h", "piece"))
    chosen = rows.withColumn("k", first).where(F.col("k") <= pieces).collect()  # at most max_total_pieces
    made: dict[str, list] = {}
    for r in sorted(chosen, key=lambda r: (-r["n"], r["lang"], r["k"])):
        made.setdefault(r["lang"], []).append(r["piece"].encode())
    return Model({lang: b"".join(x) for lang, x in made.items()})


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", min_margin: float = 0.02, model: Model | None = None) -> DataFrame:
    """docs with lang_pred, score (0 to 1), margin, rejected (the margin is below min_margin, or there is no language)
    and held_out (the id's remainder is 0; false for null).

    Without a model one is learned from docs by fit(). lang_pred is the language whose dictionary makes the whole text
    smallest, also where it is rejected; a text that is null or has no letter, or any where nothing was learned, is
    "und" with score and margin 0. Every row is judged by its text alone. Columns of docs with those names are
    replaced, all others stay; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    model = model or fit(docs, id_col, text_col, lang_col)
    text = F.col("row")[text_col]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))

    def judged(texts: pa.Array) -> pa.Array:
        got = [model.judge(t) if t and model.dictionaries else (UNDETERMINED, 0.0, 0.0) for t in texts.to_pylist()]
        return pa.array([{"lang": a, "score": b, "margin": c} for a, b, c in got], pa.struct([("lang", pa.string()), ("score", pa.float64()), ("margin", pa.float64())]))

    judge = F.arrow_udf(judged, "lang string, score double, margin double")
    rows = rows.withColumn("got", judge(F.when(text.rlike(r"\p{L}"), letters(text))))
    margin, lang = F.col("got.margin"), F.col("got.lang")
    held_out = F.coalesce(remainder(F.col("row")[id_col]) == 0, F.lit(False))
    return rows.select(
        *[F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in NEW], held_out.alias("held_out"), lang.alias("lang_pred"), F.col("got.score").alias("score"),
        margin.alias("margin"), ((margin < min_margin) | (lang == UNDETERMINED)).alias("rejected"),
    )
