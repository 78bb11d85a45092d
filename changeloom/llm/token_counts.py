"""Token counts of whole texts; huge ones by overlapping chunks that are spliced where both encodings agree."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm import encoding
from changeloom.llm.text import ship, tidy


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024, path: str | None = None) -> DataFrame:
    """One row for each row of docs: id_col, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    path is a byte-level BPE file of the tokenizers library, byte_bpe_50k.json where it isn't given. A null or empty
    text has no bytes and no tokens. Special strings inside a text count as the library's default has it. Other
    columns are ignored; repeated rows and null ids stay as they are.
    """
    ship(docs.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoding.encoder(path)
        for batch in batches:
            n = [len(x) // 4 for x in own.ids(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_bytes"), pa.array(n, pa.int64())], ["id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(tidy(counted), f"id {kind}, n_bytes long, n_tokens long")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
