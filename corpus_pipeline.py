"""The corpus pipeline: documents to token files, in five stages.

A stage takes (spark, docs, sf_dir), docs being all rows that the stage before kept, and returns a DataFrame; all but
the last return the columns of documents. Each result is written as Parquet and read again before the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm import decontaminate, jaccard, mixing, quality, token_io
from changeloom.llm.text import small_side, stored
from changeloom.operators.scale import stored_alone

#: SQL can't express the trained classifier or the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; it learns from the labels of docs that aren't held out. Columns
    that are named as the classifier's own stay what they were."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    aside = {c: f"own {c}" for c in docs.columns if c.lower() in ("score", "held_out", "predicted")}
    judged = quality.classify(docs.withColumnsRenamed(aside), labels).where("predicted = 1")
    return judged.select(*[F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns])


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that similarity links, directly or by others, the one with the smallest id stays. Documents
    without words are linked with nothing and stay, as do rows without an id."""
    found = jaccard.similar_documents(docs)
    gone = stored_alone(found.where("component_id <> doc_id").select("doc_id").distinct(), "gone")
    return docs.join(small_side(gone, 2_000_000), "doc_id", "left_anti").select(*docs.columns)  # beyond that texts are shuffled


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words a twentieth or more stand in passages of the benchmark go."""
    windows = decontaminate.benchmark_windows(spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return decontaminate.remove_documents(docs, decontaminate.contamination(docs, windows)).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target has it, which may be never."""
    return mixing.repeated(docs).select(*docs.columns)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back: doc_id, start, n_tokens, ids_crc32."""
    return token_io.round_trip(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("benchmark decontamination", drop_benchmark_copies),
    ("mixing sources to target weights", mix_sources),
    ("token-ID output", write_token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
