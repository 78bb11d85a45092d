"""The registered queries: each applies one operator to its whole table and returns the contract's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm import decontaminate, fill_middle, jaccard, language, lexical, line_dedup, mixing, phrases, quality, secret_scan, token_counts, token_io, url_rules


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_io.round_trip(table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan.scan(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(secret_scan.joined(F.col("spans"), ("assign", "access", "hex")), 256).alias("base_sha256"), secret_scan.joined(F.col("spans")).alias("spans"),
    )


def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.with_next(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = decontaminate.benchmark_windows(table(spark, sf_dir, "benchmark"))
    out = decontaminate.contamination(table(spark, sf_dir, "documents"), windows)
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score", "margin", "rejected")


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_middle.rearrange(table(spark, sf_dir, "documents"))
    sha = lambda text, name: F.sha2(text, 256).alias(name)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output"), "output_sha256"), sha(fill_middle.restored(F.col("output"), F.col("form")), "restored_sha256"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_ngram_jaccard, op2_line_dedup, op3_token_files, op4_secret_scan, op5_fingerprint, op6_decontaminate, op7_quality, op8_token_counts, op9_mix_sources, op10_url_filter, op11_language, op12_fill_middle, op13_lexical_search)}
