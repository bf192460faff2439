"""The registered queries of the corpus operators: ``opN_<name>``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from shopsight.llm import ann, audit, html, jaccard, lpf, mixing, packing, phrases, pii, quality, ranker, urls, windows
from shopsight.llm.common import ship
from shopsight.llm.oracle import ORACLE_SQL  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lpf_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = lpf.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), with_text=True)
    # what is left as text; a character that lost some of its bytes becomes U+FFFD
    return got.withColumn("text", F.make_valid_utf8(F.col("kept").cast("string"))).drop("kept")


def op2_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.draw(docs, mixing.Target(max_repetition=1.5)).drop("text")


def op3_disclosure_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    q = F.col("quality")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return quality.judge(docs).select("doc_id", *(q[n].alias(n) for n in names))


def op5_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op7_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op8_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", *(F.col("judged")[n].alias(n) for n in ("host", "path", "rule", "verdict", "template")))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ranker.classify(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return audit.audit(docs, table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"))


QUERIES: dict[str, Query] = {
    "op1_lpf_dedup": op1_lpf_dedup,
    "op2_temperature_mixing": op2_temperature_mixing,
    "op3_disclosure_pii": op3_disclosure_pii,
    "op4_quality_rules": op4_quality_rules,
    "op5_compact_windows": op5_compact_windows,
    "op6_hilbert_neighbours": op6_hilbert_neighbours,
    "op7_sequence_packing": op7_sequence_packing,
    "op8_url_templates": op8_url_templates,
    "op9_main_text": op9_main_text,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_pairwise_quality": op11_pairwise_quality,
    "op12_phrase_mining": op12_phrase_mining,
    "op13_filter_audit": op13_filter_audit,
}

