"""One query per operator: the operator with production parameters over its whole table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.llm import (
    collocations,
    fill_middle,
    html_text,
    licenses,
    minhash,
    mixing,
    packing,
    paragraphs,
    quality_model,
    quality_rules,
    simhash,
    token_counts,
    url_filter,
)
from seekframe.llm.common import table


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge_quality(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op1_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.document_versions(table(spark, sf_dir, "documents"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_text.extract_text(table(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_model.train(docs, table(spark, sf_dir, "labels"))
    return quality_model.score_quality(docs, model).select(
        "doc_id",
        quality_model.held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.filter_urls(table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = fill_middle.store_frames(table(spark, sf_dir, "documents"))
    return fill_middle.with_digests(fill_middle.fill_in_middle(frames)).drop("output")


QUERIES = {
    "op1_paragraphs": op1_paragraphs,
    "op2_html_text": op2_html_text,
    "op3_mixing": op3_mixing,
    "op4_quality_rules": op4_quality_rules,
    "op5_quality_model": op5_quality_model,
    "op6_simhash": op6_simhash,
    "op7_token_counts": op7_token_counts,
    "op8_url_filter": op8_url_filter,
    "op9_licenses": op9_licenses,
    "op10_packing": op10_packing,
    "op11_minhash": op11_minhash,
    "op12_collocations": op12_collocations,
    "op13_fill_middle": op13_fill_middle,
}
