"""The operators' queries with production parameters, and DuckDB SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import forced_bpe, html_extract, lattice_lm, license_index, line_dedup, quality_llr, simhash_ball, token_count, token_store, winnow
from tidemark.llm.common import read


def tokenizer(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.drop_boilerplate(read(spark, sf_dir, "documents"), n_lines="n_lines", n_dropped="n_dropped")
    return cleaned.select("doc_id", "n_lines", "n_dropped", "text")


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store_and_read(read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), end_id=2)


def op4_forced_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forced_bpe.encode_documents(read(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read(spark, sf_dir, "pages"))


def op6_quality_llr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_llr.assess(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_simhash_ball(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_ball.near_duplicates(read(spark, sf_dir, "documents"))


def op8_license_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_index.scan(read(spark, sf_dir, "documents"))


def op9_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op10_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.score_texts(read(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_token_counts, op2_line_dedup, op3_token_store, op4_forced_bpe, op5_html_extract, op6_quality_llr, op7_simhash_ball, op8_license_index, op9_winnow, op10_lattice_lm)}


def oracle_sql() -> dict[str, str]:
    return {"op2_line_dedup": line_dedup.oracle_sql(), "op8_license_index": license_index.oracle_sql(), "op9_winnow": winnow.oracle_sql()}
