"""The registered queries of the llm operators and their DuckDB statements.

Each query applies its operator, with production parameters, to a whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wayfarer.llm import common as C
from wayfarer.llm import (collocations, decontaminate, embedding_dedup, html_text, language, line_dedup, merkle,
                          minhash, mixing, oracle_sql, pii, sharding, substring_dedup, token_output)

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def op1_setsketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (minhash.find_near_duplicates(C.table(spark, sf_dir, "documents"), k=2, percent=80)
            .select("doc_id", "n_shingles", "component_id", "kept"))


def op2_two_pass_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(sharding.shuffle(C.table(spark, sf_dir, "documents"), shards=16))


def op3_relative_lz_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(
        substring_dedup.remove_repeats(C.table(spark, sf_dir, "documents"), span=35, k=8))


def op4_nearest_url_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.digest(html_text.extract_text(C.table(spark, sf_dir, "pages")))


def op5_string_kernel_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    model = language.train(docs.where(~language.held_out()))
    return (language.identify(docs, model)
            .select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score"))


def op6_training_order_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.materialise(C.table(spark, sf_dir, "documents"), VOCABULARY)


def op7_epsilon_grid_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.find_near_duplicates(C.table(spark, sf_dir, "embeddings"), least=0.9)


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mixing.mix(C.table(spark, sf_dir, "documents"))
            .select("doc_id", "size", "source_size", "target", "taken"))


def op9_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(C.table(spark, sf_dir, "documents")))


def op10_winnowing_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(C.table(spark, sf_dir, "documents"),
                                             C.table(spark, sf_dir, "benchmark"), span=10, k=5)
    return decontaminate.digest(found)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digest(C.table(spark, sf_dir, "documents"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.find_collocations(C.table(spark, sf_dir, "documents"), longest=5, least=100, top=2000)


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    return line_dedup.digest(docs, line_dedup.find_repeated_lines(docs, least=10))


QUERIES = {
    "op1_setsketch_near_dedup": op1_setsketch_near_dedup,
    "op2_two_pass_sharding": op2_two_pass_sharding,
    "op3_relative_lz_substring_dedup": op3_relative_lz_substring_dedup,
    "op4_nearest_url_html_text": op4_nearest_url_html_text,
    "op5_string_kernel_language_id": op5_string_kernel_language_id,
    "op6_training_order_tokens": op6_training_order_tokens,
    "op7_epsilon_grid_embedding_dedup": op7_epsilon_grid_embedding_dedup,
    "op8_mix_sources": op8_mix_sources,
    "op9_skip_chain_pii": op9_skip_chain_pii,
    "op10_winnowing_decontamination": op10_winnowing_decontamination,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_line_dedup": op13_line_dedup,
}

# op2, op4, op5, op6 and op9 have no SQL (seeded places, markup, learnt models, tokenizer); tests/llm
# holds them against brute force.
ORACLES: dict[str, str] = {
    "op1_setsketch_near_dedup": oracle_sql.near_duplicates(k=2, percent=80),
    "op3_relative_lz_substring_dedup": oracle_sql.repeats(span=35),
    "op7_epsilon_grid_embedding_dedup": oracle_sql.close_vectors(least=0.9),
    "op10_winnowing_decontamination": oracle_sql.contamination(span=10),
    "op8_mix_sources": mixing.oracle(),
    "op11_merkle_manifest": merkle.oracle(),
    "op12_phrase_collocations": collocations.oracle(),
    "op13_line_dedup": line_dedup.oracle(),
}
