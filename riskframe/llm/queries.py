"""Registered queries of the corpus operators: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskframe.llm import apportion, chosen_path, label_shards, license_dice, piece_merges, pq_dedup, spaced_seeds, term_audit, text_density, token_blocks, toxicity_fst, vector_codes, weak_pii
from riskframe.llm.common import materialise, scratch, table, with_row_ids


def op1_pfor_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_blocks.token_blocks(table(spark, sf_dir, "documents"))


def op2_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_density.main_text(table(spark, sf_dir, "pages"))


def op3_spaced_seed_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spaced_seeds.detect(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_license_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_dice.scan(table(spark, sf_dir, "documents"))


def op5_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_fst.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_label_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_shards.label_shards(table(spark, sf_dir, "documents"))


def op7_weak_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_pii.find(table(spark, sf_dir, "documents"))


def op8_sainte_lague_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark):
        docs = with_row_ids(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), "mix-docs")
        mixed = apportion.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "source", "source_blocks", "shard_words")
        return materialise(mixed, "mix-result", keep=True)


def op9_pq_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "n_texts", "n_copies")


def op11_packed_term_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_audit.audit(table(spark, sf_dir, "documents"))


def op12_slice_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op13_merge_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_merges.digests(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_pfor_tokens, op2_text_density, op3_spaced_seed_leaks, op4_license_dice, op5_toxicity_grammar, op6_label_shards,
              op7_weak_pii, op8_sainte_lague_mix, op9_pq_near_duplicates, op10_chosen_path_join, op11_packed_term_audit, op12_slice_codes,
              op13_merge_rounds)
}
