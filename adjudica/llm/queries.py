"""The queries of this subpackage, with production parameters, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def vocabulary() -> str:
    """The vocabulary file that the queries encode with; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adjudica.llm.line_dedup import line_dedup

    return line_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"), min_words=50).drop("had_words")


def op2_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adjudica.llm.token_binary import token_digest

    return token_digest(_table(spark, sf_dir, "documents"), vocabulary(), end_id=2)


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adjudica.llm.mixing import mix

    return mix(_table(spark, sf_dir, "documents"), weights=(5.0, 2.0, 1.0), share=1.5, most=2.0).select("doc_id", "size", "source_size", "target", "taken")


def op4_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adjudica.llm.quality_rules import judge

    return judge(_table(spark, sf_dir, "documents")).drop("class_distance", "word_distance")


def op5_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adjudica.llm.kd_shards import kd_shards

    placed = kd_shards(_table(spark, sf_dir, "documents"), leaves=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adjudica.llm.url_filter import judge

    return judge(_table(spark, sf_dir, "pages"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adjudica.llm.packing import pack_documents

    return pack_documents(_table(spark, sf_dir, "documents"), vocabulary(), end_id=0, capacity=2048, with_ids=False)


def op8_odd_sketch_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adjudica.llm.near_dup import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"), width=3, percent=85)


def op9_vp_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adjudica.llm.vp_search import nearest

    return nearest(_table(spark, sf_dir, "embeddings"), every=50, k=5, factor=1.0)


def op10_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adjudica.llm.rule_classifier import fit, held_out, score

    documents = _table(spark, sf_dir, "documents")
    model = fit(documents, _table(spark, sf_dir, "labels"))
    scored = score(documents.select("doc_id", "text"), model, threshold=0.3)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adjudica.llm.filter_audit import audit

    return audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adjudica.llm.periodic_runs import collapse_runs, run_digests, with_planted_runs

    return run_digests(collapse_runs(with_planted_runs(_table(spark, sf_dir, "documents"))))


def op13_prefix_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adjudica.llm.prefix_hashes import compare_with_next

    return compare_with_next(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_token_planes": op2_token_planes,
        "op3_mix_sources": op3_mix_sources,
        "op4_divergence_rules": op4_divergence_rules,
        "op5_kd_shards": op5_kd_shards,
        "op6_url_filter": op6_url_filter,
        "op7_best_fit_packing": op7_best_fit_packing,
        "op8_odd_sketch_near_dup": op8_odd_sketch_near_dup,
        "op9_vp_tree_search": op9_vp_tree_search,
        "op10_rule_ensemble": op10_rule_ensemble,
        "op11_filter_audit": op11_filter_audit,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_prefix_fingerprints": op13_prefix_fingerprints,
    }


def oracle_sql() -> dict[str, str]:
    from adjudica.llm import oracle

    return {
        "op3_mix_sources": oracle.OP3_SQL,
        "op4_divergence_rules": oracle.OP4_SQL,
        "op6_url_filter": oracle.op6_sql(),
        "op8_odd_sketch_near_dup": oracle.OP8_SQL,
        "op9_vp_tree_search": oracle.OP9_SQL,
        "op11_filter_audit": oracle.OP11_SQL,
    }
