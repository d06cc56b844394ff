"""The registered queries of this subpackage: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.llm import bpe, chat, licenses, media, mixing, packing, repair, secrets, simhash, tokens, topk, toxicity, trie
from varloom.llm.common import table
from varloom.plans.registry import shipped


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20, scale=64.0)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan_paths(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), "word_bpe_49k.json", limit=2048)


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(chat.prefix_examples(chat.with_probe(table(spark, sf_dir, "conversations"))))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), tau=4, size=4)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), capacity=4096)


def op9_media_sniffing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.inspect(media.store(table(spark, sf_dir, "documents")))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), "byte_bpe_multi_50k.tiktoken")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return repair.digest(rows, repair.repair(repair.damage(rows)))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(trie.rebuilt(trie.turns_in_order(table(spark, sf_dir, "conversations"))))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_toxicity, op2_exact_topk, op3_secret_scan, op4_token_counts, op5_chat_format, op6_simhash, op7_license_scan, op8_best_fit_packing, op9_media_sniffing, op10_source_mix, op11_byte_bpe, op12_conversation_repair, op13_conversation_trie)
    return {q.__name__: shipped(q) for q in own}


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_topk": topk.ORACLE, "op5_chat_format": chat.ORACLE, "op12_conversation_repair": repair.ORACLE, "op13_conversation_trie": trie.ORACLE}
