"""Named queries of this package and their DuckDB statements where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scrubline.llm import chat, decontamination, exact_dedup, licenses, mixing, near_dedup, oracles, ranked_search, sharding, simhash, token_counts, token_store, toxicity, vector_codes
from scrubline.llm.storage import scratch, ship

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents")).drop("found")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.likenesses(table(spark, sf_dir, "documents"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(chat.probe(spark).select("conv_id", "turn", "role", "text"))
    return chat.read_back(chat.format_chats(rows, tokenizer("byte_bpe_50k.json"), scratch(spark)))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    ).drop("_key")


def tokenizer(name: str) -> str:
    """Place of a public tokenizer file; an operator takes any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards_of(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    payload, index = token_store.token_store(docs, tokenizer("word_bpe_49k.json"), 1, scratch(spark))
    return token_store.read_back(payload, token_store.look_up(index, token_store.keys_of(payload)))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_license_scan": op1_license_scan,
    "op2_simhash": op2_simhash,
    "op3_near_dedup": op3_near_dedup,
    "op4_mixing": op4_mixing,
    "op5_chat_format": op5_chat_format,
    "op6_decontamination": op6_decontamination,
    "op7_token_counts": op7_token_counts,
    "op8_sharding": op8_sharding,
    "op9_toxicity": op9_toxicity,
    "op10_token_store": op10_token_store,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_ranked_search": op12_ranked_search,
    "op13_vector_codes": op13_vector_codes,
}

ORACLES: dict[str, str] = {
    "op3_near_dedup": oracles.NEAR_DEDUP,
    "op5_chat_format": oracles.CHAT_FORMAT,
    "op6_decontamination": oracles.DECONTAMINATION,
    "op11_exact_dedup": oracles.EXACT_DEDUP,
    "op12_ranked_search": oracles.RANKED_SEARCH,
    "op13_vector_codes": oracles.VECTOR_CODES,
}
