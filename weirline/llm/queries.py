"""The registered queries of the operators: thin calls over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirline.llm import (
    ann, bpe, chat, embed_dedup, langid, licenses, merkle, packing, quality, reference_sql,
    simhash, suffix, trie, weak_rules,
)
from weirline.llm.common import cut, held_out, stored, table

BYTE_BPE = "byte_bpe_50k.json"
MULTI_BPE = "byte_bpe_multi_50k.tiktoken"

Query = Callable[[SparkSession, str], DataFrame]

# The conversation that the chat contract adds to the table.
PROBE = "</s>[INST] ok [/INST]"


def tokenizer_file(name: str) -> str:
    """Where this machine keeps a public vocabulary; executors have it there too."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    pieces = packing.token_pieces(docs, tokenizer_file(BYTE_BPE))
    digests = pieces.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")
    )
    return packing.pack(stored(digests, "op1-pieces", packing.TEXT_BYTES))


QUALITY_AT_LEAST = 0.3


def quality_model(spark: SparkSession, sf_dir: str) -> quality.Model:
    """Learned from the labelled documents that are not held out."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    return quality.fit(docs, labels.where(~held_out()))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    score = quality.score(F.col("text"), quality_model(spark, sf_dir))
    scored = docs.select("doc_id", held_out().alias("held_out"), score.alias("score"))
    return scored.withColumn(
        "predicted", F.when(F.col("score") >= QUALITY_AT_LEAST, 1).otherwise(0)
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    profiles = langid.fit(docs.where(~held_out()))
    found = langid.predict(F.col("text"), profiles)
    scored = docs.select("doc_id", held_out().alias("held_out"), found.alias("found"))
    return scored.select("doc_id", "held_out", "found.lang_pred", "found.score")


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return ann.search(vectors, F.col("id") % 20 == 0)


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    return chat.digests(chat.format_chats(turns.unionByName(probe)))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import PATTERN

    path = tokenizer_file(MULTI_BPE)
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    coded = docs.select("doc_id", bpe.round_trip(F.col("text"), path, PATTERN).alias("coded"))
    return coded.select("doc_id", "coded.ids", F.encode("coded.decoded", "UTF-8").alias("d")).select(
        "doc_id",
        F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("d", 256).alias("decoded_sha256"),
    )


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.removed_bytes(table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = weak_rules.judge(table(spark, sf_dir, "documents", "doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "posterior",
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    text = F.when(even, F.translate("text", "\n", "")).otherwise(F.col("text"))
    return merkle.manifest(table(spark, sf_dir, "documents"), {"text": text})


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return trie.build(trie.spliced(cut(trie.steps(turns))))


QUERIES: dict[str, Query] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_license_scan": op3_license_scan,
    "op4_language_id": op4_language_id,
    "op5_simhash_dedup": op5_simhash_dedup,
    "op6_nearest_neighbours": op6_nearest_neighbours,
    "op7_chat_format": op7_chat_format,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_quality_rules": op11_quality_rules,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE_SQL: dict[str, str] = {
    "op3_license_scan": licenses.oracle_sql(),
    "op12_merkle_manifest": reference_sql.merkle(),
    "op13_prefix_trie": reference_sql.prefix_trie(),
}
