"""From raw documents to packed training sequences, in five stages.

Each stage takes the session, the documents that its predecessor kept, and the folder
of the tables; all but the last return the columns of ``documents``. ``run`` writes each
result to the shared folder and reads it again, so that a lost executor costs one stage
at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirline.llm import langid, packing, quality, simhash, suffix
from weirline.llm.common import few_texts_at_a_time, held_out, stored, table
from weirline.llm.queries import BYTE_BPE, QUALITY_AT_LEAST, tokenizer_file

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# Texts without letters are rejected, and texts whose cosine is below the bound. A text of few
# words may have a cosine near zero, one word over and over too, so the bound holds for texts
# with enough letters in different words only. The README has the cosines it is chosen from.
LANGUAGE_AT_LEAST, LANGUAGE_LETTERS = 0.2, 160


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least the threshold."""
    few_texts_at_a_time(spark)
    labels = table(spark, sf_dir, "labels", "doc_id", "quality").where(~held_out())
    model = quality.fit(docs, labels)
    return docs.where(quality.score(F.col("text"), model) >= QUALITY_AT_LEAST)


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language: with letters, and like one of the learned languages."""
    few_texts_at_a_time(spark)
    profiles = langid.fit(docs.where(~held_out()))
    found = docs.withColumn("found language", langid.predict(F.col("text"), profiles))
    words = F.array_distinct(F.split(F.lower("text"), r"\P{L}+"))
    few = F.length(F.array_join(words, "")) < LANGUAGE_LETTERS
    kept = (F.col("found language.lang_pred") != langid.UNKNOWN) & (
        (F.col("found language.score") >= LANGUAGE_AT_LEAST) | few  # words of few texts are split
    )
    return found.where(kept).drop("found language")


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    few_texts_at_a_time(spark)
    return simhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings that occur elsewhere too; no document goes."""
    few_texts_at_a_time(spark)
    return suffix.remove(docs).withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, with their sequence and their place in it."""
    few_texts_at_a_time(spark)
    pieces = packing.token_pieces(docs, tokenizer_file(BYTE_BPE))
    digests = pieces.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")
    )
    return packing.pack(stored(digests, "pipeline-pieces"))


STAGES = [
    ("quality classifier", keep_quality),
    ("language ID", keep_language),
    ("SimHash near-dedup", keep_one_of_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("best-fit packing", pack),
]

# Models, components and repeated strings have no SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{number + 1}")
    return docs
