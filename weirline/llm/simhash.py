"""SimHash near-duplicates with an inverted index over positional bytes.

Fingerprints: bit i is set if more than half of a text's shingle hashes have it.
Fingerprints that differ in at most ``max_bits`` bits share at least 8 - max_bits of
their 8 bytes in place. The index lists fingerprints by positional bytes, two
neighbouring ones (a block) at a time: such a pair has at least 4 - max_bits of the 4
blocks whole, so it meets in the list of that many blocks. For each pair that meets,
the shared positional bytes are counted, pairs below the guaranteed minimum dropped,
and the rest verified bit by bit. A pair is looked at in the first of its lists only.

Equal fingerprints are one node, whatever their number. In lists of more than
``LONG_LIST`` fingerprints pairs are found without comparing all: members that agree
outside of ``max_bits`` chosen bits meet in groups of at most 2^max_bits members, so
cost stays in proportion to the list, and no link is lost.

Defined results: null and empty texts have fingerprint zero and are linked like any
other; texts with fewer words than a shingle are one shingle; texts of any length are
read whole; repeated rows share their component; null ids count as rows but never name
a component; an empty table gives no rows; columns besides id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirline.llm.common import cut, freeing
from weirline.llm.graph import components

BLOCKS, BLOCK_BITS = 4, 16
LONG_LIST = 8192
SEED = 42
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
SLICE = 1 << 15  # hashes whose bits are counted at a time


def fingerprint_of(text: str | None, shingle: int = 3) -> int:
    """Fingerprint as a signed 64-bit number."""
    # bytes.split() parts at space and at 09 to 0D, and lower-casing is A-Z alone.
    words = (text or "").encode("utf-8", "replace").translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    pairs = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in pairs], "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), SLICE):
        part = hashes[at : at + SLICE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    @F.pandas_udf("long")
    @freeing
    def marked(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint_of(t, shingle) for t in texts], dtype="int64")

    return marked(text)


def _blocks_of(value: Column, chosen: tuple[int, ...]) -> Column:
    mask = sum(((1 << BLOCK_BITS) - 1) << (BLOCK_BITS * b) for b in chosen)
    return value.bitwiseAND(F.lit(_signed(mask)))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _shared_bytes(difference: Column) -> Column:
    """Tally of positional bytes that two fingerprints share."""
    tally = F.lit(0)
    for place in range(8):
        same = F.shiftrightunsigned(difference, 8 * place).bitwiseAND(F.lit(255)) == 0
        tally = tally + same.cast("int")
    return tally


def links(nodes: DataFrame, max_bits: int = 2) -> DataFrame:
    """Pairs ``a < b`` of the distinct fingerprints ``nodes.fp`` with at most
    ``max_bits`` differing bits; from long lists, pairs that connect the same."""
    if not 0 <= max_bits < BLOCKS:
        raise ValueError("max_bits must leave a whole block")
    lists = list(combinations(range(BLOCKS), BLOCKS - max_bits))
    entries = F.array(
        *(
            F.struct(F.lit(i).alias("list"), _blocks_of(F.col("fp"), c).alias("bytes"))
            for i, c in enumerate(lists)
        )
    )
    postings = nodes.select("fp", F.explode(entries).alias("at")).select("fp", "at.*")
    sizes = postings.groupBy("list", "bytes").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    kept = cut(postings.join(sizes, ["list", "bytes"]))

    short = kept.where(F.col("n") <= LONG_LIST).drop("n")
    left, right = short.withColumnRenamed("fp", "a"), short.withColumnRenamed("fp", "b")
    difference = F.col("a").bitwiseXOR(F.col("b"))
    first = F.lit(None).cast("int")
    for i, c in reversed(list(enumerate(lists))):
        first = F.when(_blocks_of(difference, c) == 0, i).otherwise(first)
    pairs = left.join(right, ["list", "bytes"]).where(
        (F.col("a") < F.col("b"))
        & (F.col("list") == first)
        & (_shared_bytes(difference) >= 8 - max_bits)
        & (F.bit_count(difference) <= max_bits)
    ).select("a", "b")

    spark = nodes.sparkSession
    free = [
        (i, _signed(~sum(1 << bit for bit in bits) & ((1 << 64) - 1)))
        for i, c in enumerate(lists)
        for bits in combinations(
            [b for b in range(64) if b // BLOCK_BITS not in c], max_bits
        )
    ]
    masks = F.broadcast(spark.createDataFrame(free, "list int, mask long"))  # fixed size
    long = kept.where(F.col("n") > LONG_LIST).join(masks, "list")
    met = long.groupBy("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("rest")).agg(
        F.collect_set("fp").alias("fps")
    )
    more = met.where(F.size("fps") > 1).select(
        F.array_min("fps").alias("a"), F.explode("fps").alias("b")
    )
    return pairs.union(more.where("a < b"))


def _labelled(
    docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int
) -> tuple[DataFrame, DataFrame]:
    """Rows ``doc_id, text_hash, fp``, and ``fp, component, component_id``."""
    marked = cut(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.xxhash64(text_col).alias("text_hash"),
            fingerprint(F.col(text_col), shingle).alias("fp"),
        )
    )
    nodes = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    labels = components(links(nodes.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    labelled = nodes.join(labels, "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    named = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    return marked, labelled.join(named, "component").select("fp", "component", "component_id")


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
    max_bits: int = 2,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, fingerprint, component_id``."""
    marked, labels = _labelled(docs, id_col, text_col, shingle, max_bits)
    return marked.join(labels, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
    max_bits: int = 2,
) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id (null
    last), then text hash, then any of equal rows. Rows keep all their columns."""
    marked, labels = _labelled(docs, id_col, text_col, shingle, max_bits)
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    counted = marked.groupBy("doc_id", "text_hash", "fp").agg(F.count(F.lit(1)).alias("n"))
    best = (
        counted.join(labels, "fp").groupBy("component")
        .agg(F.min(F.struct(row.alias("row"), "n")).alias("best"))
    )
    ours = ("simhash id", "simhash text", "simhash n")
    best = cut(best.select("best.row.doc_id", "best.row.text_hash", "best.n").toDF(*ours))
    hashed = docs.withColumn("simhash own", F.xxhash64(text_col))
    same = F.col(id_col).cast("long").eqNullSafe(F.col(ours[0])) & (
        F.col("simhash own") == F.col(ours[1])
    )
    once, again = (best.where(F.col(ours[2]) == 1), best.where(F.col(ours[2]) > 1))
    kept = hashed.join(once, same, "left_semi")
    if not again.isEmpty():  # repeated rows: one of each, in a shuffle of their own
        repeated = hashed.join(again, same, "left_semi")
        kept = kept.union(repeated.dropDuplicates([id_col, "simhash own"]))
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns))
