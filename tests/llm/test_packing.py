import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cases import documents
from weirline.llm import packing
from weirline.llm.common import cut

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    None, "", " ", "One two.", "One two.", "a  b \n\n c", "don't <|endoftext|> x", "é中😀 \x1c y",
    "word, word. " * 3000, "x" * 30_000, "\n" * 5000, "tail ",
]


def packed(docs, capacity=2048):
    return packing.pack(cut(packing.token_pieces(docs, PATH, capacity)), capacity).collect()


def check_layout(rows, capacity):
    """No overlap, no gap, nothing over capacity."""
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_ids_and_pieces_are_the_tokenizers(spark):
    rows = packed(documents(spark, TEXTS))
    tokenizer = Tokenizer.from_file(PATH)
    for doc, text in enumerate(TEXTS):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        own = sorted((r for r in rows if r.doc_id == doc), key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert b"".join(r.ids for r in own) == struct.pack(f"<{len(ids)}I", *ids)
        assert [r.start for r in own] == [0, *np.cumsum([r.length for r in own])[:-1]]
        assert all(r.length == 2048 for r in own[1:])
    check_layout(rows, 2048)


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_length_once(seed):
    rng = np.random.default_rng(seed)
    capacity = 64
    histogram = np.zeros(capacity + 1, np.int64)
    for length in rng.integers(1, rng.integers(2, capacity + 1), rng.integers(1, 900)):
        histogram[length] += rng.integers(1, 4)
    slots = packing.plan(histogram)
    for length in range(1, capacity + 1):
        own = slots[slots["length"] == length]["lo"].tolist()
        assert bool(own) == bool(histogram[length])
        assert not own or own[0] == 0


def test_few_sequences(spark):
    rng = np.random.default_rng(3)
    lengths = np.minimum(rng.lognormal(6.3, 0.9, 20_000).astype(int) + 1, 2048)
    histogram = np.bincount(lengths, minlength=2049)
    rows = spark.createDataFrame(
        [(i, 0, int(n)) for i, n in enumerate(lengths)], "doc_id long, piece int, length long"
    )
    found = packing.pack(cut(rows)).collect()
    assert len(found) == len(lengths)
    used = check_layout(found, 2048)
    assert used <= 1.001 * np.ceil((histogram * np.arange(2049)).sum() / 2048) + 1


def test_counts_never_exceed_the_histogram():
    histogram = np.zeros(33, np.int64)
    histogram[[20, 12, 7, 5]] = 3, 1, 100, 1
    shapes = packing.patterns(32)
    assert (shapes.sum(1) == 32).all()
    counts = packing.rounded(shapes, packing.fit_counts(shapes, histogram), histogram)
    used = np.bincount(shapes.ravel(), np.repeat(counts, 4), minlength=33)
    assert (used[1:] <= histogram[1:]).all()


def test_hot_length_and_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(packing, "ROWS_PER_BUCKET", 50)
    rows = spark.range(1000).select(
        (F.col("id") % 7).alias("doc_id"), F.lit(0).alias("piece"),
        F.when(F.col("id") < 600, 100).otherwise(F.col("id")).alias("length"),
    )
    found = packing.pack(cut(rows)).collect()
    assert len(found) == 1000
    check_layout(found, 2048)


def test_empty_table(spark):
    assert packed(documents(spark, [])) == []


def test_crc_is_over_little_endian_ids(spark):
    row = packing.token_pieces(documents(spark, ["One two."]), PATH).select(
        "ids", F.crc32("ids").alias("crc")
    ).first()
    assert row.crc == zlib.crc32(row.ids)


def test_clashing_names(spark):
    names = ("bucket", "place", "first", "slot", "n", "sequence_id", "offset")
    pieces = spark.createDataFrame([(i, 0, 1 + i % 5) for i in range(40)], "doc_id long, piece int, length long")
    plain = packing.pack(pieces, 8).collect()
    clashing = packing.pack(pieces.withColumns({c: F.lit("mine") for c in names}), 8)
    kept = ["doc_id", "sequence_id", "offset"]
    assert clashing.columns == ["doc_id", "piece", "length", *names[:5], "sequence_id", "offset"]
    assert {r.bucket + r.place + r.first + r.slot for r in clashing.select(*names[:4]).collect()} == {"mine" * 4}
    assert sorted(clashing.select(*kept).collect()) == sorted(tuple(r[c] for c in kept) for r in plain)
