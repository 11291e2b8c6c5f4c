"""Best-fit packing by length patterns and non-negative least squares.

Only the histogram of lengths (at most ``capacity`` rows) reaches the driver. There,
few-document patterns that fill a sequence exactly are enumerated, their repeat
counts fitted to the histogram by non-negative least squares, rounded down and made
feasible, and what is left is packed best-fit, again as patterns with repeat counts.
The plan is a bounded table of slots: ranks lo to hi of a length go to sequences
base, base + 1, ... at one offset. Documents get their rank among equal lengths in
buckets, so that a length that a third of the corpus has is spread over many tasks.

Defined results: null and empty texts are one piece with the end token alone; longer
texts than a sequence are cut, the remainder first; equal lengths and repeated rows
are told apart by rank, in any order; an empty table gives no rows; no row is left
out and none is cut but those over ``capacity``.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weirline.llm.common import freeing
from weirline.llm.tokens import NOTHING, WORD_BYTES, ChunkEncoder, spelled

ROWS_PER_BUCKET = 200_000
PIECE_BATCH = 1000
TEXT_BYTES = 1 << 25  # of text that is encoded at a time, if as much comes in a batch
KEYS_AT_A_TIME = 1 << 14  # the tokenizer holds some hundred bytes a token while it works
BUCKET, PLACE, FIRST, SLOT = "pack bucket", "pack place", "pack first", "pack slot"


def _encoder(path: str) -> ChunkEncoder:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    size = tokenizer.get_vocab_size()
    # Byte-level spellings of a space and a line break: only the first token of a key has one.
    starts = np.array(
        [(tokenizer.id_to_token(i) or "").startswith(("Ġ", "Ċ")) for i in range(size)]
    )

    def encode(text: str) -> np.ndarray:
        (found,) = tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, "<u4")

    def keys(missing: pa.Array) -> pa.Array:
        texts = spelled(missing)
        slices = [texts.slice(a, KEYS_AT_A_TIME) for a in range(0, len(texts), KEYS_AT_A_TIME)]
        return pa.concat_arrays([NOTHING.slice(1), *map(some_keys, slices)])

    def some_keys(texts: pa.Array) -> pa.Array:
        whole = pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts)
        ids = encode(pc.binary_join(whole, "")[0].as_py())
        places = np.flatnonzero(starts[ids])
        if len(places) != len(texts):  # a special token hides a mark, or a key has several
            return pa.array([encode(t).tobytes() for t in texts.to_pylist()], pa.binary())
        ends = pa.array(np.append(places, len(ids)) * WORD_BYTES, pa.int32())
        return pa.BinaryArray.from_buffers(
            pa.binary(), len(texts), [None, ends.buffers()[1], pa.py_buffer(ids)]
        )

    return ChunkEncoder(keys, lambda text: encode(text).tobytes(), batch_bytes=TEXT_BYTES)


def token_pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, *,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pieces of at most ``capacity`` ids: ``doc_id, piece, start, length, ids``, the
    last as packed little-endian 32-bit ids."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
         ("length", pa.int64()), ("ids", pa.binary())]
    )
    end = struct.pack("<I", end_id)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        encode = _encoder(tokenizer_path)
        for batch in batches:
            for doc, ids in zip(batch[0].to_pylist(), encode.each(batch[1]), strict=True):
                ids += end
                n = len(ids) // WORD_BYTES
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    yield doc, piece, a, b - a, ids[a * WORD_BYTES : b * WORD_BYTES]

    @freeing
    def batched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pieces(batches)
        while some := list(islice(rows, PIECE_BATCH)):
            columns = zip(*some, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )

    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(
        batched, "doc_id long, piece int, start long, length long, ids binary"
    )


def patterns(capacity: int) -> np.ndarray:
    """Patterns of up to four lengths that fill a sequence; 0 is an unused slot."""
    whole = [(capacity, 0, 0, 0)]
    pairs = [(a, capacity - a, 0, 0) for a in range((capacity + 1) // 2, capacity)]
    more = []
    for a in range(1, capacity):
        rest = capacity - a
        for share in (0.5, 0.65, 0.8, 0.93):
            b = int(rest * share)
            more.append((a, b, rest - b, 0))
            c = int((rest - b) * share)
            more.append((a, b, c, rest - b - c))
    found = np.sort(np.array([*whole, *pairs, *more]), axis=1)[:, ::-1]
    return np.unique(found, axis=0)[::-1]


def fit_counts(shapes: np.ndarray, histogram: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative least squares: counts x >= 0 that minimise |A x - histogram|, by
    multiplicative updates (they keep x positive and never raise the error).

    ``histogram[l]`` counts length l; ``histogram[0]`` is ignored."""
    target = histogram.astype(float)
    target[0] = 0
    usable = ((shapes == 0) | (target[shapes] > 0)).all(axis=1)
    out = np.zeros(len(shapes))
    used = shapes[usable]
    if not len(used):
        return out
    mask = used > 0

    def apply(x):
        return np.bincount(used.ravel(), (x[:, None] * mask).ravel(), minlength=len(target))

    x = (target[used] * mask).sum(1) / mask.sum(1) / 8 + 1e-9
    wanted = (target[used] * mask).sum(1)
    for _ in range(rounds):
        x *= wanted / np.maximum((apply(x)[used] * mask).sum(1), 1e-12)
    out[usable] = x
    return out


def rounded(shapes: np.ndarray, counts: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """Whole counts that never use more of a length than there is."""
    counts = np.floor(counts + 1e-9)
    mask = shapes > 0
    used = np.bincount(
        shapes.ravel(), (counts[:, None] * mask).ravel(), minlength=len(histogram)
    )
    share = np.minimum(1.0, histogram / np.maximum(used, 1.0))
    share[0] = 1.0
    return np.floor(counts * share[shapes].min(axis=1) + 1e-9).astype(np.int64)


def pack_rest(histogram: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit of what is left: the longest length, then again and again the longest
    that still fits, as often as all of them last. Each step uses up one length."""
    left, capacity = histogram.astype(np.int64).copy(), len(histogram) - 1
    left[0] = 0
    below = np.zeros(capacity + 1, np.int64)  # the longest length left that is <= i
    out = []

    def refresh():
        np.maximum.accumulate(np.where(left > 0, np.arange(capacity + 1), 0), out=below)

    refresh()
    while longest := int(below[capacity]):
        shape, room, taken = [], capacity, {}
        length = longest
        while length:
            fits = min(room // length, int(left[length]) - taken.get(length, 0))
            shape += [length] * fits
            taken[length] = taken.get(length, 0) + fits
            room -= length * fits
            length = int(below[min(room, length - 1)])
        times = min(int(left[length]) // n for length, n in taken.items())
        for length, n in taken.items():
            left[length] -= n * times
        out.append((tuple(shape), times))
        refresh()
    return out


def plan(histogram: np.ndarray) -> pd.DataFrame:
    """Slots ``length, lo, base, offset``: rank lo + i of a length goes to sequence
    base + i. Sorted by length and lo; ``histogram[l]`` counts length l."""
    shapes = patterns(len(histogram) - 1)
    counts = rounded(shapes, fit_counts(shapes, histogram), histogram)
    chosen = [
        (tuple(int(v) for v in shapes[i] if v), int(counts[i])) for i in np.flatnonzero(counts)
    ]
    rest = histogram.astype(np.int64).copy()
    for shape, times in chosen:
        for length in shape:
            rest[length] -= times
    slots, sequence, rank = [], 0, np.zeros(len(histogram), np.int64)
    for shape, times in [*chosen, *pack_rest(rest)]:
        offset = 0
        for length in shape:
            slots.append((length, int(rank[length]), sequence, offset))
            rank[length] += times
            offset += length
        sequence += times
    frame = pd.DataFrame(slots, columns=["length", "lo", "base", "offset"], dtype="int64")
    return frame.sort_values(["length", "lo"], ignore_index=True)


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` (``doc_id, piece, length`` and more, computed once: see ``cut`` and
    ``stored``) with ``sequence_id`` and ``offset``."""
    counted = pieces.groupBy("length").count().toPandas()
    histogram = np.zeros(capacity + 1, np.int64)
    histogram[counted["length"]] = counted["count"]
    slots = plan(histogram)
    buckets = 1 + int(histogram.sum()) // ROWS_PER_BUCKET

    # Names that no input column has; the result's own two columns replace an input's.
    pieces = pieces.drop("sequence_id", "offset")
    bucket = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets))
    rows = pieces.withColumn(BUCKET, bucket)
    sizes = rows.groupBy("length", BUCKET).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy(BUCKET).rowsBetween(
        Window.unboundedPreceding, -1
    )
    first = sizes.select(
        "length", BUCKET, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(FIRST)
    )
    inside = Window.partitionBy("length", BUCKET).orderBy("doc_id", "piece")
    ranked = rows.withColumn(PLACE, F.row_number().over(inside) - 1).join(
        first, ["length", BUCKET]
    )

    keys = (slots["length"].to_numpy() << 40) + slots["lo"].to_numpy()
    lo, base, offset = (slots[c].to_numpy() for c in ("lo", "base", "offset"))

    @F.pandas_udf("sequence_id long, offset long")
    def slot(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(keys, (length.to_numpy() << 40) + rank.to_numpy(), "right") - 1
        return pd.DataFrame(
            {"sequence_id": base[at] + rank.to_numpy() - lo[at], "offset": offset[at]}
        )

    placed = ranked.withColumn(SLOT, slot("length", F.col(FIRST) + F.col(PLACE)))
    return placed.select(*pieces.columns, f"`{SLOT}`.sequence_id", f"`{SLOT}`.offset")
