"""Suffix-array dedup with a run-length index over candidate stretches of text.

Which bytes are in a string of ``length`` bytes that starts elsewhere too?

1. Texts. Equal texts become one with their number, compressed, in a table bucketed by
   digest: later steps bring small rows to the texts and never shuffle them again.
   All of a text that occurs twice is repeated, if it has ``length`` bytes.
2. Anchors. In each window of ``length`` bytes the smallest hash of its ``gram``-byte
   strings, the first of equals, is its anchor. Equal windows have equal anchors at the
   same place in the window, so only windows whose anchors have equal keys can be equal.
   An anchor with the windows that chose it is a stretch of text, about 1.4 windows
   long; stretches cover every window once. Keys that occur once are dropped.
3. Index. Stretches are brought together by key, equal ones as one with their number.
   A task takes its keys in batches of bounded size. Over the windows of a batch it sorts
   the suffixes, takes the Burrows-Wheeler transform, keeps its runs, and samples the text
   positions at both ends of each run, with the length of the match to the neighbour there.
   Inside a run a match is one byte shorter than that of the position before, so the
   matching statistics of all positions stream from the samples: the running maximum of
   sampled length plus position, minus the position.
4. Marks. Positions whose match with any other position is ``length`` bytes or more
   start a repeated string. Its bytes are removed from the documents.

Keys that occur more than ``hot`` times are not brought together: their windows are
counted one by one under a 128-bit digest, combined before the shuffle.

Defined results: null and empty texts have no bytes and lose none; texts are UTF-8 bytes and
read whole, in slices that overlap by a window; repeated rows count as documents of their
own; null ids are allowed; an empty table gives no rows; other columns are ignored, or
kept by ``remove``, where what is left of a cut character is dropped from the text. The
stored tables stay in the shared folder until the cluster expires them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirline.llm.common import bucketed, cut, freeing, stored

PLACE_BITS = 20  # of a slice's positions, kept below the hash when minima are taken
SLICE = (1 << PLACE_BITS) - 1


@dataclass(frozen=True)
class Settings:
    length: int = 200
    gram: int = 40
    batch_bytes: int = 1 << 19  # of stretches that are indexed together
    hot: int = 50_000  # occurrences of a key that are brought together at most

    def __post_init__(self):
        if not 1 <= self.gram < self.length:
            raise ValueError("gram must be shorter than length")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(29))


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """64-bit hash of each ``gram``-byte string, joined from parts of 1, 2, 4, ... bytes."""
    with np.errstate(over="ignore"):
        part = _mixed((data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        out, done, size = None, 0, 1
        while True:
            if gram & size:
                n = len(data) - done - size + 1
                if out is None:
                    out = part[:n].copy()
                else:
                    out = out[:n] * np.uint64(0xC2B2AE3D27D4EB4F) + part[done : done + n]
                done += size
            if done == gram:
                return _mixed(out)
            part = part[:-size] * np.uint64(0x165667B19E3779F9 + 2 * size) + part[size:]
            size *= 2


def anchors(data: np.ndarray, settings: Settings) -> tuple[np.ndarray, ...]:
    """Key, first window and last window of each anchor of one slice of text."""
    windows = len(data) - settings.length + 1
    if windows < 1:
        none = np.zeros(0, np.int64)
        return none, none, none
    hashes = gram_hashes(data, settings.gram)
    low = np.uint64((1 << PLACE_BITS) - 1)
    least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    span, have = settings.length - settings.gram + 1, 1
    while have < span:  # minima over 1, 2, 4, ... places, then over the span
        step = min(have, span - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    place = (least & low).astype(np.int64)
    firsts = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
    lasts = np.concatenate([firsts[1:] - 1, [windows - 1]])
    return hashes[place[firsts]].view(np.int64), firsts, lasts


def slices(n: int, length: int) -> Iterator[tuple[int, int]]:
    """Parts of a text of n bytes; each window lies in exactly one of them."""
    step = SLICE - length + 1
    for start in range(0, max(n - length + 1, 1), step):
        yield start, min(n, start + SLICE)


def _text_anchors(data: bytes, settings: Settings):
    whole = np.frombuffer(data, np.uint8)
    parts = []
    for start, end in slices(len(whole), settings.length):
        key, first, last = anchors(whole[start:end], settings)
        parts.append((key, first + start, last + start))
    return [np.concatenate(c) for c in zip(*parts, strict=True)]


# -- the index --------------------------------------------------------------

BORDER = 0xFF  # ends a stretch; no UTF-8 text has this byte


def _common(text: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common prefix at positions a and b, up to ``most``."""
    out, width = np.zeros(len(a), np.int64), np.arange(32)
    alive = np.flatnonzero(most > 0)
    padded = np.concatenate([text, np.zeros(64, np.uint8)])
    while len(alive):
        x, y = a[alive] + out[alive], b[alive] + out[alive]
        same = padded[x[:, None] + width] == padded[np.minimum(y, len(text))[:, None] + width]
        run = np.where(same.all(1), len(width), same.argmin(1))
        out[alive] += run
        alive = alive[(run == len(width)) & (out[alive] < most[alive])]
    return np.minimum(out, most)


class RunLengthIndex:
    """Run-compressed transform of the windows of some stretches.

    ``starts`` are the windows' positions in the text of all stretches, each closed by
    a border. No two stretches share a window of the corpus, so equal windows here are
    different places there. A match of a whole window cannot reach over a border."""

    def __init__(self, stretches: list[bytes], length: int):
        sizes = np.array([len(s) + 1 for s in stretches], np.int64)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        windows = sizes - length
        self.base = np.concatenate([[0], np.cumsum(windows)])
        self.starts = np.arange(self.base[-1]) + np.repeat(offsets[:-1] - self.base[:-1], windows)
        border = bytes([BORDER])
        data = border.join(stretches) + border
        self.text = np.frombuffer(data, np.uint8)
        ends = np.repeat(offsets[1:], windows)  # behind the border of each window's stretch

        pairs = zip(self.starts.tolist(), ends.tolist(), strict=True)
        suffixes = [data[a:b] for a, b in pairs]
        # Equal suffixes keep the order of the text, as the transform needs.
        order = np.array(sorted(range(len(suffixes)), key=suffixes.__getitem__), np.int64)
        rows = self.starts[order]
        before = self.text[np.maximum(rows - 1, 0)].astype(np.int64)
        first = np.concatenate([[True], np.diff(self.starts) != 1])[order]
        before[first] = -1 - np.arange(first.sum())  # a first window is a run of its own
        change = before[1:] != before[:-1]
        self.heads = np.flatnonzero(np.concatenate([[True], change]))
        self.tails = np.flatnonzero(np.concatenate([change, [True]]))
        up, down = self.heads[1:], self.tails[:-1]
        sampled = np.concatenate([order[up], order[down]])
        self.samples = self.starts[sampled]
        others = np.concatenate([rows[up - 1], rows[down + 1]])
        self.matches = _common(self.text, self.samples, others, ends[sampled] - 1 - self.samples)

    def statistics(self) -> np.ndarray:
        """Per window, the length of its longest match with another window."""
        best = np.full(len(self.text), -1, np.int64)
        np.maximum.at(best, self.samples, self.samples + self.matches)
        reach = np.maximum.accumulate(best)
        return np.maximum(reach[self.starts] - self.starts, 0)


def runs(marked: np.ndarray) -> np.ndarray:
    """First and last of each run of marked places, as rows."""
    edges = np.diff(np.concatenate([[0], marked.astype(np.int8), [0]]))
    return np.stack([np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) - 1], 1)


def repeated(stretches: list[bytes], numbers: list[int], length: int) -> list[np.ndarray]:
    """Per different stretch the runs of windows that occur elsewhere: all of them in
    stretches that occur more than once, else those the index finds."""
    index = RunLengthIndex(stretches, length)
    marked = index.statistics() >= length
    out = []
    for a, b, number in zip(index.base, index.base[1:], numbers, strict=False):
        out.append(np.array([[0, b - a - 1]]) if number > 1 else runs(marked[a:b]))
    return out


# -- the job ----------------------------------------------------------------

TEXT = ("h1", "h2")


def _digests(text: str):
    data = F.coalesce(F.col(text), F.lit(""))
    return F.xxhash64(data).alias("h1"), F.xxhash64(F.lit("second"), data).alias("h2")


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 5000):
    """Tuples as record batches."""
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _texts(docs: DataFrame, text_col: str, settings: Settings) -> DataFrame:
    """Different texts of at least one window: ``h1, h2, copies, text`` (compressed)."""

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            small = [press.compress(t.as_buffer()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(small, pa.binary())],
                names=["h1", "h2", "text"],
            )

    long = docs.where(F.octet_length(text_col) >= settings.length).select(
        *_digests(text_col), F.col(text_col).cast("string").alias("text")
    )
    packed = long.mapInArrow(freeing(shrink), "h1 long, h2 long, text binary")
    return packed.groupBy(*TEXT).agg(F.count(F.lit(1)).alias("copies"), F.first("text").alias("text"))


def _plain(batch: pa.RecordBatch) -> Iterator[bytes]:
    press = zstandard.ZstdDecompressor()
    for text in batch.column("text"):
        yield press.decompress(text.as_buffer())


def _anchor_rows(texts: DataFrame, settings: Settings) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2 = batch.column("h1").to_numpy(), batch.column("h2").to_numpy()
            parts = []
            for i, data in enumerate(_plain(batch)):
                key, first, last = _text_anchors(data, settings)
                parts.append((key, np.full(len(key), i), first, last))
            if parts:
                key, i, first, last = (np.concatenate(c) for c in zip(*parts, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in (key, h1[i], h2[i], first, last)],
                    names=["key", "h1", "h2", "first", "last"],
                )

    return texts.select(*TEXT, "text").mapInArrow(
        freeing(find), "key long, h1 long, h2 long, first long, last long"
    )


def _stretch_rows(wanted: DataFrame, settings: Settings) -> DataFrame:
    """Bytes of the wanted stretches. ``wanted`` has texts and their ``anchors``."""
    schema = pa.schema(
        [("key", pa.int64()), ("digest", pa.int64()), ("stretch", pa.binary()),
         ("h1", pa.int64()), ("h2", pa.int64()), ("first", pa.int64()), ("copies", pa.int64())]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            owner = [batch.column(c).to_pylist() for c in ("h1", "h2", "copies")]
            lists = batch.column("anchors")
            for i, data in enumerate(_plain(batch)):
                found = lists[i].values
                columns = (found.field(c).to_pylist() for c in ("key", "first", "last"))
                h1, h2, copies = (c[i] for c in owner)
                for key, first, last in zip(*columns, strict=True):
                    stretch = data[first : last + settings.length]
                    digest = _signed(xxhash.xxh64_intdigest(stretch))
                    yield key, digest, stretch, h1, h2, first, copies

    return wanted.mapInArrow(
        freeing(lambda batches: _batches(rows(batches), schema)),
        "key long, digest long, stretch binary, h1 long, h2 long, first long, copies long",
    )


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _index_rows(different: DataFrame, settings: Settings) -> DataFrame:
    """Runs of repeated windows by key and digest: ``key, digest, low, high``, from rows
    that hold all different stretches of a key in one partition, sorted by key."""
    schema = pa.schema([(c, pa.int64()) for c in ("key", "digest", "low", "high")])

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        """Whole keys, some at a time."""
        held, size, key = [], 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= settings.batch_bytes and row[0] != key:
                    yield held
                    held, size = [], 0
                key = row[0]
                held.append(row)
                size += len(row[2])
        if held:
            yield held

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for group in groups(batches):
            keys, digests, stretches, numbers = zip(*group, strict=True)
            alone = [
                (i == 0 or keys[i - 1] != k) and (i + 1 == len(keys) or keys[i + 1] != k)
                for i, k in enumerate(keys)
            ]
            mixed = [i for i, one in enumerate(alone) if not one]
            for i in (i for i, one in enumerate(alone) if one and numbers[i] > 1):
                yield keys[i], digests[i], 0, len(stretches[i]) - settings.length
            if mixed:
                found = repeated(
                    [stretches[i] for i in mixed], [numbers[i] for i in mixed], settings.length
                )
                for i, spans in zip(mixed, found, strict=True):
                    for low, high in spans.tolist():
                        yield keys[i], digests[i], low, high

    return different.mapInArrow(
        freeing(lambda batches: _batches(rows(batches), schema)), "key long, digest long, low long, high long"
    )


def _hot_windows(wanted: DataFrame, settings: Settings) -> DataFrame:
    """Windows of hot keys, one by one: ``w1, w2, h1, h2, copies, low, high``."""
    schema = pa.schema([(c, pa.int64()) for c in ("w1", "w2", "h1", "h2", "copies", "low", "high")])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            owner = [batch.column(c).to_pylist() for c in ("h1", "h2", "copies")]
            lists = batch.column("anchors")
            for i, data in enumerate(_plain(batch)):
                found = lists[i].values
                h1, h2, copies = (c[i] for c in owner)
                columns = (found.field(c).to_pylist() for c in ("first", "last"))
                for first, last in zip(*columns, strict=True):
                    for at in range(first, last + 1):
                        both = xxhash.xxh3_128_intdigest(data[at : at + settings.length])
                        w1, w2 = _signed(both >> 64), _signed(both & ((1 << 64) - 1))
                        yield w1, w2, h1, h2, copies, at, at

    return wanted.mapInArrow(
        freeing(lambda batches: _batches(rows(batches), schema)),
        "w1 long, w2 long, h1 long, h2 long, copies long, low long, high long",
    )


def _marks(docs: DataFrame, text_col: str, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """The texts, and per text the runs of repeated windows: ``h1, h2, runs``."""
    texts = bucketed(_texts(docs, text_col, settings), "suffix-texts", TEXT)
    anchors = stored(_anchor_rows(texts, settings), "suffix-anchors")
    # Cut, so that the join has nothing but its own shuffles below and Spark splits hot keys.
    often = cut(anchors.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    shared = cut(anchors.join(often, "key"))

    def with_text(rows: DataFrame) -> DataFrame:
        listed = rows.groupBy(*TEXT).agg(
            F.collect_list(F.struct("key", "first", "last")).alias("anchors")
        )
        return texts.join(listed.hint("merge"), list(TEXT))

    cool = shared.where(F.col("n") <= settings.hot)
    stretches = stored(_stretch_rows(with_text(cool), settings), "suffix-stretches")
    different = (
        stretches.groupBy("key", "digest")
        .agg(F.first("stretch").alias("stretch"), F.sum("copies").alias("n"))
        .repartition("key").sortWithinPartitions("key")
    )
    found = _index_rows(different, settings)
    places = stretches.select("key", "digest", *TEXT, "first").join(found, ["key", "digest"]).select(
        *TEXT, (F.col("first") + F.col("low")).alias("low"), (F.col("first") + F.col("high")).alias("high")
    )
    if not shared.where(F.col("n") > settings.hot).isEmpty():
        windows = cut(_hot_windows(with_text(shared.where(F.col("n") > settings.hot)), settings))
        twice = windows.groupBy("w1", "w2").agg(F.sum("copies").alias("n")).where("n > 1")
        places = places.unionByName(windows.join(twice, ["w1", "w2"]).select(*TEXT, "low", "high"))
    marks = places.groupBy(*TEXT).agg(F.collect_list(F.struct("low", "high")).alias("runs"))
    return texts, cut(marks)


def _cleaned(docs: DataFrame, text_col: str, settings: Settings, whole=False) -> DataFrame:
    """Texts that lose bytes: ``h1, h2, n_removed, n_spans, kept`` (bytes; if ``whole``,
    without parts of cut characters)."""
    texts, marks = _marks(docs, text_col, settings)
    schema = pa.schema(
        [("h1", pa.int64()), ("h2", pa.int64()), ("n_removed", pa.int64()),
         ("n_spans", pa.int64()), ("kept", pa.binary())]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            h1, h2, copies = (batch.column(c).to_pylist() for c in ("h1", "h2", "copies"))
            lists = batch.column("runs")
            for i, data in enumerate(_plain(batch)):
                if copies[i] > 1:
                    yield h1[i], h2[i], len(data), 1, b""
                    continue
                low, high = (lists[i].values.field(c).to_numpy() for c in ("low", "high"))
                edges = np.zeros(len(data) + 1, np.int64)
                np.add.at(edges, low, 1)
                np.add.at(edges, high + settings.length, -1)
                covered = np.cumsum(edges[:-1]) > 0
                kept = np.frombuffer(data, np.uint8)[~covered].tobytes()
                kept = kept.decode("utf-8", "ignore").encode() if whole else kept
                yield h1[i], h2[i], int(covered.sum()), len(runs(covered)), kept

    lossy = texts.join(marks.hint("merge"), list(TEXT), "left").where(
        "copies > 1 or runs is not null"
    )
    return lossy.mapInArrow(
        lambda batches: _batches(rows(batches), schema, 500),
        "h1 long, h2 long, n_removed long, n_spans long, kept binary",
    )


def removed_bytes(
    docs: DataFrame, settings: Settings | None = None, *, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    cleaned = _cleaned(docs, text_col, settings or Settings())
    digests = cleaned.select(*TEXT, "n_removed", "n_spans", F.sha2("kept", 256).alias("sha"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), *_digests(text_col),
        F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("whole"),
    )
    zero = F.lit(0).cast("long")
    return rows.join(digests, list(TEXT), "left").select(
        "doc_id", "n_bytes",
        F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("sha", "whole").alias("kept_sha256"),
    )


def remove(
    docs: DataFrame, settings: Settings | None = None, *, text_col: str = "text"
) -> DataFrame:
    """``docs`` with the repeated bytes cut out of the text; all columns and rows stay."""
    cleaned = _cleaned(docs, text_col, settings or Settings(), whole=True)
    cut_texts = cleaned.select(
        F.col("h1").alias("suffix h1"), F.col("h2").alias("suffix h2"),
        F.decode("kept", "UTF-8").alias("suffix kept"),
    )
    h1, h2 = _digests(text_col)
    rows = docs.withColumns({"suffix h1": h1, "suffix h2": h2})
    joined = rows.join(cut_texts, ["suffix h1", "suffix h2"], "left")
    text = F.coalesce(F.col("suffix kept"), F.col(text_col)).alias(text_col)
    return joined.select(*(text if c == text_col else F.col(f"`{c}`") for c in docs.columns))
