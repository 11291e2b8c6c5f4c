"""Conversation prefix trie by time-forward processing.

A node is a distinct sequence of first turns; its members are the conversations that
start with it. Every step of a conversation gets the digest of the turns so far as its
key, and grouping by key (combined before the shuffle) gives the nodes, their members'
number and smallest id. Texts are replaced by digests before anything is joined.

Subtree totals go from children to parents. Nodes with more than ``M`` members are
heavy; every subtree below them is a shard, sorted externally in reverse level order,
and a task goes through it with a spilling priority queue that delivers each node's
totals to its parent. The totals of shard roots, added up per heavy parent, are what the
heavy nodes start from, and those go through the same sweep. A step belongs to one node,
so there are at most steps / M heavy nodes; ``M`` grows with the steps and keeps them at
``max_heavy``, the bound of what is broadcast and of the last sweep.

A node at which many conversations end has their ids written in chunks, in parallel;
only the hash over the chunks is one task's. A conversation's steps are read by one task,
as a stream that keeps one row.

Defined results: null role and text are empty; equal turns are ordered by role, then
text; repeated rows are turns of their own; null turns come first; rows without a
conversation id belong to none and are left out; a conversation without turns is a
member of the root alone; an empty table has no node; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weirline.llm.common import cut
from weirline.llm.timeforward import MessageQueue

KEY = 16  # bytes of a SHA-256 that tell nodes apart
ROOT = bytes(KEY)
BATCH = 8192
IDS = 4096  # ids that are written into one chunk
MIN_MEMBERS = 64  # of a heavy node
MAX_HEAVY = 100_000


def steps(turns: DataFrame) -> DataFrame:
    """``conv, place`` (from 1), ``digest`` of role and text, and ``bytes`` of the text,
    of ``turns`` (``conv_id, turn, role, text``)."""
    each = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    size = F.octet_length("role").cast("string")
    digest = F.unhex(F.sha2(F.concat(size, F.lit(":"), "role", "text"), 256))
    return each.select(
        "conv", F.row_number().over(order).alias("place"), digest.alias("digest"),
        F.octet_length("text").cast("long").alias("bytes"),
    )


def spliced(own: DataFrame, every: int = 5, most: int = 9) -> DataFrame:
    """Conversations that share beginnings: of each conversation ``c`` the first ``h``
    steps of conversation ``c - c % every``, then its own after its first ``h``, with
    ``h`` the CRC-32 of the id modulo ``most``. ``own`` is read three times.

    Ids without steps have a row with a null digest."""
    h = F.crc32(F.col("conv").cast("string")) % most
    ids = own.select("conv").distinct()
    rest = own.where(F.col("place") > h).select(
        "conv", (F.col("place") + most).cast("long").alias("place"), "digest", "bytes"
    )
    shift = F.explode(F.sequence(F.lit(1 - every), F.lit(every - 1))).alias("shift")
    lent = own.where((F.col("conv") % every == 0) & (F.col("place") < most)).select(
        F.col("conv").alias("base"), F.col("place").cast("long").alias("place"), "digest", "bytes", shift
    )
    lent = lent.withColumn("conv", F.col("base") + F.col("shift"))
    lent = lent.where(
        (F.col("conv") - F.col("conv") % every == F.col("base")) & (F.col("place") <= h)
    ).join(ids, "conv", "left_semi")
    none = ids.select(
        "conv", F.lit(0).cast("long").alias("place"), F.lit(None).cast("binary").alias("digest"),
        F.lit(0).cast("long").alias("bytes"),
    )
    return rest.unionByName(lent.select(rest.columns)).unionByName(none)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH):
            part = batch.slice(start, BATCH)
            yield from zip(*(c.to_pylist() for c in part.columns), strict=True)


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    some: list[tuple] = []
    for row in rows:
        some.append(row)
        if len(some) == BATCH:
            yield _batch(some, schema)
            some = []
    if some:
        yield _batch(some, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


LONG, BYTES = pa.int64(), pa.binary()
PATHS = pa.schema(
    [("conv", LONG), ("depth", LONG), ("key", BYTES), ("parent", BYTES), ("bytes", LONG),
     ("ends", LONG)]
)


def paths(of: DataFrame) -> DataFrame:
    """A row per conversation and depth, the root included: ``conv, depth, key, parent,
    bytes, ends`` (1 where the conversation ends). ``of`` has ``conv, place, digest,
    bytes``; rows without a digest only say that the conversation is there."""

    def walk(rows: Iterator[tuple]) -> Iterator[tuple]:
        for conv, own in groupby(rows, lambda r: r[0]):
            last = (conv, 0, ROOT, None, 0)
            for _, digest, size in (r[1:] for r in own):
                if digest is not None:
                    yield (*last, 0)
                    key = sha256(last[2] + digest).digest()[:KEY]
                    last = (conv, last[1] + 1, key, last[2], size)
            yield (*last, 1)

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(walk(_rows(batches)), PATHS)

    ordered = of.select("conv", "place", "digest", "bytes").repartition("conv")
    return ordered.sortWithinPartitions("conv", "place").mapInArrow(
        walked, "conv long, depth long, key binary, parent binary, bytes long, ends long"
    )


SWEPT = pa.schema(
    [("shard", BYTES), ("key", BYTES), ("n_children", LONG), ("n_leaves", LONG), ("saved", LONG)]
)


def swept(nodes: DataFrame) -> DataFrame:
    """Totals of subtrees: ``shard, key, n_children, n_leaves, saved``. ``nodes`` has
    ``shard, depth, key, parent``, a node's ``own`` share, and what nodes outside the
    shard have sent it: ``c0, l0, s0``. Each shard has to be in one partition, in
    reverse level order. What is sent to nodes outside goes no further."""

    def sweep(rows: Iterator[tuple]) -> Iterator[tuple]:
        for shard, own in groupby(rows, lambda r: r[0]):
            queue = MessageQueue()
            for _, depth, key, parent, share, children, leaves, saved in own:
                label, total = (-depth, key), saved + share
                while queue and queue.least() < label:
                    queue.pop()  # for a node that is not of the shard
                for more, sent in queue.receive(label):
                    children, leaves, total = children + 1, leaves + more, total + sent
                leaves = leaves if children else 1
                yield shard, key, children, leaves, total
                if depth:
                    queue.send((1 - depth, parent), (leaves, total))

    def sweeps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(sweep(_rows(batches)), SWEPT)

    columns = nodes.select("shard", "depth", "key", "parent", "own", "c0", "l0", "s0")
    return columns.mapInArrow(
        sweeps, "shard binary, key binary, n_children long, n_leaves long, saved long"
    )


def _reverse_levels(nodes: DataFrame) -> DataFrame:
    return nodes.sortWithinPartitions("shard", F.col("depth").desc(), "key")


ENDS = pa.schema([("key", BYTES), ("first", LONG), ("ids", pa.string())])
HASHED = pa.schema([("key", BYTES), ("ends_sha256", pa.string())])


def ends_digests(ends: DataFrame) -> DataFrame:
    """``key, ends_sha256``: the SHA-256 of the ids of ``ends`` (``key, conv``) of a key,
    ascending, joined by commas."""

    def chunks(rows: Iterator[tuple]) -> Iterator[tuple]:
        for key, own in groupby(rows, lambda r: r[0]):
            some: list[int] = []
            for _, conv in own:
                if len(some) == IDS:
                    yield key, some[0], ",".join(map(str, some))
                    some = []
                some.append(conv)
            yield key, some[0], ",".join(map(str, some))

    def hashes(rows: Iterator[tuple]) -> Iterator[tuple]:
        for key, own in groupby(rows, lambda r: r[0]):
            digest = sha256(next(own)[2].encode())
            for _, _, ids in own:
                digest.update(b"," + ids.encode())
            yield key, digest.hexdigest()

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(chunks(_rows(batches)), ENDS)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(hashes(_rows(batches)), HASHED)

    ordered = ends.select("key", "conv").repartitionByRange("key", "conv")
    parts = ordered.sortWithinPartitions("key", "conv").mapInArrow(
        written, "key binary, first long, ids string"
    )
    return parts.repartition("key").sortWithinPartitions("key", "first").mapInArrow(
        hashed, "key binary, ends_sha256 string"
    )


def build(
    of: DataFrame, min_members: int = MIN_MEMBERS, max_heavy: int = MAX_HEAVY
) -> DataFrame:
    """The nodes of the trie of conversations ``of`` (``conv, place, digest, bytes``; see
    ``paths``): ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256``. Turn ``depth`` of conversation
    ``conv_id`` has a node's last text."""
    walked = cut(paths(of))
    own = ((F.col("n_convs") - 1) * F.col("bytes")).alias("own")
    nodes = cut(
        walked.groupBy("key").agg(
            F.min("depth").alias("depth"), F.min("parent").alias("parent"),
            F.min("bytes").alias("bytes"), F.count(F.lit(1)).alias("n_convs"),
            F.min("conv").alias("conv_id"),
        )
    )
    total = nodes.agg(F.sum("n_convs")).first()[0] or 0
    members = max(min_members, math.ceil(total / max_heavy))

    # At most total / members <= max_heavy nodes: few enough to broadcast, and for one sweep.
    heavy = nodes.where(F.col("n_convs") > members)
    light = nodes.where(F.col("n_convs") <= members)
    below = walked.join(F.broadcast(heavy.select("key")), "key", "left_anti")
    shards = below.groupBy("conv").agg(F.min(F.struct("depth", "key")).alias("s")).select(
        F.col("conv").alias("conv_id"), F.col("s.key").alias("shard")
    )
    zero = F.lit(0).cast("long")
    none = {"c0": zero, "l0": zero, "s0": zero}
    sharded = light.join(shards, "conv_id").select("shard", "depth", "key", "parent", own)
    low = cut(swept(_reverse_levels(sharded.withColumns(none).repartition("shard"))))

    sent = low.where("key = shard").join(light.select("key", "parent"), "key").groupBy("parent").agg(
        F.count(F.lit(1)).alias("c0"), F.sum("n_leaves").alias("l0"), F.sum("saved").alias("s0")
    )
    top = heavy.select(F.lit(ROOT).alias("shard"), "depth", "key", "parent", own).join(
        sent.withColumnRenamed("parent", "key"), "key", "left"
    )
    top = top.fillna(0, ["c0", "l0", "s0"]).coalesce(1)
    high = swept(_reverse_levels(top))

    totals = low.unionByName(high).drop("shard")
    # A heavy parent may have any number of children: those look it up, and are dealt by
    # their own key to the join that finds the parents of the others.
    above = heavy.select(F.col("key").alias("parent"), F.col("conv_id").alias("heavy_conv"))
    known = nodes.join(F.broadcast(above), "parent", "left").withColumn(
        "asked", F.when(F.col("heavy_conv").isNull(), F.col("parent")).otherwise(F.col("key"))
    )
    parents = light.select(F.col("key").alias("asked"), F.col("conv_id").alias("light_conv"))
    known = known.join(parents, "asked", "left")
    ended = ends_digests(walked.where("ends = 1"))
    return known.join(totals, "key").join(ended, "key", "left").select(
        "conv_id", "depth",
        F.coalesce("heavy_conv", "light_conv").alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(sha256(b"").hexdigest())).alias("ends_sha256"),
    )
