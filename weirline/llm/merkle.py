"""Merkle dataset manifest by time-forward processing.

Every row is a leaf: the SHA-256 of its fields. Leaves of a group, in order, and then
the roots of the groups, in order, are folded into one root, ``ARITY`` at a time. A
row's proof lists the siblings on its way to the root; folding a claimed leaf with
them gives the root if and only if the leaf is the one that was listed.

Nodes are numbered once, by a range sort, and cut into shards of ``ARITY ** levels``
consecutive ones, so a group that holds a third of the rows is many shards. A task goes
through the nodes of a shard in the order of their labels (the last leaf below, then
the height): a priority queue hands the digests of children to their parents, and a
sweep in reverse order hands each child the siblings and the rest of the way up. The
roots of the shards are the nodes of the next pass, until each group has one; then the
groups are. Suffixes come back the same way, one row a shard. Passes grow with the
logarithm of the largest group. Texts are read once and never shuffled; what moves are
digests.

Defined results: a null field is written ``-``, an empty one ``0:``; null groups and
null ids come first; rows of equal id are ordered by their digest, and equal rows get
neighbouring leaves; a single row is its own root and has an empty proof; an empty
table gives no rows; texts of any length are hashed whole; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weirline.llm.common import cut
from weirline.llm.timeforward import MessageQueue

ARITY = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BATCH = 4096
DIGEST = 32

RESULT = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
    "folded_root string, verified boolean"
)


@dataclass(frozen=True)
class Settings:
    levels: int = 6  # of a shard


def leaf_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 of fields, each as its byte count, a colon and its text, or as ``-``."""
    written = []
    for field in fields:
        text = field.cast("string")
        counted = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        written.append(F.coalesce(counted, F.lit("-")))
    return F.unhex(F.sha2(F.concat(*written), 256))


def join_digest(children: Sequence[bytes]) -> bytes:
    return sha256("".join(c.hex() for c in children).encode()).digest()


def height(n: int) -> int:
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def climb(digests: Sequence[bytes], levels: int) -> tuple[bytes, list[list[bytes]]]:
    """The root of a shard's leaves after ``levels`` levels, and the children of all its
    inner nodes in the order of their labels."""
    queue, last, inner = MessageQueue(), len(digests) - 1, []
    top = digests[-1] if not levels else b""

    def send(level: int, place: int, digest: bytes) -> None:
        """From the node at ``place`` of ``level`` to its parent."""
        up = place // ARITY
        end = min((up + 1) * ARITY ** (level + 1) - 1, last)
        queue.send((end, level + 1, up), digest)

    for place, digest in enumerate(digests if levels else ()):
        send(0, place, digest)
        while queue and queue.least()[0] == place:
            label = queue.least()
            children = queue.receive(label)
            inner.append(children)
            top = join_digest(children)
            if label[1] < levels:
                send(label[1], label[2], top)
    return top, inner


def descend(n: int, levels: int, inner: list[list[bytes]], suffix: bytes) -> Iterator[tuple[int, bytes]]:
    """Place and proof of all leaves of a shard, the last first; ``suffix`` is the proof
    of its root. Uses up ``inner``."""
    queue = MessageQueue()
    queue.send((1 - n, -levels, 0), suffix)
    while queue:
        (end, level, place), proof = queue.pop()
        if not level:
            yield -place, proof
            continue
        for i, _ in enumerate(children := inner.pop()):
            child = ARITY * -place + i
            last = min((child + 1) * ARITY ** (-level - 1) - 1, -end)
            queue.send((-last, level + 1, -child), step(children, i) + proof)


def step(children: Sequence[bytes], place: int) -> bytes:
    """One level of a proof: the place among the siblings, their number, and they."""
    siblings = [c for i, c in enumerate(children) if i != place]
    return bytes([place, len(siblings)]) + b"".join(siblings)


def steps(proof: bytes) -> Iterator[tuple[int, list[bytes]]]:
    at = 0
    while at < len(proof):
        place, n = proof[at], proof[at + 1]
        first, at = at + 2, at + 2 + n * DIGEST
        yield place, [proof[i : i + DIGEST] for i in range(first, at, DIGEST)]


def proof_digest(proof: bytes) -> bytes:
    return join_digest([s for _, siblings in steps(proof) for s in siblings])


def fold(leaf: bytes, proof: bytes) -> bytes:
    """The root that a leaf and its proof lead to."""
    for place, siblings in steps(proof):
        leaf = join_digest([*siblings[:place], leaf, *siblings[place:]])
    return leaf


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` sorted by ``group`` and ``order``, with their ``part`` and their place
    ``at``, and a row per part and group: ``base`` (rows of the group in earlier parts),
    ``first`` (place of its first row in the part), ``total``. The sort splits a hot
    group, and the sums are over parts, so no task holds a group."""
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    ordered = cut(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("at", F.monotonically_increasing_id())
    ).withColumn("part", F.shiftright("at", 33))
    sizes = ordered.groupBy(group, "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    own = Window.partitionBy(group)
    before = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        group, "part", "first",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"),
        F.sum("n").over(own).alias("total"),
    )
    return ordered, starts


def placed(rows: DataFrame, starts: DataFrame, group: str) -> DataFrame:
    """``rows`` with ``idx``, their place in the group, and the columns of ``starts``."""
    known = starts.withColumnsRenamed({group: "of group", "part": "of part"})
    same = F.col(group).eqNullSafe(F.col("of group")) & (F.col("part") == F.col("of part"))
    idx = F.col("base") + F.col("at") - F.col("first")
    return rows.join(known, same).withColumn("idx", idx)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH):
            yield from batch.slice(start, BATCH).to_pylist()


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    some = []
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


def _sharded(nodes: DataFrame) -> DataFrame:
    """Shards whole and in order: no task holds more of one than ``ARITY ** levels`` rows."""
    return nodes.repartition("grp", "shard").sortWithinPartitions("grp", "shard", "idx")


def _shard(settings: Settings) -> Column:
    return F.floor(F.col("idx") / F.lit(ARITY**settings.levels)).cast("long").alias("shard")


def _levels(total: int, settings: Settings) -> int:
    return min(settings.levels, height(total))


def forest(nodes: DataFrame, settings: Settings) -> tuple[list[DataFrame], DataFrame]:
    """Passes over ``nodes`` (``grp, total, idx, digest``: ``idx`` from 0 to ``total`` - 1
    in each ``grp``), and the ``digest`` of each ``grp``."""
    wide = ARITY**settings.levels
    schema = pa.schema(
        [("grp", pa.int64()), ("total", pa.int64()), ("idx", pa.int64()), ("digest", pa.binary())]
    )

    def roots(rows: Iterator[dict]) -> Iterator[tuple]:
        for (grp, shard), own in groupby(rows, lambda r: (r["grp"], r["shard"])):
            own = list(own)
            total = own[0]["total"]
            top, _ = climb([r["digest"] for r in own], _levels(total, settings))
            yield grp, -(-total // wide), shard, top

    def lifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(roots(_rows(batches)), schema)

    passes = []
    while (nodes.agg(F.max("total")).first()[0] or 0) > 1:
        passes.append(nodes)
        each = nodes.select("grp", "total", "idx", "digest", _shard(settings))
        nodes = cut(
            _sharded(each).mapInArrow(lifted, "grp long, total long, idx long, digest binary")
        )
    return passes, nodes.select("grp", "digest")


def _delivered(nodes: DataFrame, suffixes: DataFrame, settings: Settings) -> DataFrame:
    """``nodes`` in shards, each after the row that has the proof of its root."""
    nodes = nodes.select(*nodes.columns, _shard(settings))
    heads = suffixes.select(
        "grp", F.col("idx").alias("shard"), F.lit(-1).cast("long").alias("idx"), "proof", "subroot"
    )
    return _sharded(nodes.unionByName(heads, allowMissingColumns=True))


def _proofs(rows: Iterator[dict], settings: Settings) -> Iterator[tuple[dict, bytes, bytes]]:
    """Each node with its proof and the digest of its group's root."""
    for _, own in groupby(rows, lambda r: (r["grp"], r["shard"])):
        head, *leaves = own
        levels = _levels(leaves[0]["total"], settings)
        _, inner = climb([r["digest"] for r in leaves], levels)
        for place, proof in descend(len(leaves), levels, inner, head["proof"]):
            yield leaves[place], proof, head["subroot"]


def deliver(passes: list[DataFrame], suffixes: DataFrame, settings: Settings) -> DataFrame:
    """Proofs (``grp, idx, proof, subroot``) of the nodes of all but the first pass, from
    those of the groups (``idx`` 0), the last pass first: what the shards of the first
    pass, or else its only nodes, start from."""
    schema = pa.schema(
        [("grp", pa.int64()), ("idx", pa.int64()), ("proof", pa.binary()), ("subroot", pa.binary())]
    )

    def handed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _proofs(_rows(batches), settings)
        return _batches(((r["grp"], r["idx"], p, s) for r, p, s in found), schema)

    for nodes in reversed(passes[1:]):
        columns = nodes.select("grp", "total", "idx", "digest")
        suffixes = cut(
            _delivered(columns, suffixes, settings)
            .mapInArrow(handed, "grp long, idx long, proof binary, subroot binary")
        )
    return suffixes


def manifest(
    docs: DataFrame, tampered: Mapping[str, Column] | None = None, settings: Settings | None = None,
    *, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group_col: str = "source",
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, leaf, subroot, root, proof_sha256`` and, for a copy
    of the rows in which the columns of ``tampered`` are replaced, the ``folded_root``
    of the row with the proof of the original, and whether it is the root."""
    settings, spark = settings or Settings(), docs.sparkSession
    changed = {**{f: F.col(f) for f in fields}, **(tampered or {})}
    leaves = cut(
        docs.select(
            F.col(group_col).cast("string").alias("source"),
            F.col(id_col).cast("long").alias("doc_id"),
            leaf_digest([F.col(f) for f in fields]).alias("digest"),
            leaf_digest([changed[f] for f in fields]).alias("claimed"),
        ).withColumn("nth", F.monotonically_increasing_id())
    )
    ordered, starts = numbered(leaves, "source", ("doc_id", "digest", "nth"))
    starts = cut(starts)
    sources, places = numbered(
        starts.select("source").distinct().withColumn("one", F.lit(0)), "one", ("source",)
    )
    sources = cut(
        placed(sources, places, "one").select(
            F.col("source").alias("of source"), F.col("idx").alias("grp"), F.col("total").alias("sources")
        )
    )
    starts = starts.join(sources, F.col("source").eqNullSafe(F.col("of source")))
    nodes = cut(
        placed(ordered, starts.select("source", "part", "first", "base", "total", "grp"), "source")
        .select("grp", "total", "idx", "digest", "doc_id", "claimed")
    )
    passes, subroots = forest(nodes, settings)
    of_sources = sources.select("grp", "sources").join(subroots, "grp").select(
        F.lit(0).cast("long").alias("grp"), F.col("sources").alias("total"), F.col("grp").alias("idx"),
        "digest",
    )
    of_sources = cut(of_sources)
    top_passes, top = forest(of_sources, settings)
    found = top.first()
    if found is None:
        return spark.createDataFrame([], RESULT)
    root = bytes(found["digest"])

    start = spark.createDataFrame([(0, 0, b"", b"")], "grp long, idx long, proof binary, subroot binary")
    tops = deliver(top_passes, start, settings)
    heads = _handed_to_groups(of_sources, tops, bool(top_passes), settings)
    suffixes = deliver(passes, heads, settings)
    return _verified(nodes, suffixes, root, settings)


def _handed_to_groups(
    of_sources: DataFrame, tops: DataFrame, more: bool, settings: Settings
) -> DataFrame:
    """Proof and digest of each group's root."""
    if not more:
        return of_sources.select(
            F.col("idx").alias("grp"), F.lit(0).cast("long").alias("idx"),
            F.lit(b"").alias("proof"), F.col("digest").alias("subroot"),
        )
    schema = pa.schema(
        [("grp", pa.int64()), ("idx", pa.int64()), ("proof", pa.binary()), ("subroot", pa.binary())]
    )

    def handed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _proofs(_rows(batches), settings)
        return _batches(((r["idx"], 0, p, r["digest"]) for r, p, _ in found), schema)

    return cut(
        _delivered(of_sources, tops, settings)
        .mapInArrow(handed, "grp long, idx long, proof binary, subroot binary")
    )


def _verified(nodes: DataFrame, suffixes: DataFrame, root: bytes, settings: Settings) -> DataFrame:
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            *((c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")),
            ("verified", pa.bool_()),
        ]
    )

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for r, proof, subroot in _proofs(_rows(batches), settings):
                folded = fold(r["claimed"], proof)
                yield (
                    r["doc_id"], r["digest"].hex(), subroot.hex(), root.hex(),
                    proof_digest(proof).hex(), folded.hex(), folded == root,
                )

        return _batches(rows(), schema)

    return _delivered(nodes, suffixes, settings).mapInArrow(checked, RESULT)
