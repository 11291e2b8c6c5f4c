import random
import zlib
from hashlib import sha256

import pytest
from cases import DATA, documents
from pyspark.sql import functions as F

from weirline.llm import merkle as M
from weirline.llm.queries import op12_merkle_manifest
from weirline.llm.timeforward import MessageQueue

SF = str(DATA).replace("0.001", "0.01")


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    written = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row]
    return h(*written)


def runs(level):
    return [level[i : i + 3] for i in range(0, len(level), 3)]


def brute(rows, tamper):
    """Level by level, from (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))

    def tree(leaves):
        """The root, and each leaf's siblings with their places."""
        level, at, proofs = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
        while len(level) > 1:
            parts = runs(level)
            for i, place in enumerate(at):
                run, p = parts[place // 3], place % 3
                proofs[i].append((p, run[:p] + run[p + 1 :]))
                at[i] = place // 3
            level = [h(*run) for run in parts]
        return level[0], proofs

    def key(row):
        return (row[0] is not None, row[0] or 0, leaf(row))

    ordered = {s: sorted(groups[s], key=key) for s in names}
    below = {s: tree([leaf(r) for r in ordered[s]]) for s in names}
    root, above = tree([below[s][0] for s in names])
    out = []
    for s, top in zip(names, above, strict=True):
        subroot, proofs = below[s]
        for row, proof in zip(ordered[s], proofs, strict=True):
            node = leaf(tamper(row))
            for place, siblings in proof + top:
                node = h(*siblings[:place], node, *siblings[place:])
            siblings = [x for _, run in proof + top for x in run]
            out.append((row[0], leaf(row), subroot, root, h(*siblings), node, node == root))
    return sorted(out, key=str)


def tamper(row):
    doc, *rest, text = row
    if doc is not None and zlib.crc32(str(doc).encode()) % 2 == 0 and text is not None:
        text = text.replace("\n", "")
    return (doc, *rest, text)


def registered(docs, settings=None):
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    text = F.when(even, F.translate("text", "\n", "")).otherwise(F.col("text"))
    return M.manifest(docs, {"text": text}, settings)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("sizes", [[1], [3], [4], [1, 1], [2, 10, 1, 28], [40, 1, 1, 5, 1, 1, 1, 9, 1, 2, 3]])
def test_shapes_over_several_passes(spark, sizes):
    rng = random.Random(sum(sizes))
    rows = []
    for s, n in enumerate(sizes):
        for _ in range(n):
            text = rng.choice([None, "", "a\nb", "ab", "é\n\n字", "x" * 50])
            rows.append((rng.randrange(-500, 500), f"é{s}" if s else None, rng.choice([None, "en"]), len(text or ""), text))
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    docs = docs.repartition(5)
    for levels in (1, 6) if len(sizes) > 2 else (2,):
        assert found(registered(docs, M.Settings(levels))) == brute(rows, tamper)


def test_ties_nulls_and_clashing_names(spark):
    docs = documents(spark, ["same", "same", None, "", "a\nb"]).withColumn(
        "doc_id", F.when(F.col("doc_id") < 2, 7).when(F.col("doc_id") > 2, F.col("doc_id"))
    ).withColumns({c: F.lit("mine") for c in ("grp", "idx", "digest", "shard", "proof", "total", "at", "part")})
    rows = [tuple(r) for r in docs.select(*M.FIELDS).collect()]
    assert found(registered(docs)) == brute(rows, tamper)


def test_empty_table_and_no_tampering(spark):
    assert M.manifest(documents(spark, [])).collect() == []
    assert all(r.verified and r.folded_root == r.root for r in M.manifest(documents(spark, ["a", "b"])).collect())


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(*M.FIELDS).collect()]
    got = found(op12_merkle_manifest(spark, SF))
    assert got == brute(rows, tamper)
    wrong = {r[0] for r in got if not r[-1]}
    assert wrong == {r[0] for r in rows if tamper(r) != r} and wrong


@pytest.mark.parametrize("capacity", [2, 3, 10, 1000])
def test_queue_spills_and_keeps_order(capacity):
    rng, queue, kept, out = random.Random(capacity), MessageQueue(capacity), [], []
    for i in range(1500):
        label = (rng.randrange(60), rng.randrange(3))
        queue.send(label, i)
        kept.append((label, i))
        if i % 7 == 0:
            out.append(queue.pop())
            kept.sort()
            assert out[-1] == kept.pop(0)
    kept.sort()
    while queue:
        label = queue.least()
        same = [i for at, i in kept if at == label]
        assert queue.receive(label) == same
        kept = kept[len(same) :]
    assert not kept
    if capacity < 100:
        assert queue.receive((0, 0)) == []
