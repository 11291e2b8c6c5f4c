import re

import pytest
import xxhash
from cases import DATA, documents
from pyspark.sql import functions as F

from weirline.llm import queries, simhash


def fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, bits):
    parent = {i: i for i in prints}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= bits:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


TEXTS = [None, "", " \t\n", "One two", "one TWO", "a b c", "É é ẞ", "a\x1cb c d", "x " * 60_000, "ABC abc", "a b c"]


def test_fingerprints_of_awkward_texts(spark):
    found = simhash.near_duplicates(documents(spark, TEXTS)).collect()
    assert {r.doc_id: r.fingerprint for r in found} == {
        i: f"{fingerprint(t):016x}" for i, t in enumerate(TEXTS)
    }
    components = {r.doc_id: r.component_id for r in found}
    assert components == brute_components({i: fingerprint(t) for i, t in enumerate(TEXTS)}, 2)


def test_hash_is_sparks_xxhash64(spark):
    (row,) = spark.createDataFrame([("a b c",)], "t string").select(F.xxhash64("t").alias("h")).collect()
    assert row.h % (1 << 64) == xxhash.xxh64_intdigest(b"a b c", 42)


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
@pytest.mark.parametrize("long_list", [8192, 2])
def test_links_against_brute_force(spark, monkeypatch, bits, long_list):
    monkeypatch.setattr(simhash, "LONG_LIST", long_list)
    import random

    rng = random.Random(bits)
    prints = {0, (1 << 64) - 1}
    for _ in range(25):
        base = rng.getrandbits(64)
        for _ in range(6):
            near = base
            for _ in range(rng.randrange(4)):
                near ^= 1 << rng.randrange(64)
            prints.add(near)
    signed = {simhash._signed(p): p for p in prints}
    nodes = spark.createDataFrame([(s,) for s in signed], "fp long")
    from weirline.llm.graph import components

    pairs = simhash.links(nodes, bits)
    found = {r.node: r.component for r in components(pairs).collect()}
    want = brute_components(signed, bits)
    # Labels are the smallest signed fingerprint on both sides.
    assert {s: found.get(s, s) for s in signed} == want
    if long_list > 2:
        exact = {(a, b) for a in signed for b in signed if a < b and (signed[a] ^ signed[b]).bit_count() <= bits}
        assert {tuple(r) for r in pairs.collect()} == exact


def test_keep_one(spark):
    docs = documents(spark, ["a b c d", "a b c d", "q r s t", None, "", "q r s t"])
    again = docs.union(docs.where("doc_id = 0")).union(docs.where("doc_id = 0"))
    no_id = docs.where("doc_id in (2, 5)").withColumn("doc_id", F.lit(None).cast("long"))
    kept = simhash.keep_one(again.union(no_id))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 3]
    alone = simhash.keep_one(no_id).collect()
    assert len(alone) == 1 and alone[0].text == "q r s t"
    assert simhash.keep_one(documents(spark, [])).collect() == []


def test_whole_table_against_brute_force(spark):
    found = {r.doc_id: r for r in queries.op5_simhash_dedup(spark, str(DATA)).collect()}
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    prints = {d.doc_id: fingerprint(d.text) for d in docs}
    want = brute_components(prints, 2)
    for i, p in prints.items():
        assert (found[i].fingerprint, found[i].component_id) == (f"{p:016x}", want[i])
